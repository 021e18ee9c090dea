"""Explicit schemas of raw and exported datasets; nothing is inferred."""

from __future__ import annotations

# fixed values: column names and sizes of recorded datasets
REQUIRED = ["timestamp", "frame_index", "episode_index", "index", "task_index", "observation.state", "action", "action.sent_action8", "image.path", "wrist_image.path", "tactile.left.zarr_index", "tactile.right.zarr_index", "sync.dt_image", "sync.dt_wrist_image", "sync.dt_action", "sync.dt_state", "sync.dt_tactile_left", "sync.dt_tactile_right"]
VECTORS = {"observation.state": 7, "action": 7, "action.sent_action8": 8, "action.pose7": 7, "robot.ee_pose": 7}
SYNC = ["sync.dt_image", "sync.dt_wrist_image", "sync.dt_action", "sync.dt_state", "sync.dt_vr", "sync.dt_tactile_left", "sync.dt_tactile_right", "action.http_latency_ms", "robot.latency_ms"]
MERGE_REQUIRED = ["episode_index", "frame_index", "index", "image.path", "wrist_image.path", "tactile.left.zarr_index", "tactile.right.zarr_index"]
COMPATIBLE = ["dataset_type", "tactile_msg_package", "fps", "state_dim", "action_dim"]
EXPORT_VECTORS = ["observation.state", "action", "observation.tactile_left", "observation.tactile_right"]
RAW_META = ["side", "zarr_index", "episode_index", "frame_index", "timestamp", "wall_time", "sensor_id", "sensor_index", "frame_idx", "capture_time", "repeated", "ros_stamp_float", "recv_time", "sync_dt", "data_len", "data_dtype", "source_dtype", "msg_package", "layout_json"]
EXPORT_META = ["side", "global_index", "episode_index", "frame_index", "timestamp", "task_index", "dtype"]

SIDES = ("left", "right")

# fixed values: fields of logs, in their order
EPISODE_LOG = "episode_index long, num_frames long, data_path string, image_dir string, wrist_image_dir string, tactile_left_zarr string, tactile_right_zarr string, task_index long, task_description string, source_raw_root string, source_episode_path string"
METADATA_LOG = "episode_index long, frame_index long, zarr_path string, zarr_index long, timestamp double, wall_time double, sensor_id string, sensor_index long, frame_idx long, capture_time double, repeated boolean, ros_stamp_sec long, ros_stamp_nanosec long, ros_stamp_float double, frame_id string, recv_time double, sync_dt double, data_len long, data_dtype string, source_dtype string, msg_package string, layout map<string,long>"
IMAGE_LOG = "episode_index long, record_frame_index long, path string, height long, width long, encoding string, source_encoding string, step long, ros_stamp_sec long, ros_stamp_nanosec long, ros_stamp_float double, frame_id string, topic string"
COMMAND_LOG = "type string, command_type string, pose_commanded boolean, gripper_commanded boolean, t_event double, wall_time double, action8 array<double>, pose7 array<double>, target_gripper double, target_gripper_width double, enabled boolean, workspace_clipped boolean, http struct<route:string,ok:boolean,error:string,t_send_start:double,t_send_end:double,latency_ms:double>"
STATE_LOG = "type string, ok boolean, error string, t_query_start double, t_query_end double, t_query_mid double, wall_time double, latency_ms double, state string"
