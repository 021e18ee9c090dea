"""Projections of bundled items to the columns of recorded rows and of policies' inputs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import c, is_finite, stamp_seconds, three

#: Fields of a sensor's record that every profile has.
RECORD = ("zarr_path", "zarr_index", "msg_package", "sensor_id", "sensor_index", "frame_idx", "capture_time", "repeated", "frame_id", "recv_time", "data_len", "data_dtype", "source_dtype")
#: Fields of a camera's description.
CAMERA = ("frame_id", "height", "width", "k", "d", "distortion_model")


def camera_info(item: Column, tick: Column, prefix: str) -> list[Column]:
    """Columns of the nearest camera description; ``available`` is false and the rest null without one.

    ``item`` is a struct of t, sec, nanosec and the description's fields.
    """
    there = item.isNotNull()
    dt = F.when(there, item["t"] - tick)
    stamp = F.when(there, stamp_seconds(item["sec"], item["nanosec"]))
    return [there.alias(f"{prefix}.available"), dt.alias(f"{prefix}.dt"), stamp.alias(f"{prefix}.ros_stamp_float"), *[F.when(there, item[n]).alias(f"{prefix}.{n}") for n in CAMERA]]


def sensor_fields(record: Column, tick: Column, prefix: str, layout: tuple[str, ...] = ()) -> list[Column]:
    """Columns of a sensor's record, with one for each key of its layout map."""
    fixed = [record[n].alias(f"{prefix}.{n}") for n in RECORD]
    stamps = [record["sec"].alias(f"{prefix}.ros_stamp_sec"), record["nanosec"].alias(f"{prefix}.ros_stamp_nanosec"), stamp_seconds(record["sec"], record["nanosec"]).alias(f"{prefix}.ros_stamp_float")]
    sync = (record["t"] - tick).alias(f"{prefix}.sync_dt")
    return [*fixed, *stamps, sync, *[F.element_at(record["layout"], k).alias(f"{prefix}.{k}") for k in layout]]


def episode_span(start: Column, finish: Column, longest: float, lateness: float) -> Column:
    """First tick's time and the time up to which ticks are decided: closed by hand or by length, and drained."""
    end = F.least(F.coalesce(finish, start + longest), start + longest)
    return F.struct(start.alias("start"), end.alias("end"), (end + lateness).alias("drained"))


def policy_input(state: str, left: str, right: str, cameras: dict[str, str]) -> Column:
    """One struct of float32 state and sensors and of images, by a policy's names."""
    images = [c(n).alias(k) for k, n in cameras.items()]
    return F.struct(c(state).cast("array<float>").alias("state"), c(left).cast("array<float>").alias("tactile_left"), c(right).cast("array<float>").alias("tactile_right"), *images)


def policy_problem(x: Column, dims: dict[str, int]) -> Column:
    """The first of a policy's vectors that is missing, of another size or not finite; null if all are sound."""
    out = F.lit(None).cast("string")
    for name, dim in reversed(dims.items()):
        sound = F.coalesce((F.size(x[name]) == dim) & F.forall(x[name], is_finite), F.lit(False))
        out = F.when(~sound, F.lit(name)).otherwise(out)
    return out


def static_transform(xyz: Column, rpy: Column) -> Column:
    """Translation and angles of a fixed frame, each made three values."""
    return F.struct(three(xyz).alias("xyz"), three(rpy).alias("rpy"))
