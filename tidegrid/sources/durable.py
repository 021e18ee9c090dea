"""Intermediate tables that outlive executors, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where that is unset, a temporary folder, on one machine only.

    On a cluster other machines would not see such a folder, so there it is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    context = spark.sparkContext
    own = context._jsc.sc().getCheckpointDir()
    if own.isEmpty():
        if not context.master.startswith("local[") and context.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that the whole cluster shares")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tidegrid-"))
        own = context._jsc.sc().getCheckpointDir()
    return own.get().rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed when the application ends."""
    path = f"{shared_dir(spark)}/tidegrid-{name}-{uuid.uuid4().hex}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def saved(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written to the shared folder and read again, which cuts its lineage."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
