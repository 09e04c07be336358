"""Folders that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

#: Where a local session without spark.checkpoint.dir puts them.
LOCAL = "file:///tmp/skygrid-shared"
#: A process keeps all its folders in one.
RUN = f"run-{uuid.uuid4().hex}"


def base_dir(spark: SparkSession) -> str:
    """This process's folder under spark.checkpoint.dir. A local session may
    have none; nothing is set then, the folder is just elsewhere."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = LOCAL
    return f"{base.rstrip('/')}/{RUN}"


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder name."""
    return f"{base_dir(spark)}/{name}-{uuid.uuid4().hex}"


def clean_up(spark: SparkSession) -> None:
    """Removes what this process wrote to the shared folder. Tables that were
    read from there can't be read afterwards, so it is the caller's last step."""
    path = spark._jvm.org.apache.hadoop.fs.Path(base_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write and read back: later steps don't recompute what led here."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
