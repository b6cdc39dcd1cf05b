"""Tables and files between steps, in a folder that driver and executors share."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; where it is unset, a temporary one, in local mode only."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="tierlex-")
        atexit.register(shutil.rmtree, path, True)
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def _delete(spark: SparkSession, path: str) -> None:
    try:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the session may be gone at exit
        pass


def new_path(spark: SparkSession, name: str = "table") -> str:
    """A path in the folder that nothing uses yet; it is deleted at exit."""
    path = f"{folder(spark)}/tierlex-{name}-{os.getpid()}-{uuid.uuid4().hex}"
    atexit.register(_delete, spark, path)
    return path


def kept(df: DataFrame) -> DataFrame:
    """The same rows as a table that was written: lost executors, and further readers, cost no more than reading it."""
    path = new_path(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
