"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``.

    Where that is unset, a local session gets a temporary folder that goes when Python ends; on a cluster,
    whose executors could not see it, this raises ``ValueError``.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="llm-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """The rows of ``df``, computed once and written, so that lost executors cost no recomputation."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
