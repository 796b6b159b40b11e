"""Language dimension lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uttergate.schema import language_dim


def with_language_info(df: DataFrame, language: str = "language") -> DataFrame:
    """Add ``language_name`` and ``language_script``; null for unsupported codes.

    Codes compare without case. The dimension has eleven fixed rows, so it is broadcast.
    """
    dim = language_dim(df.sparkSession).select(
        F.col("code").alias("_ug_code"),
        F.col("name").alias("language_name"),
        F.col("script").alias("language_script"),
    )
    return df.join(F.broadcast(dim), F.lower(language) == F.col("_ug_code"), "left").drop(
        "_ug_code"
    )
