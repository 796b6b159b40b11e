"""Size checks against the optimizer's own estimates."""

from __future__ import annotations

from pyspark.sql import DataFrame


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of a plan, or None where the session does not expose it."""
    try:
        size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    except AttributeError:
        return None
    return int(size if isinstance(size, int) else size.toString())


def broadcast_limit(df: DataFrame) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes; -1 when broadcasting is off."""
    text = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().lower()
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}
    text = text.removesuffix("b")
    if text and text[-1] in units:
        return int(text[:-1]) * units[text[-1]]
    return int(text)
