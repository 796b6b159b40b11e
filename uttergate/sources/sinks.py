"""Result sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Write one result table; CSV uses doubled quotes and keeps white space and emptiness."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer = (
            writer.option("header", True)
            .option("escape", '"')
            .option("emptyValue", "")
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
        )
    writer.format(fmt).save(path)


def write_document(df: DataFrame, path: str) -> None:
    """Write a one-row document as a single JSON file."""
    df.coalesce(1).write.mode("overwrite").json(path)
