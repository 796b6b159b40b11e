"""Utterance scans and the column contract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from uttergate.schema import MALFORMED, NA_TOKENS, NUMERIC_COLUMNS, REQUIRED_COLUMNS

_RECORD = "_ug_record"
# Possessive, so that long fields need no stack.
_QUOTED = r'(^|,)"[^"]*+(?:""[^"]*+)*+"(?=,|$)'


def _malformed(record: Column, last: Column, columns: int) -> Column:
    """Whether a record that the reader marked has more fields than columns, or a quote that nothing closes.

    ``last`` is the last column's value, which only a record with too many fields can have: one with too few is filled
    up with nulls, as it would be without this check.
    """
    bare = F.regexp_replace(record, _QUOTED, "$1")
    surplus = last.isNotNull() | (F.size(F.split(bare, ",")) > columns)
    return record.isNotNull() & (surplus | bare.rlike('(^|,)"'))


def scan_csv(spark: SparkSession, path: str, multi_line: bool = True, keep_malformed: bool = False) -> DataFrame:
    """Read utterance CSV files with a header; missing-value texts become null.

    Quotes are escaped by doubling and a quoted field may hold line breaks, for which a file must be read whole.
    ``multi_line=False`` is for files known to have none: they are then split over tasks. Columns keep their names
    and order; all are text except the numeric ones.

    A record with too few fields has nulls for the rest. One with too many, or with a quote that is never closed, loses
    what has no column. With ``keep_malformed`` such a record is one row of nulls with its whole text in the column
    ``MALFORMED``, for which the gate rejects it; an open quote takes the rest of its file into one record.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    names = reader.csv(path).columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    if keep_malformed:
        schema.add(_RECORD, T.StringType())
        # A parser told to skip columns doesn't see that a record has too many.
        reader = reader.option("columnNameOfCorruptRecord", _RECORD).option("columnPruning", False)
    df = reader.schema(schema).option("enforceSchema", False).csv(path)

    def clean(name: str):
        col = F.when(~F.col(f"`{name}`").isin(NA_TOKENS), F.col(f"`{name}`"))
        return (col.try_cast("double") if name in NUMERIC_COLUMNS else col).alias(name)

    if not keep_malformed:
        return df.select(*[clean(n) for n in names])
    bad = _malformed(F.col(_RECORD), F.col(f"`{names[-1]}`"), len(names))
    cells = [F.when(~bad, clean(n)).alias(n) for n in names]
    return df.select(*cells, F.when(bad, F.col(_RECORD)).alias(MALFORMED))


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Read utterance parquet files as they are."""
    return spark.read.parquet(path)


def column_contract(df: DataFrame, required: list[str] | None = None) -> DataFrame:
    """One row: ``valid, total_rows, total_columns, missing_columns, available_columns``."""
    required = REQUIRED_COLUMNS if required is None else required
    missing = [c for c in required if c not in df.columns]

    def names(values: list[str]):
        return F.array(*[F.lit(v) for v in values]).cast("array<string>")

    return df.agg(F.count("*").alias("total_rows")).select(
        F.lit(not missing).alias("valid"),
        "total_rows",
        F.lit(len(df.columns)).cast("bigint").alias("total_columns"),
        names(missing).alias("missing_columns"),
        names(df.columns).alias("available_columns"),
    )
