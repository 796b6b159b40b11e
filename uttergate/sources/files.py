"""File listings and content hashes.

Spark's file source passes over empty files, so they appear in neither.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from uttergate.operators.lookup import lookup_join


def _plain_path(path: Column) -> Column:
    return F.regexp_replace(path, "^file:/+", "/")


def _files(spark: SparkSession, path: str, pattern: str | None) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path)


def list_files(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """``audio_path, length`` of every file below a folder; contents are not read."""
    return _files(spark, path, pattern).select(
        _plain_path(F.col("path")).alias("audio_path"), "length"
    )


# Files up to this size are read whole, in the JVM; larger ones in pieces.
WHOLE_BYTES = 1 << 26
PIECE_BYTES = 1 << 23


def _hashed_in_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, length in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            system, name = fs.FileSystem.from_uri(path)
            md5 = hashlib.md5()
            with system.open_input_stream(name, compression=None) as f:
                while piece := f.read(PIECE_BYTES):
                    md5.update(piece)
            yield pa.RecordBatch.from_pylist([{"audio_path": path, "length": length, "md5": md5.hexdigest()}])


def hash_files(spark: SparkSession, path: str, pattern: str | None = None, whole_bytes: int = WHOLE_BYTES) -> DataFrame:
    """``audio_path, length, md5`` of every file below a folder.

    No task holds more of a file than ``whole_bytes``: the file source skips the contents of larger ones, which are read
    in pieces through Arrow's file systems, a task for each of some files.
    """
    files = _files(spark, path, pattern)
    plain = _plain_path(F.col("path")).alias("audio_path")
    whole = files.where(F.col("length") <= whole_bytes).select(plain, "length", content_hash(F.col("content")).alias("md5"))
    large = files.where(F.col("length") > whole_bytes).select(plain, "length").repartition("audio_path")
    return whole.unionAll(large.mapInArrow(_hashed_in_pieces, "audio_path string, length long, md5 string"))


def same_contents(hashes: DataFrame) -> DataFrame:
    """Hashed files with ``copies`` (files of the same contents, this one included) and ``first_path`` (the least of them).

    Contents that very many files share are looked up like any hot key.
    """
    groups = hashes.groupBy("md5").agg(F.count("*").alias("copies"), F.min("audio_path").alias("first_path"))
    joined = lookup_join(hashes, groups, "md5", F.lit(True), ["audio_path"], ["copies", "first_path"], "_ug_same", unique=True)
    return joined.select(*hashes.columns, "_ug_same.copies", "_ug_same.first_path")


def content_hash(content: Column) -> Column:
    """MD5 of binary content as hex text."""
    return F.md5(content)


def with_file_hash(df: DataFrame, hashes: DataFrame, path: str = "audio_path") -> DataFrame:
    """Add ``md5`` per path; empty text where no file was hashed."""
    joined = lookup_join(
        df,
        hashes.select(F.col("audio_path").alias(path), "md5"),
        key=path,
        eligible=F.lit(True),
        spread_by=[path],
        values=["md5"],
        out="_ug_hash",
    )
    return joined.withColumn("md5", F.coalesce("_ug_hash.md5", F.lit(""))).drop("_ug_hash")
