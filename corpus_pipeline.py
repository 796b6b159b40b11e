"""From raw documents to training shards: five stages, each one operator of ``uttergate.llm``.

Each stage works on all rows that the one before kept and is written and read again in the shared folder. Every stage
but the last returns the columns it was given, whatever their names. Rows that repeat an id, or have none, are judged by
their texts like others; documents without text fail or pass the quality stage by the score of an empty text, link with
nothing, hold no benchmark passage and count as documents of no words. An empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from uttergate.llm import decontaminate, mixing, nbsvm, neardup, sharding
from uttergate.llm.queries import GOOD, quality_model
from uttergate.llm.store import staged

SHARDS = 40
NEAR = neardup.NearDup(shingle=5, percent=80, bands=32, rows=5)

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier gives a score of ``GOOD`` or more."""
    model = quality_model(spark, docs, sf_dir)
    return docs.where(nbsvm.score(model, F.col("text")) >= GOOD)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates, that with the least id (none: behind all others).

    Rows are told apart by id and text together, so those that repeat an id, or have none, are judged by their texts;
    of rows that repeat both, one stays. Repeats are merged before any shuffle.
    """
    text = F.encode("text", "UTF-8")
    key = F.xxhash64("doc_id", F.col("doc_id").isNull(), "text", F.col("text").isNull())
    keyed = docs.select(key.alias("n"), "doc_id", "text")
    found = neardup.near_duplicates(keyed, NEAR, row_id="n").select(F.col("id").alias("n"), "component").distinct()
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "n")
    stay = found.join(keyed.select("n", "doc_id").distinct(), "n").groupBy("component").agg(F.min(order)["n"].alias("n"))
    rows = docs.select(key.alias("n"), F.md5(text).alias("md5"), F.struct("*").alias("row")).dropDuplicates(["n", "md5"])
    return rows.join(stay, "n", "left_semi").select("row.*")


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's budget begins them; the one at a budget's end stays whole."""
    rows = docs.select(
        F.struct("*").alias("row"),
        "source",
        mixing.word_count(F.col("text")).alias("size"),
        mixing.random_key(F.col("doc_id"), F.col("text")).alias("key"),
    )
    taken = mixing.mixed(rows).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its ``shard`` and ``slot``, which replace columns of these names."""
    rows = docs.select(F.struct("*").alias("row"), "doc_id", F.crc32(F.encode("text", "UTF-8")).alias("crc"))
    placed = sharding.sharded(rows, ["doc_id", "crc"], SHARDS)
    kept = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    return placed.select(*[F.col("row").getField(c).alias(c) for c in kept], "shard", "slot")


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminated", decontaminated),
    ("mixed", mixed),
    ("sharded", sharded),
]
#: No SQL can express the first three stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
