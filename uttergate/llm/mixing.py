"""Mixing sources to target weights.

Every document gets a hash-random key. Rows are range-sorted by source, key and a running id, which splits equal keys over
tasks, and cut into pieces of ``BUCKET_ROWS`` rows; sums of partitions and of pieces give the words before each piece and
a window inside it the words before each document. Only numbers are sorted; texts wait. A document is
taken as often as its source's budget goes over it: whole rounds over the source first, then the part of the last
round that its prefix still leaves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .rownumbers import INDEX_BITS, expanded, without
from .store import staged

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
BUCKET_ROWS = 2048
SEED = "mix-1"
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def random_key(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """Random, but the same in every run; equal only for rows equal in both."""
    parts = [F.coalesce(c, F.lit("null")) for c in (doc_id.cast("string"), F.md5(F.encode(text, "UTF-8")))]
    return F.md5(F.concat_ws(":", F.lit(seed), *parts))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``source_size`` by ``source`` (a row for each) with ``target``: the words each is to give.

    Sources by code point, null last, weigh ``weights``, repeating. Together they give the words of all sources;
    none gives more than ``max_epochs`` times its own. Filling by weight up to these limits stops, in ascending
    order of limit by weight, at the first source below its limit: there and behind, words go by weight.
    """
    ranked = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cap = F.col("source_size") * max_epochs
    full = Window.orderBy((cap.cast("double") / F.col("weight")), F.col("rank"))
    past = full.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum(cap).over(past), F.lit(0))
    still = F.sum("weight").over(full.rowsBetween(0, Window.unboundedFollowing))
    each = left.cast("double") / still.cast("double")
    out = (
        sizes.withColumn("rank", ranked)
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.pmod("rank", F.lit(len(weights))) + 1).cast("int")))
        .withColumn("each", each)
        .withColumn("below", F.col("each") * F.col("weight") < cap)
    )
    first = F.min(F.when(F.col("below"), F.struct(cap.cast("double") / F.col("weight"), "rank", "each"))).over(Window.partitionBy())
    level = first["each"]
    return out.withColumn("level", level).select(
        "source",
        "source_size",
        "rank",
        F.when(level.isNull(), cap.cast("double"))
        .otherwise(F.least(level * F.col("weight"), cap.cast("double")))
        .alias("target"),
    )


def mixed(
    df: DataFrame,
    size: str = "size",
    source: str = "source",
    key: str = "key",
    weights: tuple[int, ...] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
) -> DataFrame:
    """``df`` with ``source_size``, ``target``, ``taken`` (words, repeats counted) and ``copies`` (times it is begun).

    The words taken of a source are its target, rounded. Documents of no words are taken 0 words; they count as
    begun where their prefix is. Rows of a null source are a source. Rows with equal keys are taken one after the
    other; only such rows, when equal in key and size, could swap. Empty tables give empty tables. Columns of
    ``df`` are kept, whatever their names, but for those named as the new ones, in any case, which are replaced.
    """
    named = [F.col(f"`{c}`").alias(n) for c, n in ((size, "size"), (source, "source"), (key, "key"))]
    rows = staged(df.select(F.struct("*").alias("row"), *named, F.monotonically_increasing_id().alias("id")), "mix")
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sums, weights, max_epochs).select(F.struct("source").alias("of"), "source_size", "target", "rank")
    ranked = rows.select(F.struct("source").alias("of"), "size", "key", "id").join(targets, "of").drop("of")
    order = ["rank", "key", "size", "id"]
    ranges = ranked.repartitionByRange(*order).sortWithinPartitions(*order)
    cut = staged(ranges.withColumn("at", F.monotonically_increasing_id()), "mix-order")
    index = F.col("at").bitwiseAND((1 << INDEX_BITS) - 1)
    cut = cut.withColumns({"part": F.shiftrightunsigned("at", INDEX_BITS), "piece": F.floor(index / BUCKET_ROWS)})
    pieces = cut.groupBy("rank", "part", "piece").agg(F.sum("size").alias("words"))
    earlier = lambda *by: Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)
    so_far = lambda name, *by: F.coalesce(F.sum(name).over(earlier(*by)), F.lit(0))
    parts = pieces.groupBy("rank", "part").agg(F.sum("words").alias("words"))  # a row for each partition of a source
    parts = parts.select("rank", "part", so_far("words", "rank", "part").alias("part_base"))
    pieces = pieces.select("rank", "part", "piece", so_far("words", "rank", "part", "piece").alias("piece_base")).join(parts, ["rank", "part"])
    prefix = F.col("part_base") + F.col("piece_base") + F.col("inside")
    budget = F.floor(F.col("target") + 0.5).cast("long")
    rounds = F.when(F.col("source_size") > 0, F.expr("budget DIV source_size")).otherwise(F.lit(0))
    placed = (
        cut.withColumn("inside", so_far("size", "rank", "part", "piece", "at"))
        .join(pieces, ["rank", "part", "piece"])
        .select("id", "size", "source_size", "target", prefix.alias("prefix"), budget.alias("budget"))
        .withColumn("rounds", rounds)
        .withColumn("rest", F.col("budget") - F.col("rounds") * F.col("source_size"))
    )
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("prefix")))
    begun = F.col("rounds") + (F.col("prefix") < F.col("rest")).cast("long")
    taken = placed.select("id", "source_size", "target", (F.col("rounds") * F.col("size") + part).cast("long").alias("taken"), begun.alias("copies"))
    new = ("source_size", "target", "taken", "copies")
    return rows.select("row", "id").join(taken, "id").select(*expanded("row", without(df.columns, new)), *new)
