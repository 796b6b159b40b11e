"""Left lookup join that keeps hot and missing keys from piling up in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from uttergate.operators.sizing import broadcast_limit, estimated_bytes

KEY_BUCKETS = 65_536
# Rows of a key that one task may take; keys with more are split if they stand out.
TARGET_ROWS = 1_000_000
# A key stands out with so many times the rows of a mean bucket.
STANDS_OUT = 4
# With more bytes for each of the session's shuffle partitions, these are not merged into fewer. With less, what every
# task does once (its regular expressions are compiled, its Python worker is called) costs more than idle cores.
KEEP_BYTES = 8 << 20
# An estimate from here on stands for no estimate; the optimizer puts the largest long for tables that it knows nothing of.
UNKNOWN_BYTES = 1 << 55
# Rows without a key match nothing; they are only spread.
IDLE_SPREAD = 100_000
# Bits of the filter of left keys: 2 ** 27 are 16 MB, in 4,096 pieces.
FILTER_BITS = 1 << 27
PIECE_BITS = 32_768  # of one bitmap, fixed by the bitmap functions
# A key sets this many bits. Eight bits a key let one foreign key in twenty through.
PROBES = 2
BITS_PER_KEY = 8
# The other side has to have so many times the keys for a pass over the left keys to pay.
FILTER_PAYS = 4


def _bucket(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(KEY_BUCKETS))


def hot_buckets(df: DataFrame, key: Column, target_rows: int | None = None) -> DataFrame:
    """Key-hash buckets of more than ``target_rows`` rows that stand out, and the number of parts to cut each into.

    Reads the key column alone and shuffles at most ``KEY_BUCKETS`` counters per task. At most ``KEY_BUCKETS`` by
    ``STANDS_OUT`` buckets can stand out, whatever the input.
    """
    target_rows = target_rows or TARGET_ROWS
    counts = df.where(key.isNotNull()).groupBy(_bucket(key).alias("_ug_hot")).agg(F.count("*").alias("n"))
    mean = F.sum("n").over(Window.partitionBy()) / KEY_BUCKETS  # of KEY_BUCKETS rows at most
    limit = F.greatest(F.lit(target_rows).cast("double"), mean * STANDS_OUT)
    parts = F.ceil(F.col("n") / target_rows).cast("bigint").alias("_ug_parts")
    return counts.withColumn("_ug_limit", limit).where("n > _ug_limit").select("_ug_hot", parts, "_ug_limit")


def hot_keys(df: DataFrame, key: Column, target_rows: int | None = None) -> DataFrame:
    """The keys that have more rows than a task may take and stand out: ``_ug_hot``, and ``_ug_parts`` to cut each into.

    The buckets are a mergeable sketch: no key has more rows than its bucket, so only keys of hot buckets are counted one
    by one, exactly. A bucket that many ordinary keys share names none. There are at most ``KEY_BUCKETS`` by
    ``STANDS_OUT`` hot keys.
    """
    hot = F.broadcast(hot_buckets(df, key, target_rows).select(F.col("_ug_hot").alias("_ug_bucket"), "_ug_limit"))
    keys = df.where(key.isNotNull()).select(key.alias("_ug_hot"))
    counts = keys.join(hot, _bucket(F.col("_ug_hot")) == F.col("_ug_bucket")).groupBy("_ug_hot", "_ug_limit").agg(F.count("*").alias("n"))
    return counts.where("n > _ug_limit").select("_ug_hot", F.ceil(F.col("n") / F.col("_ug_limit")).cast("bigint").alias("_ug_parts"))


def _probes(key: Column) -> Column:
    """The filter's bits of a key, numbered from 1 as the bitmap functions do."""
    return F.array(*[F.pmod(F.xxhash64(key, F.lit(i)), F.lit(FILTER_BITS)) + 1 for i in range(PROBES)])


def key_filter(df: DataFrame, key: Column) -> DataFrame:
    """A Bloom filter of the keys in pieces, ``_ug_piece, _ug_bits``: at most ``FILTER_BITS`` bits, whatever the input.

    Pieces are built on the map side, and merged by one shuffle of at most ``FILTER_BITS`` bits a task.
    """
    bits = df.where(key.isNotNull()).select(F.explode(_probes(key)).alias("bit"))
    return bits.groupBy(F.bitmap_bucket_number("bit").alias("_ug_piece")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("_ug_bits")
    )


def thinned(df: DataFrame, key: Column, pieces: DataFrame) -> DataFrame:
    """The rows whose key the filter may hold: all that it holds, and few others. Broadcast, so nothing is shuffled."""
    for i in range(PROBES):
        bit = _probes(key)[i]
        at = F.bitmap_bit_position(bit)
        byte = F.conv(F.hex(F.substring("_ug_bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        mask = F.call_function("shiftleft", F.lit(1), (at % 8).cast("int"))
        df = df.withColumn("_ug_bit", bit).join(F.broadcast(pieces), F.bitmap_bucket_number("_ug_bit") == F.col("_ug_piece"))
        df = df.where(byte.bitwiseAND(mask) != 0).drop("_ug_bit", "_ug_piece", "_ug_bits")
    return df


def _filter_pays(left_keys: DataFrame, right_keys: DataFrame) -> bool:
    """Whether the filter holds the left keys with bits to spare and the other side has many more.

    By the optimizer's sizes, at 20 bytes a key; on either answer the join's result is the same.
    """
    keys, other = estimated_bytes(left_keys), estimated_bytes(right_keys)
    if keys is None or other is None:
        return False
    return keys / 20 * BITS_PER_KEY <= FILTER_BITS and other >= FILTER_PAYS * keys


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    eligible: Column,
    spread_by: list[str],
    values: list[str],
    out: str,
    unique: bool = False,
    target_rows: int | None = None,
    split_hot: bool = True,
    thin: bool | None = None,
) -> DataFrame:
    """Left-join ``right`` on ``key`` and add its ``values`` as struct ``out`` (null: no match).

    ``right`` is reduced to one row per key first, unless declared ``unique``. Left rows that are not ``eligible``
    match nothing, and are spread over all tasks by a key of their own. Unless the right side fits a broadcast, left
    keys with more rows than a task may take are named (see ``hot_keys``); such a key is cut into parts, with its right
    rows repeated for each, so no task gets much more than ``target_rows`` rows of a key, or ``STANDS_OUT`` times the
    rows of a mean bucket, however large its share. ``split_hot=False`` keeps the join on the bare key, as
    bucketed tables need.

    What is done to the joined rows runs in the join's tasks. The planner merges partitions by their bytes, and the few
    tasks that are left of an input of some GB leave cores idle in their last wave; so a larger left side keeps the
    session's number of shuffle partitions.

    Right rows that no left key can match are dropped by a Bloom filter before they are shuffled, where that pays (see
    ``_filter_pays``; ``thin`` says so outright). The filter is bounded, so with more keys it would let all rows through.
    """
    # Blank keys are keys no lookup row may have, as null ones are.
    usable = F.col(key).isNotNull() & (F.col(key) != "")
    right = right.where(usable).select(F.col(key).alias("_ug_rkey"), F.struct(*values).alias(out))
    size = estimated_bytes(right)
    keys = ["_ug_rkey"]
    condition = F.col("_ug_key") == F.col("_ug_rkey")
    if split_hot and (size is None or size > broadcast_limit(left)):
        partitions = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        large = not unique and KEEP_BYTES * partitions < (estimated_bytes(left) or 0) < UNKNOWN_BYTES
        left_key = F.when(eligible & usable, F.col(key))
        if thin if thin is not None else _filter_pays(left.select(key), right.select("_ug_rkey")):
            right = thinned(right, F.col("_ug_rkey"), key_filter(left, left_key))
        noise = F.xxhash64(*spread_by) + F.spark_partition_id()
        # Counted whether eligible or not: what makes a row eligible may take the whole row to tell.
        hot = F.broadcast(hot_keys(left, F.when(usable, F.col(key)), target_rows))  # KEY_BUCKETS rows at most
        left = (
            left.withColumn("_ug_key", left_key)
            .join(hot, F.col("_ug_key") == F.col("_ug_hot"), "left")
            .withColumn("_ug_salt", F.when(F.col("_ug_hot").isNull(), 0).otherwise(F.pmod(noise, F.col("_ug_parts"))))
            .drop("_ug_hot", "_ug_parts")
        )
        copies = F.when(F.col("_ug_hot").isNull(), F.expr("array(0L)")).otherwise(F.sequence(F.lit(0).cast("bigint"), F.col("_ug_parts") - 1))
        right = (
            right.join(hot, F.col("_ug_rkey") == F.col("_ug_hot"), "left")
            .withColumn("_ug_rsalt", F.explode(copies))
            .drop("_ug_hot", "_ug_parts")
        )
        keys.append("_ug_rsalt")
        condition &= F.col("_ug_salt") == F.col("_ug_rsalt")
        # A leading sign keeps the two kinds of keys apart.
        idle = F.concat(F.lit("-"), F.pmod(noise, F.lit(IDLE_SPREAD)).cast("string"))
        left = left.withColumn("_ug_key", F.coalesce(F.concat(F.lit("="), F.col("_ug_key")), idle))
        right = right.withColumn("_ug_rkey", F.concat(F.lit("="), F.col("_ug_rkey")))
        if large:  # with unique rows on the right, the planner cuts skewed partitions, which it needs its own shuffle for
            left = left.repartition(partitions, "_ug_key", "_ug_salt")
    else:
        left = left.withColumn("_ug_key", F.when(eligible & usable, F.col(key)))
    if not unique:
        # Combined map-side; grouped on the join keys, so the join needs no second shuffle.
        right = right.groupBy(*keys).agg(F.min(out).alias(out))
    joined = left.join(right, condition, "left")
    return joined.drop("_ug_key", "_ug_salt", "_ug_rkey", "_ug_rsalt")
