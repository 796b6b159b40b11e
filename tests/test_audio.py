import re

import pytest
from pyspark.sql import functions as F

from uttergate import GateConfig, validate_paths, with_audio
from uttergate.operators import lookup
from uttergate.operators.audio import audio_counters, batch_details, batch_summary
from uttergate.operators.language import with_language_info
from uttergate.sources.files import hash_files, list_files, with_file_hash

SOUND = dict(
    sample_rate=16000,
    duration=4.0,
    num_channels=1,
    num_frames=64000,
    amplitude_mean=0.1,
    amplitude_max=0.8,
    silence_ratio=0.1,
    snr_estimate=20.0,
    error=None,
)
NAN = float("nan")
FILES = [
    ({}, []),
    ({"sample_rate": 7999}, ["sample_rate_too_low"]),
    ({"sample_rate": 8000}, []),
    ({"sample_rate": 48001}, ["sample_rate_too_high"]),
    ({"duration": 0.49}, ["duration_too_short"]),
    ({"duration": 15.0}, []),
    ({"duration": 15.1}, ["duration_too_long"]),
    ({"duration": NAN}, []),
    ({"amplitude_mean": 1e-7}, ["signal_too_weak"]),
    ({"silence_ratio": 0.81}, ["too_much_silence"]),
    ({"num_channels": 2}, ["not_mono"]),
    ({"num_channels": None}, []),
    ({"sample_rate": None, "duration": None, "amplitude_mean": None},
     ["sample_rate_too_low", "duration_too_short", "signal_too_weak"]),
    ({"sample_rate": 96000, "num_channels": 6}, ["sample_rate_too_high", "not_mono"]),
    ({"error": "bad; header"}, ["validation_error: bad; header"]),
]
SCHEMA = (
    "audio_path string, sample_rate int, duration double, num_channels int, num_frames long, "
    "amplitude_mean double, amplitude_max double, silence_ratio double, snr_estimate double, "
    "error string"
)


@pytest.fixture(scope="module")
def properties(spark):
    rows = [(f"/f{i}", *{**SOUND, **c}.values()) for i, (c, _) in enumerate(FILES)]
    return spark.createDataFrame(rows, SCHEMA).coalesce(1)


def test_property_rules_and_counters(spark, properties):
    extra = ["/missing", "s3://assumed", "/f0"]
    paths = spark.createDataFrame(
        [(f"/f{i}",) for i in range(len(FILES))] + [(p,) for p in extra], "audio_path string"
    ).coalesce(1)
    checked = with_audio(paths, properties).persist()
    got = {r.audio_path: r.audio for r in checked.collect()}
    for i, (_, issues) in enumerate(FILES):
        assert got[f"/f{i}"].issues == issues, FILES[i]
        assert got[f"/f{i}"].exists
    assert got["/missing"].issues == ["file_not_found"] and not got["/missing"].exists
    assert got["s3://assumed"].is_valid and got["s3://assumed"].exists

    n_bad = sum(bool(i) and not i[0].startswith("validation") for _, i in FILES)
    counts = audio_counters(checked).first().asDict()
    total = len(FILES) + 3
    assert counts == dict(
        total_validated=total,
        valid_files=sum(not i for _, i in FILES) + 2,
        invalid_files=n_bad,
        missing_files=1,
        corrupted_files=1,
        duration_violations=3,
        sample_rate_violations=4,
        valid_ratio=(sum(not i for _, i in FILES) + 2) / total,
        invalid_ratio=n_bad / total,
    )

    strict = validate_paths(paths, properties, GateConfig(assume_exists_prefix=None))
    summary = batch_summary(strict).first()
    assert summary.total_files == total
    assert summary.valid_files + summary.invalid_files == total
    details = batch_details(paths, properties, GateConfig(assume_exists_prefix=None))
    assert details.count() == total - 1  # /f0 is listed twice
    assert details.where("audio_path = 's3://assumed'").first().issues == ["file_not_found"]


def test_without_a_table(spark):
    df = spark.createDataFrame([("s3://a",), ("/b",)], "audio_path string")
    got = {r.audio_path: r.audio.issues for r in with_audio(df, None).collect()}
    assert got == {"s3://a": [], "/b": ["file_not_found"]}


def salted(spark, monkeypatch):
    monkeypatch.setattr(lookup, "TARGET_ROWS", 1000)
    for key, value in (
        ("spark.sql.autoBroadcastJoinThreshold", "-1"),
        ("spark.sql.adaptive.enabled", "false"),
    ):
        spark.conf.set(key, value)


@pytest.fixture
def plain_conf(spark):
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.enabled")


def test_hot_and_missing_keys_are_spread(spark, monkeypatch, plain_conf):
    n = 30000
    # a third shares one path, a third has none, the rest is unique
    left = spark.range(n).select(
        F.col("id").alias("k"),
        F.when(F.col("id") % 3 == 0, "/hot")
        .when(F.col("id") % 3 == 1, F.concat(F.lit("/p"), F.col("id")))
        .alias("path"),
    )
    right = spark.range(n).select(
        F.concat(F.lit("/p"), F.col("id")).alias("path"), (F.col("id") * 2).alias("v")
    )
    hot = spark.range(500).select(F.lit("/hot").alias("path"), (F.col("id") + 7).alias("v"))
    right = right.unionAll(hot)

    def joined(split):
        return lookup.lookup_join(
            left, right, "path", F.lit(True), ["k"], ["v"], "found", split_hot=split
        )

    want = {r.k: r.found.v if r.found else None for r in joined(False).collect()}
    salted(spark, monkeypatch)
    df = joined(True)
    buckets = lookup.hot_buckets(left, F.col("path")).collect()
    assert [r._ug_parts for r in buckets] == [10]
    rows = df.collect()
    assert len(rows) == n
    assert {r.k: r.found.v if r.found else None for r in rows} == want
    assert want[0] == 7 and want[1] == 2 and want[2] is None
    sizes = [r[0] for r in df.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert max(sizes) < n / 4
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("share", [2, 700])
def test_parts_follow_the_rows_of_a_key(spark, monkeypatch, plain_conf, share):
    """A key with half of all rows, and one below any share that would stand out, both in bounded parts."""
    salted(spark, monkeypatch)
    n, target = 140_000, 100
    left = spark.range(n).select(F.col("id").alias("k"), F.when(F.col("id") % share == 0, "/hot").otherwise(F.concat(F.lit("/p"), F.col("id"))).alias("path"))
    parts = lookup.hot_buckets(left, F.col("path"), target).collect()
    assert [r._ug_parts for r in parts] == [-(-(n // share) // target)] or parts[0]._ug_parts == n // share // target + 1  # another key may share its bucket
    right = spark.createDataFrame([("/hot", 5)], "path string, v int")
    df = lookup.lookup_join(left, right, "path", F.lit(True), ["k"], ["v"], "found", target_rows=target)
    hot = df.where("path = '/hot'")
    assert hot.where("found.v = 5").count() == n // share
    sizes = [r[0] for r in hot.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert max(sizes) < 2 * n // share // len(sizes) + 3 * target


def test_only_keys_that_stand_out_are_hot(spark, monkeypatch):
    """A bucket that ordinary keys fill names none of them; as the table grows, so does what stands out."""
    monkeypatch.setattr(lookup, "KEY_BUCKETS", 4)
    df = spark.range(4000).select(F.when(F.col("id") < 1500, "/hot").otherwise(F.concat(F.lit("/p"), F.col("id"))).alias("path"))
    assert lookup.hot_buckets(df, F.col("path"), 100).count() == 0  # 4,000 rows: none has four times the mean
    monkeypatch.setattr(lookup, "KEY_BUCKETS", 64)
    assert [(r._ug_hot, r._ug_parts) for r in lookup.hot_keys(df, F.col("path"), 20).collect()] == [("/hot", 6)]
    assert lookup.hot_keys(df.where("path <> '/hot'"), F.col("path"), 20).count() == 0


def test_the_filter_holds_every_key(spark):
    keys = spark.range(5000).select(F.concat(F.lit("/p"), F.col("id")).alias("path")).unionAll(spark.createDataFrame([(None,), ("é",)], "path string"))
    pieces = lookup.key_filter(keys, F.col("path"))
    assert pieces.count() <= lookup.FILTER_BITS // lookup.PIECE_BITS
    assert {r[0] for r in pieces.select(F.octet_length("_ug_bits")).distinct().collect()} == {lookup.PIECE_BITS // 8}
    other = keys.unionAll(spark.range(200_000).select(F.concat(F.lit("/none"), F.col("id")).alias("path")))
    passed = lookup.thinned(other, F.col("path"), pieces)
    assert passed.exceptAll(passed.intersectAll(keys)).count() < 20  # foreign keys
    assert keys.where("path IS NOT NULL").exceptAll(passed).count() == 0
    assert lookup.thinned(other, F.col("path"), lookup.key_filter(keys.limit(0), F.col("path"))).count() == 0


def test_unmatched_properties_are_not_shuffled(spark, tmp_path, plain_conf):
    """Property rows that no utterance asks for stay out of the exchange; the answers are the same."""
    n = 20_000
    paths = F.concat(F.lit("/p"), F.col("id"))
    spark.range(n).select(paths.alias("path"), (F.col("id") * 2).alias("v")).write.parquet(str(tmp_path / "props"))
    right = spark.read.parquet(str(tmp_path / "props"))
    left = spark.range(0, n, 100).select(F.col("id").alias("k"), F.when(F.col("id") % 300 != 0, paths).alias("path"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")

    def joined(thin):
        return lookup.lookup_join(left, right, "path", F.lit(True), ["k"], ["v"], "found", thin=thin)

    want = sorted((r.k, r.found and r.found.v) for r in joined(False).collect())
    df = joined(True)
    assert sorted((r.k, r.found and r.found.v) for r in df.collect()) == want
    plan = df._jdf.queryExecution().executedPlan()
    lines = plan.toString().splitlines()
    scan = next(i for i, s in enumerate(lines) if "FileScan parquet" in s)
    above = lines[:scan][::-1]
    join = next(i for i, s in enumerate(above) if "BroadcastHashJoin" in s)
    exchange = next(i for i, s in enumerate(above) if "Exchange hashpartitioning" in s)
    assert join < exchange
    usable = right.select(F.col("path").alias("_ug_rkey"))
    kept = lookup.thinned(usable, F.col("_ug_rkey"), lookup.key_filter(left, F.col("path")))
    assert kept.count() <= left.where("path IS NOT NULL").count() + 5
    assert not lookup._filter_pays(right.select("path"), left.select("path")) and lookup._filter_pays(left.limit(1).select("path"), right.select("path"))


def test_verdict_is_the_same_with_salting(spark, monkeypatch, plain_conf):
    from uttergate import verdict
    import utterance_corpus as corpus

    sf = "/root/testdata/sf0.001"

    def reasons():
        df = verdict(
            corpus.utterances(spark, sf), GateConfig(), corpus.audio_properties(spark, sf)
        )
        rows = df.select("row_n", "gate_verdict.reasons").collect()
        return sorted((r.row_n, tuple(r.reasons)) for r in rows)

    want = reasons()
    salted(spark, monkeypatch)
    assert reasons() == want


def test_bucketed_tables_join_without_shuffle(spark, tmp_path, plain_conf):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    rows = spark.range(100).select(
        F.concat(F.lit("/p"), F.col("id")).alias("audio_path"), F.col("id").alias("v")
    )
    for name in ("bucketed_utts", "bucketed_props"):
        rows.write.mode("overwrite").option("path", str(tmp_path / name)).bucketBy(
            4, "audio_path"
        ).saveAsTable(name)
    try:
        df = lookup.lookup_join(
            spark.table("bucketed_utts").where("audio_path <> ''"),
            spark.table("bucketed_props"),
            "audio_path",
            F.lit(True),
            ["audio_path"],
            ["v"],
            "found",
            split_hot=False,
            unique=True,
        )
        assert df.where("found.v = v").count() == 100
        text = df._jdf.queryExecution().executedPlan().toString()
        right = text.split("SortMergeJoin")[1]
        assert right.count("Exchange") <= 1
    finally:
        for name in ("bucketed_utts", "bucketed_props"):
            spark.sql(f"DROP TABLE {name}")


def test_language_info(spark):
    df = spark.createDataFrame([("HI",), ("en",), ("xx",), (None,)], "language string")
    got = {r.language: (r.language_name, r.language_script) for r in with_language_info(df).collect()}
    assert got == {
        "HI": ("Hindi", "Devanagari"),
        "en": ("English", "Latin"),
        "xx": (None, None),
        None: (None, None),
    }


def test_large_files_and_copies(spark, tmp_path):
    import hashlib

    from uttergate.sources.files import same_contents

    contents = {"a.wav": b"x" * 9_000_000, "b.wav": b"y", "c/d.wav": b"y", "c/é e.wav": b"x" * 9_000_000, "f.wav": b"z" * 10}
    (tmp_path / "c").mkdir()
    for name, data in contents.items():
        (tmp_path / name).write_bytes(data)
    hashes = hash_files(spark, str(tmp_path), "*.wav", whole_bytes=10)
    got = {r.audio_path: (r.length, r.md5, r.copies, r.first_path) for r in same_contents(hashes).collect()}
    path = lambda n: str(tmp_path / n)
    same = {n: sorted(m for m in contents if contents[m] == contents[n]) for n in contents}
    assert got == {path(n): (len(b), hashlib.md5(b).hexdigest(), len(same[n]), path(same[n][0])) for n, b in contents.items()}


def test_file_hashes(spark, tmp_path):
    import hashlib

    (tmp_path / "a.wav").write_bytes(b"RIFF" * 5000)
    (tmp_path / "b.wav").write_bytes(b"")
    (tmp_path / "c.txt").write_bytes(b"no")
    hashes = hash_files(spark, str(tmp_path), "*.wav")
    got = {r.audio_path: (r.length, r.md5) for r in hashes.collect()}
    assert got == {
        str(tmp_path / "a.wav"): (20000, hashlib.md5(b"RIFF" * 5000).hexdigest()),
    }
    # the file source lists no empty files
    assert list_files(spark, str(tmp_path)).count() == 2
    df = spark.createDataFrame([(str(tmp_path / "a.wav"),), ("/none",)], "audio_path string")
    hashed = {r.audio_path: r.md5 for r in with_file_hash(df, hashes).collect()}
    assert hashed["/none"] == "" and len(hashed[str(tmp_path / "a.wav")]) == 32


def test_a_large_left_side_keeps_its_partitions(spark, monkeypatch, tmp_path):
    """The planner merges shuffled rows into few partitions, but not when they are many (mode_thresholds, F9)."""
    rows = [(f"s3://{i % 40}", i, "x" * 50) for i in range(400)] + [(None, 400, ""), ("", 401, "")]
    unsized = spark.createDataFrame(rows, "p string, n int, t string")
    unsized.write.parquet(str(tmp_path / "left"))
    stored = spark.read.parquet(str(tmp_path / "left"))
    right = spark.createDataFrame([(f"s3://{i}", i) for i in range(0, 80, 2)] + [("s3://0", 7)], "p string, v int")
    every = spark.conf.get("spark.sql.shuffle.partitions")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for left, keep, kept in (stored, lookup.KEEP_BYTES, False), (stored, 0, True), (unsized, 0, False):
            monkeypatch.setattr(lookup, "KEEP_BYTES", keep)
            joined = lookup.lookup_join(left, right, "p", F.lit(True), ["n"], ["v"], "found")
            plan = joined._jdf.queryExecution().executedPlan().toString()
            dealt = re.findall(r"Exchange hashpartitioning\(_ug_key#\d+, _ug_salt#\d+L?, (\d+)\), (\w+)", plan)
            assert dealt == [(every, "REPARTITION_BY_NUM" if kept else "ENSURE_REQUIREMENTS")]
            got = sorted((r.n, r.found and r.found.v) for r in joined.collect())
            assert got == [(n, int(p[5:]) if p and int(p[5:]) % 2 == 0 else None) for p, n, _ in rows]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
