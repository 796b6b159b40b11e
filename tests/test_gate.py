import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from uttergate import GateConfig, publish_gate, published, rejected, run_gate, train_ready, verdict
from uttergate.functions import template
from uttergate.functions.labels import fixed_point, format_duration, path_language, safe_name
from uttergate.operators import gates
from uttergate.operators.split import VERDICT, expanded
from uttergate.plans import pipeline, report
from uttergate.schema import UTTERANCE_SCHEMA
from uttergate.sources import manifest

GOOD = dict(
    utterance_id="u",
    audio_path="s3://c/raw/hi/u.wav",
    language="hi",
    transcription_raw="naam hai kaise",
    duration_sec="4.1",
    quality_flag=0.0,
)
MESSAGE = "processing_error: cannot convert float infinity to integer"

# changed fields, expected reasons
ROWS = [
    ({}, []),
    ({"utterance_id": None}, ["missing_utterance_id"]),
    ({"utterance_id": ""}, ["missing_utterance_id"]),
    ({"audio_path": None}, ["missing_audio_path"]),
    ({"language": None}, ["missing_language"]),
    ({"language": "HI"}, []),
    ({"language": "xx"}, ["unsupported_language", "language_path_mismatch"]),
    ({"transcription_raw": None}, ["empty_transcription"]),
    ({"transcription_raw": "  \t"}, ["empty_transcription"]),
    ({"audio_path": "/local/raw/hi/u.wav"}, ["audio_file_not_found"]),
    (
        {"audio_path": "/local/raw/hi/u.wav", "utterance_id": ""},
        ["missing_utterance_id"],
    ),
    ({"duration_sec": "0"}, []),
    ({"duration_sec": "0.0"}, []),
    ({"duration_sec": None}, []),
    ({"duration_sec": ""}, []),
    ({"duration_sec": "nan"}, []),
    ({"duration_sec": "+nan"}, []),
    ({"duration_sec": "inf"}, ["duration_too_long"]),
    ({"duration_sec": "-Infinity"}, ["duration_too_short"]),
    ({"duration_sec": "0.49"}, ["duration_too_short"]),
    ({"duration_sec": "0.5"}, []),
    ({"duration_sec": "15"}, []),
    ({"duration_sec": "15.01"}, ["duration_too_long"]),
    ({"duration_sec": " 4.1 "}, []),
    ({"duration_sec": "1_0.5"}, []),
    ({"duration_sec": "1__0"}, ["invalid_duration_format"]),
    ({"duration_sec": "1.0d"}, ["invalid_duration_format"]),
    ({"duration_sec": " "}, ["invalid_duration_format"]),
    ({"duration_sec": "abc"}, ["invalid_duration_format"]),
    ({"audio_path": "s3://c/raw/bn/u.wav"}, ["language_path_mismatch"]),
    ({"audio_path": "s3://c/raw/HI/u.wav"}, []),
    ({"audio_path": "s3://c/x/u.wav"}, []),
    ({"transcription_raw": "haan"}, ["too_few_words"]),
    ({"transcription_raw": "ha ha ha ha"}, []),
    ({"transcription_raw": "ha ha ha ha ha ha"}, ["too_many_repeated_words"]),
    ({"transcription_raw": "a a a a"}, ["low_text_quality"]),
    ({"transcription_raw": "a " * 8}, ["low_text_quality", "too_many_repeated_words"]),
    (
        {"transcription_raw": "@#$%"},
        [
            "low_text_quality",
            "too_few_words",
            "too_many_repeated_words",
            "script_mismatch_empty",
        ],
    ),
    ({"transcription_raw": "12 34"}, ["script_mismatch_no_alpha"]),
    ({"transcription_raw": "ab где λόγ 日本"}, ["script_mismatch_CYRILLIC"]),
    ({"quality_flag": -1.0}, ["negative_quality_flag"]),
    ({"quality_flag": -0.5}, []),
    ({"quality_flag": -1.5}, ["negative_quality_flag"]),
    ({"quality_flag": None}, []),
    ({"quality_flag": float("nan")}, []),
    ({"quality_flag": float("inf"), "utterance_id": ""}, [MESSAGE]),
    ({"quality_flag": float("-inf")}, [MESSAGE]),
    (
        {
            "utterance_id": "",
            "duration_sec": "abc",
            "audio_path": "s3://c/raw/bn/u.wav",
            "transcription_raw": "haan",
            "quality_flag": -3.0,
        },
        [
            "missing_utterance_id",
            "invalid_duration_format",
            "language_path_mismatch",
            "too_few_words",
            "negative_quality_flag",
        ],
    ),
]


@pytest.fixture(scope="module")
def table(spark):
    rows = [{"i": i, **GOOD, **change} for i, (change, _) in enumerate(ROWS)]
    schema = T.StructType(
        [T.StructField("i", T.IntegerType())]
        + [f for f in UTTERANCE_SCHEMA.fields if f.name in GOOD]
    )
    return spark.createDataFrame(
        [tuple(r[f.name] for f in schema.fields) for r in rows], schema
    ).coalesce(2)


@pytest.fixture(scope="module")
def judged(table):
    return verdict(table).persist()


def test_reasons_and_their_order(judged):
    for r in expanded(judged).collect():
        assert r.reasons == ROWS[r.i][1], ROWS[r.i]
        assert r.is_valid == (not ROWS[r.i][1])


def test_split_is_exhaustive(judged, table):
    accepted, refused = train_ready(judged), rejected(judged)
    kept = {r.i for r in accepted.collect()} | {r.i for r in refused.collect()}
    assert kept == set(range(len(ROWS)))
    assert accepted.count() + refused.count() == len(ROWS)
    assert accepted.columns == [*table.columns, "transcription_normalized", "text_quality_score"]
    assert refused.columns == [*table.columns, "reason", "original_transcription"]
    by_row = {r.i: r for r in refused.collect()}
    for i, (change, reasons) in enumerate(ROWS):
        if reasons:
            assert by_row[i].reason == "; ".join(reasons)
            assert by_row[i].original_transcription == ({**GOOD, **change}["transcription_raw"] or "")


def test_reports(judged):
    counted = [reasons for _, reasons in ROWS if MESSAGE not in reasons]
    totals = report.run_totals(judged).first()
    valid = sum(not r for r in counted)
    assert totals.total_processed == len(counted)
    assert (totals.valid_samples, totals.rejected_samples) == (valid, len(counted) - valid)
    assert totals.valid_ratio == valid / len(counted)
    histogram = {r.reason: r.n for r in report.reason_histogram(judged).collect()}
    flat = [reason for reasons in counted for reason in reasons]
    assert histogram == {reason: flat.count(reason) for reason in flat}
    analysis = {r.reason: r.n for r in report.reason_analysis(rejected(judged)).collect()}
    assert analysis == {**histogram, MESSAGE: 2}
    top = report.top_reasons(report.reason_histogram(judged), 3).collect()
    ranked = sorted(histogram.items(), key=lambda kv: (-kv[1], kv[0]))[:3]
    assert [(r.reason, r.n) for r in top] == ranked
    doc = report.stats_document(judged).first()
    assert doc.processing_stats.rejection_reasons == histogram
    assert doc.rejection_reason_analysis == histogram
    assert tuple(doc.other_messages) == (0, 2)
    assert doc.config.audio_validation.max_duration == 15.0
    rows = {(r.category, r.key): r.value for r in report.stats_report(judged).collect()}
    assert rows["PROCESSING_STATS", "valid_ratio"] == f"{valid / len(counted):.2f}"


def test_empty_table(spark, table):
    nothing = verdict(table.limit(0))
    assert report.run_totals(nothing).first().valid_ratio == 0.0
    assert report.reason_histogram(nothing).count() == 0


def test_published_sample_rows(spark):
    rows = [
        ("utt_0001", "s3://x/raw/bn/utt_0001.wav", "hi", "naam hai kaise", "4.16", -1.0),
        ("utt_0002", "s3://x/raw/ml/utt_0002.wav", "kn", "mera hu se se", "4.5", 1.0),
        ("utt_0003", "s3://x/raw/pa/utt_0003.wav", "pa", "hu se hai dilli hai naam", "4.22", 1.0),
        ("utt_0004", "s3://x/raw/ml/utt_0004.wav", "ml", "aaya kaise aaya", "1.71", 0.0),
        ("utt_0005", "s3://x/raw/pa/utt_0005.wav", "kn", "namaste se namaste naam ho", "4.98", 0.0),
    ]
    df = spark.createDataFrame(rows, list(GOOD)).coalesce(1)
    got = {r.utterance_id: r.reasons for r in expanded(verdict(df)).collect()}
    assert got == {
        "utt_0001": ["language_path_mismatch", "negative_quality_flag"],
        "utt_0002": ["language_path_mismatch"],
        "utt_0003": [],
        "utt_0004": [],
        "utt_0005": ["language_path_mismatch"],
    }
    strict = verdict(df, GateConfig(min_duration=2.0, max_duration=8.0))
    assert {r.utterance_id: r.reasons for r in expanded(strict).collect()}["utt_0004"] == [
        "duration_too_short"
    ]
    # accepted text is a fixed point of the gate
    again = train_ready(verdict(df)).withColumn("transcription_raw", F.col("transcription_normalized"))
    assert expanded(verdict(again)).where("NOT is_valid").count() == 0


def test_typed_and_missing_columns(spark):
    base = spark.createDataFrame(
        [("u", "s3://c/x.wav", "en", "one two three", 0.1, -2), ("v", "s3://c/x.wav", "en", "one two three", 0.0, 1)],
        "utterance_id string, audio_path string, language string, transcription_raw string, "
        "duration_sec double, quality_flag int",
    )
    got = {r.utterance_id: r.reasons for r in expanded(verdict(base)).collect()}
    assert got == {"u": ["duration_too_short", "negative_quality_flag"], "v": []}
    texts = base.withColumn("quality_flag", F.lit(" -1 "))
    assert expanded(verdict(texts)).where("utterance_id = 'v'").first().reasons == ["negative_quality_flag"]
    flags = spark.createDataFrame([("-1.0",), ("x",), ("-0",), ("-1_0",)], "f string")
    reasons = flags.select(gates.flag_reason(F.col("f"), T.StringType())).collect()
    assert [r[0] for r in reasons] == [None, None, None, "negative_quality_flag"]
    assert expanded(verdict(base.drop("quality_flag"))).where("is_valid").count() == 1
    with pytest.raises(ValueError, match="language"):
        verdict(base.drop("language"))


def test_modes(table, judged):
    def reasons(config):
        return {r.i: r.reasons for r in expanded(verdict(table, config)).select("i", "reasons").collect()}

    default = {i: r for i, (_, r) in enumerate(ROWS)}
    text = {"low_text_quality", "too_few_words", "too_many_repeated_words"}

    def without(dropped):
        return {i: [x for x in r if x not in dropped] for i, r in default.items()}

    assert reasons(GateConfig().normalize_only()) == without(text)
    assert reasons(GateConfig().skip_language_mismatch()) == without({"language_path_mismatch"})
    assert reasons(GateConfig().skip_audio()) == without({"audio_file_not_found"})


def test_config_checks():
    for bad in (
        dict(min_duration=0),
        dict(max_duration=-1.0),
        dict(min_duration=5.0, max_duration=5.0),
        dict(min_text_quality_score=1.5),
        dict(max_repeated_word_ratio=-0.1),
        dict(min_word_count=-1),
        dict(audio_min_duration=9.0, audio_max_duration=3.0),
        dict(min_sample_rate=9000, max_sample_rate=8000),
        dict(min_duration=float("nan")),
        dict(train_ready_name="x", rejected_name="X"),
        dict(rejected_name="verdict"),
    ):
        with pytest.raises(ValueError):
            GateConfig(**bad)


def test_run_gate_writes_everything(spark, table, tmp_path):
    paths = run_gate(table, str(tmp_path), fmt="csv")
    back = spark.read.option("header", True).option("escape", '"').csv(paths["rejected"])
    assert back.count() == sum(bool(r) for _, r in ROWS)
    assert back.columns[-2:] == ["reason", "original_transcription"]
    accepted = spark.read.option("header", True).csv(paths["train_ready"])
    assert accepted.count() == sum(not r for _, r in ROWS)
    stats = [
        json.loads(line)
        for f in (tmp_path / "processing_stats").glob("*.json")
        for line in f.read_text().splitlines()
    ]
    assert len(stats) == 1
    assert stats[0]["processing_stats"]["total_processed"] == len(ROWS) - 2
    histogram = spark.read.json(paths["rejection_reasons"])
    assert {"reason", "n"} == set(histogram.columns)
    quiet = run_gate(table, str(tmp_path / "q"), GateConfig(include_stats=False), fmt="parquet")
    assert set(quiet) == {"verdict", "train_ready", "rejected"}


@pytest.mark.parametrize("rows", [None, 0])
def test_written_statistics_are_those_of_the_verdict(spark, table, tmp_path, rows):
    """Counters observed while the verdict is written, and reasons counted in one pass over it."""
    table = table if rows is None else table.limit(rows)
    paths = run_gate(table, str(tmp_path))
    judged = verdict(table)
    want = json.loads(report.stats_document(judged).toJSON().first())
    assert json.loads(spark.read.text(paths["processing_stats"]).first()[0]) == want
    for name, made in (("rejection_reasons", report.reason_histogram(judged)), ("rejection_reason_analysis", report.reason_analysis(rejected(judged)))):
        back = spark.read.schema("reason string, n bigint").json(paths[name])
        assert sorted(map(tuple, back.collect())) == sorted(map(tuple, made.collect()))


def test_reason_tables_take_one_pass(spark, table):
    plan = report.reason_counts(verdict(table))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 2 and "partial_count" in plan


def test_a_run_that_dies_leaves_the_published_one(spark, table, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    assert published(spark, out) == {}
    first = publish_gate(table, out, fmt="parquet")
    assert published(spark, out) == first
    accepted = spark.read.parquet(first["train_ready"]).count()

    def die(*_):
        raise OSError("no space left")

    for broken in ("write_table", "write_document"):
        with monkeypatch.context() as patch:
            patch.setattr(pipeline, broken, die)
            with pytest.raises(OSError):
                publish_gate(table.limit(1), out, fmt="parquet")
        assert published(spark, out) == first
        assert spark.read.parquet(published(spark, out)["train_ready"]).count() == accepted
    second = publish_gate(table.limit(1), out, GateConfig(include_stats=False), fmt="parquet")
    assert published(spark, out) == second and set(second) == {"verdict", "train_ready", "rejected"}
    assert spark.read.parquet(first["train_ready"]).count() == accepted  # readers of the old run go on


def test_publications_at_once_get_numbers_of_their_own(spark, tmp_path, monkeypatch):
    out = f"file://{tmp_path}"
    manifest.publish(spark, out, "run-a", ["t"])
    real, stale = manifest._numbers, [[], [], [1]]
    monkeypatch.setattr(manifest, "_numbers", lambda *a: stale.pop(0) if stale else real(*a))
    assert manifest.publish(spark, out, "run-b", ["t"]) == {"t": f"{out}/run-b/t"}  # number 1 was taken meanwhile
    monkeypatch.undo()
    assert published(spark, out) == {"t": f"{out}/run-b/t"}
    assert sorted(p.name for p in (tmp_path / manifest.FOLDER).glob("*.json")) == [f"{n:020d}.json" for n in (1, 2)]


def test_templates_fit_names_types_and_settings(spark, table):
    """A second plan takes the expressions of the first, and a config, type or column of its own gets its own."""
    verdict(table)
    made = len(template._made)
    again = verdict(table.where("i < 5"))
    assert len(template._made) == made
    strict = verdict(table, GateConfig(min_duration=5.0, max_duration=8.0))
    whole = table.where("try_cast(duration_sec AS double) < 100").withColumn("duration_sec", F.col("duration_sec").try_cast("double").try_cast("int"))
    assert len(template._made) > made
    by_row = {i: r for i, (_, r) in enumerate(ROWS)}
    assert all(r[VERDICT].reasons == by_row[r.i] for r in again.collect())
    assert strict.where("i = 0").first()[VERDICT].reasons == ["duration_too_short"]
    assert verdict(whole, GateConfig(min_duration=4.05)).where("i = 0").first()[VERDICT].reasons == ["duration_too_short"]
    assert verdict(table.drop("quality_flag")).where(F.col("i") == 0).first()[VERDICT].is_valid


def test_input_columns_survive(spark, table):
    """Names of the verdict's fields, of sinks' columns, with dots, and a verdict of an earlier gate."""
    odd = table.withColumns({c: F.concat(F.lit("in "), F.lit(c)) for c in ("audio", "script", "is_valid", "reasons", "reason", "transcription_normalized", "a.b")})
    judged = verdict(odd)
    accepted, refused = train_ready(judged), rejected(judged)
    assert set(accepted.columns) == {*odd.columns, "text_quality_score"}
    assert set(refused.columns) == {*odd.columns, "original_transcription"}
    for r in accepted.collect():
        assert (r["audio"], r["script"], r["is_valid"], r["reasons"], r["a.b"]) == ("in audio", "in script", "in is_valid", "in reasons", "in a.b")
        assert r["transcription_normalized"] != "in transcription_normalized"
    assert {r["reason"] for r in refused.collect()} == {"; ".join(x) for _, x in ROWS if x}
    again = verdict(judged.drop("is_valid"))
    assert again.columns.count(VERDICT) == 1
    assert {r.i: r[VERDICT].reasons for r in again.collect()} == {i: x for i, (_, x) in enumerate(ROWS)}


def test_missing_numbers_are_missing(spark):
    df = spark.createDataFrame([(float("nan"), "s3://c/x.wav", "en", "one two three", "1")], list(GOOD)[:5])
    assert verdict(df).first()[VERDICT].reasons == ["missing_utterance_id"]


def test_statistics_are_bounded_and_tables_whole(spark):
    rows = [dict(GOOD, utterance_id=f"u{i}", audio_path=f"/d/raw/hi/{i}.wav") for i in range(50)]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], list(GOOD))
    props = spark.createDataFrame([(f"/d/raw/hi/{i}.wav", f"bad header; offset {i}") for i in range(50)], "audio_path string, error string")
    judged = verdict(df, audio_properties=props)
    doc = report.stats_document(judged).first()
    assert doc.processing_stats.rejection_reasons == {} and doc.rejection_reason_analysis == {}
    assert tuple(doc.other_messages) == (50, 100)
    assert report.reason_histogram(judged).count() == 50
    assert report.reason_analysis(rejected(judged)).count() == 51


def test_labels(spark):
    values = [0.0, -0.0, 0.05, 0.15, 0.25, 0.35, 0.45, 2.5, 0.125, 0.375, 2.675, 1.005, 1e-9, -0.3]
    values += [59.94, 59.95, 59.96, 60.0, 3599.9, 3600.0, 5400.0, 1e9, 123456.785, -2.25]
    values += [k / 16 for k in range(1, 200, 7)] + [k / 7 for k in range(1, 300, 11)]
    values += [float("inf"), float("-inf"), float("nan"), 1e16, -1e20, 2.0**52, 2.0**53 + 2]
    df = spark.createDataFrame([(v,) for v in values], "v double").coalesce(1)
    got = df.select(
        fixed_point(F.col("v"), 1).alias("one"),
        fixed_point(F.col("v"), 2).alias("two"),
        format_duration(F.col("v")).alias("label"),
    ).collect()
    for v, r in zip(values, got):
        assert (r.one, r.two) == (f"{v:.1f}", f"{v:.2f}"), v
        short, middle = v < 60, v < 3600
        want = f"{v:.1f}s" if short else f"{v / 60:.1f}m" if middle else f"{v / 3600:.1f}h"
        assert r.label == want, v
    huge = spark.createDataFrame([(1e300,), (-1e40,)], "v double").select(format_duration(F.col("v"))).collect()
    assert all(r[0].endswith("E296h") or r[0].startswith("-1.0E40") for r in huge)
    paths = {
        "s3://b/raw/hi/x.wav": "hi",
        "raw/bn": "bn",
        "a/raw": None,
        "a/raw/": None,
        "a/raw/raw/hi": "raw",
        "a/xraw/hi/raw/te/y": "te",
        "": None,
    }
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    for r in df.select("p", path_language(F.col("p")).alias("l")).collect():
        assert r.l == paths[r.p], r.p
    df = spark.createDataFrame([("a b\t c/d-é_#!" + "x" * 60,)], "s string")
    assert df.select(safe_name(F.col("s"))).first()[0] == ("a_b_cd-é_" + "x" * 60)[:50]
