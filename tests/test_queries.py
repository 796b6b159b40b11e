"""Every registered query against its SQL counterpart, and the shape of the plans."""

import hashlib
import math
import pathlib
import re

import duckdb
import pytest
from conftest import SMALL

import __spark_entry__ as entry
from uttergate import GateConfig, train_ready, verdict
import utterance_corpus as corpus

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


def comparable(rows):
    def cell(v):
        return "NaN" if isinstance(v, float) and math.isnan(v) else v

    return sorted((tuple(map(cell, r)) for r in rows), key=lambda r: tuple(map(str, r)))


WITHOUT_SQL = {"pipeline", "audio_hash"}  # files are no tables; see test_audio_hash


def test_every_query_has_a_counterpart():
    assert {q for q in QUERIES if not q.startswith("op")} - WITHOUT_SQL <= set(ORACLE) <= set(QUERIES)


def test_audio_hash(spark):
    files = {p.name: p.read_bytes() for p in pathlib.Path(SMALL).glob("*.parquet")}
    md5 = {n: hashlib.md5(b).hexdigest() for n, b in files.items()}
    same = {n: sorted(m for m in md5 if md5[m] == md5[n]) for n in md5}
    got = {tuple(r) for r in entry.audio_hash(spark, SMALL).collect()}
    assert got == {(n, len(b), md5[n], len(same[n]), same[n][0]) for n, b in files.items()}


def test_statistics_read_the_gate_once(spark):
    plan = physical(entry.stats_document(spark, SMALL))
    assert plan.count("ArrowEvalPython") == 2


@pytest.mark.parametrize("name", sorted(q for q in ORACLE if not q.startswith("op")))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    columns = sorted(df.columns)
    got = comparable(tuple(r[c] for c in columns) for r in df.collect())
    answer = duck.execute(ORACLE[name])
    names = [d[0] for d in answer.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    want = comparable(tuple(r[i] for i in at) for r in answer.fetchall())
    assert got == want


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["reason", "n"]
    assert df.count() > 0


def test_verdict_plan(spark):
    df = verdict(
        corpus.utterances(spark, SMALL), GateConfig(), corpus.audio_properties(spark, SMALL)
    )
    plan = physical(df)
    assert plan.count("ArrowEvalPython") == 2
    assert "BatchEvalPython" not in plan
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan
    # filters on a verdict do not repeat the gate below the Python steps
    filtered = physical(train_ready(df))
    assert len(filtered) < 1.5 * len(plan)
    assert filtered.count("ArrowEvalPython") == 2


def test_scans_are_pruned(spark):
    plan = physical(entry.duration_gate(spark, SMALL))
    assert all("text" not in s for s in re.findall(r"ReadSchema: struct<(.*?)>", plan))
    plan = physical(entry.text_normalize(spark, SMALL))
    assert all("n_chars" not in s for s in re.findall(r"ReadSchema: struct<(.*?)>", plan))


def test_a_second_gate_does_not_repeat_the_first(spark):
    assert physical(entry.regate(spark, SMALL)).count("ArrowEvalPython") == 2


def test_hot_paths_are_counted_without_texts(spark, tmp_path):
    corpus.utterances(spark, SMALL).write.parquet(str(tmp_path / "u"))
    corpus.audio_properties(spark, SMALL).write.parquet(str(tmp_path / "p"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.maxMetadataStringLength": "10000"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        plan = physical(verdict(spark.read.parquet(str(tmp_path / "u")), None, spark.read.parquet(str(tmp_path / "p"))))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum("transcription_raw" in s for s in re.findall(r"ReadSchema: struct<(.*?)>", plan)) == 1


def test_filters_reach_the_scan(spark, tmp_path):
    corpus.utterances(spark, SMALL).write.parquet(str(tmp_path / "u"))
    stored = spark.read.parquet(str(tmp_path / "u"))
    assert "EqualTo(language,hi)" in physical(verdict(stored.where("language = 'hi'")))
    assert "EqualTo(language,hi)" in physical(verdict(stored, where="language = 'hi'"))


def test_histogram_combines_before_the_shuffle(spark):
    plan = physical(entry.reason_histogram(spark, SMALL))
    assert "partial_count" in plan


@pytest.mark.parametrize("name", ["run_totals", "top_reasons", "rejected", "mode_thresholds"])
def test_unasked_parts_are_pruned(spark, name):
    """Queries that need neither the trace nor the share of punctuation don't compute them."""
    plan = entry.queries()[name](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "diacritics_removed" not in plan and "AS _ug_before" not in plan
    assert "AS _ug_m_punctuation_ratio" not in plan and "AS _ug_m_quality_score" in plan
