import pytest
from pyspark.sql import functions as F

from uttergate import column_contract, rejected, scan_csv, train_ready, verdict
from uttergate.operators.split import VERDICT
from uttergate.plans import report
from uttergate.plans.report import completeness
from uttergate.schema import MALFORMED
from uttergate.sources.sinks import write_table
from uttergate.streaming.incremental import gate_new_files

HEADER = "﻿utterance_id,audio_path,language,transcription_raw,duration_sec,quality_flag,mood\n"
BODY = (
    'u1,s3://c/raw/hi/1.wav,hi,"line one\nsays ""two""",4.2,-1,calm\n'
    "u2,NA,hi,null,abc,x,\n"
    'u3,s3://c/3.wav,n/a,"  kept, spaces  ",,0,NaN\n'
)


def test_csv_scan(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text(HEADER + BODY, encoding="utf-8")
    df = scan_csv(spark, str(path))
    assert df.columns == HEADER.strip().lstrip("﻿").split(",")
    rows = {r.utterance_id: r for r in df.collect()}
    assert set(rows) == {"u1", "u2", "u3"}
    assert rows["u1"].transcription_raw == 'line one\nsays "two"'
    assert rows["u1"].quality_flag == -1.0 and rows["u1"].mood == "calm"
    assert rows["u2"].audio_path is None and rows["u2"].transcription_raw is None
    assert rows["u2"].duration_sec == "abc" and rows["u2"].quality_flag is None
    assert rows["u3"].language is None and rows["u3"].duration_sec is None
    assert rows["u3"].transcription_raw == "  kept, spaces  " and rows["u3"].mood is None
    reasons = {r.utterance_id: r.reasons for r in verdict(df).select("utterance_id", "gate_verdict.reasons").collect()}
    assert reasons["u1"] == ["negative_quality_flag"]
    assert reasons["u2"] == [
        "missing_audio_path",
        "empty_transcription",
        "invalid_duration_format",
    ]


RAGGED = (
    'utterance_id,audio_path,language,transcription_raw,duration_sec\n'
    'u1,s3://c/1.wav,hi,"kya, haal hai",4.2\n'
    'u2,s3://c/2.wav,hi,naam kya hai\n'
    'u3,s3://c/3.wav,hi,naam, kya hai,4.2\n'
    'u4,s3://c/4.wav,hi,"ek ""do"" teen",4.2,\n'
    'u5,s3://c/5.wav,hi,"a,b","c,d"\n'
    'u6,s3://c/6.wav,hi,ek do"teen,4.2\n'
)


@pytest.mark.parametrize("multi_line", [True, False])
def test_malformed_records_are_rows(spark, tmp_path, multi_line):
    """Records with a field too many, the last one empty too; short ones are filled up, and quoted commas are no fields."""
    (tmp_path / "a.csv").write_text(RAGGED)
    df = scan_csv(spark, str(tmp_path), multi_line, keep_malformed=True)
    bad = sorted(r[0] for r in df.select(MALFORMED).collect() if r[0])
    lines = RAGGED.splitlines()
    assert bad == [lines[3], lines[4]]
    assert df.select(MALFORMED).count() == df.count() == 6
    assert all(v is None for r in df.where(F.col(MALFORMED).isNotNull()).collect() for v in r[:-1])
    assert {r.utterance_id for r in df.where(F.col(MALFORMED).isNull()).collect()} == {"u1", "u2", "u5", "u6"}
    judged = verdict(df)
    errors = judged.where(F.col(MALFORMED).isNotNull()).select(f"{VERDICT}.reasons").collect()
    assert [r.reasons for r in errors] == [["processing_error: malformed record"]] * 2
    assert MALFORMED not in train_ready(judged).columns
    assert {r[MALFORMED] for r in rejected(judged).collect() if r[MALFORMED]} == set(bad)
    doc = report.stats_document(judged).first()
    assert doc.processing_stats.total_processed == 4 and doc.rejection_reason_analysis["processing_error: malformed record"] == 2


def test_long_malformed_records(spark, tmp_path):
    text = 'a ""b"", c\n' * 40_000
    (tmp_path / "a.csv").write_text(f'utterance_id,text\nu1,"{text}"\nu2,"{text}",x\nu3,y\n')
    got = {r.utterance_id: r for r in scan_csv(spark, str(tmp_path), keep_malformed=True).collect()}
    assert set(got) == {"u1", None, "u3"}
    assert got["u1"].text == text.replace('""', '"') and got[None][MALFORMED] == f'u2,"{text}",x'


def test_an_open_quote_is_one_malformed_record(spark, tmp_path):
    (tmp_path / "a.csv").write_text('utterance_id,language,text\nu1,hi,x\nu2,"hi,x\nu3,hi,y\n')
    (tmp_path / "b.csv").write_text("utterance_id,language,text\nu4,hi,z\n")
    got = scan_csv(spark, str(tmp_path), keep_malformed=True).collect()
    assert {r.utterance_id for r in got} == {"u1", None, "u4"}
    assert [r[MALFORMED] for r in got if r[MALFORMED]] == ['u2,"hi,x\nu3,hi,y']
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "empty.csv").write_text("utterance_id,language\n")
    assert scan_csv(spark, str(tmp_path / "c"), keep_malformed=True).collect() == []


def test_files_must_agree_on_the_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("utterance_id,language\nu1,hi\n")
    (tmp_path / "b.csv").write_text("language,utterance_id\nhi,u2\n")
    with pytest.raises(Exception, match="(?i)header"):
        scan_csv(spark, str(tmp_path)).collect()


def test_column_contract(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("utterance_id,language,mood\nu1,hi,x\nu2,te,y\n")
    df = scan_csv(spark, str(path))
    c = column_contract(df).first()
    assert (c.valid, c.total_rows, c.total_columns) == (False, 2, 3)
    assert c.missing_columns == ["audio_path", "transcription_raw", "duration_sec"]
    assert c.available_columns == ["utterance_id", "language", "mood"]
    with pytest.raises(ValueError, match="audio_path"):
        verdict(df)


def test_csv_sink_keeps_text(spark, tmp_path):
    texts = ['say "hi", ok', " edge ", "two\nlines", "", None, "#x", "back\\slash", 'end\\"']
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    write_table(df.coalesce(1), str(tmp_path / "out"))
    rows = {int(r.i): r.text for r in scan_csv(spark, str(tmp_path / "out")).collect()}
    assert rows == {i: t or None for i, t in enumerate(texts)}


def test_completeness(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("", float("nan")), (None, None), ("b", 2.0)], "s string, d double"
    )
    got = {r.column_name: r for r in completeness(df, ["s", "d", "absent"]).collect()}
    assert set(got) == {"s", "d"}
    s = got["s"]
    assert (s.total_rows, s.null_count, s.empty_count, s.missing_count) == (4, 1, 1, 2)
    assert s.completeness_ratio == 0.5
    assert (got["d"].null_count, got["d"].empty_count) == (2, 0)


def test_new_files_are_gated_once(spark, tmp_path):
    def arrive(i):
        rows = [(f"u{i}", "s3://c/x.wav", "en", "one two three", "4.0")]
        columns = "utterance_id audio_path language transcription_raw duration_sec".split()
        df = spark.createDataFrame(rows, columns).coalesce(1)
        df.write.mode("append").parquet(str(tmp_path / "in"))
        return df.schema

    def run(schema, checkpoint="cp"):
        gate_new_files(
            spark, str(tmp_path / "in"), schema, str(tmp_path / "out"), checkpoint=str(tmp_path / checkpoint)
        ).awaitTermination(120)
        out = spark.read.parquet(str(tmp_path / "out"))
        return sorted((r.utterance_id, r.gate_verdict.is_valid) for r in out.collect())

    schema = arrive(1)
    assert run(schema) == [("u1", True)]
    arrive(2)
    assert run(schema) == [("u1", True), ("u2", True)]
    assert run(schema) == [("u1", True), ("u2", True)]
    # with a new checkpoint batches count from 0 again
    assert run(schema, "new") == [("u1", True)] * 2 + [("u2", True)] * 2


def test_quoted_line_breaks_in_odd_folders(spark, tmp_path):
    folder = tmp_path / "a b"
    folder.mkdir()
    (folder / "one.csv").write_text('utterance_id,language,transcription_raw\nu"1,hi,"one\ntwo"\nu2,hi,three\n')
    (folder / "two.csv").write_text("utterance_id,language,transcription_raw\nu3,hi,four\n")
    got = scan_csv(spark, str(tmp_path / "a b")).collect()
    assert {(r.utterance_id, r.transcription_raw) for r in got} == {('u"1', "one\ntwo"), ("u2", "three"), ("u3", "four")}
    lines = scan_csv(spark, str(tmp_path / "a b" / "two.csv"), multi_line=False).collect()
    assert [r.utterance_id for r in lines] == ["u3"]
