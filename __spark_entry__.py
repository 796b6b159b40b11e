"""Registered queries and their DuckDB counterparts."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import pyarrow as pa  # noqa: E402
from pyspark.sql import Column, DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import oracle_sql as _oracle  # noqa: E402
import utterance_corpus as corpus  # noqa: E402
from uttergate.config import GateConfig  # noqa: E402
from uttergate.functions.labels import (  # noqa: E402
    format_duration,
    language_path_mismatch,
    path_language,
    safe_name,
)
from uttergate.functions.metrics import with_text_metrics  # noqa: E402
from uttergate.functions.script import latin_consistency, with_script  # noqa: E402
from uttergate.functions.text import safe_string, with_normalized_text  # noqa: E402
from uttergate.operators import gates  # noqa: E402
from uttergate.operators.audio import (  # noqa: E402
    audio_counters,
    batch_details,
    batch_summary,
    validate_paths,
)
from uttergate.operators.language import with_language_info  # noqa: E402
from uttergate.operators.split import expanded, fields, rejected, train_ready  # noqa: E402
from uttergate.plans import report  # noqa: E402
from uttergate.plans.pipeline import publish_gate  # noqa: E402
from uttergate.plans.verdict import verdict  # noqa: E402
from uttergate.schema import MALFORMED  # noqa: E402
from uttergate.sources.files import (  # noqa: E402
    content_hash,
    hash_files,
    list_files,
    same_contents,
    with_file_hash,
)
from uttergate.sources.manifest import published  # noqa: E402
from uttergate.sources.sinks import write_table  # noqa: E402
from uttergate.sources.utterances import column_contract, scan_csv  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"

Query = Callable[[SparkSession, str], DataFrame]


def _shared_folder(spark: SparkSession) -> str:
    """A new folder below the cluster's shared one; in a local session without one, a folder until Python ends."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="run-")
        atexit.register(shutil.rmtree, shared, ignore_errors=True)
    return f"{shared}/run-{uuid.uuid4().hex}"


def _safe(spark: SparkSession, sf: str) -> DataFrame:
    """The utterances with null-safe text columns."""
    names = {"utterance_id": "id", "audio_path": "path", "language": "lang", "transcription_raw": "txt"}
    return corpus.utterances(spark, sf).withColumns(
        {new: safe_string(F.col(old)) for old, new in names.items()}
    )


def _normalized(spark: SparkSession, sf: str, trace: str | None = None) -> DataFrame:
    return with_normalized_text(_safe(spark, sf), "txt", "lang", out="norm", trace=trace)


def _verdict(spark: SparkSession, sf: str, config: GateConfig | None = None) -> DataFrame:
    return verdict(
        corpus.utterances(spark, sf), config, corpus.audio_properties(spark, sf)
    )


def _joined(reasons: Column) -> Column:
    return F.concat_ws("; ", reasons)


def text_normalize(spark: SparkSession, sf: str) -> DataFrame:
    return _normalized(spark, sf).select(
        "row_n", F.col("lang").alias("language"), F.col("norm").alias("transcription_normalized")
    )


def normalize_trace(spark: SparkSession, sf: str) -> DataFrame:
    return (
        _normalized(spark, sf, "t")
        .where("t IS NOT NULL")
        .select(
            "row_n",
            F.concat_ws(",", "t.operations").alias("operations"),
            F.col("t.original_length").cast("bigint").alias("original_length"),
            F.col("t.final_length").cast("bigint").alias("final_length"),
            "t.reduction_ratio",
        )
    )


def normalize_counters(spark: SparkSession, sf: str) -> DataFrame:
    return report.normalizer_counters(_normalized(spark, sf, "t"), "t")


def _metric_columns() -> list[Column]:
    counts = {"word_count", "char_count"}
    names = [
        "quality_score",
        "word_count",
        "char_count",
        "avg_word_length",
        "repeated_word_ratio",
        "punctuation_ratio",
    ]
    return [
        (F.col(f"m.{n}").cast("bigint") if n in counts else F.col(f"m.{n}")).alias(n)
        for n in names
    ]


def normalize_conversations(spark: SparkSession, sf: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "text")
    turns = corpus.spread_small(turns, "conv_id", "turn").withColumn("lang", F.lit("en"))
    out = with_normalized_text(turns, "text", "lang", out="norm")
    return with_text_metrics(out, "norm", out="m", single_spaced=True).select(
        "conv_id", "turn", F.col("norm").alias("transcription_normalized"), *_metric_columns()
    )


def text_metrics(spark: SparkSession, sf: str) -> DataFrame:
    out = with_text_metrics(_normalized(spark, sf), "norm", out="m", single_spaced=True)
    return out.select("row_n", *_metric_columns())


def text_metrics_raw(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    return with_text_metrics(corpus.spread_small(docs, "doc_id"), "text", out="m").select(
        "doc_id", *_metric_columns()
    )


def path_language_query(spark: SparkSession, sf: str) -> DataFrame:
    path, lang = F.col("path"), F.col("lang")
    return _safe(spark, sf).select(
        "row_n",
        path_language(path).alias("path_language"),
        language_path_mismatch(path, lang).alias("mismatch"),
    )


def script_profile(spark: SparkSession, sf: str) -> DataFrame:
    out = with_script(_normalized(spark, sf, "t"), "norm", "lang", out="k")
    return out.select(
        "row_n",
        "k.detected_script",
        "k.confidence",
        "k.is_valid",
        F.when(F.col("t").isNotNull(), gates.script_reason(F.col("k"))).alias("reason"),
    )


def latin_consistency_query(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    checked = corpus.spread_small(docs, "doc_id").withColumn(
        "c", latin_consistency(F.col("text"), F.col("lang"))
    )
    return checked.select("doc_id", "c.consistent", "c.confidence")


def presence_gates(spark: SparkSession, sf: str) -> DataFrame:
    cols = [F.col(c) for c in ("id", "path", "lang", "txt")]
    reasons = gates.reason_list(*gates.presence_reasons(*cols))
    return _safe(spark, sf).select("row_n", _joined(reasons).alias("reason"))


def duration_gate(spark: SparkSession, sf: str) -> DataFrame:
    df = corpus.utterances(spark, sf)
    reason = gates.duration_reason(
        F.col("duration_sec"), df.schema["duration_sec"].dataType, GateConfig()
    )
    return df.select("row_n", reason.alias("reason"))


def text_gates(spark: SparkSession, sf: str) -> DataFrame:
    df = with_text_metrics(_normalized(spark, sf, "t"), "norm", out="m", single_spaced=True)
    reasons = gates.reason_list(
        *[
            F.when(F.col("t").isNotNull(), r)
            for r in gates.text_reasons(F.col("m"), GateConfig())
        ]
    )
    return df.select("row_n", _joined(reasons).alias("reason"))


def quality_flag_gate(spark: SparkSession, sf: str) -> DataFrame:
    df = corpus.utterances(spark, sf)
    flag, dtype = F.col("quality_flag"), df.schema["quality_flag"].dataType
    return df.select(
        "row_n",
        gates.flag_reason(flag, dtype).alias("reason"),
        gates.flag_is_infinite(flag, dtype).alias("is_infinite"),
    )


UNASSUMED = GateConfig(assume_exists_prefix=None)


def _validated(spark: SparkSession, sf: str) -> DataFrame:
    paths = corpus.utterances(spark, sf).select("audio_path").where("audio_path IS NOT NULL")
    return validate_paths(paths, corpus.audio_properties(spark, sf), UNASSUMED)


def audio_rules(spark: SparkSession, sf: str) -> DataFrame:
    return _validated(spark, sf).select(
        "audio_path",
        "exists",
        "is_valid",
        F.concat_ws(",", "issues").alias("issues"),
        "properties.sample_rate",
        "properties.duration",
    )


def audio_batch_summary(spark: SparkSession, sf: str) -> DataFrame:
    return batch_summary(_validated(spark, sf))


def audio_batch_details(spark: SparkSession, sf: str) -> DataFrame:
    paths = corpus.utterances(spark, sf).where("audio_path IS NOT NULL")
    return batch_details(paths, corpus.audio_properties(spark, sf), UNASSUMED).select(
        "audio_path", "exists", "is_valid", F.concat_ws(",", "issues").alias("issues")
    )


def language_dim(spark: SparkSession, sf: str) -> DataFrame:
    return with_language_info(corpus.utterances(spark, sf)).select(
        "row_n", "language", "language_name", "language_script"
    )


def verdict_query(spark: SparkSession, sf: str) -> DataFrame:
    return expanded(_verdict(spark, sf)).select(
        "row_n",
        "is_valid",
        _joined(F.col("reasons")).alias("reason"),
        "transcription_normalized",
        F.col("audio.checked").alias("audio_checked"),
        "text_metrics.quality_score",
        "script.detected_script",
    )


def train_ready_query(spark: SparkSession, sf: str) -> DataFrame:
    return train_ready(_verdict(spark, sf))


def rejected_query(spark: SparkSession, sf: str) -> DataFrame:
    return rejected(_verdict(spark, sf))


def reason_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return report.reason_histogram(_verdict(spark, sf))


def reason_analysis(spark: SparkSession, sf: str) -> DataFrame:
    return report.reason_analysis(rejected(_verdict(spark, sf)))


def top_reasons(spark: SparkSession, sf: str) -> DataFrame:
    return report.top_reasons(reason_histogram(spark, sf), 10)


def run_totals(spark: SparkSession, sf: str) -> DataFrame:
    return report.run_totals(_verdict(spark, sf))


def audio_counters_query(spark: SparkSession, sf: str) -> DataFrame:
    return audio_counters(fields(_verdict(spark, sf)))


def completeness(spark: SparkSession, sf: str) -> DataFrame:
    columns = [
        "utterance_id",
        "audio_path",
        "language",
        "transcription_raw",
        "duration_sec",
        "quality_flag",
        "not_there",
    ]
    return report.completeness(corpus.utterances(spark, sf, spread=False), columns)


def schema_contract(spark: SparkSession, sf: str) -> DataFrame:
    contract = column_contract(corpus.utterances(spark, sf, spread=False))
    return contract.withColumns(
        {c: F.concat_ws(",", c) for c in ("missing_columns", "available_columns")}
    )


def stats_report(spark: SparkSession, sf: str) -> DataFrame:
    return report.stats_report(_verdict(spark, sf))


def stats_document(spark: SparkSession, sf: str) -> DataFrame:
    doc = report.stats_document(_verdict(spark, sf))

    def listed(name: str) -> Column:
        pairs = F.array_sort(F.map_entries(name))
        text = F.transform(pairs, lambda e: F.concat_ws("=", e["key"], e["value"]))
        return F.concat_ws("|", text)

    return doc.select(
        "config.audio_validation.min_duration",
        "config.audio_validation.max_duration",
        "processing_stats.total_processed",
        "processing_stats.valid_samples",
        "processing_stats.rejected_samples",
        "processing_stats.valid_ratio",
        F.col("component_stats.text_normalization.total_processed").alias("texts_processed"),
        "component_stats.text_normalization.numbers_expanded",
        "component_stats.audio_validation.total_validated",
        "component_stats.audio_validation.missing_files",
        listed("processing_stats.rejection_reasons").alias("rejection_reasons"),
        listed("rejection_reason_analysis").alias("rejection_reason_analysis"),
        F.col("other_messages.rejection_reasons").alias("other_reasons"),
        F.col("other_messages.rejection_reason_analysis").alias("other_parts"),
    )


def safe_name_query(spark: SparkSession, sf: str) -> DataFrame:
    return _safe(spark, sf).select("row_n", safe_name(F.col("txt")).alias("safe_name"))


def duration_label(spark: SparkSession, sf: str) -> DataFrame:
    scales = F.explode(F.array(F.lit(1.0), F.lit(7.25), F.lit(333.0)))
    seconds = F.col("duration_sec").try_cast("double")
    return (
        corpus.utterances(spark, sf)
        .select("row_n", seconds.alias("seconds"), scales.alias("scale"))
        .select("row_n", "scale", format_duration(F.col("seconds") * F.col("scale")).alias("label"))
    )


def content_hash_query(spark: SparkSession, sf: str) -> DataFrame:
    content = F.encode("html", "UTF-8")
    return spark.read.parquet(f"{sf}/pages.parquet").select(
        "page_id",
        F.octet_length(content).cast("bigint").alias("length"),
        content_hash(content).alias("md5"),
    )


def audio_hash(spark: SparkSession, sf: str) -> DataFrame:
    """Every file below the folder by its listing, joined to its hash, with the files of the same contents."""
    pattern = "*.parquet"
    hashes = same_contents(hash_files(spark, sf, pattern))
    listed = with_file_hash(list_files(spark, sf, pattern), hashes)
    groups = hashes.select("audio_path", "copies", "first_path")

    def below(path: str) -> Column:
        folder = re.escape(sf.rstrip("/").rsplit("/", 1)[-1])
        return F.regexp_extract(path, f"(?:^|/){folder}/(.*)$", 1).alias(path)

    return listed.join(groups, "audio_path").select(below("audio_path"), "length", "md5", "copies", below("first_path"))


def _mode(config: GateConfig) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return expanded(_verdict(spark, sf, config)).select(
            "row_n", "is_valid", _joined(F.col("reasons")).alias("reason")
        )

    return run


def csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Write every utterance as CSV and scan it back."""
    folder = f"{_shared_folder(spark)}/utterances"
    write_table(corpus.utterances(spark, sf), folder)
    back = scan_csv(spark, folder)
    return back.withColumn("row_n", F.col("row_n").cast("bigint"))


SURPLUS, SHORT = "row_n % 11 = 0", "row_n % 13 = 5"


def csv_malformed(spark: SparkSession, sf: str) -> DataFrame:
    """Every utterance as a CSV record, one in eleven with a field too many and one in thirteen without its last three,
    scanned and gated; malformed ones are rows of their own, numbered by the first field of their record."""
    df = corpus.utterances(spark, sf)
    as_is = {"escape": '"', "emptyValue": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    whole, short = F.to_csv(F.struct(*df.columns), as_is), F.to_csv(F.struct(*df.columns[:-3]), as_is)
    record = F.when(F.expr(SURPLUS), F.concat(whole, F.lit(",one field too many"))).when(F.expr(SHORT), short).otherwise(whole)
    header = pa.RecordBatch.from_pydict({"value": [",".join(df.columns)]})

    def with_header(records: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield header
        yield from records

    folder = f"{_shared_folder(spark)}/records"
    df.select(record.alias("value")).mapInArrow(with_header, "value string").write.text(folder)
    back = scan_csv(spark, folder, keep_malformed=True)
    judged = verdict(back, GateConfig().skip_audio())
    number = F.coalesce("row_n", F.split(MALFORMED, ",", 2)[0]).cast("bigint")
    return judged.select(number.alias("row_n"), "gate_verdict.is_valid", _joined(F.col("gate_verdict.reasons")).alias("reason"))


def gate_run(spark: SparkSession, sf: str) -> DataFrame:
    """The batch run over every utterance, read back from what it published."""
    folder = _shared_folder(spark)
    publish_gate(corpus.utterances(spark, sf), folder, audio_properties=corpus.audio_properties(spark, sf), fmt="parquet")
    paths = published(spark, folder)
    accepted = spark.read.parquet(paths["train_ready"])
    refused = spark.read.parquet(paths["rejected"])
    return accepted.select(
        "row_n", F.lit("accepted").alias("outcome"), F.col("transcription_normalized").alias("detail")
    ).unionAll(refused.select("row_n", F.lit("refused"), "reason"))


def _llm() -> tuple[dict[str, Query], dict[str, str]]:
    """The training-data operators and the pipeline, where they are installed."""
    try:
        import corpus_pipeline
        from uttergate.llm import oracles
        from uttergate.llm import queries as llm_queries
    except ModuleNotFoundError as missing:
        if missing.name not in ("corpus_pipeline", "uttergate.llm"):
            raise
        return {}, {}
    sql = dict(oracles.SQL)
    if corpus_pipeline.ORACLE_SQL is not None:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {**llm_queries.QUERIES, "pipeline": corpus_pipeline.run}, sql


def regate(spark: SparkSession, sf: str) -> DataFrame:
    """The accepted rows of a gate, gated again with the columns that the first one added.

    They are stored first, since the second gate's lookup reads its input's paths before it reads the rows.
    """
    folder = f"{_shared_folder(spark)}/accepted"
    write_table(train_ready(_verdict(spark, sf)), folder, "parquet")
    again = spark.read.parquet(folder).withColumn("audio", F.lit("an input of this name"))
    judged = verdict(again, GateConfig(), corpus.audio_properties(spark, sf))
    return judged.select("row_n", _joined(F.col("gate_verdict.reasons")).alias("reason"))


def entry(spark: SparkSession) -> DataFrame:
    """Rejection reason histogram of the full gate."""
    return reason_histogram(spark, SMOKE_DIR)


def queries() -> dict[str, Query]:
    return {
        "text_normalize": text_normalize,
        "normalize_trace": normalize_trace,
        "normalize_counters": normalize_counters,
        "normalize_conversations": normalize_conversations,
        "text_metrics": text_metrics,
        "text_metrics_raw": text_metrics_raw,
        "path_language": path_language_query,
        "script_profile": script_profile,
        "latin_consistency": latin_consistency_query,
        "presence_gates": presence_gates,
        "duration_gate": duration_gate,
        "text_gates": text_gates,
        "quality_flag_gate": quality_flag_gate,
        "audio_rules": audio_rules,
        "audio_batch_summary": audio_batch_summary,
        "audio_batch_details": audio_batch_details,
        "language_dim": language_dim,
        "verdict": verdict_query,
        "train_ready": train_ready_query,
        "rejected": rejected_query,
        "reason_histogram": reason_histogram,
        "reason_analysis": reason_analysis,
        "top_reasons": top_reasons,
        "run_totals": run_totals,
        "audio_counters": audio_counters_query,
        "completeness": completeness,
        "schema_contract": schema_contract,
        "stats_report": stats_report,
        "stats_document": stats_document,
        "safe_name": safe_name_query,
        "duration_label": duration_label,
        "content_hash": content_hash_query,
        "audio_hash": audio_hash,
        "mode_normalize_only": _mode(GateConfig().normalize_only()),
        "mode_skip_mismatch": _mode(GateConfig().skip_language_mismatch()),
        "mode_skip_audio": _mode(GateConfig().skip_audio()),
        "mode_toggles": _mode(
            GateConfig(apply_unicode_nfc=False, remove_diacritics=False, expand_numbers=False)
        ),
        "mode_sample_rate": _mode(GateConfig(min_sample_rate=16001, max_sample_rate=100_000)),
        "mode_thresholds": _mode(
            GateConfig(min_duration=2.0, max_duration=8.0, min_text_quality_score=0.6)
        ),
        "csv_round_trip": csv_round_trip,
        "csv_malformed": csv_malformed,
        "gate_run": gate_run,
        "regate": regate,
        **_llm()[0],
    }


def oracle_sql() -> dict[str, str]:
    return {**_oracle.oracle_sql(), **_llm()[1]}
