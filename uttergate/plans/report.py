"""Aggregate reports over verdict and utterance tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from uttergate.config import GateConfig
from uttergate.functions.labels import fixed_point
from uttergate.functions.text import strip
from uttergate.operators.audio import audio_counts
from uttergate.operators.split import VERDICT, fields

OPERATION_COUNTERS = {
    "diacritics_removed": "diacritics_removed",
    "numbers_expanded": "numbers_expanded",
    "punctuation_normalized": "punctuation_normalized",
    "unicode_normalized": "unicode_nfc",
}


def _failed(reasons: Column) -> Column:
    """Rows whose processing failed: rejected, but left out of the run counters."""
    return F.exists(reasons, lambda r: r.startswith("processing_error: "))


def run_counts(reasons: str = "reasons", is_valid: str = "is_valid") -> Column:
    """Aggregate struct: total, valid and rejected rows, valid share (0 for an empty table)."""
    counted = ~_failed(F.col(reasons))
    total = F.count_if(counted)
    valid = F.count_if(counted & F.col(is_valid))
    return F.struct(
        total.alias("total_processed"),
        valid.alias("valid_samples"),
        F.count_if(counted & ~F.col(is_valid)).alias("rejected_samples"),
        F.coalesce(F.try_divide(valid, total), F.lit(0.0)).alias("valid_ratio"),
    )


def run_totals(verdict: DataFrame) -> DataFrame:
    """One row of run totals."""
    return fields(verdict).agg(run_counts().alias("s")).select("s.*")


def reason_histogram(verdict: DataFrame) -> DataFrame:
    """``reason, n``: how many counted rows carry each reason."""
    return (
        fields(verdict)
        .where(~F.col("is_valid") & ~_failed(F.col("reasons")))
        .select(F.explode("reasons").alias("reason"))
        .groupBy("reason")
        .agg(F.count("*").alias("n"))
    )


def reason_analysis(rejected: DataFrame) -> DataFrame:
    """``reason, n`` from the joined reason text of a rejected table, failed rows included.

    The text is split at every semicolon, also inside a free-text message.
    """
    parts = rejected.select(F.explode(F.split("reason", ";")).alias("part"))
    return (
        parts.select(strip(F.col("part")).alias("reason"))
        .where(F.col("reason") != "")
        .groupBy("reason")
        .agg(F.count("*").alias("n"))
    )


def top_reasons(histogram: DataFrame, n: int = 5) -> DataFrame:
    """The n commonest reasons; equal counts are ordered by name."""
    return histogram.orderBy(F.desc("n"), "reason").limit(n)


def normalizer_counts(trace: str = "normalization") -> Column:
    """Aggregate struct: texts normalised (blank ones left out), texts changed by each step."""
    operations = F.col(trace)["operations"]
    return F.struct(
        F.count(F.col(trace)).alias("total_processed"),
        *[
            F.count_if(F.array_contains(operations, op)).alias(name)
            for name, op in OPERATION_COUNTERS.items()
        ],
    )


def normalizer_counters(normalized: DataFrame, trace: str = "normalization") -> DataFrame:
    """One row of normaliser counters."""
    return normalized.agg(normalizer_counts(trace).alias("s")).select("s.*")


def completeness(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per present column: nulls (NaN included), empty strings, completeness."""
    types = {f.name: f.dataType for f in df.schema.fields}
    present = [c for c in columns if c in types]

    def is_null(c: str) -> Column:
        null = F.col(c).isNull()
        floating = isinstance(types[c], (T.DoubleType, T.FloatType))
        return null | F.isnan(c) if floating else null

    def is_empty(c: str) -> Column:
        return F.col(c) == "" if isinstance(types[c], T.StringType) else F.lit(False)

    counts = df.agg(
        F.count("*").alias("total_rows"),
        *[F.count_if(is_null(c)).alias(f"null_{i}") for i, c in enumerate(present)],
        *[F.count_if(is_empty(c)).alias(f"empty_{i}") for i, c in enumerate(present)],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(f"null_{i}").alias("null_count"),
                F.col(f"empty_{i}").alias("empty_count"),
            )
            for i, c in enumerate(present)
        ]
    )
    missing = F.col("null_count") + F.col("empty_count")
    return counts.select("total_rows", F.inline(rows)).select(
        "column_name",
        "total_rows",
        "null_count",
        "empty_count",
        missing.alias("missing_count"),
        (1 - F.try_divide(missing, F.col("total_rows"))).alias("completeness_ratio"),
    )


def summary(verdict: DataFrame) -> DataFrame:
    """One row with the three counter structs, from a single pass over the verdict."""
    return fields(verdict).agg(
        run_counts().alias("processing_stats"),
        normalizer_counts().alias("text_normalization"),
        audio_counts().alias("audio_validation"),
    )


def observed(judged: DataFrame) -> tuple[DataFrame, Observation]:
    """The verdict table with the three counter structs of ``summary`` gathered as its rows pass by.

    The counters are those of the first action on the table, and are exact where that action writes it straight away
    (each partition counts once, however often a lost one is computed); ``Observation.get`` has them then.
    """
    counters = Observation()
    sections = {
        "processing_stats": run_counts(f"{VERDICT}.reasons", f"{VERDICT}.is_valid"),
        "text_normalization": normalizer_counts(f"{VERDICT}.normalization"),
        "audio_validation": audio_counts(f"{VERDICT}.audio"),
    }
    return judged.observe(counters, *[c.alias(n) for n, c in sections.items()]), counters


def report_rows(summary: DataFrame) -> DataFrame:
    """``category, key, value`` rows of a summary; fractions with two decimals."""
    pairs = []
    for section in summary.schema.fields:
        for field in section.dataType.fields:
            value = F.col(f"{section.name}.{field.name}")
            fraction = isinstance(field.dataType, T.DoubleType)
            pairs.append(
                F.struct(
                    F.lit(section.name.upper()).alias("category"),
                    F.lit(field.name).alias("key"),
                    (fixed_point(value, 2) if fraction else value.cast("string")).alias("value"),
                )
            )
    return summary.select(F.inline(F.array(*pairs)))


def stats_report(verdict: DataFrame) -> DataFrame:
    """Run totals and component counters as report rows."""
    return report_rows(summary(verdict))


#: Reasons the gates can give, but for the script's name and free-text messages; a fixed vocabulary.
_NAMED = (
    "^(missing_(utterance_id|audio_path|language)|empty_transcription|unsupported_language|audio_(file_not_found"
    "|sample_rate_too_(low|high)|duration_too_(short|long)|signal_too_weak|too_much_silence|not_mono)"
    "|duration_too_(short|long)|invalid_duration_format|language_path_mismatch|low_text_quality|too_few_words"
    "|too_many_repeated_words|script_mismatch_[A-Za-z_-]+|negative_quality_flag|processing_error: malformed record)$"
)


#: What a row adds to the statistics document: itself, or a message under its name (none: free text).
_ROW, _COUNTED, _ANALYSED = "row", "counted", "analysed"


def _statistics(verdict: DataFrame) -> DataFrame:
    """One row, from one pass over the verdict: the counters of ``summary``, and counts of the named reasons in counted
    rows and in the joined texts of all rejected rows, with the number of other messages of each.

    Every row is tagged as itself and with its messages, and the tags are counted in one aggregate, which leaves a row
    for each name of the gates' vocabulary. The histogram tables list every message.
    """

    def tag(kind: str, label: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), label.alias("label"))

    counted, analysed = _messages()
    tags = F.concat(
        F.array(tag(_ROW, F.lit(None).cast("string"))),
        F.transform(counted, lambda r: tag(_COUNTED, _named(r))),
        F.transform(analysed, lambda p: tag(_ANALYSED, _named(p))),
    )
    sections = {"processing_stats": run_counts(), "text_normalization": normalizer_counts(), "audio_validation": audio_counts()}
    tagged = fields(verdict).select("*", F.explode(tags).alias("_ug_tag"))
    per = tagged.groupBy("_ug_tag").agg(*[c.alias(n) for n, c in sections.items()], F.count("*").alias("n"))
    kind, label = F.col("_ug_tag.kind"), F.col("_ug_tag.label")

    def of_rows(name: str) -> Column:
        kinds = per.schema[name].dataType.fields
        none = F.struct(*[F.lit(0).cast(f.dataType).alias(f.name) for f in kinds])  # an empty table
        return F.coalesce(F.max(F.when(kind == _ROW, F.col(name))), none)

    return per.agg(*[of_rows(n).alias(n) for n in sections], *_maps(kind, label))


def _named(reason: Column) -> Column:
    return F.when(reason.rlike(_NAMED), reason)


def _messages() -> tuple[Column, Column]:
    """The reasons of a counted row, and the pieces of the joined text of a rejected one; else no entries."""
    refused, none = ~F.col("is_valid"), F.array().cast("array<string>")
    counted = F.when(refused & ~_failed(F.col("reasons")), F.col("reasons")).otherwise(none)
    parts = F.filter(F.transform(F.flatten(F.transform("reasons", lambda r: F.split(r, ";"))), strip), lambda p: p != "")
    return counted, F.when(refused, parts).otherwise(none)


def _maps(kind: Column, label: Column) -> list[Column]:
    """Aggregates over counts ``n`` of labels: for each kind a map of its labels, and the sum where there is none."""

    def as_map(wanted: str) -> Column:
        pair = F.when((kind == wanted) & label.isNotNull(), F.struct(label.alias("label"), "n"))
        return F.map_from_entries(F.array_sort(F.collect_list(pair)))

    def others(wanted: str) -> Column:
        return F.coalesce(F.sum(F.when((kind == wanted) & label.isNull(), F.col("n"))), F.lit(0))

    return [c for k in (_COUNTED, _ANALYSED) for c in (as_map(k).alias(k), others(k).alias(f"{k}_others"))]


def reason_counts(verdict: DataFrame) -> DataFrame:
    """``kind, reason, n`` from one pass: the rows of ``reason_histogram`` and of ``reason_analysis``, told apart by
    ``kind`` (``counted``, ``analysed``)."""

    def tags(kind: str, messages: Column) -> Column:
        return F.transform(messages, lambda m: F.struct(F.lit(kind).alias("kind"), m.alias("reason")))

    counted, analysed = _messages()
    every = F.concat(tags(_COUNTED, counted), tags(_ANALYSED, analysed))
    return fields(verdict).select(F.inline(every)).groupBy("kind", "reason").agg(F.count("*").alias("n"))


def stats_document(verdict: DataFrame, config: GateConfig | None = None) -> DataFrame:
    """One row: ``config`` in sections, ``processing_stats, component_stats, rejection_reason_analysis`` and
    ``other_messages``, the number of free-text messages that the two reason maps leave to the tables."""
    return _document(_statistics(verdict), config or GateConfig())


def observed_document(counters: dict, reasons: DataFrame, config: GateConfig | None = None) -> DataFrame:
    """The row of ``stats_document`` from observed counters and the table of ``reason_counts``."""

    def literal(value: object) -> Column:
        return F.lit(value) if isinstance(value, float) else F.lit(value).cast("bigint")

    sections = {n: F.struct(*[literal(v).alias(k) for k, v in c.asDict().items()]) for n, c in counters.items()}
    maps = reasons.agg(*_maps(F.col("kind"), _named(F.col("reason"))))
    return _document(maps.withColumns(sections), config or GateConfig())


def _document(statistics: DataFrame, config: GateConfig) -> DataFrame:
    settings = F.struct(
        *[
            F.struct(*[F.lit(v).alias(k) for k, v in values.items()]).alias(section)
            for section, values in config.sections().items()
        ]
    )
    return statistics.select(
        settings.alias("config"),
        F.struct("processing_stats.*", F.col("counted").alias("rejection_reasons")).alias(
            "processing_stats"
        ),
        F.struct("text_normalization", "audio_validation").alias("component_stats"),
        F.col("analysed").alias("rejection_reason_analysis"),
        F.struct(
            F.col("counted_others").alias("rejection_reasons"),
            F.col("analysed_others").alias("rejection_reason_analysis"),
        ).alias("other_messages"),
    )
