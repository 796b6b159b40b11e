"""Audio validation against a property table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from uttergate.config import GateConfig
from uttergate.functions.template import staged, template
from uttergate.functions.text import pin
from uttergate.operators.lookup import lookup_join
from uttergate.schema import AUDIO_PROPERTY_FIELDS

PROPERTY_NAMES = [f.name for f in AUDIO_PROPERTY_FIELDS]
# Optional text column of a property table: why the file could not be analysed.
ERROR_COLUMN = "error"


def property_issues(props: Column, config: GateConfig | None = None) -> Column:
    """Ordered issues of one property struct.

    A missing property counts as 0, a missing channel count as 1; NaN breaks no rule.
    """
    config = config or GateConfig()

    def number(name: str, default: float) -> Column:
        return F.coalesce(props[name].cast("double"), F.lit(float(default)))

    def below(col: Column, limit: float) -> Column:
        return ~F.isnan(col) & (col < float(limit))

    def above(col: Column, limit: float) -> Column:
        return ~F.isnan(col) & (col > float(limit))

    rate, duration = number("sample_rate", 0), number("duration", 0)
    return F.array_compact(
        F.array(
            F.when(below(rate, config.min_sample_rate), "sample_rate_too_low").when(
                above(rate, config.max_sample_rate), "sample_rate_too_high"
            ),
            F.when(below(duration, config.audio_min_duration), "duration_too_short").when(
                above(duration, config.audio_max_duration), "duration_too_long"
            ),
            F.when(below(number("amplitude_mean", 0), config.min_amplitude), "signal_too_weak"),
            F.when(above(number("silence_ratio", 0), config.max_silence_ratio), "too_much_silence"),
            F.when(number("num_channels", 1) != 1, "not_mono"),
        )
    )


def with_audio(
    df: DataFrame,
    properties: DataFrame | None,
    config: GateConfig | None = None,
    path: str = "audio_path",
    eligible: Column | None = None,
    spread_by: list[str] | None = None,
    out: str = "audio",
    unique: bool = False,
    **lookup: object,
) -> DataFrame:
    """Look every path up and add ``struct<checked, exists, is_valid, issues, properties>``.

    Rows that are not ``eligible`` are passed through unchecked. ``properties`` has one row per
    analysed file: ``audio_path``, any of the eight properties, and optionally ``error``.
    """
    config = config or GateConfig()
    found = "_ug_found"
    df = df.withColumn("_ug_eligible", F.lit(True) if eligible is None else eligible)
    if properties is None:
        df = df.withColumn(found, F.lit(None).cast("struct<_present:int>"))
    else:
        df = lookup_join(
            df,
            properties.select(*_property_columns(path, tuple(properties.columns))),
            key=path,
            eligible=F.col("_ug_eligible"),
            spread_by=spread_by or [path],
            values=[*PROPERTY_NAMES, ERROR_COLUMN],
            out=found,
            unique=unique,
            **lookup,
        )
    return staged(df, _audit_steps(path, found, out, config, properties is not None), [found, "_ug_issues", "_ug_eligible"])


@template
def _property_columns(path: str, have: tuple[str, ...]) -> list[Column]:
    def column(name: str, dtype: T.DataType) -> Column:
        return (F.col(name) if name in have else F.lit(None)).cast(dtype).alias(name)

    columns = [column(f.name, f.dataType) for f in AUDIO_PROPERTY_FIELDS]
    return [F.col("audio_path").alias(path), *columns, column(ERROR_COLUMN, T.StringType())]


@template
def _audit_steps(path: str, found: str, out: str, config: GateConfig, looked_up: bool) -> list[dict]:
    checked = F.col("_ug_eligible")
    if looked_up:
        matched = F.col(found).isNotNull()
        props = F.when(matched, F.struct(*[F.col(found)[n].alias(n) for n in PROPERTY_NAMES]))
        error = F.col(found)[ERROR_COLUMN]
    else:
        props = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in AUDIO_PROPERTY_FIELDS])
        matched, error = F.lit(False), F.lit(None).cast("string")
    assumed = (
        F.lit(False)
        if config.assume_exists_prefix is None
        else F.col(path).startswith(config.assume_exists_prefix)
    )
    none = F.array().cast("array<string>")
    issues = (
        F.when(~checked, none)
        .when(error.isNotNull(), F.array(F.concat(F.lit("validation_error: "), error)))
        .when(matched, property_issues(F.col(found), config) if looked_up else none)
        .when(assumed, none)
        .otherwise(F.array(F.lit("file_not_found")))
    )
    audit = F.struct(
        checked.alias("checked"),
        (checked & (matched | assumed)).alias("exists"),
        (checked & (F.size("_ug_issues") == 0)).alias("is_valid"),
        F.col("_ug_issues").alias("issues"),
        F.when(checked & error.isNull(), props).alias("properties"),
    )
    return [{"_ug_issues": pin(issues)}, {out: audit}]


def validate_paths(
    paths: DataFrame,
    properties: DataFrame | None,
    config: GateConfig | None = None,
    path: str = "audio_path",
    **lookup: object,
) -> DataFrame:
    """One verdict per listed path: ``audio_path, exists, is_valid, issues, properties``."""
    checked = with_audio(paths.select(path), properties, config, path, **lookup)
    return checked.select(
        path, "audio.exists", "audio.is_valid", "audio.issues", "audio.properties"
    )


def batch_summary(validated: DataFrame) -> DataFrame:
    """Totals over listed paths; a path listed twice counts twice."""
    return validated.agg(
        F.count("*").alias("total_files"),
        F.count_if(F.col("is_valid")).alias("valid_files"),
        F.count_if(~F.col("is_valid")).alias("invalid_files"),
    )


def batch_details(
    paths: DataFrame,
    properties: DataFrame | None,
    config: GateConfig | None = None,
    path: str = "audio_path",
    **lookup: object,
) -> DataFrame:
    """One verdict per distinct path; repeats go before the lookup, whose keys the paths are then dealt by."""
    return validate_paths(paths.select(path).distinct(), properties, config, path, **lookup)


def audio_counts(audio: str = "audio") -> Column:
    """Aggregate struct over the rows whose audio was checked.

    A missing or unreadable file is neither valid nor invalid here, so the two ratios need
    not add up to one.
    """
    a = F.col(audio)
    checked, issues = a["checked"], a["issues"]
    error = F.exists(issues, lambda i: i.startswith("validation_error: "))
    missing = F.array_contains(issues, "file_not_found")
    analysed = checked & ~missing & ~error

    def has(*names: str) -> Column:
        return F.count_if(
            analysed & F.arrays_overlap(issues, F.array(*[F.lit(n) for n in names]))
        )

    total = F.count_if(checked)
    valid = F.count_if(a["is_valid"])
    invalid = F.count_if(analysed & ~a["is_valid"])

    def share(n: Column) -> Column:
        return F.coalesce(F.try_divide(n, total), F.lit(0.0))

    return F.struct(
        total.alias("total_validated"),
        valid.alias("valid_files"),
        invalid.alias("invalid_files"),
        F.count_if(checked & missing).alias("missing_files"),
        F.count_if(checked & error).alias("corrupted_files"),
        has("duration_too_short", "duration_too_long").alias("duration_violations"),
        has("sample_rate_too_low", "sample_rate_too_high").alias("sample_rate_violations"),
        share(valid).alias("valid_ratio"),
        share(invalid).alias("invalid_ratio"),
    )


def audio_counters(verdict: DataFrame, audio: str = "audio") -> DataFrame:
    """One row of audio counters."""
    return verdict.agg(audio_counts(audio).alias("s")).select("s.*")
