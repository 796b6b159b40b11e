"""Quality gates: each returns a reason, or null when the row passes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from uttergate.config import GateConfig
from uttergate.functions.charclass import SP
from uttergate.functions.labels import language_path_mismatch
from uttergate.functions.text import is_blank
from uttergate.schema import LANGUAGE_CODES

# A decimal number as a text may spell it: digits may be grouped by single underscores.
_DIGITS = r"[0-9](?:_?[0-9])*"
_NUMBER = (
    rf"^[{SP}]*[+-]?(?:(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?"
    rf"|(?i:inf|infinity|nan))[{SP}]*$"
)
_INTEGER = rf"^[{SP}]*[+-]?{_DIGITS}[{SP}]*$"

MALFORMED_ERROR = "processing_error: malformed record"
INFINITE_FLAG_ERROR = "processing_error: cannot convert float infinity to integer"


def presence_reasons(
    utterance_id: Column, audio_path: Column, language: Column, text: Column
) -> list[Column]:
    """The presence and language gates, in order; inputs are null-safe strings."""
    supported = F.lower(language).isin(LANGUAGE_CODES)
    return [
        F.when(utterance_id == "", "missing_utterance_id"),
        F.when(audio_path == "", "missing_audio_path"),
        F.when(language == "", "missing_language"),
        F.when(is_blank(text), "empty_transcription"),
        F.when((language != "") & ~supported, "unsupported_language"),
    ]


def _bare_number(col: Column) -> Column:
    return F.regexp_replace(col, f"[{SP}_]+", "").try_cast("double")


def duration_reason(duration: Column, dtype: T.DataType, config: GateConfig) -> Column:
    """Too short, too long, or not a number; zero, missing and NaN pass."""
    if isinstance(dtype, T.StringType):
        seconds = _bare_number(duration)
        malformed = duration.isNotNull() & (duration != "") & ~duration.rlike(_NUMBER)
    else:
        seconds = duration.cast("double")
        malformed = F.lit(False)
    real = seconds.isNotNull() & ~F.isnan(seconds) & (seconds != 0)
    return (
        F.when(malformed, "invalid_duration_format")
        .when(real & (seconds < float(config.min_duration)), "duration_too_short")
        .when(real & (seconds > float(config.max_duration)), "duration_too_long")
    )


def path_reason(audio_path: Column, language: Column, config: GateConfig) -> Column:
    if not config.check_language_mismatch:
        return F.lit(None).cast("string")
    return F.when(language_path_mismatch(audio_path, language), "language_path_mismatch")


def text_reasons(metrics: Column, config: GateConfig) -> list[Column]:
    """Score, word count and repetition gates over a metrics struct."""
    return [
        F.when(
            metrics["quality_score"] < float(config.min_text_quality_score), "low_text_quality"
        ),
        F.when(metrics["word_count"] < config.min_word_count, "too_few_words"),
        F.when(
            metrics["repeated_word_ratio"] > float(config.max_repeated_word_ratio),
            "too_many_repeated_words",
        ),
    ]


def script_reason(script: Column) -> Column:
    """A wrong script rejects only when its share of the letters is below one half."""
    return F.when(
        ~script["is_valid"] & (script["confidence"] < 0.5),
        F.concat(F.lit("script_mismatch_"), script["detected_script"]),
    )


def _flag_number(flag: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        # texts count only when they spell an integer
        return F.when(flag.rlike(_INTEGER), _bare_number(flag))
    return flag.cast("double")


def flag_reason(flag: Column, dtype: T.DataType) -> Column:
    """Negative after truncation toward zero; missing and unreadable flags pass."""
    return F.when(_flag_number(flag, dtype) <= -1, "negative_quality_flag")


def flag_is_infinite(flag: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return F.lit(False)
    return F.coalesce(F.abs(flag.cast("double")) == float("inf"), F.lit(False))


def reason_list(*reasons: Column) -> Column:
    return F.array_compact(F.array(*reasons))
