"""The two halves of a verdict table.

A verdict is one struct column under a reserved name beside the input columns, so an input may have columns named like
its fields, or come from an earlier gate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uttergate.functions.text import safe_string
from uttergate.schema import MALFORMED

#: is_valid, reasons, transcription_normalized, normalization, text_metrics, script, audio
VERDICT = "gate_verdict"


def column(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def others(names: list[str], taken: list[str]) -> list[Column]:
    """Columns but for those that new ones replace; names differ by more than case."""
    gone = {t.lower() for t in taken}
    return [column(n) for n in names if n.lower() not in gone]


def fields(judged: DataFrame) -> DataFrame:
    """The verdict's fields alone."""
    return judged.select(f"{VERDICT}.*")


def expanded(judged: DataFrame) -> DataFrame:
    """Input columns with the verdict's fields beside them, which replace inputs of the same name."""
    names = judged.schema[VERDICT].dataType.names
    return judged.select(*others(judged.columns, [VERDICT, *names]), f"{VERDICT}.*")


def _half(judged: DataFrame, keep: Column, added: dict[str, Column]) -> DataFrame:
    kept = others(judged.columns, [VERDICT, *added])
    return judged.where(keep).select(*kept, *[c.alias(n) for n, c in added.items()])


def train_ready(judged: DataFrame) -> DataFrame:
    """Accepted rows: input columns, normalised text, quality score (of this gate, if there was one before)."""
    v = F.col(VERDICT)
    added = {
        "transcription_normalized": v["transcription_normalized"],
        "text_quality_score": v["text_metrics"]["quality_score"],
    }
    return _half(judged, v["is_valid"], added).drop(MALFORMED)  # null in all of them


def rejected(judged: DataFrame) -> DataFrame:
    """Rejected rows: input columns, joined reasons, original text."""
    v = F.col(VERDICT)
    added = {
        "reason": F.concat_ws("; ", v["reasons"]),
        "original_transcription": safe_string(F.col("transcription_raw")),
    }
    return _half(judged, ~v["is_valid"], added)
