"""Text quality metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uttergate.functions.charclass import ALNUM, SP, low_class
from uttergate.functions.template import staged, template
from uttergate.functions.text import HIGH, pin


_LOW_ALNUM_OR_SPACE = low_class(lambda c: c.isalnum() or c.isspace())


def quality_score(repeated_ratio: Column, word_count: Column, avg_length: Column) -> Column:
    """1.0 damped by fixed factors; the factors multiply in this order so that bits agree."""
    return (
        F.lit(1.0)
        * F.when(repeated_ratio > 0.7, 0.3).otherwise(1.0)
        * F.when(word_count < 3, 0.5).otherwise(1.0)
        * F.when(avg_length < 2, 0.7).otherwise(1.0)
    )


def with_text_metrics(
    df: DataFrame, text: str, out: str = "text_metrics", single_spaced: bool = False
) -> DataFrame:
    """Add a struct of six metrics; blank text gets the fixed values 0, 0, 0, 0.0, 1.0, 0.0.

    ``single_spaced`` promises stripped text whose only white space is one space between words,
    which is what the normaliser returns; words and lengths are then cheaper to get.
    """
    return staged(df, *_metric_steps(text, out, single_spaced))


@template
def _metric_steps(text: str, out: str, single_spaced: bool) -> tuple[list[dict], list[str]]:
    t = F.col(text)
    words, n, chars, letters, distinct = (
        F.col(c) for c in ("_ug_words", "_ug_n", "_ug_chars", "_ug_in_words", "_ug_distinct")
    )
    if single_spaced:
        split = F.when(t != "", F.split(t, " "))
    else:
        pieces = F.filter(F.split(t, f"[{SP}]+"), lambda w: w != "")
        split = F.when(F.size(pieces) > 0, pieces)
    count = F.when(words.isNotNull(), F.size(words))
    in_words = (
        F.length(t) - (count - 1) if single_spaced else F.length(F.regexp_replace(t, f"[{SP}]+", ""))
    )
    counted = {
        "_ug_n": count,
        "_ug_chars": F.length(t),
        "_ug_in_words": in_words,
        "_ug_distinct": F.size(F.array_distinct(words)),
    }
    avg_length = F.coalesce(letters / n, F.lit(0.0))
    repeated = F.coalesce((n - distinct) / n, F.lit(1.0))
    left = F.when((F.octet_length(t) > chars) & t.rlike(HIGH), F.regexp_replace(t, f"[{ALNUM}{SP}]+", "")).otherwise(
        F.regexp_replace(t, f"[{_LOW_ALNUM_OR_SPACE}]+", "")
    )
    punctuation = F.length(left) / chars
    ratios = {"_ug_avg": avg_length, "_ug_repeated": repeated}
    score = F.when(n.isNull(), 0.0).otherwise(quality_score(F.col("_ug_repeated"), n, F.col("_ug_avg")))
    # Each metric is pinned on its own, so that those nobody asks for are pruned.
    metrics = {
        "quality_score": score,
        "word_count": F.coalesce(n, F.lit(0)),
        "char_count": F.when(n.isNull(), 0).otherwise(chars),
        "avg_word_length": F.col("_ug_avg"),
        "repeated_word_ratio": F.col("_ug_repeated"),
        "punctuation_ratio": F.when(n.isNull(), 0.0).otherwise(punctuation),
    }
    pinned = {f"_ug_m_{name}": pin(metric) for name, metric in metrics.items()}
    struct = F.struct(*[F.col(f"_ug_m_{name}").alias(name) for name in metrics])
    return [{"_ug_words": split}, counted, ratios, pinned, {out: struct}], ["_ug_words", *counted, *ratios, *pinned]
