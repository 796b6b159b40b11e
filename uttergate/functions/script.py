"""Writing-script profile and verdict."""

from __future__ import annotations

import string

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from uttergate.functions.charclass import LETTER, SCRIPT_TOKENS, WIDE_LETTER, script_letters
from uttergate.functions.template import staged, template
from uttergate.functions.text import has_any, is_blank, letter_count, pin
from uttergate.schema import LANGUAGES

_TAIL_TYPE = T.StructType(
    [T.StructField("token", T.StringType()), T.StructField("n", T.IntegerType())]
)


def _tail_udf():
    # Built inside a function so that workers receive it by value. It is a pandas UDF while the
    # normaliser's is an Arrow UDF: the optimizer fuses projections holding Python UDFs of one
    # kind, which would inline every staged column between the two.
    def dominant(letters: pd.Series) -> pd.DataFrame:
        import unicodedata

        import numpy as np
        import pandas

        def tally(text):
            codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
            distinct, first, n = np.unique(codes, return_index=True, return_counts=True)
            counts: dict[str, int] = {}
            for i in np.argsort(first):
                token = unicodedata.name(chr(distinct[i]), "").partition(" ")[0] or "UNKNOWN"
                counts[token] = counts.get(token, 0) + int(n[i])
            # dicts keep first-seen order and max takes the first of equals
            best = max(counts, key=counts.get)
            return best, counts[best]

        rows = [(None, None) if t is None else tally(t) for t in letters]
        out = pandas.DataFrame(rows, columns=["token", "n"])
        return out.astype({"token": object, "n": "Int32"})

    return F.pandas_udf(dominant, _TAIL_TYPE)


def expected_script(language: Column) -> Column:
    """Script name of a language code (exact case), UNKNOWN for others."""
    scripts = F.create_map(*[F.lit(v) for code, _, s in LANGUAGES for v in (code, s)])
    return F.coalesce(F.try_element_at(scripts, language), F.lit("UNKNOWN"))


def with_script(
    df: DataFrame, text: str, language: str, out: str = "script"
) -> DataFrame:
    """Add ``struct<is_valid, confidence, detected_script>``.

    The dominant script is the commonest first word of the letters' Unicode names, ties going
    to the one seen first. Three tiers, by falling frequency: texts in ASCII and the main Latin
    blocks need two scans; in texts of the ten expected scripts a table gives every letter's script in
    one pass, and the scripts are counted; only texts with other letters reach Python.
    """
    return staged(df, *_script_steps(text, language, out))


@template
def _script_steps(text: str, language: str, out: str) -> tuple[list[dict], list[str]]:
    t, lang = F.col(text), F.col(language)
    plain = (F.octet_length(t) == F.length(t)) | ~t.rlike(r"[\x{aa}\x{b5}\x{ba}\x{2b0}-\x{10ffff}]")
    steps = [{"_ug_plain": plain}]
    # Each letter of an expected script becomes that script's mark, in ASCII; all else stays as it is.
    by_script = script_letters()
    marks = dict(zip(SCRIPT_TOKENS, string.ascii_uppercase, strict=False))
    table = "".join(by_script.values()), "".join(marks[k] * len(v) for k, v in by_script.items())
    steps.append({"_ug_marked": F.when(F.col("_ug_plain"), "").otherwise(F.translate(t, *table))})
    marked, counts, letters = F.col("_ug_marked"), F.col("_ug_counts"), F.col("_ug_letters")
    tallies = []
    for token, mark in marks.items():
        there = marked.contains(mark)  # cheaper than what follows, and most texts hold one script or two
        n = F.length(marked) - F.length(F.replace(marked, F.lit(mark), F.lit("")))
        n, early = F.when(there, n).otherwise(0), F.when(there, -F.instr(marked, mark)).otherwise(0)
        tallies.append(F.struct(n.alias("n"), early.alias("early"), F.lit(token).alias("token")))
    steps.append(
        {
            "_ug_counts": F.array(*tallies),
            # letters of all scripts, only where there are some beyond the ten
            "_ug_letters": F.when(marked.rlike(f"[{WIDE_LETTER}]"), F.regexp_replace(t, f"[^{LETTER}]+", "")),
        }
    )
    steps.append({"_ug_best": F.array_max(counts), "_ug_tail": _tail_udf()(letters)})
    best, tail = F.col("_ug_best"), F.col("_ug_tail")
    known = sum((counts[i]["n"] for i in range(1, len(marks))), counts[0]["n"])
    has_letter = F.when(F.col("_ug_plain"), has_any(t, LETTER)).otherwise((known > 0) | letters.isNotNull())
    named = (
        F.when(is_blank(t), "empty")
        .when(~has_letter, "no_alpha")
        .when(F.col("_ug_plain"), "LATIN")
        .otherwise(F.coalesce(tail["token"], best["token"]))
    )
    token = F.col("_ug_token")
    share = (
        F.when(token.isin("empty", "no_alpha"), 0.0)
        .when(F.col("_ug_plain"), 1.0)
        .otherwise(F.coalesce(tail["n"] / F.length(letters), F.try_divide(best["n"], known)))
    )
    steps += [{"_ug_token": named}, {"_ug_conf": share, "_ug_expected": expected_script(lang)}]
    conf, expected = F.col("_ug_conf"), F.col("_ug_expected")
    valid = (
        F.when(token.isin("empty", "no_alpha"), False)
        .when((lang == "en") & token.contains("LATIN"), conf > 0.7)
        .when(
            F.upper(token).contains(expected) | F.upper(expected).contains(token), conf > 0.5
        )
        .otherwise(False)
    )
    script = F.struct(valid.alias("is_valid"), conf.alias("confidence"), token.alias("detected_script"))
    steps.append({out: pin(script)})
    return steps, ["_ug_plain", "_ug_token", "_ug_conf", "_ug_best", "_ug_tail", "_ug_letters", "_ug_marked", "_ug_counts", "_ug_expected"]


def latin_consistency(text: Column, language: Column) -> Column:
    """``struct<consistent, confidence>``: share of ASCII letters for Latin-script languages.

    Other supported languages, and texts without letters, get the fixed answer (true, 0.6).
    """
    supported = [code for code, _, _ in LANGUAGES]
    latin = [code for code, _, script in LANGUAGES if script == "Latin"]
    lang = F.lower(language)
    total = letter_count(text)
    ascii_letters = F.length(F.regexp_replace(text, "[^A-Za-z]+", ""))
    known = (
        text.isNotNull() & (text != "") & language.isNotNull() & lang.isin(supported)
    )
    confidence = (
        F.when(~known | known.isNull(), 0.0)
        .when(lang.isin(latin) & (total > 0), ascii_letters / total)
        .otherwise(0.6)
    )
    consistent = (
        F.when(~known | known.isNull(), False)
        .when(lang.isin(latin) & (total > 0), ascii_letters / total > 0.7)
        .otherwise(True)
    )
    return F.struct(consistent.alias("consistent"), confidence.alias("confidence"))
