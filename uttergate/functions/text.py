"""Transcription normaliser as column expressions.

Each step is ``Column -> Column``. ``with_normalized_text`` stages the steps as successive
projections, so that a step used twice (as input of the next step and in the trace) is
computed once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from uttergate.config import GateConfig
from uttergate.functions.charclass import (
    LETTER,
    LOW,
    MARK,
    SP,
    SP_NOT_BLANK,
    WORD,
    composition_needed,
    kept_class,
    low_class,
)
from uttergate.functions.template import staged, template

# Hindi words for the digits 0 to 9.
HINDI_DIGIT_WORDS = ["शून्य", "एक", "दो", "तीन", "चार", "पांच", "छह", "सात", "आठ", "नौ"]

# Punctuation mapped one to one, and the ellipsis.
PUNCTUATION_FROM = "।॥‘’‛“”„–—"
PUNCTUATION_TO = "..'''\"\"\"--"
ELLIPSIS = "…"

# Punctuation that survives normalisation.
KEPT_PUNCTUATION = ".,!?-'" + '"'

# A text has one of these code points, or is all below ``LOW``.
HIGH = rf"[\x{{{LOW:x}}}-\x{{10ffff}}]"
_LOW_SPACES = low_class(lambda c: c.isspace() and c != " ")
_LOW_SPECIAL = low_class(lambda c: not (c.isalnum() or c.isspace() or c in ".,!?-'\"_"))
# In texts below LOW, what full lower-casing may change beyond A-Z, and a little more.
_LOW_CASED = low_class(lambda c: c >= "\u0100" or "À" <= c <= "Þ" and c != "×")


def _clean(c: str) -> bool:
    return c.isalnum() or c in " \n.,!?-'\"_"


# Whole texts below LOW without anything to drop, whose only white space is blanks and line feeds, and of these the
# ones that full lower-casing changes in A-Z only. One class repeated: the engine loops over it without a stack.
CLEAN = rf"^[{low_class(_clean)}]*\z"
SIMPLE = rf"^[{low_class(lambda c: _clean(c) and (c < chr(0xC0) or chr(0xDF) <= c < chr(0x100)))}]*\z"

# Non-ASCII code points that full lower-casing would change.
_CASED_BEYOND_ASCII = (
    "[ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ"
    r"[\x{100}-\x{10ffff}&&[\p{Lu}\p{Lt}\x{1c89}\x{2160}-\x{216f}\x{24b6}-\x{24cf}\x{2c2f}"
    r"\x{a7c0}-\x{a7dc}\x{10570}-\x{10595}\x{10d50}-\x{10d65}]]]"
)


def pin(col: Column) -> Column:
    """The same value, computed where it stands.

    The optimizer moves filters below deterministic projections by copying the filtered
    expression. For a column that stands for dozens of steps this repeats all of them, so such
    columns are marked as depending on the task; filters then stay above.
    """
    return F.when(F.spark_partition_id() >= 0, col)


def safe_string(col: Column, dtype: T.DataType | None = None) -> Column:
    """Text of a value; missing values, NaN in a column of numbers among them, are empty."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        col = F.when(~F.isnan(col), col)
    return F.coalesce(col.cast("string"), F.lit(""))


def has_any(col: Column, members: str) -> Column:
    """Whether a text has a character of the class. Most texts show one at once, and need not be decoded whole."""
    return F.substring(col, 1, 16).rlike(f"[{members}]") | col.rlike(f"[{members}]")


def is_blank(col: Column) -> Column:
    """True for null, empty and white-space-only text."""
    return col.isNull() | ~has_any(col, f"^{SP}")


def strip(col: Column) -> Column:
    """Trim every kind of white space, not only spaces."""
    return F.regexp_replace(col, f"^[{SP}]+|[{SP}]+$", "")


def collapse_spaces(col: Column) -> Column:
    """Runs of white space become one space; a lone space is not rewritten."""
    return F.regexp_replace(col, f" [{SP}]+|[{SP_NOT_BLANK}][{SP}]*", " ")


def _nfc_udf():
    # Built inside a function so that workers receive it by value.
    @F.arrow_udf(T.StringType())
    def nfc(texts):
        import unicodedata

        import pyarrow as pa

        def changed(t):
            if t is None or unicodedata.is_normalized("NFC", t):
                return None
            return unicodedata.normalize("NFC", t)

        return pa.array(map(changed, texts.to_pylist()), pa.string())

    return nfc


def nfc(col: Column, worth: Column | None = None) -> Column:
    """Canonical composition.

    Spark has no built-in for it. Only texts with a place where composition may apply reach Python and only changed
    texts come back; all others cross as nulls and keep their JVM string. ``worth`` can rule texts out more cheaply.
    """
    return F.coalesce(_nfc_udf()(nfc_suspect(col, worth)), col)


def nfc_suspect(col: Column, worth: Column | None = None) -> Column:
    """The text where it may differ from its composed form, else null. Composed text is no suspect, unless two
    combining marks stand together."""
    cheap, found, beyond = composition_needed()
    sensitive = col.rlike(f"[{cheap}]")
    sensitive = sensitive if worth is None else worth & sensitive
    place = col.rlike(found) | (col.rlike(r"[\x{10000}-\x{10ffff}]") & col.rlike(beyond))
    return F.when(F.when(sensitive, place).otherwise(False), col)


def strip_marks(col: Column) -> Column:
    """Delete every nonspacing mark; the nuktas and combining diacritics are among them."""
    return F.regexp_replace(col, f"[{MARK}]+", "")


def strip_accents(col: Column) -> Column:
    """Delete the combining diacritics of Latin, Greek and Cyrillic; other marks belong to their words."""
    return F.regexp_replace(col, r"[\x{300}-\x{36f}]+", "")


def expand_digits(col: Column, language: Column) -> Column:
    """Stand-alone digits become Hindi words; other languages keep theirs."""
    # The digit comes first, so that the look-arounds run only where one stands. The letter
    # U+20000 is in the class already; a literal one makes the look-behind step over whole
    # code points instead of UTF-16 units.
    lone = r"{d}(?<![{w}𠀀]{d})(?![{w}])"
    out = col
    for digit, word in enumerate(HINDI_DIGIT_WORDS):
        out = F.regexp_replace(out, lone.format(w=WORD, d=digit), word)
    has_lone = col.rlike(lone.format(w=WORD, d="[0-9]"))
    return F.when((language == "hi") & has_lone, out).otherwise(col)


def cased_beyond_ascii(col: Column, high: Column) -> Column:
    """Whether full lower-casing changes more than A-Z; ``high`` tells texts that had code points from ``LOW`` on."""
    return F.when(high, col.rlike(_CASED_BEYOND_ASCII)).otherwise(
        col.rlike(f"[{_LOW_CASED}]") & col.rlike(_CASED_BEYOND_ASCII)
    )


def lowercase(col: Column, language: Column, cased: Column | None = None) -> Column:
    """Full lower-casing for English, A-Z only for every other language."""
    ascii_only = ~(col.rlike(_CASED_BEYOND_ASCII) if cased is None else cased)
    return F.when((language == "en") | ascii_only, F.lower(col)).otherwise(_lower_ascii(col))


def _lower_ascii(col: Column) -> Column:
    """A-Z in lower case."""
    return _mapped_at(col, "[A-Z]", F.lower)


def _mapped_at(col: Column, members: str, step: Callable[[Column], Column]) -> Column:
    """The text with ``step`` done to each character of a class, which cost a table lookup for every character.

    It is cut before each of them, so that they head the pieces. The blank put before it heads the first piece."""

    def mapped(piece: Column) -> Column:
        return F.concat(step(F.substring(piece, 1, 1)), F.substring(piece, 2, 0x7FFFFFFF))

    pieces = F.split(F.concat(F.lit(" "), col), f"(?={members})")
    return F.substring(F.array_join(F.transform(pieces, mapped), ""), 2, 0x7FFFFFFF)


def map_punctuation(col: Column) -> Column:
    """Dandas, quotes, dashes and the ellipsis to their ASCII forms."""
    members = rf"[\x{{964}}-\x{{2026}}&&[{PUNCTUATION_FROM}{ELLIPSIS}]]"

    def ascii_form(c: Column) -> Column:
        return F.replace(F.translate(c, PUNCTUATION_FROM, PUNCTUATION_TO), F.lit(ELLIPSIS), F.lit("..."))

    return F.when(col.rlike(members), _mapped_at(col, members, ascii_form)).otherwise(col)


def drop_special(col: Column, keep_marks: bool = False) -> Column:
    """Keep words, white space and the basic punctuation; on request the marks of words too."""
    marks = r"\p{M}" + MARK if keep_marks else ""
    return F.regexp_replace(col, f"[^{kept_class(KEPT_PUNCTUATION + '_')}{marks}]+", "")


def _plain_spaces(col: Column) -> Column:
    return F.regexp_replace(col, f"[{SP_NOT_BLANK}]+", " ")


def normalize_punctuation(col: Column) -> Column:
    return drop_special(collapse_spaces(map_punctuation(col)))


def final_cleanup(col: Column) -> Column:
    """Strip, collapse, and drop empty brackets."""
    out = collapse_spaces(strip(col))
    for opening, closing in (r"\(", r"\)"), (r"\[", r"\]"), (r"\{", r"\}"):
        out = F.regexp_replace(out, f"{opening}[{SP}]*{closing}", "")
    return out


def _cleanup_after_punctuation(col: Column) -> Column:
    # Only spaces are left as white space and brackets are gone, so the cheap forms suffice.
    trimmed = F.trim(col)
    return F.when(trimmed.contains("  "), F.regexp_replace(trimmed, " {2,}", " ")).otherwise(
        trimmed
    )


def with_normalized_text(
    df: DataFrame,
    text: str,
    language: str,
    config: GateConfig | None = None,
    out: str = "transcription_normalized",
    trace: str | None = None,
) -> DataFrame:
    """Add the normalised text, and on request a trace struct of what was done to it.

    The trace holds ``operations`` in order, ``original_length``, ``final_length`` and
    ``reduction_ratio``; it is null for blank text, which normalises to ``''``.
    """
    return staged(df, *_normal_steps(text, language, config or GateConfig(), out, trace))


@template
def _normal_steps(
    text: str, language: str, config: GateConfig, out: str, trace: str | None
) -> tuple[list[dict], list[str]]:
    raw, lang = F.col(text), F.col(language)
    s = [f"_ug_s{i}" for i in range(7)]

    # Nothing below U+0300 composes, is a mark or is mapped punctuation.
    high, cased, low = F.col("_ug_high"), F.col("_ug_cased"), F.col("_ug_low")
    simple, clean = F.col("_ug_simple"), F.col("_ug_clean")
    stages = [{s[0]: F.when(~is_blank(raw), raw)}]
    # Most texts are told by one scan to need none of the scans below.
    stages.append({"_ug_simple": F.col(s[0]).rlike(SIMPLE)})
    stages.append({"_ug_clean": simple | F.col(s[0]).rlike(CLEAN)})
    stages.append({"_ug_high": ~clean & F.col(s[0]).rlike(HIGH)})

    def if_high(step):
        return lambda c: F.when(high, step(c)).otherwise(c)

    def punctuation(c: Column) -> Column:
        # Runs of spaces are left to the cleanup; the trace below accounts for them.
        general = drop_special(_plain_spaces(if_high(map_punctuation)(c)), config.keep_marks)
        plain = F.regexp_replace(F.regexp_replace(c, f"[{_LOW_SPACES}]+", " "), f"[{_LOW_SPECIAL}]+", "")
        blanks = F.array_join(F.split(c, "\n"), " ")
        return F.when(low & clean, blanks).when(low, plain).otherwise(general)

    compose = (lambda c: nfc(c, high)) if config.apply_unicode_nfc else None
    strip_step = strip_accents if config.keep_marks else strip_marks
    first = [compose, if_high(strip_step) if config.remove_diacritics else None]
    names = ["unicode_nfc", "diacritics_removed"]
    if config.keep_marks:  # accents go before they can be composed
        first.reverse()
        names.reverse()
    steps = [
        *first,
        (lambda c: expand_digits(c, lang)) if config.expand_numbers else None,
        lambda c: lowercase(c, lang, cased),
        punctuation if config.normalize_punctuation else None,
        _cleanup_after_punctuation if config.normalize_punctuation else final_cleanup,
    ]
    for i, step in enumerate(steps):
        col = F.col(s[i])
        if i == 3:
            stages.append({"_ug_cased": ~simple & cased_beyond_ascii(col, high)})
            # Words for digits and full lower-casing can bring code points from LOW on into a text without.
            spelled = (lang == "hi") & (F.col(s[2]) != F.col(s[3])) if config.expand_numbers else F.lit(False)
            still = ~high & ~spelled & ~(cased & (lang == "en"))
            stages.append({"_ug_low": F.coalesce(still, F.lit(False))})
        stages.append({s[i + 1]: col if step is None else step(col)})

    cleaned = F.col(s[6])
    result = cleaned if config.normalize_punctuation else strip(cleaned)
    added = {out: pin(F.coalesce(result, F.lit("")))}
    if trace:
        named = [
            (names[0], 0),
            (names[1], 1),
            ("numbers_expanded", 2),
            ("punctuation_normalized", 4),
        ]
        changed = {n: F.col(s[i]) != F.col(s[i + 1]) for n, i in named}
        if config.normalize_punctuation:
            changed["punctuation_normalized"] |= F.col(s[4]).contains("  ")
        # The comparisons have a step of their own, as array_compact would interpret them.
        done = F.array(*[F.when(differs, F.lit(n)) for n, differs in changed.items()])
        stages.append({"_ug_done": pin(done), "_ug_before": F.length(s[0]), "_ug_after": F.length(cleaned)})
        before, after = F.col("_ug_before"), F.col("_ug_after")
        added[trace] = pin(
            F.when(
                cleaned.isNotNull(),
                F.struct(
                    F.array_compact("_ug_done").alias("operations"),
                    before.alias("original_length"),
                    after.alias("final_length"),
                    (1 - after / before).alias("reduction_ratio"),
                ),
            )
        )
    spare = [*s, "_ug_simple", "_ug_clean", "_ug_high", "_ug_cased", "_ug_low", "_ug_done", "_ug_before", "_ug_after"]
    return [*stages, added], spare


def letter_count(col: Column) -> Column:
    return F.length(F.regexp_replace(col, f"[^{LETTER}]+", ""))
