import random
import re
import sys
import unicodedata

import pyoracle
import pytest
from pyspark.sql import functions as F

from uttergate.config import GateConfig
from uttergate.functions import charclass as C
from uttergate.functions.metrics import with_text_metrics
from uttergate.functions.script import latin_consistency, with_script
from uttergate.functions.text import _lower_ascii, map_punctuation, nfc_suspect, with_normalized_text
from uttergate.plans.report import normalizer_counters

BLOCKS = [
    (0x20, 0x7E),
    (0xA0, 0x24F),
    (0x300, 0x36F),
    (0x370, 0x3FF),
    (0x400, 0x52F),
    (0x600, 0x6FF),
    (0x900, 0x97F),
    (0x980, 0x9FF),
    (0xA00, 0xA7F),
    (0xA80, 0xAFF),
    (0xB80, 0xBFF),
    (0xC00, 0xC7F),
    (0xC80, 0xCFF),
    (0xD00, 0xD7F),
    (0x1100, 0x11FF),
    (0x1E00, 0x1EFF),
    (0x2010, 0x2030),
    (0x3040, 0x30FF),
    (0x4E00, 0x4E40),
    (0xAC00, 0xAC40),
    (0x1F600, 0x1F640),
    (0x16A70, 0x16AC9),
    (0x31350, 0x31360),
]
SPACES = [chr(cp) for cp in range(sys.maxunicode + 1) if chr(cp).isspace()]
LANGS = ["hi", "bn", "te", "ta", "ml", "kn", "gu", "mr", "pa", "ur", "en", "fr", "", "HI"]


def random_texts(n, seed):
    rng = random.Random(seed)
    for i in range(n):
        blocks = rng.sample(BLOCKS, rng.choice([1, 1, 2, 3]))
        chars = []
        for _ in range(rng.randint(0, 40)):
            kind = rng.random()
            if kind < 0.15:
                chars.append(rng.choice(SPACES))
            elif kind < 0.25:
                chars.append(rng.choice("0123456789"))
            elif kind < 0.35:
                chars.append(rng.choice(".,!?-'\"()[]{}@_।॥‘’‛“”„–—…İΣßẞ"))
            elif kind < 0.42:
                chars.append(rng.choice("़̣́াᅡᆨ゙ٔ"))
            else:
                chars.append(chr(rng.randint(*rng.choice(blocks))))
        yield i, "".join(chars), rng.choice(LANGS)


@pytest.fixture(scope="module")
def random_frame(spark):
    rows = list(random_texts(6000, seed=7))
    df = spark.createDataFrame(rows, "i int, text string, lang string").repartition(8, "i")
    df = with_normalized_text(df, "text", "lang", out="norm", trace="t")
    df = with_text_metrics(df, "norm", out="m", single_spaced=True)
    df = with_text_metrics(df, "text", out="raw")
    df = with_script(df, "norm", "lang", out="k")
    df = with_script(df, "text", "lang", out="kraw")
    return df.collect()


def test_normaliser_matches_plain_python(random_frame):
    for r in random_frame:
        want = pyoracle.normalized(r.text, r.lang)
        if want is None:
            assert r.norm == "" and r.t is None
            continue
        got = (r.norm, r.t.operations, r.t.original_length, r.t.final_length)
        assert got == want, (r.text, r.lang)
        assert r.t.reduction_ratio == 1 - want[3] / want[2]


def test_metrics_match_plain_python(random_frame):
    for r in random_frame:
        assert tuple(r.m) == pyoracle.metrics(r.norm), r.norm
        assert tuple(r.raw) == pyoracle.metrics(r.text), r.text


def test_script_matches_plain_python(random_frame):
    for r in random_frame:
        assert tuple(r.k) == pyoracle.script(r.norm, r.lang), (r.norm, r.lang)
        assert tuple(r.kraw) == pyoracle.script(r.text, r.lang), (r.text, r.lang)


def test_character_classes_are_exact(spark):
    def rows(batches):
        import pandas as pd

        for pdf in batches:
            yield pd.DataFrame({"cp": pdf["id"], "c": [chr(i) for i in pdf["id"]]})

    codes = spark.range(sys.maxunicode + 1).where("id < 55296 OR id > 57343")
    flags = {"word": C.WORD, "letter": C.LETTER, "alnum": C.ALNUM, "mark": C.MARK, "space": C.SP}
    flags["sensitive"] = C.composition_needed()[0]
    got = (
        codes.mapInPandas(rows, "cp long, c string")
        .select("cp", *[F.col("c").rlike(f"[{body}]").alias(n) for n, body in flags.items()])
        .collect()
    )
    for r in got:
        ch = chr(r.cp)
        assert r.word == (ch.isalnum() or ch == "_"), hex(r.cp)
        assert r.letter == ch.isalpha(), hex(r.cp)
        assert r.alnum == ch.isalnum(), hex(r.cp)
        assert r.mark == (unicodedata.category(ch) == "Mn"), hex(r.cp)
        assert r.space == ch.isspace(), hex(r.cp)
        if unicodedata.normalize("NFC", ch) != ch or unicodedata.combining(ch):
            assert r.sensitive, hex(r.cp)


def members(body):
    """How many members each level of a class has; nested ones behind bounds are levels of their own."""
    depth, counts, sizes = 0, [0], []
    for token in re.findall(r"\\x\{\w+\}(?:-\\x\{\w+\})?(?:&&)?|\[|\]", body):
        if token == "[":
            counts[-1] += 1
            counts.append(0)
        elif token == "]":
            sizes.append(counts.pop())
        elif not token.endswith("&&"):
            counts[-1] += 1
    return [*sizes, *counts]


def test_long_classes_are_trees():
    ranges = [(cp, cp + 1) for cp in range(0x300, 0x3000, 7)]
    assert max(members(C.class_body(ranges))) <= 4


def test_letters_are_not_compared_with_every_second_half():
    # one alternative for each set of first halves, tried at every character, would be about a hundred
    cheap, found, _ = C.composition_needed()
    assert found.startswith(f"(?=[{cheap}])")


def test_every_letter_has_its_script(spark):
    letters = [chr(cp) for cp in range(sys.maxunicode + 1) if chr(cp).isalpha()]
    rows = [(i, ch, "hi") for i, ch in enumerate(letters)]
    df = with_script(spark.createDataFrame(rows, "i int, text string, lang string"), "text", "lang")
    got = {r.i: tuple(r.script) for r in df.collect()}
    for i, ch in enumerate(letters):
        token = unicodedata.name(ch, "").partition(" ")[0] or "UNKNOWN"
        assert got[i] == pyoracle.script(ch, "hi") and got[i][2] == token, hex(ord(ch))


CASES = [
    # text, language, normalised, operations
    ("café", "hi", "café", []),
    ("café", "hi", "café", ["unicode_nfc"]),
    ("क़िताब", "hi", "कतब", ["diacritics_removed", "punctuation_normalized"]),
    ("àb́c", "hi", "àb́c".replace("́", ""), ["unicode_nfc", "diacritics_removed"]),
    ("1 2 3", "hi", "एक द तन", ["numbers_expanded", "punctuation_normalized"]),
    ("10 2x _3 4", "hi", "10 2x _3 चर", ["numbers_expanded", "punctuation_normalized"]),
    ("We counted 7 boats", "en", "we counted 7 boats", []),
    ("5 6", "mr", "5 6", []),
    ("Hello—world", "en", "hello-world", ["punctuation_normalized"]),
    ("Wait…", "en", "wait...", ["punctuation_normalized"]),
    ("Multiple   spaces", "en", "multiple spaces", ["punctuation_normalized"]),
    ("HELLO World", "en", "hello world", []),
    ("ÉCOLE ABC", "fr", "École abc", []),
    ("नमस्ते", "hi", "नमसत", ["diacritics_removed"]),
    ("hello ( ) world", "en", "hello world", ["punctuation_normalized"]),
    ("hello [ ] world", "en", "hello world", ["punctuation_normalized"]),
    ("Fare: £12.40 [child: 50%]", "en", "fare 12.40 child 50", ["punctuation_normalized"]),
    ("Bread 🥖 and a ™ sign", "en", "bread and a sign", ["punctuation_normalized"]),
    ("", "hi", "", None),
    (" \n\t ", "hi", "", None),
    (None, "hi", "", None),
]


def test_literal_cases(spark):
    rows = [(i, t, lang) for i, (t, lang, _, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "i int, text string, lang string").coalesce(2)
    df = with_normalized_text(df, "text", "lang", out="norm", trace="t")
    got = {r.i: r for r in df.collect()}
    for i, (text, lang, norm, ops) in enumerate(CASES):
        if text is not None:
            assert norm == (pyoracle.normalized(text, lang) or ("",))[0], text
        assert got[i].norm == norm, text
        assert (got[i].t.operations if got[i].t else None) == ops, text
    counters = normalizer_counters(df, "t").first()
    assert counters.total_processed == sum(ops is not None for *_, ops in CASES)
    assert counters.unicode_normalized == 2


INDIC = ["हिन्दी में लिखा हुआ", "বাংলা ভাষায় লেখা কোন", "తెలుగు లో రాసినది", "தமிழில் எழுதியது கொண்டு", "മലയാളത്തിൽ എഴുതിയത്", "ಕನ್ನಡದಲ್ಲಿ ಬರೆದದ್ದು", "ગુજરાતીમાં લખેલું", "मराठीत लिहिलेले", "ਪੰਜਾਬੀ ਵਿੱਚ", "اردو میں لکھا ہوا", "written in English, naïve café"]


def test_composed_text_stays_out_of_python(spark):
    texts = [unicodedata.normalize("NFC", t) for t in INDIC]
    # two marks on one letter may have to be put in order
    apart = [t for t in texts if not any(unicodedata.combining(a) and unicodedata.combining(b) for a, b in zip(t, t[1:]))]
    assert len(apart) >= 10
    df = spark.createDataFrame([(t,) for t in apart], "t string")
    assert df.select(nfc_suspect(F.col("t")).alias("s")).where("s IS NOT NULL").count() == 0


def test_no_uncomposed_text_is_missed(spark):
    marks = [chr(c) for c in range(0x300, sys.maxunicode) if unicodedata.combining(chr(c))]
    pairs = [chr(f) + chr(s) for s, firsts in C._composites().items() for f in list(firsts)[:60]]
    rng = random.Random(5)
    starters = [p[0] for p in pairs] + list("aé가한क") + [chr(c) for c in range(0xC0, 0x2000) if unicodedata.decomposition(chr(c))]
    mixed = ["".join(rng.choice(starters) + "".join(rng.choices(marks, k=rng.randint(0, 3))) for _ in range(3)) for _ in range(4000)]
    single = [chr(c) for c in range(0x300, 0x30000) if not 0xD800 <= c <= 0xDFFF]
    every = pairs + mixed + ["x" + t + "y" for t in pairs] + single
    df = spark.createDataFrame(list(enumerate(every)), "i int, t string").repartition(8)
    found = {r.i for r in df.where(nfc_suspect(F.col("t")).isNotNull()).select("i").collect()}
    for i, t in enumerate(every):
        assert unicodedata.is_normalized("NFC", t) or i in found, [hex(ord(c)) for c in t]
    assert all(unicodedata.normalize("NFC", p) != p for p in pairs)


def test_kept_marks(spark):
    cases = {"नमस्ते": "नमस्ते", "a\u0300b\u0301c": "abc", "বাংলা, ভাষা!": "বাংলা, ভাষা!", "க்ஷ (x)": "க்ஷ x"}
    df = spark.createDataFrame([(t,) for t in cases], "text string").withColumn("lang", F.lit("hi"))
    out = with_normalized_text(df, "text", "lang", GateConfig(keep_marks=True), out="n", trace="t").collect()
    assert {r.text: r.n for r in out} == cases
    assert next(r for r in out if r.text.startswith("a")).t.operations == ["diacritics_removed"]


def test_toggles(spark):
    df = spark.createDataFrame(
        [("ệ 5 ़( )(x) A",)], "text string"
    ).withColumn("lang", F.lit("hi"))

    def run(**off):
        return with_normalized_text(df, "text", "lang", GateConfig(**off), out="n").first().n

    assert run() == "ệ पच x a"
    assert run(apply_unicode_nfc=False) == "e पच x a"
    assert run(remove_diacritics=False, apply_unicode_nfc=False) == "e पच x a"
    assert run(expand_numbers=False) == "ệ 5 x a"
    assert run(normalize_punctuation=False) == "ệ पांच (x) a"


def test_single_cases_of_the_script_verdict(spark):
    cases = [
        ("Hello world", "en", (True, 1.0, "LATIN")),
        ("", "hi", (False, 0.0, "empty")),
        ("123 !@#", "hi", (False, 0.0, "no_alpha")),
        ("abc где", "te", (False, 0.5, "LATIN")),
        ("где abc", "te", (False, 0.5, "CYRILLIC")),
        ("ªª a", "en", (False, 2 / 3, "FEMININE")),
        ("naam hai", "hi", (False, 1.0, "LATIN")),
    ]
    rows = [(i, t, lang) for i, (t, lang, _) in enumerate(cases)]
    df = with_script(spark.createDataFrame(rows, "i int, text string, lang string"), "text", "lang")
    for r in df.collect():
        assert tuple(r.script) == cases[r.i][2]


def test_latin_consistency(spark):
    cases = [
        ("Hello world", "en", (True, 1.0)),
        ("héé", "EN", (False, 1 / 3)),
        ("123", "en", (True, 0.6)),
        ("नमस्ते", "hi", (True, 0.6)),
        ("abc", "fr", (False, 0.0)),
        ("", "en", (False, 0.0)),
        (None, "en", (False, 0.0)),
        ("abc", None, (False, 0.0)),
    ]
    rows = [(i, t, lang) for i, (t, lang, _) in enumerate(cases)]
    df = spark.createDataFrame(rows, "i int, text string, lang string")
    for r in df.select("i", latin_consistency(F.col("text"), F.col("lang")).alias("c")).collect():
        assert tuple(r.c) == cases[r.i][2], cases[r.i]


def test_single_characters_are_mapped_in_place(spark):
    """Only at the characters that change, the first and the last among them; no table for every character (F9)."""
    texts = ["ÉAÀB", "AB", "", " A", "a", "İI ΣΑΣ ÀÉ", "ABC123 𐐀Z", "x…“q” – y।", "…", "।॥", "‘’‛“”„–—", "𠀀“𠀀", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", _lower_ascii(F.col("t")), map_punctuation(F.col("t"))).collect()
    signs = {**dict(zip("।॥‘’‛“”„–—", "..'''\"\"\"--")), "…": "..."}
    for t, low, dots in rows:
        if t is None:
            assert low is None and dots is None
            continue
        assert low == "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
        assert dots == "".join(signs.get(c, c) for c in t)


def test_hindi_without_spelled_digits_takes_the_cheap_classes(spark):
    """Digits within words stay, so no Hindi words come in and the plain classes do (F9)."""
    texts = ["Room a1, (b22) *x*\n|y|", "a1 (5) b", "5", "x5 & y", "É1 ÀB: (c)"]
    df = spark.createDataFrame([(i, t, "hi") for i, t in enumerate(texts)], "i int, text string, lang string")
    want = ["room a1, b22 x y", "a1 पच b", "पच", "x5 y", "É1 Àb c"]  # marks are dropped
    for r in with_normalized_text(df, "text", "lang", out="norm").collect():
        assert r.norm == want[r.i]
