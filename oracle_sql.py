"""DuckDB SQL for the registered queries, written from the gate rules on its own."""

from __future__ import annotations

from utterance_corpus import AUDIO_PROPERTIES_SQL, UTTERANCES_SQL

SP = (
    r"\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}"
    r"\x{202f}\x{205f}\x{3000}"
)
W = r"\p{L}\p{N}_"
# Digit words, languages and codes, script names.
DIGITS = ["शून्य", "एक", "दो", "तीन", "चार", "पांच", "छह", "सात", "आठ", "नौ"]
LANGUAGES = (
    "('hi','Hindi','Devanagari'),('bn','Bengali','Bengali'),('te','Telugu','Telugu'),"
    "('ta','Tamil','Tamil'),('ml','Malayalam','Malayalam'),('kn','Kannada','Kannada'),"
    "('gu','Gujarati','Gujarati'),('mr','Marathi','Devanagari'),('pa','Punjabi','Gurmukhi'),"
    "('ur','Urdu','Arabic'),('en','English','Latin')"
)
CODES = "('hi','bn','te','ta','ml','kn','gu','mr','pa','ur','en')"
SCRIPTS = [
    ("LATIN", "Latin"),
    ("DEVANAGARI", "Devanagari"),
    ("BENGALI", "Bengali"),
    ("GURMUKHI", "Gurmukhi"),
    ("ARABIC", "Arabic"),
    ("CYRILLIC", "Cyrillic"),
    ("GREEK", "Greek"),
    ("CJK", "Han"),
    ("TELUGU", "Telugu"),
    ("TAMIL", "Tamil"),
    ("MALAYALAM", "Malayalam"),
    ("KANNADA", "Kannada"),
    ("GUJARATI", "Gujarati"),
    ("ORIYA", "Oriya"),
]


def sub(text: str, pattern: str, new: str) -> str:
    return f"regexp_replace({text}, '{pattern}', '{new}', 'g')"


def _digits(col: str) -> str:
    # No look-around here: neighbours are captured, and a second pass takes the digits whose
    # left neighbour the first pass consumed.
    for d, word in enumerate(DIGITS):
        for _ in range(2):
            col = sub(col, rf"(^|[^{W}]){d}([^{W}]|$)", rf"\1{word}\2")
    return col


_S5 = "translate(s4, '।॥‘’‛“”„–—', '..''''''\"\"\"--')"
_S5 = f"replace({_S5}, '…', '...')"
_S5 = sub(_S5, f"[{SP}]+", " ")
_S5 = sub(_S5, rf"[^{W}{SP}.,!?''\"-]", "")
_S6 = sub(sub("s5", f"^[{SP}]+|[{SP}]+$", ""), f"[{SP}]+", " ")


def normalize(source: str, text: str = "txt", lang: str = "lang", prefix: str = "n") -> str:
    """CTEs ``{prefix}0..{prefix}6`` over a CTE; the last adds s0..s6 and norm."""
    p = prefix
    return f"""
{p}0 AS (SELECT *, CASE WHEN regexp_matches({text}, '[^{SP}]') THEN {text} END AS s0 FROM {source}),
{p}1 AS (SELECT *, nfc_normalize(s0) AS s1 FROM {p}0),
{p}2 AS (SELECT *, {sub('s1', chr(92) + 'p{Mn}', '')} AS s2 FROM {p}1),
{p}3 AS (SELECT *, CASE WHEN {lang} = 'hi' THEN {_digits('s2')} ELSE s2 END AS s3 FROM {p}2),
{p}4 AS (SELECT *, CASE WHEN {lang} = 'en' THEN lower(s3) ELSE
    translate(s3, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') END AS s4 FROM {p}3),
{p}5 AS (SELECT *, {_S5} AS s5 FROM {p}4),
{p}6 AS (SELECT *, coalesce(s6, '') AS norm FROM (SELECT *, {_S6} AS s6 FROM {p}5))"""


def metrics(source: str, text: str = "norm", prefix: str = "m") -> str:
    """CTEs adding score, wc, cc, avg_len, rep, punct."""
    p = prefix
    return f"""
{p}0 AS (SELECT *, list_filter(string_split({sub(text, f'[{SP}]+', ' ')}, ' '), lambda x: x <> '') AS words
    FROM {source}),
{p}1 AS (SELECT *, len(words) AS wc, CASE WHEN len(words) = 0 THEN 0 ELSE length({text}) END AS cc,
    CASE WHEN len(words) = 0 THEN 0.0::DOUBLE
         ELSE length({sub(text, f'[{SP}]', '')})::DOUBLE / len(words) END AS avg_len,
    CASE WHEN len(words) = 0 THEN 1.0::DOUBLE
         ELSE (len(words) - list_unique(words))::DOUBLE / len(words) END AS rep,
    CASE WHEN len(words) = 0 THEN 0.0::DOUBLE
         ELSE length({sub(text, f'[{chr(92)}p{{L}}{chr(92)}p{{N}}{SP}]', '')})::DOUBLE / length({text})
         END AS punct FROM {p}0),
{p}2 AS (SELECT *, CASE WHEN wc = 0 THEN 0.0::DOUBLE ELSE
    1.0::DOUBLE * (CASE WHEN rep > 0.7::DOUBLE THEN 0.3::DOUBLE ELSE 1.0::DOUBLE END)
    * (CASE WHEN wc < 3 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END)
    * (CASE WHEN avg_len < 2 THEN 0.7::DOUBLE ELSE 1.0::DOUBLE END) END AS score FROM {p}1)"""


def script(source: str, text: str = "norm", lang: str = "lang", prefix: str = "k") -> str:
    """CTEs adding token, conf, script_ok."""
    p = prefix
    counted = ", ".join(
        "{'n': length(" + sub("letters", rf"[^\p{{{s}}}]", "") + "), 'early': "
        rf"-length(regexp_extract(letters, '^[^\p{{{s}}}]*')), 'token': '{t}'" + "}"
        for t, s in SCRIPTS
    )
    return f"""
{p}0 AS (SELECT *, {sub(text, '[^' + chr(92) + 'p{L}]', '')} AS letters FROM {source}),
{p}1 AS (SELECT *, list_reverse_sort([{counted}])[1] AS best FROM {p}0),
{p}2 AS (SELECT *, CASE WHEN NOT regexp_matches({text}, '[^{SP}]') THEN 'empty'
        WHEN letters = '' THEN 'no_alpha' ELSE best.token END AS token,
    CASE WHEN letters = '' THEN 0.0::DOUBLE ELSE best.n::DOUBLE / length(letters) END AS conf,
    coalesce((SELECT upper(script) FROM (VALUES {LANGUAGES}) AS d(code, name, script)
              WHERE code = {lang}), 'UNKNOWN') AS expected FROM {p}1),
{p}3 AS (SELECT *, CASE WHEN token IN ('empty', 'no_alpha') THEN FALSE
        WHEN {lang} = 'en' AND token = 'LATIN' THEN conf > 0.7::DOUBLE
        WHEN contains(expected, token) THEN conf > 0.5::DOUBLE ELSE FALSE END AS script_ok FROM {p}2)"""


BASE = f"""
u AS ({UTTERANCES_SQL.format(documents='documents', conversations='conversations')}),
a AS ({AUDIO_PROPERTIES_SQL.format(utterances='u')}),
b AS (SELECT *, coalesce(utterance_id, '') AS id, coalesce(audio_path, '') AS path,
    coalesce(language, '') AS lang, coalesce(transcription_raw, '') AS txt FROM u)"""

# One utterance in thirteen lost its last three fields on the way; a text that spells NaN is missing in a CSV file.
AS_RECORDS = BASE.replace("u AS (", "whole AS (", 1).replace("\na AS (", """
u AS (SELECT * REPLACE (CASE WHEN row_n % 13 <> 5 AND duration_sec <> 'NaN' THEN duration_sec END AS duration_sec,
    CASE WHEN row_n % 13 <> 5 THEN quality_flag END AS quality_flag) FROM whole),
a AS (""", 1)

EARLY = f"""list_filter([
    CASE WHEN id = '' THEN 'missing_utterance_id' END,
    CASE WHEN path = '' THEN 'missing_audio_path' END,
    CASE WHEN lang = '' THEN 'missing_language' END,
    CASE WHEN NOT regexp_matches(txt, '[^{SP}]') THEN 'empty_transcription' END,
    CASE WHEN lang <> '' AND lower(lang) NOT IN {CODES} THEN 'unsupported_language' END
], lambda x: x IS NOT NULL)"""


def issues(alias: str) -> str:
    a = alias
    return f"""list_filter([
    CASE WHEN {a}.sample_rate < 8000 THEN 'sample_rate_too_low'
         WHEN {a}.sample_rate > 48000 THEN 'sample_rate_too_high' END,
    CASE WHEN {a}.duration < 0.5::DOUBLE THEN 'duration_too_short'
         WHEN {a}.duration > 15.0::DOUBLE THEN 'duration_too_long' END,
    CASE WHEN {a}.amplitude_mean < 1e-6::DOUBLE THEN 'signal_too_weak' END,
    CASE WHEN {a}.silence_ratio > 0.8::DOUBLE THEN 'too_much_silence' END,
    CASE WHEN {a}.num_channels <> 1 THEN 'not_mono' END], lambda x: x IS NOT NULL)"""


def audio_issues(eligible: str, assume: bool) -> str:
    assumed = "WHEN starts_with(path, 's3://') THEN []" if assume else ""
    return f"""CASE WHEN NOT ({eligible}) THEN []
        WHEN a.error IS NOT NULL THEN ['validation_error: ' || a.error]
        WHEN a.audio_path IS NOT NULL THEN {issues('a')}
        {assumed} ELSE ['file_not_found'] END"""


SECONDS = "TRY_CAST(duration_sec AS DOUBLE)"
PATH_LANG = "nullif(regexp_extract(path, '(?:^|/)raw/([^/]*)', 1), '')"


def duration(low: str = "0.5", high: str = "15.0") -> str:
    return f"""CASE WHEN duration_sec IS NULL OR duration_sec = '' THEN NULL
        WHEN {SECONDS} IS NULL THEN 'invalid_duration_format'
        WHEN isnan({SECONDS}) OR {SECONDS} = 0 THEN NULL
        WHEN {SECONDS} < {low}::DOUBLE THEN 'duration_too_short'
        WHEN {SECONDS} > {high}::DOUBLE THEN 'duration_too_long' END"""


MISMATCH = f"""CASE WHEN path <> '' AND lang <> '' AND lower({PATH_LANG}) <> lower(lang)
    THEN 'language_path_mismatch' END"""
INFINITE = "coalesce(isinf(quality_flag), FALSE)"
FLAG = "CASE WHEN quality_flag <= -1 THEN 'negative_quality_flag' END"


def text_gates(score: str = "0.3", words: int = 2, repeated: str = "0.8") -> list[str]:
    return [
        f"CASE WHEN s0 IS NOT NULL AND score < {score}::DOUBLE THEN 'low_text_quality' END",
        f"CASE WHEN s0 IS NOT NULL AND wc < {words} THEN 'too_few_words' END",
        f"CASE WHEN s0 IS NOT NULL AND rep > {repeated}::DOUBLE THEN 'too_many_repeated_words' END",
    ]


SCRIPT_GATE = """CASE WHEN s0 IS NOT NULL AND NOT script_ok AND conf < 0.5::DOUBLE
    THEN 'script_mismatch_' || token END"""


def verdict(
    low: str = "0.5",
    high: str = "15.0",
    score: str = "0.3",
    words: int = 2,
    repeated: str = "0.8",
    mismatch: bool = True,
    audio: bool = True,
    base: str = BASE,
) -> str:
    """CTEs up to ``v``: utterance columns, reasons, issues and all derived values."""
    gates = [duration(low, high)]
    if mismatch:
        gates.append(MISMATCH)
    gates += text_gates(score, words, repeated) + [SCRIPT_GATE, FLAG]
    checked = "len(early) = 0" if audio else "FALSE"
    return f"""WITH {base},
e AS (SELECT *, {EARLY} AS early FROM b),
j AS (SELECT e.*, {checked} AS checked, {audio_issues(checked, True)} AS issues
    FROM e LEFT JOIN a ON e.path = a.audio_path),
{normalize('j')},
{metrics('n6')},
{script('m2')},
v AS (SELECT *, len(reasons) = 0 AS is_valid FROM (
    SELECT *, CASE WHEN {INFINITE}
        THEN ['processing_error: cannot convert float infinity to integer']
        ELSE list_concat(early, list_transform(issues, lambda x: 'audio_' || x),
            list_filter([{', '.join(gates)}], lambda x: x IS NOT NULL)) END AS reasons FROM k3))
"""


OPERATIONS = """list_filter([
    CASE WHEN s0 <> s1 THEN 'unicode_nfc' END, CASE WHEN s1 <> s2 THEN 'diacritics_removed' END,
    CASE WHEN s2 <> s3 THEN 'numbers_expanded' END,
    CASE WHEN s4 <> s5 THEN 'punctuation_normalized' END], lambda x: x IS NOT NULL)"""
COUNTED = f"NOT ({INFINITE})"
INPUT = (
    "row_n, utterance_id, audio_path, language, transcription_raw, duration_sec, quality_flag, "
    "collection_source"
)
COUNTERS = f"""count(s0) AS total_processed,
    count(*) FILTER (s0 IS NOT NULL AND s1 <> s2) AS diacritics_removed,
    count(*) FILTER (s0 IS NOT NULL AND s2 <> s3) AS numbers_expanded,
    count(*) FILTER (s0 IS NOT NULL AND s4 <> s5) AS punctuation_normalized,
    count(*) FILTER (s0 IS NOT NULL AND s0 <> s1) AS unicode_normalized"""
AUDIO_COUNTERS = """SELECT *,
    CASE WHEN total_validated = 0 THEN 0.0::DOUBLE ELSE valid_files::DOUBLE / total_validated END AS valid_ratio,
    CASE WHEN total_validated = 0 THEN 0.0::DOUBLE ELSE invalid_files::DOUBLE / total_validated END AS invalid_ratio
FROM (SELECT count(*) FILTER (checked) AS total_validated,
    count(*) FILTER (checked AND len(issues) = 0) AS valid_files,
    count(*) FILTER (checked AND len(issues) > 0 AND NOT missing AND NOT broken) AS invalid_files,
    count(*) FILTER (checked AND missing) AS missing_files,
    count(*) FILTER (checked AND broken) AS corrupted_files,
    count(*) FILTER (checked AND list_has_any(issues, ['duration_too_short', 'duration_too_long'])) AS duration_violations,
    count(*) FILTER (checked AND list_has_any(issues, ['sample_rate_too_low', 'sample_rate_too_high'])) AS sample_rate_violations
    FROM (SELECT *, list_contains(issues, 'file_not_found') AS missing,
        coalesce(issues[1], '') LIKE 'validation_error: %' AS broken FROM v))"""
TOTALS = f"""SELECT *, CASE WHEN total_processed = 0 THEN 0.0::DOUBLE
    ELSE valid_samples::DOUBLE / total_processed END AS valid_ratio
FROM (SELECT count(*) FILTER ({COUNTED}) AS total_processed,
    count(*) FILTER ({COUNTED} AND is_valid) AS valid_samples,
    count(*) FILTER ({COUNTED} AND NOT is_valid) AS rejected_samples FROM v)"""
HISTOGRAM = f"""SELECT reason, count(*) AS n FROM
    (SELECT unnest(reasons) AS reason FROM v WHERE {COUNTED}) GROUP BY reason"""
REASON = "array_to_string(reasons, '; ')"
ANALYSIS = f"""SELECT reason, count(*) AS n FROM
    (SELECT trim(unnest(string_split({REASON}, ';'))) AS reason FROM v WHERE NOT is_valid)
    WHERE reason <> '' GROUP BY reason"""
TRAIN = f"SELECT {INPUT}, norm AS transcription_normalized, score AS text_quality_score FROM v WHERE is_valid"
REJECTED = f"""SELECT {INPUT}, {REASON} AS reason, txt AS original_transcription
    FROM v WHERE NOT is_valid"""
REASON_ROWS = f"SELECT row_n, is_valid, {REASON} AS reason FROM v"
LABEL = f"""CASE WHEN {SECONDS} IS NULL THEN NULL WHEN isnan({SECONDS}) THEN 'nanh'
    WHEN {SECONDS} * scale < 60 THEN printf('%.1f', {SECONDS} * scale) || 's'
    WHEN {SECONDS} * scale < 3600 THEN printf('%.1f', {SECONDS} * scale / 60) || 'm'
    ELSE printf('%.1f', {SECONDS} * scale / 3600) || 'h' END"""


def _completeness(columns: list[str]) -> str:
    parts = []
    for c, text in columns:
        empty = f"count(*) FILTER ({c} = '')" if text else "0"
        null = f"count(*) FILTER ({c} IS NULL)" if text else f"count(*) FILTER ({c} IS NULL OR isnan({c}))"
        parts.append(
            f"SELECT '{c}' AS column_name, count(*) AS total_rows, {null} AS null_count, "
            f"{empty} AS empty_count FROM u"
        )
    return f"""WITH {BASE} SELECT *, null_count + empty_count AS missing_count,
        1 - (null_count + empty_count)::DOUBLE / total_rows AS completeness_ratio
        FROM ({' UNION ALL '.join(parts)})"""


def _report() -> str:
    def rows(category: str, table: str, ints: list[str], doubles: list[str]) -> list[str]:
        return [
            f"SELECT '{category}' AS category, '{c}' AS key, CAST({c} AS VARCHAR) AS value FROM {table}"
            for c in ints
        ] + [
            f"SELECT '{category}', '{c}', printf('%.2f', {c}) FROM {table}" for c in doubles
        ]

    parts = rows(
        "PROCESSING_STATS",
        "totals",
        ["total_processed", "valid_samples", "rejected_samples"],
        ["valid_ratio"],
    )
    parts += rows(
        "TEXT_NORMALIZATION",
        "texts",
        [
            "total_processed",
            "diacritics_removed",
            "numbers_expanded",
            "punctuation_normalized",
            "unicode_normalized",
        ],
        [],
    )
    parts += rows(
        "AUDIO_VALIDATION",
        "sounds",
        [
            "total_validated",
            "valid_files",
            "invalid_files",
            "missing_files",
            "corrupted_files",
            "duration_violations",
            "sample_rate_violations",
        ],
        ["valid_ratio", "invalid_ratio"],
    )
    return f"""{verdict()}, totals AS ({TOTALS}), texts AS (SELECT {COUNTERS} FROM v),
        sounds AS ({AUDIO_COUNTERS}) {' UNION ALL '.join(parts)}"""


NAMED = (
    "(missing_[a-z_]+|empty_transcription|unsupported_language|audio_(file|sample|duration|signal|too|not)_[a-z_]+"
    "|duration_too_[a-z]+|invalid_duration_format|language_path_mismatch|low_text_quality|too_few_words"
    "|too_many_repeated_words|script_mismatch_[A-Za-z_-]+|negative_quality_flag)"
)


def _document() -> str:
    listed = f"(SELECT string_agg(reason || '=' || n, '|' ORDER BY reason) FROM ({{}}) WHERE regexp_full_match(reason, '{NAMED}'))"
    other = f"(SELECT coalesce(sum(n), 0)::BIGINT FROM ({{}}) WHERE NOT regexp_full_match(reason, '{NAMED}'))"
    return f"""{verdict()}, totals AS ({TOTALS}), texts AS (SELECT {COUNTERS} FROM v),
        sounds AS ({AUDIO_COUNTERS})
        SELECT 0.5::DOUBLE AS min_duration, 15.0::DOUBLE AS max_duration,
            t.total_processed, t.valid_samples, t.rejected_samples, t.valid_ratio,
            x.total_processed AS texts_processed, x.numbers_expanded, s.total_validated, s.missing_files,
            {listed.format(HISTOGRAM)} AS rejection_reasons, {other.format(HISTOGRAM)} AS other_reasons,
            {listed.format(ANALYSIS)} AS rejection_reason_analysis, {other.format(ANALYSIS)} AS other_parts
        FROM totals t, texts x, sounds s"""


def _validated() -> str:
    return f"""WITH {BASE},
p AS (SELECT audio_path AS path FROM u WHERE audio_path IS NOT NULL),
v AS (SELECT p.path AS audio_path, a.audio_path IS NOT NULL AS "exists",
    {audio_issues('TRUE', False)} AS issues, a.* EXCLUDE (audio_path)
    FROM p LEFT JOIN a ON p.path = a.audio_path)"""


def _toggled(sql: str) -> str:
    """Without composition, mark stripping and digit words."""
    for step, at in (("nfc_normalize(s0)", "s0"), (sub("s1", chr(92) + "p{Mn}", ""), "s1"), (f"CASE WHEN lang = 'hi' THEN {_digits('s2')} ELSE s2 END", "s2")):
        if step not in sql:
            raise ValueError(step)
        sql = sql.replace(step, at)
    return sql


def oracle_sql() -> dict[str, str]:
    n = f"WITH {BASE}, {normalize('b')}"
    m = f"{n}, {metrics('n6')}"
    v = verdict()
    return {
        "text_normalize": f"{n} SELECT row_n, lang AS language, norm AS transcription_normalized FROM n6",
        "normalize_trace": f"""{n} SELECT row_n, array_to_string({OPERATIONS}, ',') AS operations,
            length(s0) AS original_length, length(s6) AS final_length,
            1 - length(s6)::DOUBLE / length(s0) AS reduction_ratio FROM n6 WHERE s0 IS NOT NULL""",
        "normalize_counters": f"{n} SELECT {COUNTERS} FROM n6",
        "normalize_conversations": f"""WITH c AS (SELECT conv_id, turn, text AS txt, 'en' AS lang
            FROM conversations), {normalize('c')}, {metrics('n6')}
            SELECT conv_id, turn, norm AS transcription_normalized, score AS quality_score,
            wc AS word_count, cc AS char_count, avg_len AS avg_word_length,
            rep AS repeated_word_ratio, punct AS punctuation_ratio FROM m2""",
        "text_metrics": f"""{m} SELECT row_n, score AS quality_score, wc AS word_count,
            cc AS char_count, avg_len AS avg_word_length, rep AS repeated_word_ratio,
            punct AS punctuation_ratio FROM m2""",
        "text_metrics_raw": f"""WITH {metrics('documents', 'text')} SELECT doc_id,
            score AS quality_score, wc AS word_count, cc AS char_count,
            avg_len AS avg_word_length, rep AS repeated_word_ratio,
            punct AS punctuation_ratio FROM m2""",
        "path_language": f"""WITH {BASE} SELECT row_n, {PATH_LANG} AS path_language,
            {MISMATCH} IS NOT NULL AS mismatch FROM b""",
        "script_profile": f"""{n}, {script('n6')} SELECT row_n, token AS detected_script,
            conf AS confidence, script_ok AS is_valid, {SCRIPT_GATE} AS reason FROM k3""",
        "latin_consistency": rf"""SELECT doc_id,
            CASE WHEN text = '' OR lower(lang) NOT IN {CODES} THEN FALSE
                 WHEN lower(lang) = 'en' AND letters > 0 THEN latin::DOUBLE / letters > 0.7::DOUBLE
                 ELSE TRUE END AS consistent,
            CASE WHEN text = '' OR lower(lang) NOT IN {CODES} THEN 0.0::DOUBLE
                 WHEN lower(lang) = 'en' AND letters > 0 THEN latin::DOUBLE / letters
                 ELSE 0.6::DOUBLE END AS confidence
            FROM (SELECT *, length({sub('text', '[^A-Za-z]', '')}) AS latin,
                  length({sub('text', '[^' + chr(92) + 'p{L}]', '')}) AS letters FROM documents)""",
        "presence_gates": f"WITH {BASE} SELECT row_n, array_to_string({EARLY}, '; ') AS reason FROM b",
        "duration_gate": f"WITH {BASE} SELECT row_n, {duration()} AS reason FROM b",
        "text_gates": f"""{m} SELECT row_n, array_to_string(list_filter(
            [{', '.join(text_gates())}], lambda x: x IS NOT NULL), '; ') AS reason FROM m2""",
        "quality_flag_gate": f"""WITH {BASE} SELECT row_n, {FLAG} AS reason,
            {INFINITE} AS is_infinite FROM b""",
        "audio_rules": f"""{_validated()} SELECT audio_path, "exists", len(issues) = 0 AS is_valid,
            array_to_string(issues, ',') AS issues,
            CASE WHEN error IS NULL THEN sample_rate END AS sample_rate,
            CASE WHEN error IS NULL THEN duration END AS duration FROM v""",
        "audio_batch_summary": f"""{_validated()} SELECT count(*) AS total_files,
            count(*) FILTER (len(issues) = 0) AS valid_files,
            count(*) FILTER (len(issues) > 0) AS invalid_files FROM v""",
        "audio_batch_details": f"""{_validated()} SELECT DISTINCT audio_path, "exists",
            len(issues) = 0 AS is_valid, array_to_string(issues, ',') AS issues FROM v""",
        "language_dim": f"""WITH {BASE} SELECT row_n, language, d.name AS language_name,
            d.script AS language_script FROM b
            LEFT JOIN (VALUES {LANGUAGES}) AS d(code, name, script) ON lower(lang) = d.code""",
        "verdict": f"""{v} SELECT row_n, is_valid, {REASON} AS reason,
            CASE WHEN {INFINITE} THEN '' ELSE norm END AS transcription_normalized,
            checked AS audio_checked, CASE WHEN s0 IS NOT NULL THEN score END AS quality_score,
            CASE WHEN s0 IS NOT NULL THEN token END AS detected_script FROM v""",
        "train_ready": v + TRAIN,
        "rejected": v + REJECTED,
        "reason_histogram": v + HISTOGRAM,
        "reason_analysis": v + ANALYSIS,
        "top_reasons": f"{v} SELECT * FROM ({HISTOGRAM}) ORDER BY n DESC, reason LIMIT 10",
        "run_totals": v + TOTALS,
        "audio_counters": v + AUDIO_COUNTERS,
        "completeness": _completeness(
            [
                ("utterance_id", True),
                ("audio_path", True),
                ("language", True),
                ("transcription_raw", True),
                ("duration_sec", True),
                ("quality_flag", False),
            ]
        ),
        "schema_contract": f"""WITH {BASE} SELECT TRUE AS valid, count(*) AS total_rows,
            8::BIGINT AS total_columns, '' AS missing_columns,
            '{INPUT.replace(' ', '')}' AS available_columns FROM u""",
        "stats_report": _report(),
        "stats_document": _document(),
        "safe_name": f"""WITH {BASE} SELECT row_n, left({sub(sub('txt', f'[^{W}{SP}-]', ''), f'[{SP}]+', '_')}, 50)
            AS safe_name FROM b""",
        "duration_label": f"""WITH {BASE} SELECT row_n, scale, {LABEL} AS label FROM b,
            (SELECT unnest([1.0::DOUBLE, 7.25::DOUBLE, 333.0::DOUBLE]) AS scale)""",
        "content_hash": """SELECT page_id, octet_length(encode(html)) AS length,
            md5(html) AS md5 FROM pages""",
        "mode_normalize_only": verdict(score="0.0", words=0, repeated="1.0") + REASON_ROWS,
        "mode_skip_mismatch": verdict(mismatch=False) + REASON_ROWS,
        "mode_skip_audio": verdict(audio=False) + REASON_ROWS,
        "regate": v + " SELECT row_n, '' AS reason FROM v WHERE is_valid",
        "mode_toggles": _toggled(verdict()) + REASON_ROWS,
        "mode_sample_rate": verdict().replace("< 8000", "< 16001").replace("> 48000", "> 100000") + REASON_ROWS,
        "mode_thresholds": verdict(low="2.0", high="8.0", score="0.6") + REASON_ROWS,
        "csv_round_trip": f"""WITH {BASE} SELECT row_n, utterance_id, audio_path,
            nullif(language, '') AS language, nullif(transcription_raw, '') AS transcription_raw,
            CASE WHEN duration_sec <> 'NaN' THEN duration_sec END AS duration_sec, quality_flag,
            collection_source FROM u""",
        "csv_malformed": f"""{verdict(audio=False, base=AS_RECORDS)} SELECT row_n,
            is_valid AND row_n % 11 <> 0 AS is_valid, CASE WHEN row_n % 11 = 0
            THEN 'processing_error: malformed record' ELSE {REASON} END AS reason FROM v""",
        "gate_run": f"""{v} SELECT row_n, 'accepted' AS outcome, norm AS detail FROM v WHERE is_valid
            UNION ALL SELECT row_n, 'refused', {REASON} FROM v WHERE NOT is_valid""",
    }
