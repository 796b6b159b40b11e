"""Utterance and audio-property tables derived from the given tables.

Every document and every conversation turn becomes an utterance with its whole text. Each
document gives a second utterance with a planted fault, so that every gate and normaliser step
fires. The SQL text runs unchanged on Spark and on DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from uttergate.operators.sizing import estimated_bytes

# Below this much input per core, one small file would leave most cores idle.
SPREAD_BYTES_PER_CORE = 64 * 1024 * 1024

# Planted texts by fault number; {body} stands for the whole text of the document.
FAULTS = [
    "''",
    "'   '",
    "repeat('हाँ ', 10)",
    "repeat('a ', 8)",
    "'मैं 5 साल 12 का हूँ। ' || body",
    "'CAFÉ “Noir”—ok… fine ' || body",
    "'@#$%'",
    "'123 456 !'",
    "'বাংলা ভাষা ভালো'",
    "'ab где λόγ 日本'",
    "'abc где'",
    "body || ' ( ) [x] {{y}} 7 8, 9_ „q“ ।॥'",
    "' \tone   two　' || body",
    "'قَالَ نَعَم ثُمَّ ذَهَبَ'",
    "'ਸਤ ਸ੍ਰੀ ਅਕਾਲ ਜੀ'",
    "'ok ok ok ok'",
    "repeat('తెలుగు భాష బాగుంది ', 60) || '.'",
    "repeat('தமிழ் மொழி நன்று ', 60) || '.'",
    "repeat('മലയാളം ഭാഷ നല്ലത് ', 60) || '.'",
    "repeat('ಕನ್ನಡ ಭಾಷೆ ಚೆನ್ನಾಗಿದೆ ', 60) || '.'",
    "repeat('ગુજરાતી ભાષા સારી છે ', 60) || '.'",
    "repeat('क़िताब कো தொ ', 20) || 'ଏ'",
]

_LANGUAGE = " ".join(
    f"WHEN {i} THEN '{code}'"
    for i, code in enumerate(
        ["hi", "bn", "te", "ta", "ml", "kn", "gu", "mr", "pa", "ur", "en", "fr", ""]
    )
)
_TEXT = " ".join(f"WHEN {i} THEN {text}" for i, text in enumerate(FAULTS))

UTTERANCES_SQL = f"""
SELECT row_n,
       CASE WHEN row_n % 97 = 0 THEN NULL ELSE 'utt_' || CAST(row_n AS STRING) END AS utterance_id,
       CASE WHEN row_n % 89 = 0 THEN NULL
            ELSE CASE WHEN row_n % 7 >= 4 THEN '/data/' ELSE 's3://corpus/' END
                 || CASE WHEN row_n % 31 = 0 THEN 'misc' WHEN row_n % 5 = 0 THEN 'raw/hi'
                         ELSE 'raw/' || language END
                 || '/utt_' || CAST(row_n AS STRING) || '.wav' END AS audio_path,
       language,
       CASE fault {_TEXT} ELSE body END AS transcription_raw,
       CASE row_n % 19
            WHEN 0 THEN '0' WHEN 1 THEN NULL WHEN 2 THEN 'abc' WHEN 3 THEN '0.2'
            WHEN 4 THEN '20.5' WHEN 5 THEN 'NaN' WHEN 6 THEN '1e17'
            ELSE CAST((row_n * 37) % 14 + 1 AS STRING) || '.' || CAST(row_n % 10 AS STRING)
       END AS duration_sec,
       CASE WHEN row_n % 101 = 0 THEN CAST('Infinity' AS DOUBLE)
            WHEN row_n % 7 = 0 THEN CAST(-1 AS DOUBLE) WHEN row_n % 7 = 1 THEN NULL
            WHEN row_n % 7 = 2 THEN CAST(-0.5 AS DOUBLE) WHEN row_n % 7 = 3 THEN CAST(1 AS DOUBLE)
            ELSE CAST(0 AS DOUBLE) END AS quality_flag,
       collection_source
FROM (
    SELECT row_n, fault, body, collection_source,
           CASE WHEN row_n % 53 = 0 THEN 'EN'
                ELSE CASE row_n % 13 {_LANGUAGE} END END AS language
    FROM (
        SELECT 4 * doc_id AS row_n, -1 AS fault, text AS body, source AS collection_source
        FROM {{documents}}
        UNION ALL
        SELECT 4 * doc_id + 1, doc_id % {len(FAULTS)}, text, source FROM {{documents}}
        UNION ALL
        SELECT 4 * (1000 * conv_id + turn) + 2, -1, text, role FROM {{conversations}}
    ) AS numbered
) AS labelled
"""

# The misc folders were never analysed, so their paths have no row here.
AUDIO_PROPERTIES_SQL = """
SELECT audio_path,
       CASE WHEN row_n % 23 = 0 THEN 4000 WHEN row_n % 23 = 1 THEN 96000
            ELSE 16000 END AS sample_rate,
       CASE WHEN row_n % 29 = 0 THEN CAST(0.1 AS DOUBLE) WHEN row_n % 29 = 1 THEN CAST(20 AS DOUBLE)
            ELSE CAST(4 AS DOUBLE) END AS duration,
       CASE WHEN row_n % 37 = 0 THEN 2 ELSE 1 END AS num_channels,
       CAST(64000 AS BIGINT) AS num_frames,
       CASE WHEN row_n % 41 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(0.1 AS DOUBLE) END AS amplitude_mean,
       CAST(0.8 AS DOUBLE) AS amplitude_max,
       CASE WHEN row_n % 43 = 0 THEN CAST(0.9 AS DOUBLE) ELSE CAST(0.1 AS DOUBLE) END AS silence_ratio,
       CAST(20 AS DOUBLE) AS snr_estimate,
       CASE WHEN row_n % 122 = 0 THEN 'bad header; offset ' || CAST(row_n AS STRING)
            WHEN row_n % 61 = 0 THEN 'bad header' ELSE NULL END AS error
FROM {utterances}
WHERE audio_path NOT LIKE '%/misc/%'
"""


def spread_small(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-spread a small input over the cores; leave a large one alone.

    A parquet file with one row group is one task however many cores there are. The shuffle
    is bounded: it happens only while the input is below ``SPREAD_BYTES_PER_CORE`` per core.
    """
    size = estimated_bytes(df)
    if size is None:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    if size > cores * SPREAD_BYTES_PER_CORE:
        return df
    return df.repartition(cores, *keys)


def _tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "conversations")}


def utterances(spark: SparkSession, sf_dir: str, spread: bool = True) -> DataFrame:
    df = spark.sql(UTTERANCES_SQL, **_tables(spark, sf_dir))
    return spread_small(df, "row_n") if spread else df


def audio_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(AUDIO_PROPERTIES_SQL, utterances=utterances(spark, sf_dir, spread=False))
