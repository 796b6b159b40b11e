"""Column contracts of the utterance and audio-property tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

REQUIRED_COLUMNS = [
    "utterance_id",
    "audio_path",
    "language",
    "transcription_raw",
    "duration_sec",
]

# Text of a record that a text source could not split into its columns; null in every other row.
MALFORMED = "gate_malformed_record"

# Columns that are numbers in a text source; every other column stays text there.
NUMERIC_COLUMNS = ["noise_level_db", "quality_flag"]

UTTERANCE_SCHEMA = T.StructType(
    [
        T.StructField("utterance_id", T.StringType()),
        T.StructField("audio_path", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("speaker_id", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("transcription_raw", T.StringType()),
        T.StructField("duration_sec", T.StringType()),
        T.StructField("noise_level_db", T.DoubleType()),
        T.StructField("collection_source", T.StringType()),
        T.StructField("quality_flag", T.DoubleType()),
    ]
)

AUDIO_PROPERTY_FIELDS = [
    T.StructField("sample_rate", T.IntegerType()),
    T.StructField("duration", T.DoubleType()),
    T.StructField("num_channels", T.IntegerType()),
    T.StructField("num_frames", T.LongType()),
    T.StructField("amplitude_mean", T.DoubleType()),
    T.StructField("amplitude_max", T.DoubleType()),
    T.StructField("silence_ratio", T.DoubleType()),
    T.StructField("snr_estimate", T.DoubleType()),
]
AUDIO_PROPERTIES_SCHEMA = T.StructType(
    [T.StructField("audio_path", T.StringType()), *AUDIO_PROPERTY_FIELDS]
)

# Cell texts that mean "missing" in a CSV source.
NA_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

# Language code, name, script.
LANGUAGES = [
    ("hi", "Hindi", "Devanagari"),
    ("bn", "Bengali", "Bengali"),
    ("te", "Telugu", "Telugu"),
    ("ta", "Tamil", "Tamil"),
    ("ml", "Malayalam", "Malayalam"),
    ("kn", "Kannada", "Kannada"),
    ("gu", "Gujarati", "Gujarati"),
    ("mr", "Marathi", "Devanagari"),
    ("pa", "Punjabi", "Gurmukhi"),
    ("ur", "Urdu", "Arabic"),
    ("en", "English", "Latin"),
]
LANGUAGE_CODES = [code for code, _, _ in LANGUAGES]


def language_dim(spark: SparkSession) -> DataFrame:
    """The eleven supported languages as a table (code, name, script)."""
    rows = ", ".join(f"('{c}', '{n}', '{s}')" for c, n, s in LANGUAGES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS languages(code, name, script)")
