"""Registered queries of the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import codes, ctw, decontaminate, licenses, mixing, nbsvm, neardup, packing, periodic, sharding, tokenbin, topk, warc


def _documents(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet").select(*columns)


def remainder(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5: the fold of a document."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5


def op1_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    return decontaminate.leaks(_documents(spark, sf, "doc_id", "text"), items)


def op2_sharding(spark: SparkSession, sf: str) -> DataFrame:
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    docs = _documents(spark, sf, "doc_id", "text").select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    return sharding.sharded(docs, ["doc_id", "text_crc32", "size"], 40).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_licenses(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.license_matches(_documents(spark, sf, "doc_id", "text"))


def op6_mixing(spark: SparkSession, sf: str) -> DataFrame:
    docs = _documents(spark, sf, "doc_id", "source", "text").select(
        "doc_id",
        "source",
        mixing.word_count(F.col("text")).alias("size"),
        mixing.random_key(F.col("doc_id"), F.col("text")).alias("key"),
    )
    return mixing.mixed(docs).select("doc_id", "size", "source_size", "target", "taken")


def op3_ctw(spark: SparkSession, sf: str) -> DataFrame:
    return ctw.scores(_documents(spark, sf, "doc_id", "text"), remainder() == 1)


def op4_warc(spark: SparkSession, sf: str) -> DataFrame:
    index = warc.write_bundles(spark.read.parquet(f"{sf}/pages.parquet"))
    return warc.read_records(index, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


END_ID = 2


def op7_tokenbin(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    files = tokenbin.write_ids(_documents(spark, sf, "doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"), END_ID)
    return tokenbin.read_ids(files)


def quality_model(spark: SparkSession, docs: DataFrame, sf: str) -> nbsvm.Model:
    """Learned from labels outside fold 0."""
    labels = spark.read.parquet(f"{sf}/labels.parquet").where(remainder() != 0)
    return nbsvm.fit(docs.where(remainder() != 0), labels)


GOOD = 0.3


def op8_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = _documents(spark, sf, "doc_id", "text")
    score = nbsvm.score(quality_model(spark, docs, sf), F.col("text"))
    scored = docs.select("doc_id", F.coalesce(remainder() == 0, F.lit(False)).alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= GOOD).cast("int"))


def op9_neardup(spark: SparkSession, sf: str) -> DataFrame:
    found = neardup.near_duplicates(_documents(spark, sf, "doc_id", "text"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_shingles",
        F.col("component").alias("component_id"),
        (F.col("id") == F.col("component")).alias("kept"),
    )


def op10_topk(spark: SparkSession, sf: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet")
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0, 5)


def op11_periodic(spark: SparkSession, sf: str) -> DataFrame:
    return periodic.repeated_passages(_documents(spark, sf, "doc_id", "text"), periodic.planted)


PACK_END_ID = 0


def op12_packing(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    return packing.packed(_documents(spark, sf, "doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"), PACK_END_ID)


def op13_codes(spark: SparkSession, sf: str) -> DataFrame:
    return codes.codes(spark.read.parquet(f"{sf}/embeddings.parquet")).drop("label")


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_sharding": op2_sharding,
    "op3_ctw": op3_ctw,
    "op4_warc": op4_warc,
    "op5_licenses": op5_licenses,
    "op6_mixing": op6_mixing,
    "op7_tokenbin": op7_tokenbin,
    "op8_quality": op8_quality,
    "op9_neardup": op9_neardup,
    "op10_topk": op10_topk,
    "op11_periodic": op11_periodic,
    "op12_packing": op12_packing,
    "op13_codes": op13_codes,
}
