"""Batch run: verdict, two result tables, statistics."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uttergate.config import GateConfig
from uttergate.operators.split import VERDICT, rejected, train_ready
from uttergate.plans import report
from uttergate.plans.verdict import require_columns, verdict
from uttergate.sources.manifest import publish
from uttergate.sources.sinks import write_document, write_table

OUTCOME = "gate_accepted"


def run_gate(
    utterances: DataFrame,
    output_dir: str,
    config: GateConfig | None = None,
    audio_properties: DataFrame | None = None,
    fmt: str = "csv",
    unique_properties: bool = False,
) -> dict[str, str]:
    """Gate a table and write the results; returns the written paths.

    The verdict is computed once and written, split by outcome; the counters of the statistics are gathered on the way.
    The result tables read it back, each its own half, and the reasons are counted in one pass over it. So nothing is
    recomputed and a lost executor costs only its tasks. Results of an earlier run in the same folder are overwritten
    table by table; ``publish_gate`` keeps them until all new ones are there.
    """
    config = config or GateConfig()
    require_columns(utterances)
    spark = utterances.sparkSession
    paths = {"verdict": f"{output_dir}/verdict"}

    judged = verdict(utterances, config, audio_properties, unique_properties)
    judged = judged.withColumn(OUTCOME, F.col(VERDICT)["is_valid"])
    passing, counters = report.observed(judged)
    passing.write.mode("overwrite").partitionBy(OUTCOME).parquet(paths["verdict"])
    stored = spark.read.schema(judged.schema).parquet(paths["verdict"])
    refused = stored.where(f"NOT {OUTCOME}").drop(OUTCOME)

    for name, table in (
        (config.train_ready_name, train_ready(stored.where(OUTCOME).drop(OUTCOME))),
        (config.rejected_name, rejected(refused)),
    ):
        paths[name] = f"{output_dir}/{name}"
        write_table(table, paths[name], fmt)
    if config.include_stats:
        paths["reason_counts"] = f"{output_dir}/reason_counts"
        write_table(report.reason_counts(refused), paths["reason_counts"], "parquet")
        reasons = spark.read.schema("kind string, reason string, n bigint").parquet(paths["reason_counts"])
        for name, kind in (("rejection_reasons", "counted"), ("rejection_reason_analysis", "analysed")):
            paths[name] = f"{output_dir}/{name}"
            write_table(reasons.where(F.col("kind") == kind).drop("kind"), paths[name], "json")
        paths["processing_stats"] = f"{output_dir}/processing_stats"
        write_document(report.observed_document(counters.get, reasons, config), paths["processing_stats"])
    return paths


def publish_gate(
    utterances: DataFrame,
    output_dir: str,
    config: GateConfig | None = None,
    audio_properties: DataFrame | None = None,
    fmt: str = "csv",
    unique_properties: bool = False,
) -> dict[str, str]:
    """``run_gate`` into a folder of its own, published when all of its tables are written; returns their paths.

    Readers take the paths from ``published(spark, output_dir)``: those of the last whole run, whatever becomes of this
    one.
    """
    run = f"run-{uuid.uuid4().hex}"
    paths = run_gate(utterances, f"{output_dir}/{run}", config, audio_properties, fmt, unique_properties)
    return publish(utterances.sparkSession, output_dir, run, list(paths))
