"""Gate newly arrived utterance files in batches."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from uttergate.config import GateConfig
from uttergate.plans.verdict import verdict


def gate_new_files(
    spark: SparkSession,
    input_dir: str,
    schema: T.StructType,
    output_dir: str,
    config: GateConfig | None = None,
    audio_properties: DataFrame | None = None,
    checkpoint: str | None = None,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Start a run over the parquet files not seen before; it ends when none are left.

    Each batch runs the batch plan and overwrites its own folder, so a batch repeated after a
    failure leaves no duplicates. Folders lie below one named after the checkpoint's own id, so a
    new checkpoint, whose batches count from 0 again, leaves earlier results alone. Progress is
    kept below the cluster's ``spark.checkpoint.dir`` unless a folder is given.
    """
    if checkpoint is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared:
            raise ValueError("set spark.checkpoint.dir or pass checkpoint")
        run = hashlib.md5(f"{input_dir}\n{output_dir}".encode()).hexdigest()
        checkpoint = f"{shared}/gate-{run}"
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def judge(batch: DataFrame, batch_id: int) -> None:
        judged = verdict(batch, config, audio_properties)
        run = spark.read.json(f"{checkpoint}/metadata").first()["id"]
        judged.write.mode("overwrite").parquet(f"{output_dir}/run={run}/batch_id={batch_id}")

    return (
        reader.parquet(input_dir)
        .writeStream.foreachBatch(judge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
