"""Answer prompts as they arrive (Structured Streaming).

Prompt files ``(prompt_id INT, prompt STRING)`` landing in a folder are read
with ``readStream``; every micro-batch runs the configured question pipeline
(``skein.plans.ask.ask``) against static, pre-built sources and is written to
``<out_dir>/batch_id=<n>``. The write overwrites its own batch folder, so a
batch replayed after a failure gives the same files (idempotent sink); the
stream's offsets live in a checkpoint folder under the shared
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.plans.ask import Sources, ask
from skein.session import checkpoint_dir

PROMPT_SCHEMA = "prompt_id long, prompt string"


def start(spark: SparkSession, prompt_dir: str, out_dir: str, config: dict, sources: Sources,
          name: str = "prompts", available_now: bool = True, max_files_per_trigger: int | None = None):
    """Start the stream and return the ``StreamingQuery``."""
    reader = spark.readStream.schema(PROMPT_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(prompt_dir)

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        result = ask(batch, config, sources).withColumn("batch_id", F.lit(batch_id))
        result.write.mode("overwrite").parquet(os.path.join(out_dir, f"batch_id={batch_id}"))

    writer = (stream.writeStream.queryName(name).foreachBatch(run_batch)
              .option("checkpointLocation", os.path.join(checkpoint_dir(spark), "stream-" + name)))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
