"""New shards only: an available-now stream over a shard folder, with its own checkpoint as the record of finished ones."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from askmine.sources.shards import EMAIL


def process_new_shards(spark: SparkSession, folder: str, out: str, checkpoint: str, step: Callable[[DataFrame], DataFrame], schema: str = EMAIL) -> int:
    """Apply step to each batch of shards that no run has seen, and append its rows to out; the number of batches.

    A batch that is run again after a failure writes the same folder again.
    """
    done: list[int] = []

    def write(batch: DataFrame, number: int) -> None:
        step(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")
        done.append(number)

    stream = spark.readStream.schema(schema).option("pathGlobFilter", "emails-*.jsonl").option("recursiveFileLookup", "true").json(folder)
    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return len(done)
