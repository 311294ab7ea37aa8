"""Structured Streaming: landing clip rows through the same selection as the batch plans, and resuming by key.

A stream reads a landing folder of files; each micro-batch is decided by the batch operator and written under its batch
id, so a batch that is repeated after a failure replaces its own output. Back-pressure is the number of files a trigger
takes.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cliploom.operators.select import decide, score_reason


def landing(spark: SparkSession, folder: str, schema: T.StructType | str, kind: str = "parquet", max_files: int = 16) -> DataFrame:
    """Rows of files as they land."""
    return spark.readStream.format(kind).schema(schema).option("maxFilesPerTrigger", max_files).load(folder)


def each_batch(stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Run ``work`` for every micro-batch; with ``available_now`` the query ends when what has landed is done."""
    writer = stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")).start()


def select_stream(stream: DataFrame, thresholds: Mapping[str, float], output: str, checkpoint: str, strategy: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Decide landing clips (with ``scores``) and write them under ``output/batch_id=...``."""

    def work(batch: DataFrame, batch_id: int) -> None:
        decided = decide(batch.drop("reason", "keep"), score_reason(F.col("scores"), thresholds, strategy))
        decided.write.mode("overwrite").parquet(f"{output}/batch_id={batch_id}")

    return each_batch(stream, work, checkpoint, available_now)


def new_records(stream: DataFrame, keys: list[str], seen_at: str | None = None, delay: str = "7 days") -> DataFrame:
    """Rows whose key hasn't come before; null is a key value.

    With an event-time column the state is bounded by the watermark; without one it grows with the number of keys.
    """
    marked = stream.withColumns({f"__n_{k}": F.col(k).isNull() for k in keys} | {f"__k_{k}": F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys})
    on = [f"__{x}_{k}" for k in keys for x in ("n", "k")]
    unique = marked.withWatermark(seen_at, delay).dropDuplicatesWithinWatermark(on) if seen_at else marked.dropDuplicates(on)
    return unique.drop(*on)


def stage_progress(stream: DataFrame, at: str, window: str = "1 hour", delay: str = "1 day") -> DataFrame:
    """Saves by event-time window and stage; late ones count until the watermark has passed."""
    return stream.withWatermark(at, delay).groupBy(F.window(at, window), "stage").agg(F.count(F.lit(1)).alias("saves"))
