"""Metadata rows and their files."""

from __future__ import annotations

import json
import os
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliploom.functions.text import output_name
from cliploom.operators.records import with_extras
from cliploom.session import file_system


def shard_rows(results: DataFrame, listing: DataFrame, extras: DataFrame | None = None) -> DataFrame:
    """Rows of a shard's metadata: size 0 for a missing file, an output only for a kept clip that exists.

    ``results``: (source_path, scores, keep, reason, output_path); ``extras`` override columns of the same name.
    """
    sizes = listing.select(F.col("path").alias("source_path"), F.col("length").alias("__length"))
    rows = results.join(sizes, "source_path", "left")
    there = F.col("__length").isNotNull()
    rows = rows.withColumn("output_path", F.when(F.col("keep") & there, F.col("output_path"))).withColumn("size_bytes", F.coalesce("__length", F.lit(0))).drop("__length")
    return with_extras(rows, extras, "source_path") if extras is not None else rows


def offline_rows(results: DataFrame, listing: DataFrame, pending_kinds: list[str] = ()) -> DataFrame:
    """Rows of an offline run: a kept record whose source is gone is dropped, outputs are numbered.

    ``results``: (index, source_path, keep, reason, scores, text, meta).
    """
    have = listing.select(F.col("path").alias("source_path"), F.lit(True).alias("__there"))
    rows = results.join(have, "source_path", "left")
    gone = F.col("keep") & F.col("__there").isNull()
    rows = rows.withColumn("reason", F.when(gone, "source_missing").otherwise(F.col("reason"))).withColumn("keep", F.col("keep") & ~gone).drop("__there")
    rows = rows.withColumn("output_path", F.when(F.col("keep"), output_name(F.col("index"), F.col("source_path"))))
    if pending_kinds:
        rows = rows.withColumn("consistency_stub", F.lit(True)).withColumn("consistency_pending", F.lit(",".join(dict.fromkeys(pending_kinds))))
    return rows


def write_metadata(rows: DataFrame, path: str, append: bool = False, partition_by: str | None = None) -> None:
    """JSON lines with null fields written out; the task commit protocol keeps partial files out of sight."""
    writer = rows.write.mode("append" if append else "overwrite").option("ignoreNullFields", False)
    (writer.partitionBy(partition_by) if partition_by else writer).json(path)


def write_calibration(metadata: DataFrame, path: str) -> None:
    """Scored rows as parquet; scores are a map, so rows without any entry are no special case."""
    metadata.where(F.col("scores").isNotNull()).write.mode("overwrite").parquet(path)


def write_grid(table: DataFrame, path: str) -> None:
    """The grid table, a row per combination, as one CSV file."""
    table.coalesce(1).write.mode("overwrite").csv(path, header=True)


def write_run_log(path: str, status: str, counts: Mapping[str, int], **config: object) -> None:
    """A run's log as one JSON file at a local path or URI, replaced in one step."""
    system, at = file_system(path)
    system.create_dir(os.path.dirname(at), recursive=True)
    with system.open_output_stream(f"{at}.tmp") as f:
        f.write(json.dumps({"status": status, "reason_counts": dict(counts), **config}, ensure_ascii=False, indent=2).encode())
    system.move(f"{at}.tmp", at)


def pending_kinds(kinds: list[str], aliases: Mapping[str, str]) -> list[str]:
    """Checks still to be made, by their usual names, each once in the order given."""
    return list(dict.fromkeys(aliases.get(k, k) for k in kinds))


def write_states(states: DataFrame, path: str) -> None:
    """Current states as a table of one row per shard, replaced as a whole; saves of single shards are ``plans.shards.Store``'s."""
    states.write.mode("overwrite").parquet(path)


def write_summaries(summaries: DataFrame, path: str) -> None:
    summaries.write.mode("overwrite").option("ignoreNullFields", False).json(path)
