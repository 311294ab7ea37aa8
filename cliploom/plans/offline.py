"""The offline run: records of manifests and folders, scored, decided and written, resumable by key."""

from __future__ import annotations

import datetime as dt
import os
import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cliploom import edge
from cliploom.config import Config
from cliploom.operators import records, select
from cliploom.operators.partition import numbered
from cliploom.session import is_folder, write_table
from cliploom.sinks import metadata as sink
from cliploom.sources import files, manifests
from cliploom.strategy.ir import compile_strategy

KEYS = ["source_path", "text"]


@dataclass
class Job:
    """What to run over: a manifest, folders, or both; manifest records come first."""

    manifest: str | None = None
    folders: Sequence[str] = ()
    recursive: bool = True
    limit: int | None = None
    output: str | None = None
    resume: bool = True
    strategy: str | None = None
    copy: bool = False


def load_records(spark: SparkSession, job: Job) -> DataFrame:
    """(index, source_path, text, meta): first record of each path and text in order, then the limit.

    Order is that of the manifest file's parts, then of folder paths by name, made explicit as an ordinal.
    """
    parts = []
    if job.manifest:
        rows = manifests.read_manifest(spark, job.manifest)
        at = F.col("line") if "line" in rows.columns else F.monotonically_increasing_id()
        parts.append(rows.select(F.lit(0).alias("part"), at.alias("at"), F.lit("").alias("name"), "video_path", "text", "meta"))
    if job.folders:
        rows = files.videos(spark, job.folders, job.recursive)
        parts.append(rows.select(F.lit(1).alias("part"), F.lit(0).cast("bigint").alias("at"), F.col("video_path").alias("name"), "video_path", "text", "meta"))
    if not parts:
        raise ValueError("neither a manifest nor a folder is given")
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    rows = write_table(rows, "records")  # the ordinal must not change between uses
    rows = rows.withColumn("ordinal", F.struct("part", "at", "name"))
    first = records.first_records(rows.select("ordinal", "video_path", "text", "meta"), ["video_path", "text"], "ordinal")
    first = records.limited(first, "ordinal", job.limit)
    keyed = first.select(F.format_string("%d|%020d|%s|%s", "ordinal.part", "ordinal.at", "ordinal.name", F.coalesce(F.col("text"), F.lit(""))).alias("key"), F.col("video_path").alias("source_path"), "text", "meta")
    return numbered(keyed, "key").drop("key").withColumnRenamed("place", "index")


def run(spark: SparkSession, config: Config, job: Job) -> dict:
    """Score, decide and append what isn't in the output yet; returns the run's log, which is also written."""
    began = time.time()
    output = job.output or os.path.join(config.workdir, "output", dt.datetime.now(dt.timezone.utc).strftime("offline_%Y%m%dT%H%M%SZ"))
    meta_path, log_path = os.path.join(output, "metadata.jsonl"), os.path.join(output, "runlog.json")
    text = job.strategy or config.selection.strategy
    strategy = compile_strategy(text) if text else None
    log = {"started_at": dt.datetime.now(dt.timezone.utc).isoformat(), "strategy": text, "models": [m.name for m in config.models]}
    sink.write_run_log(log_path, "running", {}, **log)
    try:
        wanted = write_table(load_records(spark, job), "wanted")
        total = wanted.count()
        if not total:
            raise SystemExit("no records")
        done = manifests.read_metadata(spark, meta_path) if job.resume and is_folder(meta_path) else None
        todo = records.pending(wanted, done, KEYS) if done is not None else wanted
        todo = write_table(todo, "pending")
        n = todo.count()
        if n:
            models = [(m.name, m.kind, {"batch_size": m.batch_size, "device": m.device, **m.extra}) for m in config.models]
            scored = edge.score(todo.withColumnRenamed("source_path", "video_path"), models, "__init_failed").withColumnRenamed("video_path", "source_path")
            reason = select.score_reason(F.col("scores"), config.thresholds(), strategy, F.col("text"), F.col("meta"))
            reason = select.drop_reason(reason, init_failed=F.col("__init_failed"))
            decided = write_table(select.decide(scored, reason).drop("__init_failed"), "decided")
            sources = decided.where("keep").select(F.col("source_path").alias("path")).distinct()
            found = sources.where(edge.exists("path"))
            pending_kinds = sink.pending_kinds([m.kind for m in config.models if m.kind in {*edge.STUBS, *edge.STUBS.values()}], edge.STUBS)
            rows = sink.offline_rows(decided, found, pending_kinds)
            rows = write_table(rows, "rows")
            targets = rows.where("keep").withColumn("target", F.concat(F.lit(os.path.join(output, "videos") + "/"), "output_path"))
            edge.materialize(targets, "source_path", "target", job.copy)
            sink.write_metadata(rows, meta_path, append=done is not None)
        everything = manifests.read_metadata(spark, meta_path) if is_folder(meta_path) else None
        counts = {r["outcome"]: r["clips"] for r in select.reason_histogram(everything).collect()} if everything is not None else {}
        current = everything.join(wanted.select(*KEYS).distinct(), [everything[k].eqNullSafe(wanted[k]) for k in KEYS], "left_semi") if everything is not None else None
        log |= {"records_total": total, "processed": n, "pending": 0, "kept": counts.get("kept", 0), "dropped": sum(v for k, v in counts.items() if k != "kept"), "kept_of_inputs": current.where("keep").count() if current is not None else 0}
        log |= {"finished_at": dt.datetime.now(dt.timezone.utc).isoformat(), "duration_sec": round(time.time() - began, 3)}
        reasons = {k: v for k, v in counts.items() if k != "kept"}
        sink.write_run_log(log_path, "success", reasons, **log)
        return {"status": "success", "output": output, "reason_counts": reasons, **log}
    except BaseException as e:
        status = "interrupted" if isinstance(e, KeyboardInterrupt) else "failed"
        sink.write_run_log(log_path, status, {}, **log, error=str(e))
        raise
