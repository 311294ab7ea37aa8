"""The run of shards through all stages: spans, windows, flash, text overlay, scores, decision, rows, states, summaries.

All pending shards are one plan. If it fails, the shards are halved until those that make it fail stand alone; they are
left as they were, with the error in the log, and all others are stored. Rows, states and summaries of a job are
committed together by one pointer file, so a run that dies is repeated from the last committed job, without skipping or
repeating a shard.
"""

from __future__ import annotations

import time
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cliploom import edge
from cliploom.config import Config
from cliploom.operators import captions, frames, scenes, select, windows
from cliploom.operators.versions import Versions
from cliploom.session import write_table
from cliploom.strategy.ir import compile_strategy

STATE = "shard string, downloaded boolean, extracted boolean, scored boolean, uploaded boolean, stage string, started_at double, finished_at double, save_seq bigint"


def process(config: Config, videos: DataFrame, features: DataFrame) -> DataFrame:
    """Rows of all videos (shard, path, fps, total_frames, width, height, size_bytes): flags, windows, scores, reason, keep.

    ``features``: (path, frame_idx, mean_luma, and text_ratio, content, boundary_score where there are). A video without
    a frame rate or frames can't be divided. Only what passes the stages before is scored.
    """
    s, f, o = config.splitter, config.flash_filter, config.ocr
    content = "content" if "content" in features.columns else "mean_luma"
    spans = scenes.scene_spans(features, videos, s.kind, s.threshold, s.min_scene_len, s.transnet_threshold, content)
    by_path = spans.groupBy("path").agg(F.transform(F.sort_array(F.collect_list(F.struct("span_idx", "start", "end"))), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))).alias("spans"))
    rows = windows.video_metadata(videos.join(by_path, "path", "left"), s.window_len, s.window_stride).drop("spans")
    flash = frames.flash(features, f.sample_stride, f.brightness_delta, f.max_flash_ratio) if f.enabled else None
    text = frames.text_hit(features, o.sample_stride, o.text_area_threshold) if o.enabled and "text_ratio" in features.columns else None
    for hits, name in ((flash, "flash_hit"), (text, "ocr_hit")):
        rows = frames.flag(rows, hits, name) if hits is not None else rows.withColumn(name, F.lit(None).cast("boolean"))
    broken = ~F.coalesce((F.col("fps") > 0) & (F.col("total_frames") > 0), F.lit(False))
    drops = {"split_failed": broken, "flash_hit": None if f.record_only else F.col("flash_hit"), "ocr_hit": None if o.record_only else F.col("ocr_hit")}
    rows = write_table(rows.withColumn("__early", select.drop_reason(F.lit(None).cast("string"), **drops)), "prepared")
    models = [(m.name, m.kind, {"batch_size": m.batch_size, "device": m.device, **m.extra}) for m in config.models]
    named = rows.withColumnRenamed("path", "video_path").withColumns({"text": F.lit(None).cast("string"), "meta": F.create_map().cast("map<string,string>")})
    scored = edge.score(named.where("__early is null"), models, "__init").withColumnRenamed("video_path", "path")
    strategy = compile_strategy(config.selection.strategy) if config.selection.strategy else None
    reason = select.score_reason(F.col("scores"), config.thresholds(), strategy, F.col("text"), F.col("meta"))
    reason = select.drop_reason(reason, init_failed=F.col("__init"), source_exists=F.col("size_bytes").isNotNull())
    done = scored.withColumn("reason", reason).drop("__init", "text", "meta", "__early")
    early = rows.where("__early is not null").withColumn("scores", F.create_map().cast("map<string,double>")).withColumnRenamed("__early", "reason")
    return done.unionByName(early).withColumn("keep", F.col("reason").isNull()).withColumnRenamed("path", "source_path")


def pending(videos: DataFrame, states: DataFrame | None) -> DataFrame:
    """(shard): shards of videos that no committed job has scored."""
    listed = videos.where("shard is not null").select("shard").distinct()
    return listed if states is None else listed.join(states.where("scored").select("shard"), "shard", "left_anti")


class Store:
    """What jobs have committed: folders of rows, states and summaries."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.versions = spark, Versions(spark, path)

    def _read(self, kind: str) -> DataFrame | None:
        m = self.versions.head()
        return self.spark.read.parquet(*[f"{self.versions.path}/{j}/{kind}" for j in m["jobs"]]) if m else None

    def rows(self) -> DataFrame | None:
        return self._read("rows")

    def states(self) -> DataFrame | None:
        return self._read("states")

    def summaries(self) -> DataFrame | None:
        return self._read("summaries")

    def add(self, rows: DataFrame, config: Config, began: float) -> None:
        m = self.versions.head() or {"version": 0, "jobs": []}
        job = self.versions.attempt()
        at = f"{self.versions.path}/{job}"
        rows.write.parquet(f"{at}/rows")
        stored = self.spark.read.schema(rows.schema).parquet(f"{at}/rows")
        now, upload = time.time(), config.upload.enabled and not config.skip_upload
        flags = [F.lit(True).alias(c) for c in ("downloaded", "extracted", "scored")]
        state = [*flags, F.lit(False).alias("uploaded"), F.lit("materializing" if upload else "processed").alias("stage"), F.lit(began).alias("started_at"), F.lit(now).alias("finished_at"), F.lit(m["version"] + 1).cast("bigint").alias("save_seq")]
        stored.select("shard").distinct().select("shard", *state).write.parquet(f"{at}/states")
        select.funnel(stored, ["shard"]).withColumn("time_total", F.lit(now - began)).write.parquet(f"{at}/summaries")
        self.versions.commit(m["version"] + 1, {"jobs": [*m["jobs"], job]})


def run(spark: SparkSession, config: Config, videos: DataFrame, features: DataFrame, output: str) -> dict:
    """Process the pending shards; returns {processed, failed: {shard: error}, kept, dropped}."""
    store = Store(spark, output)
    todo = sorted(r["shard"] for r in pending(videos, store.states()).collect())  # the shard list, which is configuration
    todo = todo[: config.limit_shards] if config.limit_shards else todo
    failed: dict[str, str] = {}
    waiting = [todo] if todo else []
    while waiting:
        some = waiting.pop()
        began = time.time()
        names = F.broadcast(spark.createDataFrame([(x,) for x in some], "shard string"))
        mine = videos.join(names, "shard", "left_semi")
        try:
            store.add(process(config, mine, features.join(mine.select("path").distinct(), "path", "left_semi")), config, began)
        except Exception as e:
            if len(some) == 1:
                failed[some[0]] = (str(e) or type(e).__name__)[:500]
            else:
                waiting += [some[len(some) // 2 :], some[: len(some) // 2]]
    done = [x for x in todo if x not in failed]
    rows = store.rows()
    counts = {r["keep"]: r["count"] for r in rows.groupBy("keep").count().collect()} if rows is not None else {}
    return {"processed": len(done), "failed": failed, "kept": counts.get(True, 0), "dropped": counts.get(False, 0)}


def caption_kept(spark: SparkSession, config: Config, output: str) -> DataFrame:
    """(path, caption, caption_visual, caption_error) of kept clips without a caption, stored and returned.

    Frames come from the reader registered as ``frames``, if there is one. The visual stage looks at the clip, the rewriting stage at its answer; a failed rewriting leaves the visual caption.
    """
    store, versions = Store(spark, output), Versions(spark, f"{output.rstrip('/')}/captions")
    m = versions.head() or {"version": 0, "jobs": []}
    rows = store.rows()
    if rows is None:
        raise ValueError(f"no processed shards in {output}")
    clips = rows.where("keep").select(F.col("source_path").alias("path")).distinct()
    if m["jobs"]:
        had = reduce(DataFrame.unionByName, [spark.read.parquet(f"{versions.path}/{j}") for j in m["jobs"]])
        clips = clips.join(had.where("caption is not null").select("path").distinct(), "path", "left_anti")

    def ask(todo: DataFrame, stage, prompt) -> DataFrame:
        options = {"model": stage.model, "base_url": stage.base_url, "api_key": stage.api_key, "system_prompt": stage.system_prompt, "num_frames": stage.num_frames, "max_side": stage.max_side}
        return edge.caption(todo.select("path", prompt.alias("prompt"), *([c for c in ("frames",) if c in todo.columns])), stage.provider, options, stage.retry)

    first = config.caption.visual or config.caption.single
    if first is None:
        raise ValueError("no caption stage is configured")
    if edge.has_frame_reader("frames"):
        clips = edge.read_frames(clips, "frames", {}, first.num_frames, first.max_side)
    seen = write_table(ask(clips, first, captions.prompt(F.lit(first.prompt), F.col("path"))), "visual-captions").select("path", F.col("response").alias("visual"), F.col("error").alias("visual_error"))
    second = config.caption.rewrite
    if second is not None:
        todo = seen.where("visual_error is null and visual is not null")
        said = ask(todo, second, captions.fill_template(F.lit(second.template or second.prompt), F.col("visual"), F.col("path")))
        seen = seen.join(said.select("path", F.col("response").alias("rewrite"), F.col("error").alias("rewrite_error")), "path", "left")
        got = seen.select("path", captions.two_stage(F.col("visual"), F.col("visual_error"), F.col("rewrite"), F.col("rewrite_error")).alias("o")).select("path", "o.caption", "o.caption_visual", "o.caption_error")
    else:
        got = seen.select("path", F.col("visual").alias("caption"), F.col("visual").alias("caption_visual"), F.col("visual_error").alias("caption_error"))
    job = versions.attempt()
    got.write.parquet(f"{versions.path}/{job}")
    versions.commit(m["version"] + 1, {"jobs": [*m["jobs"], job]})
    return spark.read.schema(got.schema).parquet(f"{versions.path}/{job}")
