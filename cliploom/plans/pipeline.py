"""Queries of records, windows, progress, partitioning, captions and scalar functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cliploom.functions import kernels, text
from cliploom.operators import captions, partition, progress, records, windows
from cliploom.session import table
from cliploom.sources import files, manifests

NOW = 1_770_000_000.0


# Windows and frame numbers


def sliding_windows(spark: SparkSession, d: str) -> DataFrame:
    clips = table(spark, d, "clip_results").select("clip_id", "fps", "total_frames", "width", "height")
    got = windows.video_metadata(clips, 60, 45)
    return got.select("clip_id", F.round("duration_sec", 6).alias("duration_sec"), "num_windows", F.get("windows", F.lit(0))[1].alias("first_end"), F.try_element_at("windows", F.lit(-1))[0].alias("last_start"))


def scene_windows(spark: SparkSession, d: str) -> DataFrame:
    """Two spans a video, the second of which may be too short for a window; one row of nulls without a frame rate."""
    clips = table(spark, d, "clip_results").select("clip_id", "fps", "total_frames", "width", "height")
    stop = F.when(F.col("fps") > 0, F.col("total_frames") / F.col("fps"))
    cut = F.round(stop * 0.7, 3)
    spans = F.array(F.struct(F.lit(0.0).alias("start"), cut.alias("end")), F.struct(cut.alias("start"), stop.alias("end")))
    got = windows.video_metadata(clips.withColumn("spans", spans), 48, 24)
    return got.select("clip_id", F.posexplode_outer("scenes").alias("scene", "s")).select("clip_id", "scene", "s.start_frame", "s.end_frame", "s.num_windows")


def _sizes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "clip_results").select(F.col("total_frames").alias("total"), (F.col("total_frames") % 37).cast("int").alias("n")).distinct()


def uniform_indices(spark: SparkSession, d: str) -> DataFrame:
    return _sizes(spark, d).select("total", "n", kernels.uniform_indices(F.col("total"), F.col("n")).alias("at"))


def frame_pairs(spark: SparkSession, d: str) -> DataFrame:
    return _sizes(spark, d).select("total", "n", kernels.frame_pairs(F.col("total"), F.col("n")).alias("at"))


def caption_frame_indices(spark: SparkSession, d: str) -> DataFrame:
    return _sizes(spark, d).select("total", "n", kernels.caption_indices(F.col("total"), F.col("n")).alias("at"))


def _quad(a: Column, b: Column, c: Column, e: Column) -> Column:
    """A quadrangle away from the origin, turned either way, which crosses itself for some values."""
    p = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    return F.array(p(a, b), p(a + c, b - e), p(c * 2 - b, e + a), p(b - c, a * 2))


def polygon_area(spark: SparkSession, d: str) -> DataFrame:
    """Quadrangles made of the numbers of order lines."""
    q = _quad(F.col("l_quantity"), F.col("l_discount") * 100, F.col("l_tax") * 100, F.col("l_linenumber"))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.round(kernels.polygon_area(q), 6).alias("area"))


def text_area_ratio(spark: SparkSession, d: str) -> DataFrame:
    """Two boxes of text of each clip, of sizes that differ from clip to clip, and one that is missing."""
    w, h, k = F.col("width"), F.col("height"), F.col("clip_id") % 17
    boxes = F.array(_quad(k + 3, k % 5, w / 8, h / 9), F.lit(None), _quad(w / 3, h / (k + 4), k + 1, F.lit(7)))
    return table(spark, d, "clip_results").select("clip_id", F.round(kernels.text_area_ratio(boxes, w, h), 9).alias("ratio"))


def fit_within(spark: SparkSession, d: str) -> DataFrame:
    sizes = table(spark, d, "clip_results").where("width is not null and height is not null").select("width", "height").distinct()
    return sizes.select("width", "height", kernels.fit_within(F.col("width"), F.col("height"), F.lit(512)).alias("s")).select("width", "height", F.col("s.width").alias("w"), F.col("s.height").alias("h"))


# Records


def _records(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "clip_captions").select(F.col("path").alias("video_path"), "caption", "caption_id", "provider")
    return rows.withColumnRenamed("caption", "text")


def dedup_first(spark: SparkSession, d: str) -> DataFrame:
    return records.first_records(_records(spark, d), ["video_path", "text"], "caption_id").select("video_path", "text", "caption_id", "provider")


def limit_after_dedup(spark: SparkSession, d: str) -> DataFrame:
    return records.limited(records.first_records(_records(spark, d), ["video_path", "text"], "caption_id"), "caption_id", 500).select("caption_id", "video_path")


def resume_anti_join(spark: SparkSession, d: str) -> DataFrame:
    """Caption records whose clip and text no failed record covers; null texts match null texts."""
    rows = _records(spark, d)
    done = table(spark, d, "clip_captions").where("caption_error is not null").select(F.col("path").alias("video_path"), F.col("caption").alias("text"))
    return records.pending(rows, done, ["video_path", "text"]).select("caption_id", "video_path", "text", "provider")


def extras_left_join(spark: SparkSession, d: str) -> DataFrame:
    """Captions merged into clip rows; a caption's shard overrides the clip's where it has one."""
    clips = table(spark, d, "clip_results").select("source_path", "clip_id", "shard", "keep")
    caps = table(spark, d, "clip_captions").groupBy(F.col("path").alias("source_path")).agg(F.max("caption").alias("caption"), F.max("shard").alias("shard"))
    return records.with_extras(clips, caps, "source_path").select("clip_id", "shard", "keep", "caption")


def state_upsert(spark: SparkSession, d: str) -> DataFrame:
    states = progress.current_states(table(spark, d, "shard_state")).select("shard", "downloaded", "scored", "stage")
    shards = table(spark, d, "clip_results").where("shard is not null").select("shard").unionByName(spark.createDataFrame([("zz_new.zip",)], "shard string"))
    return records.upsert_downloaded(states, shards, {"downloaded": False, "scored": False, "stage": "pending"})


def manifest_json_meta(spark: SparkSession, d: str) -> DataFrame:
    """Documents as manifest lines and back: texts, and kinds of meta cells."""
    docs = table(spark, d, "documents").where("source_path is not null")
    line = F.to_json(F.struct(F.col("source_path").alias("video_path"), "text", F.col("n_chars").alias("n"), F.col("lang").alias("l")), {"ignoreNullFields": "false"})
    got = manifests.json_records(docs.select(line.alias("value")), "/data")
    cell = text.meta_cell(F.try_element_at("meta", F.lit("n")))
    return got.select("video_path", F.length("text").alias("text_len"), cell["kind"].alias("kind"), cell["number"].alias("number"), F.try_element_at("meta", F.lit("l")).alias("lang"))


# Progress


def _states(spark: SparkSession, d: str) -> DataFrame:
    return progress.current_states(table(spark, d, "shard_state"))


def flag_totals(spark: SparkSession, d: str) -> DataFrame:
    return progress.flag_totals(_states(spark, d))


def stage_counts(spark: SparkSession, d: str) -> DataFrame:
    return progress.stage_counts(_states(spark, d))


def oldest_active_topk(spark: SparkSession, d: str) -> DataFrame:
    return progress.oldest_active(_states(spark, d), "saved_at", 5).select("shard", "stage", "saved_at")


def oldest_active_per_config(spark: SparkSession, d: str) -> DataFrame:
    rows = _states(spark, d).withColumn("config", F.substring_index("shard", "_", 1))
    return progress.oldest_per(rows, "config", "saved_at")


def avg_shard_duration(spark: SparkSession, d: str) -> DataFrame:
    got = progress.average_duration(_states(spark, d), ["stage"])
    return got.select("stage", "finished", F.round("avg_seconds", 3).alias("avg_seconds"))


def config_progress(spark: SparkSession, d: str) -> DataFrame:
    """Configurations by the last digit of a shard's number, over shards of clips, some of which have no state."""
    listed = table(spark, d, "clip_results").where("shard is not null").select("shard").unionByName(spark.createDataFrame([("none_000001.zip",)], "shard string"))
    return progress.config_progress(listed.select("shard", F.regexp_extract("shard", r"(\d)\.", 1).alias("config")), _states(spark, d))


def summary_rollup(spark: SparkSession, d: str) -> DataFrame:
    return progress.rollup_progress(_states(spark, d), F.substring_index("shard", "_", 1))


def intersect_scored(spark: SparkSession, d: str) -> DataFrame:
    return progress.in_both(table(spark, d, "clip_results"), _states(spark, d).where("scored"))


def except_uploaded(spark: SparkSession, d: str) -> DataFrame:
    return progress.missing(_states(spark, d), _states(spark, d).where("uploaded"))


def missing_top20(spark: SparkSession, d: str) -> DataFrame:
    return progress.first_missing(_states(spark, d), table(spark, d, "run_ledger"), 20)


def snapshot_rates(spark: SparkSession, d: str) -> DataFrame:
    """Videos done a minute between consecutive saves of a shard."""
    saves = table(spark, d, "shard_state").select("shard", "save_seq", F.unix_micros(F.to_timestamp("saved_at")).alias("us"), F.col("progress.videos_done").alias("done")).where("done is not null").distinct()
    got = progress.rates(saves.withColumn("at", F.col("us") / 1e6), "at", "done")
    return got.select("shard", "done", (F.round("per_minute", 4) + F.lit(0.0)).alias("per_minute"))


def status_lines(spark: SparkSession, d: str) -> DataFrame:
    return progress.active(_states(spark, d)).select(progress.status_line(F.lit(NOW) - F.col("started_at")).alias("line"))


def age_format(spark: SparkSession, d: str) -> DataFrame:
    """Ages of finished shards' runs."""
    rows = progress.duration(_states(spark, d))
    return rows.select("shard", text.age(F.col("seconds")).alias("age"))


def upload_outcomes(spark: SparkSession, d: str) -> DataFrame:
    return progress.upload_outcomes(_states(spark, d), table(spark, d, "clip_results").where("output_path is not null and shard is not null"))


def upload_manifest_bytes(spark: SparkSession, d: str) -> DataFrame:
    """Kept outputs as files; a file that two patterns match is listed twice."""
    rows = table(spark, d, "clip_results").where("output_path is not null").select(F.col("output_path").alias("path"), F.col("size_bytes").alias("length")).distinct()
    got = files.upload_manifest(rows, "output", ["*/videos/*.mp4", "**/*_scene_0001.mp4", "*.zip"])
    return got.groupBy(F.substring_index("path", "/", 1).alias("folder")).agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"))


def run_counts(spark: SparkSession, d: str) -> DataFrame:
    got = progress.run_counts(table(spark, d, "run_log"))
    return got.select("status", "runs", F.round("seconds", 3).alias("seconds"))


def checks_all_ok(spark: SparkSession, d: str) -> DataFrame:
    """Consistency of finished runs as checks."""
    rows = table(spark, d, "run_log").select(F.col("run_id").cast("string").alias("name"), (F.col("status") != "failed").alias("ok"))
    return progress.checks_summary(rows)


def failed_workers(spark: SparkSession, d: str) -> DataFrame:
    return partition.failed(table(spark, d, "run_log").select(F.when(F.col("status") == "success", 0).otherwise(1).alias("code")))


def _summaries(spark: SparkSession, d: str) -> DataFrame:
    """Clips as a stand-in for shard summaries: seconds of video as time."""
    rows = table(spark, d, "clip_results").where("shard is not null")
    return rows.groupBy("shard").agg(F.count(F.lit(1)).alias("clips_scored"), F.sum("total_frames").cast("double").alias("time_total"))


def summary_totals(spark: SparkSession, d: str) -> DataFrame:
    got = progress.summary_totals(_states(spark, d), _summaries(spark, d))
    return got.select("summarised", F.round("avg_time", 3).alias("avg_time"), "clips")


def next_actions(spark: SparkSession, d: str) -> DataFrame:
    return _states(spark, d).groupBy(progress.next_action().alias("action"), progress.next_action(skip_upload=True).alias("without_upload")).agg(F.count(F.lit(1)).alias("shards"))


def stage_timings(spark: SparkSession, d: str) -> DataFrame:
    """Frames and windows as stand-ins for seconds by stage."""
    rows = table(spark, d, "clip_results").select("shard", F.col("total_frames").alias("time_scene"), F.col("num_windows").alias("time_score"))
    return progress.stage_timings(rows, ["time_scene", "time_score"], ["shard"])


# Partitioning


def _shards(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "shard_state").select("shard").distinct()


def split_even(spark: SparkSession, d: str) -> DataFrame:
    return partition.even_chunks(_shards(spark, d), "shard", 7).select("shard", "chunk")


def split_ntile(spark: SparkSession, d: str) -> DataFrame:
    return partition.balanced_chunks(_shards(spark, d), "shard", 7).select("shard", "chunk")


def gpu_round_robin(spark: SparkSession, d: str) -> DataFrame:
    got = partition.even_chunks(_shards(spark, d), "shard", 7).withColumn("gpu", partition.round_robin(F.col("chunk"), 3).cast("int"))
    return got.groupBy("gpu").agg(F.count(F.lit(1)).alias("shards"))


# Captions


def parse_chat_completion(spark: SparkSession, d: str) -> DataFrame:
    """Captions as chat responses, every third in parts."""
    caps = table(spark, d, "clip_captions").select("caption_id", "caption").distinct()
    plain = F.to_json(F.struct(F.array(F.struct(F.struct(F.col("caption").alias("content")).alias("message"))).alias("choices")), {"ignoreNullFields": "false"})
    part = lambda kind, t: F.struct(F.lit(kind).alias("type"), t.alias("text"))
    parts = F.to_json(F.struct(F.array(F.struct(F.struct(F.array(part("text", F.col("caption")), part("image", F.lit("no")), part("text", F.lit("end"))).alias("content")).alias("message"))).alias("choices")), {"ignoreNullFields": "false"})
    body = F.when(F.col("caption_id") % 3 == 0, parts).otherwise(plain)
    return caps.select("caption_id", captions.parse_chat(body).alias("content"))


def _json_string(text: Column) -> Column:
    """``text`` as an escaped JSON string; the missing one is null in JSON."""
    items = F.to_json(F.array(text), {"ignoreNullFields": "false"})
    return F.substring(items, F.lit(2), F.length(items) - 2)


def parse_generic_response(spark: SparkSession, d: str) -> DataFrame:
    """Captions as objects, strings and plain text."""
    caps = table(spark, d, "clip_captions").select("caption_id", "caption").distinct()
    k = F.col("caption_id") % 4
    one = lambda name: F.to_json(F.create_map(F.lit("id"), F.lit("7"), F.lit(name), F.col("caption")))
    body = F.when(k == 0, one("result")).when(k == 1, one("text")).when(k == 2, _json_string(F.col("caption"))).otherwise(F.concat(F.lit("  ~"), F.col("caption")))
    return caps.select("caption_id", captions.parse_generic(body, "result").alias("content"))


def caption_fallback(spark: SparkSession, d: str) -> DataFrame:
    """Outcome of both stages from the recorded results."""
    caps = table(spark, d, "clip_captions").select("caption_id", "caption", "caption_visual", "caption_error").distinct()
    kind = captions.error_kind(F.col("caption_error"))
    detail = F.substring_index("caption_error", ":", -1)
    got = captions.two_stage(F.col("caption_visual"), F.when(kind == "visual_failed", detail), F.when(F.coalesce(kind, F.lit("")) != "rewrite_empty", F.col("caption")), F.when(kind == "rewrite_failed", detail))
    return caps.select("caption_id", got.alias("o")).select("caption_id", "o.caption", "o.caption_visual", "o.caption_error")


def caption_eligible(spark: SparkSession, d: str) -> DataFrame:
    clips = table(spark, d, "clip_results").select("clip_id", "source_path", "keep").distinct()
    caps = captions.non_empty(table(spark, d, "clip_captions")).groupBy(F.col("path").alias("source_path")).agg(F.max("caption").alias("caption"))
    return captions.eligible(clips.join(caps, "source_path", "left")).select("clip_id")


def caption_errors(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "clip_captions").groupBy(captions.error_kind(F.col("caption_error")).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def prompt_templates(spark: SparkSession, d: str) -> DataFrame:
    caps = table(spark, d, "clip_captions").where("caption_visual is not null").select("caption_id", "path", "caption_visual").distinct()
    template = F.when(F.col("caption_id") % 2 == 0, "{filename}: {visual_caption}!").otherwise("say {other}")
    return caps.select("caption_id", captions.fill_template(template, F.col("caption_visual"), F.col("path")).alias("prompt"), captions.prompt(F.lit("look"), F.col("path")).alias("with_name"))


def url_normalise(spark: SparkSession, d: str) -> DataFrame:
    tails = F.array(F.lit(""), F.lit("/"), F.lit("/v1"), F.lit("/v1//"), F.lit("/v1/chat/completions"), F.lit("/x"))
    base = F.concat(F.lit("http://"), F.lower("n_name"), F.get(tails, F.col("n_nationkey") % 6))
    return table(spark, d, "nation").select("n_nationkey", text.chat_url(base).alias("url"))


def placeholder_clean(spark: SparkSession, d: str) -> DataFrame:
    value = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("${"), "c_name", F.lit("}"))).when(F.col("c_custkey") % 3 == 1, F.lit("")).otherwise(F.col("c_name"))
    return table(spark, d, "customer").select("c_custkey", text.without_placeholder(value).alias("value"))


# Scalars


def output_names(spark: SparkSession, d: str) -> DataFrame:
    clips = table(spark, d, "clip_results").select("clip_id", "source_path").distinct()
    path = F.col("source_path")
    return clips.select("clip_id", text.output_name(F.col("clip_id"), path).alias("name"), text.stem(path).alias("stem"), text.suffix(path).alias("suffix"), text.scene_name(path, F.col("clip_id") % 100).alias("scene"))


def meta_key_normalise(spark: SparkSession, d: str) -> DataFrame:
    names = table(spark, d, "part").select("p_partkey", F.concat(F.when(F.col("p_partkey") % 3 == 0, F.col("p_size").cast("string")).otherwise(F.lit(" ")), "p_brand", F.lit(" / "), "p_type").alias("k"))
    return names.select("p_partkey", text.normalise_key(F.col("k")).alias("name"))


def devices(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "score_models").select("name", text.device(F.col("device")).alias("x")).select("name", "x.kind", "x.index")


QUERIES = {
    f.__name__: f
    for f in (
        sliding_windows, scene_windows, uniform_indices, frame_pairs, caption_frame_indices, polygon_area, text_area_ratio, fit_within,
        dedup_first, limit_after_dedup, resume_anti_join, extras_left_join, state_upsert, manifest_json_meta, flag_totals, stage_counts,
        oldest_active_topk, oldest_active_per_config, avg_shard_duration, config_progress, summary_rollup, intersect_scored, except_uploaded,
        missing_top20, snapshot_rates, status_lines, age_format, upload_outcomes, upload_manifest_bytes, run_counts, checks_all_ok, summary_totals, next_actions, stage_timings,
        failed_workers, split_even, split_ntile, gpu_round_robin, parse_chat_completion, parse_generic_response, caption_fallback,
        caption_eligible, caption_errors, prompt_templates, url_normalise, placeholder_clean, output_names, meta_key_normalise, devices,
    )
}

_ST = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY save_seq DESC) AS rn FROM shard_state) WHERE rn = 1)"
_SZ = "(SELECT DISTINCT total_frames AS total, CAST(total_frames % 37 AS INTEGER) AS n FROM clip_results)"
_FIRST = "(SELECT *, row_number() OVER (PARTITION BY path, caption ORDER BY caption_id) AS rn FROM clip_captions)"
_LAST = "CAST(CAST(total_frames / fps * fps AS DOUBLE) AS INTEGER)"
_DUR = "greatest(finished_at - coalesce(started_at, finished_at), 0.0)"
_FLAGS = ", ".join(f"count(*) FILTER (coalesce({f}, false)) AS n_{f}" for f in ("downloaded", "extracted", "scored", "uploaded"))
_BLANK = "trim({}, ' ' || chr(9) || chr(10) || chr(13))"



def _shoelace(a: str, b: str, c: str, e: str) -> str:
    """SQL of the area of the same quadrangle, as half the cross product of its diagonals."""
    a, b, c, e = f"({a})", f"({b})", f"({c})", f"({e})"
    x, y = [f"({a})", f"({a} + {c})", f"({c} * 2 - {b})", f"({b} - {c})"], [f"({b})", f"({b} - {e})", f"({e} + {a})", f"({a} * 2)"]
    return f"abs((({x[2]} - {x[0]}) * ({y[3]} - {y[1]}) - ({x[3]} - {x[1]}) * ({y[2]} - {y[0]}))::DOUBLE) / 2"


_AREAS = "(" + _shoelace("k + 3", "k % 5", "width / 8", "height / 9") + " + " + _shoelace("width / 3", "height / (k + 4)", "k + 1", "7") + ")"

ORACLE = {
    "sliding_windows": """SELECT clip_id, round(d, 6) AS duration_sec, CASE WHEN fps > 0 THEN n END AS num_windows, CASE WHEN fps > 0 AND n > 0 THEN 59 END AS first_end,
  CASE WHEN fps > 0 AND n > 0 THEN 45 * (n - 1) END AS last_start FROM (SELECT *, CAST(CASE WHEN l + 1 >= 60 THEN (l - 59) // 45 + 1 ELSE 0 END AS INTEGER) AS n
  FROM (SELECT *, CASE WHEN fps > 0 THEN greatest(CAST(trunc(d * fps) AS INTEGER) - 1, 0) END AS l FROM (SELECT *, CASE WHEN fps > 0 THEN total_frames / fps END AS d FROM clip_results)))""",
    "scene_windows": """SELECT clip_id, scene, f AS start_frame, l AS end_frame, CAST(CASE WHEN l - 47 >= f THEN (l - 47 - f) // 24 + 1 ELSE 0 END AS INTEGER) AS num_windows FROM (
  SELECT clip_id, scene, f, greatest(e, f) AS l FROM (SELECT clip_id, scene, CAST(trunc(s * fps) AS INTEGER) AS f, CAST(trunc(x * fps) AS INTEGER) - 1 AS e FROM (
   SELECT clip_id, fps, 0 AS scene, 0.0::DOUBLE AS s, round(total_frames / fps * 0.7, 3) AS x FROM clip_results WHERE fps > 0 UNION ALL
   SELECT clip_id, fps, 1, round(total_frames / fps * 0.7, 3), total_frames / fps FROM clip_results WHERE fps > 0)))
  UNION ALL SELECT clip_id, NULL, NULL, NULL, NULL FROM clip_results WHERE NOT coalesce(fps > 0, false)""",
    "uniform_indices": f"SELECT total, n, CAST(CASE WHEN total <= 0 OR n <= 0 THEN [] WHEN n >= total THEN range(total) ELSE list_transform(range(n), lambda i: CAST(trunc(i * (CAST(total AS DOUBLE) / n)) AS INTEGER)) END AS INTEGER[]) AS at FROM {_SZ}",
    "frame_pairs": f"SELECT total, n, CAST(CASE WHEN total < 2 THEN [] ELSE list_filter(list_transform(range(greatest(n, 1)), lambda i: i * greatest(total // (greatest(n, 1) + 1), 1)), lambda x: x + 1 < total) END AS INTEGER[]) AS at FROM {_SZ}",
    "caption_frame_indices": f"""SELECT total, n, CASE WHEN total <= 0 OR n <= 0 THEN [] WHEN n = 1 THEN [total // 2] ELSE list_sort(list_distinct(list_transform(range(greatest(n, 2)), lambda i:
  least(CAST(round_even(CAST(i AS DOUBLE) * greatest(total - 1, 1) / greatest(n - 1, 1), 0) AS INTEGER), total - 1)))) END AS at FROM {_SZ}""",
    "polygon_area": f"SELECT l_orderkey, l_linenumber, round({_shoelace('l_quantity', 'l_discount * 100', 'l_tax * 100', 'l_linenumber')}, 6) AS area FROM lineitem",
    "text_area_ratio": f"""SELECT clip_id, round(CASE WHEN width > 0 AND height > 0 THEN {_AREAS} / (CAST(width AS DOUBLE) * height) ELSE 0.0 END, 9)::DOUBLE AS ratio FROM (SELECT *, clip_id % 17 AS k FROM clip_results)""",
    "fit_within": """SELECT width, height, CASE WHEN m > 512 THEN greatest(CAST(trunc(width * (512.0::DOUBLE / m)) AS INTEGER), 1) ELSE width END AS w, CASE WHEN m > 512 THEN greatest(CAST(trunc(height * (512.0::DOUBLE / m)) AS INTEGER), 1) ELSE height END AS h
  FROM (SELECT DISTINCT width, height, greatest(width, height) AS m FROM clip_results WHERE width IS NOT NULL AND height IS NOT NULL)""",
    "dedup_first": f"SELECT path AS video_path, caption AS text, caption_id, provider FROM {_FIRST} WHERE rn = 1",
    "limit_after_dedup": f"SELECT caption_id, path AS video_path FROM {_FIRST} WHERE rn = 1 ORDER BY caption_id LIMIT 500",
    "resume_anti_join": """SELECT caption_id, path AS video_path, caption AS text, provider FROM clip_captions a WHERE NOT EXISTS (SELECT 1 FROM clip_captions b WHERE b.caption_error IS NOT NULL AND a.path = b.path
  AND a.caption IS NOT DISTINCT FROM b.caption)""",
    "extras_left_join": "SELECT clip_id, coalesce(s, shard) AS shard, keep, caption FROM clip_results r LEFT JOIN (SELECT path, max(caption) AS caption, max(shard) AS s FROM clip_captions GROUP BY path) c ON c.path = r.source_path",
    "state_upsert": f"""SELECT coalesce(s.shard, n.shard) AS shard, CASE WHEN n.shard IS NOT NULL THEN true ELSE coalesce(downloaded, false) END AS downloaded, coalesce(scored, false) AS scored, coalesce(stage, 'pending') AS stage
  FROM {_ST} s FULL JOIN (SELECT DISTINCT shard FROM clip_results WHERE shard IS NOT NULL UNION SELECT 'zz_new.zip') n ON s.shard = n.shard""",
    "manifest_json_meta": "SELECT '/data/' || source_path AS video_path, CAST(length(text) AS INTEGER) AS text_len, CASE WHEN n_chars IS NOT NULL THEN 'int' END AS kind, CAST(n_chars AS DOUBLE) AS number, lang FROM documents WHERE source_path IS NOT NULL",
    "flag_totals": f"SELECT count(*) AS shards, {_FLAGS} FROM {_ST}",
    "stage_counts": f"SELECT stage, shards, CAST(row_number() OVER (ORDER BY shards DESC, stage) AS INTEGER) AS place FROM (SELECT stage, count(*) AS shards FROM {_ST} GROUP BY stage)",
    "oldest_active_topk": f"SELECT shard, stage, saved_at FROM {_ST} WHERE NOT coalesce(uploaded, false) AND stage NOT IN ('uploaded', 'processed') ORDER BY saved_at, shard LIMIT 5",
    "oldest_active_per_config": f"SELECT config, shard, saved_at FROM (SELECT split_part(shard, '_', 1) AS config, shard, saved_at, row_number() OVER (PARTITION BY split_part(shard, '_', 1) ORDER BY saved_at, shard) AS p FROM {_ST} WHERE NOT coalesce(uploaded, false) AND stage NOT IN ('uploaded', 'processed')) WHERE p = 1",
    "avg_shard_duration": f"SELECT stage, count(*) AS finished, round(avg({_DUR}), 3) AS avg_seconds FROM {_ST} WHERE finished_at IS NOT NULL GROUP BY stage",
    "config_progress": f"SELECT regexp_extract(n.shard, '(\\d)\\.', 1) AS config, count(*) AS shards, {_FLAGS} FROM (SELECT DISTINCT shard FROM clip_results WHERE shard IS NOT NULL UNION SELECT 'none_000001.zip') n LEFT JOIN {_ST} s ON s.shard = n.shard GROUP BY 1",
    "summary_rollup": f"SELECT grp, stage, count(*) AS shards, CAST(grouping(grp, stage) AS INTEGER) AS level FROM (SELECT split_part(shard, '_', 1) AS grp, stage FROM {_ST}) GROUP BY ROLLUP (grp, stage)",
    "intersect_scored": f"SELECT shard FROM clip_results INTERSECT SELECT shard FROM {_ST} WHERE scored",
    "except_uploaded": f"SELECT shard FROM {_ST} EXCEPT SELECT shard FROM {_ST} WHERE uploaded",
    "missing_top20": f"SELECT shard FROM (SELECT shard FROM {_ST} EXCEPT SELECT shard FROM run_ledger) ORDER BY shard LIMIT 20",
    "snapshot_rates": """SELECT shard, done, round(CASE WHEN secs - p > 0 THEN (done - q) * 60.0 / (secs - p) END, 4) + 0.0 AS per_minute FROM (SELECT *, lag(secs) OVER w AS p, lag(done) OVER w AS q FROM (
  SELECT DISTINCT shard, save_seq, epoch_us(saved_at) / 1e6 AS secs, progress.videos_done AS done FROM shard_state WHERE progress.videos_done IS NOT NULL) WINDOW w AS (PARTITION BY shard ORDER BY secs))""",
    "status_lines": f"""SELECT concat_ws('; ', concat_ws(' ', shard, stage), CASE WHEN progress.videos_total > 0 THEN 'videos ' || progress.videos_done || '/' || progress.videos_total END,
  CASE WHEN progress.queue_pending > 0 THEN 'queue ' || progress.queue_pending END, progress.last_video, 'age ' || CASE WHEN s < 60 THEN CAST(floor(s) AS INTEGER) || 's' WHEN s < 3600 THEN CAST(floor(s / 60) AS INTEGER) || 'm' ELSE printf('%.1fh', s / 3600) END) AS line
  FROM (SELECT *, {NOW} - started_at AS s FROM {_ST} WHERE NOT coalesce(uploaded, false) AND stage NOT IN ('uploaded', 'processed'))""",
    "age_format": f"SELECT shard, CASE WHEN s < 60 THEN CAST(floor(s) AS INTEGER) || 's' WHEN s < 3600 THEN CAST(floor(s / 60) AS INTEGER) || 'm' ELSE printf('%.1fh', s / 3600) END AS age FROM (SELECT shard, {_DUR} AS s FROM {_ST} WHERE finished_at IS NOT NULL)",
    "upload_outcomes": f"SELECT CASE WHEN coalesce(uploaded, false) THEN 'skipped' WHEN o.shard IS NULL THEN 'missing' ELSE 'uploaded' END AS outcome, count(*) AS shards FROM {_ST} s LEFT JOIN (SELECT DISTINCT shard FROM clip_results WHERE output_path IS NOT NULL) o ON o.shard = s.shard GROUP BY 1",
    "upload_manifest_bytes": """SELECT split_part(p, '/', 1) AS folder, count(*) AS files, CAST(sum(b) AS BIGINT) AS bytes FROM (SELECT p, b FROM (SELECT DISTINCT substr(output_path, 8) AS p, size_bytes AS b FROM clip_results WHERE output_path IS NOT NULL) WHERE regexp_full_match(p, '[^/]*/videos/[^/]*\\.mp4')
  UNION ALL SELECT p, b FROM (SELECT DISTINCT substr(output_path, 8) AS p, size_bytes AS b FROM clip_results WHERE output_path IS NOT NULL) WHERE p LIKE '%\\_scene\\_0001.mp4' ESCAPE '\\') GROUP BY 1""",
    "run_counts": "SELECT status, count(*) AS runs, round(sum(duration_sec), 3) AS seconds FROM (SELECT DISTINCT run_id, status, duration_sec FROM run_log) GROUP BY status",
    "checks_all_ok": "SELECT bool_and(status <> 'failed') AS all_ok, count(*) FILTER (status <> 'failed') AS passed, count(*) AS total FROM run_log",
    "failed_workers": "SELECT count(*) FILTER (status <> 'success') AS failed FROM run_log",
    "summary_totals": f"SELECT count(*) AS summarised, round(avg(t), 3) AS avg_time, CAST(sum(c) AS BIGINT) AS clips FROM {_ST} s JOIN (SELECT shard, count(*) AS c, CAST(sum(total_frames) AS DOUBLE) AS t FROM clip_results WHERE shard IS NOT NULL GROUP BY shard) r ON r.shard = s.shard WHERE scored",
    "next_actions": f"""SELECT CASE WHEN u THEN 'skip' ELSE coalesce(a, 'upload') END AS action, coalesce(a, 'skip') AS without_upload, count(*) AS shards FROM (SELECT coalesce(uploaded, false) AS u,
  CASE WHEN NOT coalesce(downloaded, false) THEN 'download' WHEN NOT coalesce(extracted, false) THEN 'extract' WHEN NOT coalesce(scored, false) THEN 'process' END AS a FROM {_ST}) GROUP BY ALL""",
    "stage_timings": "SELECT shard, CAST(sum(total_frames) AS BIGINT) AS time_scene, CAST(sum(num_windows) AS BIGINT) AS time_score FROM clip_results GROUP BY shard",
    "split_even": "SELECT shard, CAST((row_number() OVER (ORDER BY shard) - 1) // CAST(ceil(count(*) OVER () / 7.0) AS BIGINT) AS INTEGER) AS chunk FROM (SELECT DISTINCT shard FROM shard_state)",
    "split_ntile": "SELECT shard, CAST(ntile(7) OVER (ORDER BY shard) - 1 AS INTEGER) AS chunk FROM (SELECT DISTINCT shard FROM shard_state)",
    "gpu_round_robin": "SELECT CAST(chunk % 3 AS INTEGER) AS gpu, count(*) AS shards FROM (SELECT (row_number() OVER (ORDER BY shard) - 1) // CAST(ceil(count(*) OVER () / 7.0) AS BIGINT) AS chunk FROM (SELECT DISTINCT shard FROM shard_state)) GROUP BY 1",
    "parse_chat_completion": f"SELECT caption_id, nullif({_BLANK.format('c')}, '') AS content FROM (SELECT caption_id, CASE WHEN caption_id % 3 = 0 THEN concat_ws(chr(10), caption, 'end') ELSE caption END AS c FROM (SELECT DISTINCT caption_id, caption FROM clip_captions))",
    "parse_generic_response": f"""SELECT caption_id, nullif({_BLANK.format("CASE WHEN caption_id % 4 = 3 THEN '~' || caption WHEN caption IS NULL AND caption_id % 4 < 2 THEN '7' ELSE caption END")}, '') AS content FROM (SELECT DISTINCT caption_id, caption FROM clip_captions)""",
    "caption_fallback": f"""SELECT caption_id, CASE WHEN ve IS NOT NULL OR v IS NULL THEN NULL WHEN re IS NOT NULL THEN v ELSE coalesce(r, v) END AS caption, CASE WHEN ve IS NULL THEN v END AS caption_visual,
  CASE WHEN ve IS NOT NULL THEN 'visual_failed:' || ve WHEN v IS NULL THEN 'rewrite_skipped:visual_caption_missing' WHEN re IS NOT NULL THEN 'rewrite_failed:' || re WHEN r IS NULL THEN 'rewrite_empty_fallback_visual' END AS caption_error
  FROM (SELECT caption_id, nullif({_BLANK.format('caption_visual')}, '') AS v, CASE WHEN k = 'visual_failed' THEN e END AS ve, CASE WHEN k = 'rewrite_failed' THEN e END AS re, CASE WHEN k IS DISTINCT FROM 'rewrite_empty' THEN nullif({_BLANK.format('caption')}, '') END AS r
   FROM (SELECT *, split_part(caption_error, ':', 1) AS k, split_part(caption_error, ':', -1) AS e FROM (SELECT DISTINCT caption_id, caption, caption_visual, caption_error FROM clip_captions)))""",
    "caption_eligible": f"SELECT clip_id FROM (SELECT DISTINCT clip_id, source_path, keep FROM clip_results) r WHERE keep AND NOT EXISTS (SELECT 1 FROM clip_captions c WHERE c.path = r.source_path AND {_BLANK.format('c.caption')} <> '')",
    "caption_errors": "SELECT split_part(caption_error, ':', 1) AS kind, count(*) AS n FROM clip_captions GROUP BY 1",
    "prompt_templates": """SELECT caption_id, CASE WHEN caption_id % 2 = 0 THEN f || ': ' || caption_visual || '!' ELSE 'say {other}' || chr(10) || caption_visual END AS prompt, 'look' || chr(10) || '文件名: ' || f AS with_name
  FROM (SELECT DISTINCT caption_id, caption_visual, split_part(path, '/', -1) AS f FROM clip_captions WHERE caption_visual IS NOT NULL)""",
    "url_normalise": """SELECT n_nationkey, CASE WHEN b LIKE '%/chat/completions' THEN b WHEN b LIKE '%/v1' THEN b || '/chat/completions' ELSE b || '/v1/chat/completions' END AS url
  FROM (SELECT n_nationkey, rtrim('http://' || lower(n_name) || ['', '/', '/v1', '/v1//', '/v1/chat/completions', '/x'][n_nationkey % 6 + 1], '/') AS b FROM nation)""",
    "placeholder_clean": "SELECT c_custkey, CASE WHEN c_custkey % 3 = 2 THEN c_name END AS value FROM customer",
    "output_names": """SELECT clip_id, CASE WHEN clip_id < 100000000 THEN lpad(CAST(clip_id AS VARCHAR), 8, '0') ELSE CAST(clip_id AS VARCHAR) END || '_' || f AS name, regexp_replace(f, '\\.[^.]+$', '') AS stem, lower(regexp_extract(f, '(\\.[^.]+)$', 1)) AS suffix,
  regexp_replace(f, '\\.[^.]+$', '') || '_scene_' || lpad(CAST(clip_id % 100 AS VARCHAR), 4, '0') || regexp_extract(f, '(\\.[^.]+)$', 1) AS scene FROM (SELECT DISTINCT clip_id, split_part(source_path, '/', -1) AS f FROM clip_results)""",
    "meta_key_normalise": r"""SELECT p_partkey, CASE WHEN regexp_matches(k, '^\d') THEN 'v_' || k ELSE k END AS name FROM (SELECT p_partkey, regexp_replace(trim(CASE WHEN p_partkey % 3 = 0 THEN CAST(p_size AS VARCHAR) ELSE ' ' END || p_brand || ' / ' || p_type), '\W+', '_', 'g') AS k FROM part)""",
    "devices": r"SELECT name, regexp_extract(device, '^([a-z]+)', 1) AS kind, coalesce(TRY_CAST(regexp_extract(device, ':(\d+)$', 1) AS INTEGER), 0) AS index FROM score_models",
}
