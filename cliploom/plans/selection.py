"""Queries of scoring and selection over the scored-clip and document tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cliploom import edge
from cliploom.functions import kernels
from cliploom.operators import calibrate, frames, scenes, select
from cliploom.session import table
from cliploom.sinks import metadata
from cliploom.sources import manifests

NAMES = ["dover", "dover_tech", "aes", "motion"]
CHAIN = "0.2 < dover <= 0.9 and not (aes < 4 or motion % 7 > 5) or -dover_tech / dover_tech == -1 and dover + 0.5 > 1"
META = "n_chars > 300 and (has_text and text_len >= n_chars or meta_rating > 3)"


def _thresholds(spark: SparkSession, d: str, names: list[str] | None = None) -> dict[str, float]:
    rows = table(spark, d, "score_models").select("name", "threshold").collect()  # configuration
    return {r["name"]: r["threshold"] for r in rows if names is None or r["name"] in names}


def _decided(spark: SparkSession, d: str, strategy: str | None = None) -> DataFrame:
    reason = select.score_reason(F.col("scores"), _thresholds(spark, d), strategy)
    return select.decide(table(spark, d, "clip_results").drop("reason", "keep"), reason)


def select_thresholds(spark: SparkSession, d: str) -> DataFrame:
    return _decided(spark, d).select("clip_id", "keep", "reason")


def select_strategy(spark: SparkSession, d: str) -> DataFrame:
    return _decided(spark, d, "motion >= motion_thr and (aes >= aes_thr or dover_tech > 0)").select("clip_id", "keep", "reason")


def strategy_chain_compare(spark: SparkSession, d: str) -> DataFrame:
    return _decided(spark, d, CHAIN).select("clip_id", "keep", "reason")


def strategy_missing_meta(spark: SparkSession, d: str) -> DataFrame:
    """Documents as records: text and meta, of which rating exists for none, so it fails where it is reached."""
    docs = table(spark, d, "documents")
    meta = F.map_filter(F.create_map(F.lit("n chars"), F.col("n_chars").cast("string"), F.lit("lang"), F.col("lang")), lambda k, v: v.isNotNull())
    scored = docs.select("doc_id", "text", meta.alias("meta"), F.create_map(F.lit("sanity"), F.lit(1.0)).alias("scores"))
    reason = select.score_reason(F.col("scores"), {"sanity": 0.0}, META, F.col("text"), F.col("meta"))
    return select.decide(scored, reason).select("doc_id", "keep", "reason")


def no_scorers_keep_all(spark: SparkSession, d: str) -> DataFrame:
    clips = table(spark, d, "clip_results").select("clip_id", F.create_map().cast("map<string,double>").alias("scores"))
    return select.decide(clips, select.score_reason(F.col("scores"), {})).groupBy("keep").agg(F.count(F.lit(1)).alias("clips"))


def reason_histogram(spark: SparkSession, d: str) -> DataFrame:
    return select.reason_histogram(_decided(spark, d), ["shard"])


def recorded_reasons(spark: SparkSession, d: str) -> DataFrame:
    """The reasons that the table itself records; dropped clips without one count as filtered."""
    return select.reason_histogram(table(spark, d, "clip_results"))


def invalid_scores(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "clip_results").where(select.any_invalid(F.col("scores"))).select("clip_id")


def _funnelled(spark: SparkSession, d: str, record_only: bool) -> DataFrame:
    clips = table(spark, d, "clip_results").drop("reason", "keep")
    scored = select.score_reason(F.col("scores"), _thresholds(spark, d, ["dover", "aes"]))
    reason = select.drop_reason(scored, split_failed=F.col("total_frames") < 60, flash_hit=F.col("flash_hit"), ocr_hit=F.col("ocr_hit"), record_only=record_only, source_exists=F.col("size_bytes") > 0)
    return select.decide(clips, reason)


def funnel_counts(spark: SparkSession, d: str) -> DataFrame:
    return select.funnel(_funnelled(spark, d, False), ["shard"])


def flash_record_only(spark: SparkSession, d: str) -> DataFrame:
    """Hits recorded but not dropped: outcome by recorded hits."""
    done = _funnelled(spark, d, True)
    return done.groupBy("flash_hit", "ocr_hit", "keep").agg(F.count(F.lit(1)).alias("clips"))


def fused_score(spark: SparkSession, d: str) -> DataFrame:
    s = lambda n: F.try_element_at("scores", F.lit(n))
    clips = table(spark, d, "clip_results").select("clip_id", s("dover_tech").alias("t"), s("dover").alias("a"))
    return clips.select("clip_id", (F.round(kernels.fused(F.col("t"), F.col("a")), 6) + F.lit(0.0)).alias("fused"))


def branch_outputs(spark: SparkSession, d: str) -> DataFrame:
    """Mean score of each dover model's output mode."""
    s = lambda n: F.nanvl(F.try_element_at("scores", F.lit(n)), F.lit(None).cast("double"))
    models = table(spark, d, "score_models").where("kind = 'dover'").select("name", F.col("extra")["output"].alias("mode"))
    clips = table(spark, d, "clip_results").select(s("dover_tech").alias("t"), s("dover").alias("a"))
    got = clips.crossJoin(F.broadcast(models)).select("name", kernels.branch_output(F.col("mode"), F.col("t"), F.col("a")).alias("v"))
    return got.groupBy("name").agg(F.count("v").alias("n"), F.round(F.avg("v"), 6).alias("mean"))


HEAD = [((i * 7) % 11 - 5) / 10 for i in range(64)]


def linear_head_score(spark: SparkSession, d: str) -> DataFrame:
    """Mean head score of a clip's embeddings; the label stands for the clip."""
    e = table(spark, d, "embeddings").select("label", kernels.linear_head(F.col("embedding"), HEAD, 0.25).alias("s"))
    return e.groupBy("label").agg(F.round(F.coalesce(F.avg("s"), F.lit(0.0)), 6).alias("score"))


def flow_magnitude(spark: SparkSession, d: str) -> DataFrame:
    """Both halves of an embedding as the two components of a flow field."""
    u, v = F.slice("embedding", 1, 32), F.slice("embedding", 33, 32)
    return table(spark, d, "embeddings").select("vec_id", F.round(kernels.flow_magnitude(u, v), 6).alias("magnitude"))


def calibration_quantiles(spark: SparkSession, d: str) -> DataFrame:
    got = calibrate.quantiles(table(spark, d, "clip_results"), [0.1, 0.4, 0.5, 0.7, 0.95])
    return got.select("name", "q", F.round("value", 6).alias("value"))


def calibration_cap(spark: SparkSession, d: str) -> DataFrame:
    """Mean over the first rows of all shards together."""
    once = table(spark, d, "clip_results").select("source_path", "scored_at", "scores", "size_bytes")
    rows = calibrate.capped(once, ["source_path", "scored_at", "size_bytes"], 3000)
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("size_bytes").alias("size_bytes"))


def calibration_wide(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "clip_results")
    names = calibrate.score_names(rows)
    wide = calibrate.wide_scores(rows, names, ["shard"])
    return wide.groupBy("shard").agg(*[F.count(n).alias(f"n_{n}") for n in names])


GRID = {"dover": [0.3, 0.4, 0.5, 0.6], "aes": [4.0, 4.5, 5.0], "motion": [20.0, 36.0, 60.0, 90.0]}


def threshold_grid(spark: SparkSession, d: str) -> DataFrame:
    got = calibrate.threshold_grid(table(spark, d, "clip_results"), GRID, "keep")
    return got.withColumns({"prec": F.round("prec", 9), "rec": F.round("rec", 9)})


def top_thresholds(spark: SparkSession, d: str) -> DataFrame:
    got = calibrate.threshold_grid(table(spark, d, "clip_results"), GRID, "keep")
    return calibrate.best_thresholds(got, list(GRID), 10).select(*GRID, "tp", "fp", "fn", "place")


def luma_frames(spark: SparkSession, d: str) -> DataFrame:
    """Events of a user as the frames of a video: value as brightness, numbered in order."""
    e = table(spark, d, "events")
    place = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1
    return e.select(F.col("user_id").cast("string").alias("path"), place.alias("frame_idx"), F.col("value").alias("mean_luma"))


def flash_filter(spark: SparkSession, d: str) -> DataFrame:
    got = frames.flash(luma_frames(spark, d), 2, 60.0, 0.3)
    return got.select("path", "n_samples", "n_events", F.round("flash_ratio", 9).alias("flash_ratio"), "flash_hit")


def text_area_any(spark: SparkSession, d: str) -> DataFrame:
    rows = luma_frames(spark, d).withColumn("text_ratio", F.col("mean_luma") / 20000)
    return frames.text_hit(rows, 3, 0.012)


def frame_diff_normalised(spark: SparkSession, d: str) -> DataFrame:
    got = frames.differences(luma_frames(spark, d), "mean_luma", 16)
    return got.select("path", "frame_idx", F.round("diff", 6).alias("diff"))


def boundary_spans(spark: SparkSession, d: str) -> DataFrame:
    rows = luma_frames(spark, d)
    videos = rows.groupBy("path").agg((F.max("frame_idx") + 1).alias("total_frames")).withColumn("fps", F.lit(25.0))
    spans = frames.boundary_spans(rows, videos, 120.0, "mean_luma")
    return spans.select("path", "span_idx", F.round("start", 6).alias("start"), F.round("end", 6).alias("end"))


def adaptive_ratio(spark: SparkSession, d: str) -> DataFrame:
    got = frames.neighbour_ratio(luma_frames(spark, d), "mean_luma", 2)
    return got.select("path", "frame_idx", F.round("ratio", 6).alias("ratio"))


def adaptive_cuts(spark: SparkSession, d: str) -> DataFrame:
    ratios = frames.neighbour_ratio(luma_frames(spark, d), "mean_luma", 2)
    return frames.adaptive_cuts(ratios, 2.0, 5)


def _videos(rows: DataFrame) -> DataFrame:
    return rows.groupBy("path").agg((F.max("frame_idx") + 1).alias("total_frames")).withColumn("fps", F.lit(25.0))


def scene_spans_adaptive(spark: SparkSession, d: str) -> DataFrame:
    rows = luma_frames(spark, d)
    return scenes.scene_spans(rows, _videos(rows), "pyscenedetect", 2.0, 5, content="mean_luma")


def scene_spans_differences(spark: SparkSession, d: str) -> DataFrame:
    """Without boundary scores, spans come from normalised frame differences."""
    rows = luma_frames(spark, d)
    spans = scenes.scene_spans(rows, _videos(rows), "transnet", 0.6)
    return spans.select("path", "span_idx", F.round("start", 6).alias("start"), F.round("end", 6).alias("end"))


def offline_existence(spark: SparkSession, d: str) -> DataFrame:
    """Clips as decided records whose sources are a table's own file for every third clip and otherwise aren't there."""
    clips = table(spark, d, "clip_results").select(F.col("clip_id").alias("index"), "keep", "reason").distinct()
    path = F.when(F.col("index") % 3 == 0, f"{d}/../{d.rstrip('/').rsplit('/', 1)[-1]}/./keep_targets.parquet").otherwise(F.concat(F.lit(f"{d}/gone_"), F.col("index").cast("string")))
    rows = clips.withColumn("source_path", manifests.collapsed(path))
    found = rows.where("keep").select(F.col("source_path").alias("path")).distinct().where(edge.exists("path"))
    return metadata.offline_rows(rows, found).select("index", "keep", "reason", F.col("output_path").isNotNull().alias("has_output"))


QUERIES = {
    f.__name__: f
    for f in (
        select_thresholds, select_strategy, strategy_chain_compare, strategy_missing_meta, no_scorers_keep_all, reason_histogram,
        recorded_reasons, invalid_scores, funnel_counts, flash_record_only, fused_score, branch_outputs, linear_head_score,
        flow_magnitude, calibration_quantiles, calibration_cap, calibration_wide, threshold_grid, top_thresholds, flash_filter,
        text_area_any, frame_diff_normalised, boundary_spans, adaptive_ratio, adaptive_cuts, scene_spans_adaptive,
        scene_spans_differences, offline_existence,
    )
}

_S = "SELECT r.*, " + ", ".join(f"scores['{n}'] AS {n}" for n in ["sanity", *NAMES]) + " FROM clip_results r"
_BAD = " OR ".join(f"{n} IS NULL OR isnan({n})" for n in ["sanity", *NAMES])
_T = "SELECT " + ", ".join(f"max(threshold) FILTER (name = '{n}') AS {n}_thr" for n in ["sanity", *NAMES]) + " FROM score_models"
_LOW = " OR ".join(f"{n} < {n}_thr" for n in ["sanity", *NAMES])
_REASON = f"CASE WHEN {_BAD} THEN 'scoring_error' WHEN {_LOW} THEN 'score_below_threshold' END"
_BY_STRATEGY = "SELECT clip_id, reason IS NULL AS keep, reason FROM (SELECT clip_id, CASE WHEN {bad} THEN 'scoring_error' {more} END AS reason FROM ({s}), ({t}))"
_MOD = "(motion % 7)"
_CHAIN_SQL = f"(0.2 < dover AND dover <= 0.9 AND NOT (aes < 4 OR (CASE WHEN isinf(motion) THEN false ELSE {_MOD} > 5 END))) "
_FUNNEL = f"""SELECT *, reason IS NULL AS k FROM (SELECT *, CASE WHEN total_frames < 60 THEN 'split_failed' {{drop}}
  WHEN dover IS NULL OR isnan(dover) OR aes IS NULL OR isnan(aes) THEN 'scoring_error' WHEN dover < dover_thr OR aes < aes_thr THEN 'score_below_threshold'
  WHEN NOT coalesce(size_bytes > 0, false) THEN 'source_missing' END AS reason FROM (SELECT * EXCLUDE (reason, keep) FROM ({_S})), ({_T}))"""
_FR = "SELECT CAST(user_id AS VARCHAR) AS path, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS INTEGER) AS frame_idx, value AS mean_luma FROM events"
_CONF = "SELECT " + ", ".join(
    f"count(*) FILTER (said AND keep) AS tp, count(*) FILTER (said AND NOT keep) AS fp, count(*) FILTER (NOT said AND keep) AS fn" for _ in range(1)
)
_GRID = f"""SELECT dover, aes, motion, tp, fp, fn, tp / (tp + fp + 1e-9) AS prec, tp / (tp + fn + 1e-9) AS rec FROM (
  {_CONF}, g.dover, g.aes, g.motion FROM (SELECT keep, d.v AS dover, a.v AS aes, m.v AS motion,
     coalesce(sd, -1) >= d.v AND NOT coalesce(isnan(sd), false) AND coalesce(sa, -1) >= a.v AND NOT coalesce(isnan(sa), false)
     AND coalesce(sm, -1) >= m.v AND NOT coalesce(isnan(sm), false) AS said
   FROM (SELECT keep, scores['dover'] AS sd, scores['aes'] AS sa, scores['motion'] AS sm FROM clip_results WHERE keep IS NOT NULL),
   (VALUES {', '.join(f'({x})' for x in GRID['dover'])}) d(v), (VALUES {', '.join(f'({x})' for x in GRID['aes'])}) a(v), (VALUES {', '.join(f'({x})' for x in GRID['motion'])}) m(v)) g
  GROUP BY g.dover, g.aes, g.motion)"""
_D = "CAST({} AS DOUBLE) AS {}"
_SIG = "1 / (1 + exp(-((t - 0.1107) / 0.07355 * 0.6104 + (a + 0.08285) / 0.03774 * 0.3896)))"

# Ratios of frames, the hits among them, and cuts one after the other, each at least five frames after the last.
_CUTS = f"""WITH RECURSIVE f AS ({_FR}), q AS (SELECT path, frame_idx, CASE WHEN m > 1e-5 THEN least(c / m, 255.0) WHEN c >= 15 THEN 255.0 ELSE 0.0 END AS ratio FROM (SELECT path, frame_idx, mean_luma AS c,
  CASE WHEN count(*) OVER w > 1 THEN (sum(mean_luma) OVER w - mean_luma) / (count(*) OVER w - 1) END AS m FROM f WINDOW w AS (PARTITION BY path ORDER BY frame_idx ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING))),
  hits AS (SELECT path, list(frame_idx ORDER BY frame_idx) AS l FROM q WHERE ratio >= 2.0 GROUP BY path),
  cuts AS (SELECT path, l, list_filter(l, lambda x: x >= 5)[1] AS pos FROM hits UNION ALL SELECT path, l, list_filter(l, lambda x: x >= pos + 5)[1] FROM cuts WHERE pos IS NOT NULL)
"""

ORACLE = {
    "adaptive_cuts": _CUTS + "SELECT path, CAST(pos AS BIGINT) AS frame_idx FROM cuts WHERE pos IS NOT NULL",
    "scene_spans_adaptive": _CUTS + """, n AS (SELECT path, max(frame_idx) AS stop FROM f GROUP BY path),
  e AS (SELECT path, pos FROM cuts WHERE pos IS NOT NULL UNION SELECT path, stop FROM n),
  s AS (SELECT path, pos, row_number() OVER w - 1 AS i, coalesce(lag(pos) OVER w, 0) AS a, lead(pos) OVER w IS NULL AS final FROM e WINDOW w AS (PARTITION BY path ORDER BY pos))
  SELECT path, CAST(i AS INTEGER) AS span_idx, round(a / 25.0, 6) AS start, round(CASE WHEN final THEN (n.stop + 1) / 25.0 ELSE pos / 25.0 END, 6) AS "end" FROM s JOIN n USING (path)""",
    "offline_existence": """SELECT clip_id AS index, keep AND clip_id % 3 = 0 AS keep, CASE WHEN keep AND clip_id % 3 <> 0 THEN 'source_missing' ELSE reason END AS reason, keep AND clip_id % 3 = 0 AS has_output
  FROM (SELECT DISTINCT clip_id, keep, reason FROM clip_results)""",
    "select_thresholds": f"SELECT clip_id, reason IS NULL AS keep, reason FROM (SELECT clip_id, {_REASON} AS reason FROM ({_S}), ({_T}))",
    "select_strategy": _BY_STRATEGY.format(bad=_BAD, s=_S, t=_T, more="WHEN NOT (motion >= motion_thr AND (aes >= aes_thr OR dover_tech > 0)) THEN 'strategy_filtered'"),
    "strategy_chain_compare": _BY_STRATEGY.format(bad=_BAD, s=_S, t=_T, more=f"WHEN {_CHAIN_SQL} THEN NULL WHEN dover_tech = 0 THEN 'strategy_error' WHEN -dover_tech / dover_tech = -1 AND dover + 0.5 > 1 THEN NULL ELSE 'strategy_filtered'"),
    "strategy_missing_meta": """SELECT doc_id, reason IS NULL AS keep, reason FROM (SELECT doc_id, CASE WHEN n_chars IS NULL THEN 'strategy_error' WHEN n_chars <= 300 THEN 'strategy_filtered'
  WHEN length(coalesce(text, '')) > 0 AND length(text) >= n_chars THEN NULL ELSE 'strategy_error' END AS reason FROM documents)""",
    "no_scorers_keep_all": "SELECT true AS keep, count(*) AS clips FROM clip_results",
    "reason_histogram": f"SELECT shard, coalesce(reason, 'kept') AS outcome, count(*) AS clips FROM (SELECT shard, {_REASON} AS reason FROM ({_S}), ({_T})) GROUP BY ALL",
    "recorded_reasons": "SELECT CASE WHEN keep THEN 'kept' ELSE coalesce(reason, 'filtered') END AS outcome, count(*) AS clips FROM clip_results GROUP BY ALL",
    "invalid_scores": "SELECT clip_id FROM clip_results WHERE len(list_filter(map_values(scores), lambda v: v IS NULL OR isnan(v))) > 0",
    "funnel_counts": f"""SELECT shard, count(*) AS files, count(*) FILTER (r NOT IN ('split_failed')) AS clips_after_scene, count(*) FILTER (r NOT IN ('split_failed', 'flash')) AS clips_after_flash,
  count(*) FILTER (r NOT IN ('split_failed', 'flash', 'ocr_text')) AS clips_after_ocr, count(*) FILTER (r NOT IN ('split_failed', 'flash', 'ocr_text')) AS clips_scored, count(*) FILTER (k) AS clips_kept
  FROM (SELECT shard, k, coalesce(reason, '') AS r FROM ({_FUNNEL.format(drop="WHEN flash_hit THEN 'flash' WHEN ocr_hit THEN 'ocr_text'")})) GROUP BY ALL""",
    "flash_record_only": f"SELECT flash_hit, ocr_hit, k AS keep, count(*) AS clips FROM ({_FUNNEL.format(drop='')}) GROUP BY ALL",
    "fused_score": f"SELECT clip_id, round(CASE WHEN t IS NULL THEN a WHEN a IS NULL THEN t ELSE {_SIG} END, 6) + 0.0 AS fused FROM (SELECT clip_id, scores['dover_tech'] AS t, scores['dover'] AS a FROM clip_results)",
    "branch_outputs": f"""SELECT name, count(v) AS n, round(avg(v), 6) AS mean FROM (SELECT name, CASE WHEN mode = 'technical' THEN coalesce(t, a) WHEN mode = 'aesthetic' THEN coalesce(a, t)
  WHEN t IS NULL THEN a WHEN a IS NULL THEN t ELSE {_SIG} END AS v FROM (SELECT CASE WHEN NOT isnan(scores['dover_tech']) THEN scores['dover_tech'] END AS t, CASE WHEN NOT isnan(scores['dover']) THEN scores['dover'] END AS a FROM clip_results),
  (SELECT name, extra['output'] AS mode FROM score_models WHERE kind = 'dover')) GROUP BY ALL""",
    "linear_head_score": f"""SELECT label, round(coalesce(avg(s), 0.0), 6) AS score FROM (SELECT label, list_sum(list_transform(range(1, 65), lambda i: CAST(embedding[i] AS DOUBLE) * ({HEAD})[i])) / n + 0.25 AS s
  FROM (SELECT label, embedding, sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))) AS n FROM embeddings)) GROUP BY ALL""",
    "flow_magnitude": "SELECT vec_id, round(list_avg(list_transform(range(1, 33), lambda i: sqrt(CAST(embedding[i] AS DOUBLE) * embedding[i] + CAST(embedding[i + 32] AS DOUBLE) * embedding[i + 32]))), 6) AS magnitude FROM embeddings",
    "calibration_quantiles": """SELECT name, q, round(value, 6) AS value FROM (SELECT x.key AS name, unnest([0.1, 0.4, 0.5, 0.7, 0.95]::DOUBLE[]) AS q, unnest(quantile_cont(x.value, [0.1, 0.4, 0.5, 0.7, 0.95])) AS value
  FROM (SELECT unnest(map_entries(scores)) AS x FROM clip_results) WHERE x.value IS NOT NULL AND NOT isnan(x.value) GROUP BY x.key)""",
    "calibration_cap": "SELECT count(*) AS n_rows, CAST(sum(size_bytes) AS BIGINT) AS size_bytes FROM (SELECT size_bytes FROM clip_results WHERE scores IS NOT NULL ORDER BY source_path, scored_at, size_bytes LIMIT 3000)",
    "calibration_wide": "SELECT shard, " + ", ".join(f"count(scores['{n}']) AS n_{n}" for n in ["sanity", *NAMES]) + " FROM clip_results GROUP BY shard",
    "threshold_grid": f"SELECT {', '.join(_D.format(n, n) for n in GRID)}, tp, fp, fn, round(prec, 9) AS prec, round(rec, 9) AS rec FROM ({_GRID})",
    "top_thresholds": f"SELECT {', '.join(_D.format(n, n) for n in GRID)}, tp, fp, fn, CAST(row_number() OVER (ORDER BY rec DESC, prec DESC, dover, aes, motion) AS INTEGER) AS place FROM ({_GRID}) QUALIFY place <= 10",
    "flash_filter": f"""SELECT path, count(*) AS n_samples, count(*) FILTER (abs(v - p) >= 60) AS n_events, round(count(*) FILTER (abs(v - p) >= 60) / count(*), 9) AS flash_ratio,
  count(*) FILTER (abs(v - p) >= 60) / count(*) >= 0.3 AS flash_hit FROM (SELECT path, mean_luma AS v, lag(mean_luma) OVER (PARTITION BY path ORDER BY frame_idx) AS p FROM ({_FR}) WHERE frame_idx % 2 = 0) GROUP BY path""",
    "text_area_any": f"SELECT path, bool_or(mean_luma / 20000 >= 0.012) AS ocr_hit FROM ({_FR}) WHERE frame_idx % 3 = 0 GROUP BY path",
    "frame_diff_normalised": f"""SELECT path, frame_idx, round(raw / (max(raw) OVER (PARTITION BY path, frame_idx // 16) + 1e-6), 6) AS diff FROM (
  SELECT path, frame_idx, coalesce(abs(mean_luma - lag(mean_luma) OVER (PARTITION BY path, frame_idx // 16 ORDER BY frame_idx)), 0.0) AS raw FROM ({_FR}))""",
    "boundary_spans": f"""WITH f AS ({_FR}), n AS (SELECT path, max(frame_idx) AS stop FROM f GROUP BY path),
  e AS (SELECT path, frame_idx AS pos FROM f WHERE mean_luma >= 120 AND frame_idx > 0 UNION SELECT path, stop FROM n)
  SELECT path, CAST(row_number() OVER (PARTITION BY path ORDER BY pos) - 1 AS INTEGER) AS span_idx, round(coalesce(lag(pos) OVER (PARTITION BY path ORDER BY pos), 0) / 25.0, 6) AS start, round(pos / 25.0, 6) AS "end" FROM e""",
    "adaptive_ratio": f"""SELECT path, frame_idx, round(CASE WHEN m > 1e-5 THEN least(c / m, 255.0) WHEN c >= 15 THEN 255.0 ELSE 0.0 END, 6) AS ratio FROM (SELECT path, frame_idx, mean_luma AS c,
  CASE WHEN count(*) OVER w > 1 THEN (sum(mean_luma) OVER w - mean_luma) / (count(*) OVER w - 1) END AS m FROM ({_FR}) WINDOW w AS (PARTITION BY path ORDER BY frame_idx ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING))""",
    "scene_spans_differences": f"""WITH f AS ({_FR}), n AS (SELECT path, max(frame_idx) AS stop FROM f GROUP BY path),
  r AS (SELECT path, frame_idx, coalesce(abs(mean_luma - lag(mean_luma) OVER w), 0.0) AS raw FROM f WINDOW w AS (PARTITION BY path, frame_idx // 1024 ORDER BY frame_idx)),
  e AS (SELECT path, frame_idx AS pos FROM (SELECT *, raw / (max(raw) OVER (PARTITION BY path, frame_idx // 1024) + 1e-6) AS diff FROM r) WHERE diff >= 0.6 AND frame_idx > 0 UNION SELECT path, stop FROM n)
  SELECT path, CAST(row_number() OVER (PARTITION BY path ORDER BY pos) - 1 AS INTEGER) AS span_idx, round(coalesce(lag(pos) OVER (PARTITION BY path ORDER BY pos), 0) / 25.0, 6) AS start, round(pos / 25.0, 6) AS "end" FROM e""",
}
