"""Queries of the training-data problems, with their SQL where SQL can express them."""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cliploom.llm import abuse, clips, cutoffs, packing, quantiles, rank_fusion, tokens, truncation
from cliploom.operators import calibrate
from cliploom.session import shared_dir, table, write_table

TOKENIZER = "byte_bpe_50k"
#: The four scores that p2 ranks clips by.
MODELS = ["dover", "dover_tech", "aes", "motion"]
PERCENTILES = [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]


def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return docs.select("doc_id", tokens.token_ids(spark, F.col("text"), TOKENIZER).alias("ids"))


def _current_and_before(spark: SparkSession, d: str, landed: Column | None) -> tuple[DataFrame, list[str]]:
    """(clip_id, now, before, touched), written once: the current version of each clip; the one before the rows with
    ``landed`` came; whether any of them is the clip's. Without ``landed`` all rows come at once."""
    names = [r["name"] for r in table(spark, d, "keep_targets").select("name").distinct().collect()]  # configuration
    row = F.struct(F.col("scored_at").alias("__at"), "shard", *[clips.score(m).alias(f"s_{m}") for m in names])
    late = F.lit(True) if landed is None else F.coalesce(landed, F.lit(False))
    picked = table(spark, d, "clip_results").select("clip_id", row.alias("row"), late.alias("late"))
    both = picked.groupBy("clip_id").agg(F.max("row").alias("now"), F.max(F.when(~F.col("late"), F.col("row"))).alias("before"), F.bool_or("late").alias("touched"))
    return write_table(both, "current-scores"), names


def _valid(rows: DataFrame, version: str, names: list[str]) -> DataFrame:
    """(source, name, id, value): valid scores of a version by non-null shard."""
    flat = rows.select(F.col("clip_id").alias("id"), F.col(f"{version}.shard").alias("source"), *[F.col(f"{version}.s_{m}").alias(f"s_{m}") for m in names])
    return clips.long_scores(flat.where("source is not null"), ["source", "id"], names)


def _tree_store(spark: SparkSession) -> cutoffs.TreeStore:
    return cutoffs.TreeStore(spark, f"{shared_dir(spark)}/cliploom/cutoffs-{uuid.uuid4().hex}")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    rows, names = _current_and_before(spark, d, None)
    scores, store = _valid(rows, "now", names), _tree_store(spark)
    store.apply(scores)
    _, at = cutoffs.cutoffs(scores, table(spark, d, "keep_targets"), store.tree())
    return at.select(F.col("source").alias("shard"), "name", F.col("id").alias("clip_id"))


def p3_cutoffs(spark: SparkSession, d: str) -> DataFrame:
    """Cutoff and kept size of each shard and model, beside the fixed threshold and what it keeps.

    The tree is stored from the rows landed in the first half of the time and brought up to date by a second batch, in
    which the new versions of clips scored again are counted in and their old ones out.
    """
    half = table(spark, d, "clip_results").agg(F.expr("timestampadd(SECOND, timestampdiff(SECOND, min(landed_at), max(landed_at)) div 2, min(landed_at))").alias("t")).first()["t"]
    rows, names = _current_and_before(spark, d, F.col("landed_at") > F.lit(half) if half else None)
    scores, store = _valid(rows, "now", names), _tree_store(spark)
    store.apply(_valid(rows.where("before is not null"), "before", names))
    store.apply(_valid(rows.where("touched"), "now", names), _valid(rows.where("touched and before is not null"), "before", names))
    cut, _ = cutoffs.cutoffs(scores, table(spark, d, "keep_targets"), store.tree())
    fixed = table(spark, d, "score_models").groupBy("name").agg(F.max("threshold").alias("threshold"))
    passed = scores.join(F.broadcast(fixed), "name").groupBy("source", "name").agg(F.count_if(F.expr("value >= threshold")).alias("kept_by_threshold"))  # a row per model
    got = cut.join(fixed, "name", "left").join(passed, ["source", "name"], "left")
    return got.select(F.col("source").alias("shard"), "name", "n", "target", "cutoff", "kept", "at_cutoff", "threshold", "kept_by_threshold")


def clip_ranking(spark: SparkSession, d: str) -> DataFrame:
    """The ranking of all clips by current versions, the four scores counting alike."""
    rows = clips.current_versions(table(spark, d, "clip_results"), {f"s_{m}": clips.score(m) for m in MODELS})
    return rank_fusion.fuse(write_table(rows, "current-scores"), "clip_id", dict.fromkeys(MODELS, 1.0))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return rank_fusion.best_of(clip_ranking(spark, d), "clip_id", table(spark, d, "review_panels"), "panel_id")


def p2_ranking(spark: SparkSession, d: str) -> DataFrame:
    return clip_ranking(spark, d)


def _version_scores(spark: SparkSession, d: str) -> tuple[DataFrame, list[str]]:
    """Rows (shard, clip_id, scored_at, a column per model) of all versions, and the models: every key of the score maps."""
    rows = table(spark, d, "clip_results")
    names = calibrate.score_names(rows)
    return rows.select("shard", "clip_id", "scored_at", *[clips.score(m).alias(m) for m in names]), names


def p5_percentiles(spark: SparkSession, d: str) -> DataFrame:
    """Percentiles of each shard and model over all scored versions, copies of a row counting once."""
    rows, names = _version_scores(spark, d)
    summaries = quantiles.grouped_summaries(rows, "shard", names, ["clip_id", "scored_at"])
    return quantiles.percentiles(summaries, PERCENTILES)


def p5_within_bounds(spark: SparkSession, d: str) -> DataFrame:
    """Whether each percentile's true rank lies within the stated error, and the stated error within the permitted one."""
    rows, names = _version_scores(spark, d)
    got = p5_percentiles(spark, d).groupBy("shard", "name", "n", "value").agg(F.collect_list(F.struct("q", "rank_error")).alias("asked"))
    once = rows.where("shard is not null").groupBy("shard", "clip_id", "scored_at").agg(*[F.max(m).alias(m) for m in names])
    long = clips.long_scores(once.withColumnsRenamed({m: f"s_{m}" for m in names}), ["shard"], names)
    counts = long.groupBy("shard", "name", "value").agg(F.count(F.lit(1)).alias("equal"))
    upto = F.sum("equal").over(Window.partitionBy("shard", "name").orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
    true = counts.select("shard", "name", "value", (upto - F.col("equal") + 1).alias("first"), upto.alias("last"))
    each = got.join(true, ["shard", "name", "value"], "left").select("*", F.inline("asked"))
    wanted = F.greatest(F.lit(1), F.ceil(F.col("q") * F.col("n")))
    miss = F.greatest(F.col("first") - wanted, wanted - F.col("last"), F.lit(0))
    ok = F.coalesce((miss <= F.col("rank_error")) & (F.col("rank_error") <= quantiles.ERROR * F.col("n") + 1), F.lit(False))
    return each.select("shard", "name", "q", "n", ok.alias("within"))


def p5_days_combined(spark: SparkSession, d: str) -> DataFrame:
    """Medians from summaries of separate days, kept by day and merged: the stored form and its use."""
    rows, names = _version_scores(spark, d)
    rows = rows.where("shard is not null").withColumn("day", F.to_date("scored_at"))
    once = rows.groupBy("shard", "day", "clip_id", "scored_at").agg(*[F.max(m).alias(m) for m in names])
    # Tasks of (shard, day) groups: almost all of a group lies in one.
    parts = write_table(quantiles.summarise(once, ["shard", "day"], names), "summaries")
    half = quantiles.ERROR / 2
    daily = write_table(quantiles.merge_summaries(parts, ["shard", "day", "name"], error=half), "daily-summaries")
    total = quantiles.merge_summaries(daily.withColumnRenamed("day", "part"), ["shard", "name"], have=half)
    return quantiles.percentiles(total, [0.5])


def caption_values(spark: SparkSession, d: str) -> DataFrame:
    """(id, field, source, shard, provider, text): both caption fields, identical copies of a record counting once."""
    rows = table(spark, d, "clip_captions").select("caption_id", "shard", "provider", "caption", "caption_visual").distinct()
    fields = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("text")) for c in ("caption", "caption_visual")])
    values = rows.select(F.col("caption_id").alias("id"), "shard", "provider", F.inline(fields)).where("text is not null and trim(text) <> ''")
    return write_table(values.withColumn("source", F.concat_ws("/", "provider", "field")), "caption-values")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    found, _ = truncation.find_truncated(caption_values(spark, d).select("id", "field", "source", "text"))
    return found.where("cut").select(F.col("id").alias("caption_id"), F.col("field").alias("field_name")).distinct()


def p4_rates(spark: SparkSession, d: str) -> DataFrame:
    """Values, cut values and their share of each shard, provider and field."""
    values = caption_values(spark, d)
    found, _ = truncation.find_truncated(values.select("id", "field", "source", "text"))
    known = values.select("id", "field", "shard", "provider").distinct()
    by = known.join(found.select("id", "field", "cut").distinct(), ["id", "field"]).groupBy("shard", "provider", F.col("field").alias("field_name"))
    return by.agg(F.count(F.lit(1)).alias("n_values"), F.count_if("cut").alias("n_cut"), (F.count_if("cut") / F.count(F.lit(1))).alias("share"))


def p4_evidence(spark: SparkSession, d: str) -> DataFrame:
    """Cut values of each field and provider by what showed the cut: a significant length or the ending itself."""
    values = caption_values(spark, d)
    found, _ = truncation.find_truncated(values.select("id", "field", "source", "text"))
    return found.where("cut").groupBy("source", "evidence").agg(F.count(F.lit(1)).alias("n_values"))


def p4_limits(spark: SparkSession, d: str) -> DataFrame:
    """Lengths at which a source's values end far more often than at the lengths around them."""
    _, lengths = truncation.find_truncated(caption_values(spark, d).select("id", "field", "source", "text"))
    return lengths.where("significant").select("source", "script", "unit", "length", "events", "at_risk", "expected", "p")


def _budgets(spark: SparkSession, d: str) -> list:
    return table(spark, d, "pack_budgets").distinct().orderBy("budget_id").collect()  # configuration


def p7_packed(spark: SparkSession, d: str) -> DataFrame:
    """Container of each text (or piece of a text longer than the capacity) under each budget."""
    docs, out = table(spark, d, "documents"), []
    budgets = _budgets(spark, d)
    sizes = {}
    for name in {b["tokenizer"] for b in budgets}:
        sizes[name] = write_table(docs.select("doc_id", tokens.token_counts(spark, F.col("text"), name).alias("size")), "token-counts")
    for b in budgets:
        packed = packing.pack(sizes[b["tokenizer"]], b["capacity"], "doc_id")
        out.append(packed.select(F.lit(b["budget_id"]).alias("budget_id"), F.col("id").alias("doc_id"), "piece", F.col("length").alias("n_tokens"), "container"))
    return functools.reduce(DataFrame.unionByName, out)


def p7_usage(spark: SparkSession, d: str) -> DataFrame:
    """Containers and unused share of each budget, beside the least number of containers any packing needs."""
    budgets = table(spark, d, "pack_budgets").distinct()
    used = p7_packed(spark, d).groupBy("budget_id", "container").agg(F.sum("n_tokens").alias("fill"), F.count(F.lit(1)).alias("pieces")).where("container is not null")
    by = used.groupBy("budget_id").agg(F.count(F.lit(1)).alias("containers"), F.sum("fill").alias("tokens"), F.max("fill").alias("fullest"))
    return by.join(budgets, "budget_id").select(
        "budget_id", "capacity", "containers", F.ceil(F.col("tokens") / F.col("capacity")).alias("least"), "tokens", "fullest",
        (1 - F.col("tokens") / (F.col("containers") * F.col("capacity"))).alias("unused_share"),
    )


def p7_valid(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of any packing, counted for each budget from the documents and the containers."""
    budgets = table(spark, d, "pack_budgets").distinct()
    packed = write_table(p7_packed(spark, d).join(F.broadcast(budgets.select("budget_id", "capacity")), "budget_id"), "packed")  # three rows
    by_doc = packed.groupBy("budget_id", "doc_id").agg(F.count(F.lit(1)).alias("pieces"), F.count_distinct("piece").alias("different"), F.sum("n_tokens").alias("tokens"), F.max("capacity").alias("capacity"), F.min("n_tokens").alias("least"))
    docs = table(spark, d, "documents").select("doc_id", (F.length(F.coalesce("text", F.lit(""))) > 0).alias("filled"))
    each = docs.crossJoin(F.broadcast(budgets.select("budget_id"))).join(by_doc, ["budget_id", "doc_id"], "left")  # three rows
    per = each.groupBy("budget_id").agg(
        F.count(F.lit(1)).alias("documents"), F.count_if(F.col("pieces").isNull()).alias("missing"), F.count_if(F.col("pieces") != F.col("different")).alias("repeated"),
        F.count_if((F.col("pieces") > 1) & (F.col("tokens") <= F.col("capacity"))).alias("divided_without_need"),
        F.count_if((F.col("tokens") > F.col("capacity")) & (F.col("pieces") != F.ceil(F.col("tokens") / F.col("capacity")))).alias("divided_too_often"),
        F.count_if(F.col("filled") != (F.col("tokens") > 0)).alias("wrongly_empty"),
    )
    fill = packed.where("container is not null").groupBy("budget_id", "container").agg(F.sum("n_tokens").alias("fill"), F.max("capacity").alias("capacity"))
    over = fill.groupBy("budget_id").agg(F.count_if(F.col("fill") > F.col("capacity")).alias("overfull"))
    return per.join(over, "budget_id", "left").withColumn("overfull", F.coalesce("overfull", F.lit(0).cast("bigint")))


def p4_rates_valid(spark: SparkSession, d: str) -> DataFrame:
    """Values of each shard, provider and field by the rates, and whether cut values and share agree with them."""
    ok = (F.col("n_cut") >= 0) & (F.col("n_cut") <= F.col("n_values")) & (F.abs(F.col("share") * F.col("n_values") - F.col("n_cut")) < 1e-6)
    return p4_rates(spark, d).select("shard", "provider", "field_name", "n_values", ok.alias("ok"))


def p8_rates_valid(spark: SparkSession, d: str) -> DataFrame:
    """Documents of each source by the rates, and whether flagged ones and rate agree with them."""
    ok = (F.col("n_abusive") >= 0) & (F.col("n_abusive") <= F.col("n_documents")) & (F.abs(F.col("rate") * F.col("n_documents") - F.col("n_abusive")) < 1e-6)
    return p8_rates(spark, d).select("source", "n_documents", ok.alias("ok"))


def scored_documents(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "source", "text")
    return abuse.score_documents(docs, table(spark, d, "content_labels")).select("doc_id", "source", "score", "abusive")


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return scored_documents(spark, d).where("abusive").select("doc_id")


def p8_scores(spark: SparkSession, d: str) -> DataFrame:
    return scored_documents(spark, d)


def p8_rates(spark: SparkSession, d: str) -> DataFrame:
    """Documents, flagged documents and their share of each source."""
    by = scored_documents(spark, d).groupBy("source")
    return by.agg(F.count(F.lit(1)).alias("n_documents"), F.count_if("abusive").alias("n_abusive"), (F.count_if("abusive") / F.count(F.lit(1))).alias("rate"))


QUERIES = {
    "p8_found": p8_found,
    "p8_scores": p8_scores,
    "p8_rates": p8_rates,
    "p4_found": p4_found,
    "p4_rates": p4_rates,
    "p4_limits": p4_limits,
    "p4_evidence": p4_evidence,
    "p7_packed": p7_packed,
    "p7_usage": p7_usage,
    "p7_valid": p7_valid,
    "p4_rates_valid": p4_rates_valid,
    "p8_rates_valid": p8_rates_valid,
    "p2_found": p2_found,
    "p2_ranking": p2_ranking,
    "p3_found": p3_found,
    "p3_cutoffs": p3_cutoffs,
    "p5_percentiles": p5_percentiles,
    "p5_within_bounds": p5_within_bounds,
    "p5_days_combined": p5_days_combined,
    "p6_ids": p6_ids,
}

_CURRENT = """
WITH versions AS (SELECT *, row_number() OVER (PARTITION BY clip_id ORDER BY scored_at DESC) AS rn FROM clip_results),
cur AS (SELECT clip_id, shard, scores FROM versions WHERE rn = 1),
"""
_LONG = _CURRENT + """
e AS (SELECT clip_id, shard, unnest(map_entries(scores)) AS x FROM cur WHERE shard IS NOT NULL),
s AS (SELECT clip_id, shard, x.key AS name, x.value + 0.0 AS v FROM e WHERE x.value IS NOT NULL AND NOT isnan(x.value)),
r AS (SELECT s.*, k.keep_fraction, row_number() OVER (PARTITION BY shard, s.name ORDER BY v DESC) AS rn,
        count(*) OVER (PARTITION BY shard, s.name) AS n FROM s JOIN keep_targets k ON s.name = k.name),
c AS (SELECT shard, name, v, n, rn FROM r WHERE rn = CAST(ceil(keep_fraction * n) AS BIGINT))
"""
_FOUR = "dover", "dover_tech", "aes", "motion"
_RANKS = _CURRENT + "w AS (SELECT clip_id, " + ", ".join(f"CASE WHEN NOT isnan(scores['{m}']) THEN scores['{m}'] + 0.0 END AS {m}" for m in _FOUR) + " FROM cur),\nr AS (SELECT clip_id, " + " AND ".join(f"{m} IS NOT NULL" for m in _FOUR) + " AS complete, " + ", ".join(
    f"(rank() OVER (ORDER BY {m} DESC NULLS LAST) + count(*) OVER (ORDER BY {m} DESC NULLS LAST RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) / 2.0 AS rank_{m}" for m in _FOUR
) + " FROM w),\nk AS (SELECT *, list_sort([" + ", ".join(f"rank_{m}" for m in _FOUR) + "]) AS l FROM r),\nf AS (SELECT clip_id, complete, (l[2] + l[3]) / 2 AS median_rank, (" + " + ".join(f"rank_{m}" for m in _FOUR) + ") / 4 AS mean_rank, " + ", ".join(f"rank_{m}" for m in _FOUR) + " FROM k)\n"
_QS = ", ".join(f"({q})" for q in PERCENTILES)
ORACLE = {
    "p7_valid": """SELECT budget_id, documents, 0 AS missing, 0 AS repeated, 0 AS divided_without_need, 0 AS divided_too_often, 0 AS wrongly_empty, 0 AS overfull
FROM (SELECT DISTINCT budget_id FROM pack_budgets), (SELECT count(*) AS documents FROM documents)""",
    "p4_rates_valid": """
WITH r AS (SELECT DISTINCT caption_id, shard, provider, caption, caption_visual FROM clip_captions),
v AS (SELECT caption_id, shard, provider, 'caption' AS field_name, caption AS t FROM r UNION ALL SELECT caption_id, shard, provider, 'caption_visual', caption_visual FROM r)
SELECT shard, provider, field_name, count(DISTINCT caption_id) AS n_values, true AS ok FROM v WHERE trim(t) <> '' GROUP BY ALL""",
    "p8_rates_valid": "SELECT source, count(*) AS n_documents, true AS ok FROM documents GROUP BY source",
    "p2_ranking": _RANKS + "SELECT * FROM f",
    "p2_found": _RANKS + """
SELECT panel_id, clip_id FROM (SELECT panel_id, clip_id, row_number() OVER (PARTITION BY panel_id ORDER BY median_rank, mean_rank, clip_id) AS p
  FROM (SELECT DISTINCT panel_id, clip_id FROM review_panels) JOIN f USING (clip_id) WHERE complete) WHERE p = 1""",
    "p5_within_bounds": f"""
WITH e AS (SELECT shard, unnest(map_entries(scores)) AS x FROM (SELECT DISTINCT clip_id, scored_at, shard, scores FROM clip_results) WHERE shard IS NOT NULL),
s AS (SELECT shard, x.key AS name, count(*) AS n FROM e WHERE x.value IS NOT NULL AND NOT isnan(x.value) GROUP BY ALL)
SELECT shard, name, CAST(q AS DOUBLE) AS q, n, true AS within FROM s, (VALUES {_QS}) AS t(q)""",
    "p3_found": _LONG + "SELECT s.shard, s.name, s.clip_id FROM s JOIN c ON s.shard = c.shard AND s.name = c.name AND s.v = c.v",
    "p3_cutoffs": _LONG + """
SELECT c.shard, c.name, c.n, c.rn AS target, c.v AS cutoff, count(*) FILTER (s.v >= c.v) AS kept, count(*) FILTER (s.v = c.v) AS at_cutoff,
  any_value(m.threshold) AS threshold, count(*) FILTER (s.v >= m.threshold) AS kept_by_threshold
FROM c JOIN s ON s.shard = c.shard AND s.name = c.name LEFT JOIN score_models m ON m.name = c.name
GROUP BY c.shard, c.name, c.n, c.rn, c.v""",
}
