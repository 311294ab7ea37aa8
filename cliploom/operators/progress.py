"""Progress analytics over shard states, summaries and shard lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cliploom.functions.text import age

#: Stages of a finished shard.
FINISHED = ("uploaded", "processed")


def current_states(saves: DataFrame, seq: str = "save_seq") -> DataFrame:
    """The save with the greatest sequence number of each shard."""
    rest = [c for c in saves.columns if c != "shard"]
    best = saves.groupBy("shard").agg(F.max_by(F.struct(*rest), F.col(seq)).alias("__row"))
    return best.select("shard", *[F.col(f"__row.`{c}`").alias(c) for c in rest])


def active(states: DataFrame) -> DataFrame:
    return states.where(~F.coalesce("uploaded", F.lit(False)) & ~F.coalesce(F.col("stage").isin(*FINISHED), F.lit(False)))


def flag_totals(states: DataFrame, by: list[str] | None = None) -> DataFrame:
    flags = ("downloaded", "extracted", "scored", "uploaded")
    return states.groupBy(*(by or [])).agg(F.count(F.lit(1)).alias("shards"), *[F.count_if(F.coalesce(f, F.lit(False))).alias(f"n_{f}") for f in flags])


def stage_counts(states: DataFrame) -> DataFrame:
    """(stage, shards, place): stages by number of shards, most common first."""
    counts = states.groupBy("stage").agg(F.count(F.lit(1)).alias("shards"))
    return counts.withColumn("place", F.row_number().over(Window.orderBy(F.desc("shards"), "stage")))  # a row per stage


def duration(states: DataFrame) -> DataFrame:
    """Seconds from start to finish of finished shards; a missing start is the finish, never below 0."""
    took = F.greatest(F.col("finished_at") - F.coalesce("started_at", "finished_at"), F.lit(0.0))
    return states.where("finished_at is not null").withColumn("seconds", took)


def average_duration(states: DataFrame, by: list[str] | None = None) -> DataFrame:
    return duration(states).groupBy(*(by or [])).agg(F.count(F.lit(1)).alias("finished"), F.avg("seconds").alias("avg_seconds"))


def oldest_active(states: DataFrame, touched: str, n: int = 5) -> DataFrame:
    """The active shards not saved for longest."""
    return active(states).orderBy(touched, "shard").limit(n)


def oldest_per(states: DataFrame, by: str, touched: str) -> DataFrame:
    """The oldest active shard of each group."""
    first = F.min(F.struct(F.col(touched), F.col("shard"))).alias("f")
    return active(states).groupBy(by).agg(first).select(by, F.col("f.shard").alias("shard"), F.col(f"f.`{touched}`").alias(touched))


def config_progress(configs: DataFrame, states: DataFrame) -> DataFrame:
    """Listed shards and flag totals of each configuration; shards without a state count as not begun."""
    flags = ("downloaded", "extracted", "scored", "uploaded")
    joined = configs.select("config", "shard").distinct().join(states.select("shard", *flags), "shard", "left")
    return flag_totals(joined, ["config"])


def rollup_progress(states: DataFrame, group: Column) -> DataFrame:
    """Shards by group and stage with subtotals; a null stage or group is the total over it."""
    rows = states.select(group.alias("grp"), "stage")
    return rows.rollup("grp", "stage").agg(F.count(F.lit(1)).alias("shards"), F.grouping_id().cast("int").alias("level"))


def in_both(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select("shard").intersect(b.select("shard"))


def missing(wanted: DataFrame, have: DataFrame) -> DataFrame:
    return wanted.select("shard").distinct().exceptAll(have.select("shard").distinct())


def first_missing(wanted: DataFrame, have: DataFrame, n: int = 20) -> DataFrame:
    return missing(wanted, have).orderBy("shard").limit(n)


def rates(snapshots: DataFrame, at: str, value: str) -> DataFrame:
    """Change per minute between consecutive snapshots of a shard."""
    w = Window.partitionBy("shard").orderBy(at)
    before, when = F.lag(value).over(w), F.lag(at).over(w)
    seconds = F.col(at).cast("double") - when.cast("double")
    return snapshots.select("shard", at, value, F.when(seconds > 0, (F.col(value) - before) * 60.0 / seconds).alias("per_minute"))


def status_line(seconds: Column) -> Column:
    """One line of an active shard; segments without a value are left out."""
    p = F.col("progress")
    done = F.when(p["videos_total"] > 0, F.format_string("videos %d/%d", p["videos_done"], p["videos_total"]))
    queue = F.when(p["queue_pending"] > 0, F.format_string("queue %d", p["queue_pending"]))
    return F.concat_ws("; ", F.concat_ws(" ", "shard", "stage"), done, queue, p["last_video"], F.concat(F.lit("age "), age(seconds)))


def upload_outcomes(states: DataFrame, outputs: DataFrame, force: bool = False) -> DataFrame:
    """(outcome, shards): uploaded ones are skipped unless forced, of the others those without output are missing."""
    have = outputs.select("shard").distinct().withColumn("__have", F.lit(True))
    done = F.coalesce("uploaded", F.lit(False)) & F.lit(not force)
    outcome = F.when(done, "skipped").when(F.col("__have").isNull(), "missing").otherwise("uploaded")
    return states.join(have, "shard", "left").groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("shards"))


def checks_summary(checks: DataFrame) -> DataFrame:
    return checks.agg(F.coalesce(F.bool_and("ok"), F.lit(True)).alias("all_ok"), F.count_if("ok").alias("passed"), F.count(F.lit(1)).alias("total"))


def run_counts(runs: DataFrame) -> DataFrame:
    """Distinct runs by status with their time; copies of a row count once."""
    once = runs.select("run_id", "status", "duration_sec").distinct()
    return once.groupBy("status").agg(F.count(F.lit(1)).alias("runs"), F.sum("duration_sec").alias("seconds"))


#: Stages of a shard in their order.
STAGES = ("pending", "prefetched", "downloading", "extracting", "processing", "materializing", "uploading", "uploaded", "processed")


def summary_totals(states: DataFrame, summaries: DataFrame) -> DataFrame:
    """Scored shards with a summary, their mean time and clips in total; shards without one are left out."""
    joined = states.where("scored").select("shard").join(summaries, "shard")
    return joined.agg(F.count(F.lit(1)).alias("summarised"), F.avg("time_total").alias("avg_time"), F.sum("clips_scored").alias("clips"))


def next_action(skip_upload: bool = False, calibrating: bool = False) -> Column:
    """What a run has to do for a shard: skip, download, extract, process or upload."""
    is_set = lambda c: F.coalesce(c, F.lit(False))
    return (
        F.when(is_set("uploaded") & F.lit(not skip_upload and not calibrating), "skip")
        .when(~is_set("downloaded"), "download")
        .when(~is_set("extracted"), "extract")
        .when(~is_set("scored") | F.lit(calibrating), "process")
        .when(F.lit(skip_upload), "skip")
        .otherwise("upload")
    )


def stage_timings(rows: DataFrame, timings: list[str], by: list[str]) -> DataFrame:
    """Sum of each stage's seconds."""
    return rows.groupBy(*by).agg(*[F.sum(t).alias(t) for t in timings])


def gpu_samples(lines: DataFrame, column: str = "value") -> DataFrame:
    """(index, utilization, memory_used, memory_total, temperature) of sampled CSV lines; bad ones are left out."""
    fields = ("index", "utilization", "memory_used", "memory_total", "temperature")
    parts = F.split(F.col(column), ",")
    cells = [F.regexp_replace(F.get(parts, F.lit(i)), r"[^0-9.+-]", "").try_cast("double") for i in range(5)]
    got = lines.where(F.size(parts) == 5).select(*[c.alias(n) for c, n in zip(cells, fields)])
    return got.dropna().withColumn("index", F.col("index").cast("int"))


def pinned_checks(pinned: DataFrame, heads: DataFrame) -> DataFrame:
    """(name, ok, detail): whether each component with a pinned commit is at it; absent ones fail."""
    joined = pinned.select("name", F.col("commit").alias("want")).join(heads.select("name", F.col("commit").alias("have")), "name", "left")
    ok = F.col("want").isNull() | F.coalesce(F.startswith("have", "want"), F.lit(False))
    return joined.select("name", ok.alias("ok"), F.when(ok, F.coalesce("have", F.lit("not pinned"))).otherwise(F.concat(F.lit("expected "), "want", F.lit(", found "), F.coalesce("have", F.lit("nothing")))).alias("detail"))
