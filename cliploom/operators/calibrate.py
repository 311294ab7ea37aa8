"""Score calibration: quantiles by model over a capped, ordered sample, and the threshold grid search."""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cliploom.functions.kernels import safe_ratio
from cliploom.session import write_table

SAMPLE_SIZE = 10_000


def scored_rows(metadata: DataFrame) -> DataFrame:
    return metadata.where(F.col("scores").isNotNull())


def score_names(metadata: DataFrame, scores: str = "scores") -> list[str]:
    """The models that any score map has an entry of, in order: as many as there are models."""
    names = metadata.select(F.explode(F.map_keys(scores)).alias("name")).distinct().collect()
    return sorted(r["name"] for r in names)


def long_scores(metadata: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """(name, value): scores that are neither null nor NaN, of the named models only if names are given."""
    if names is not None:
        pairs = F.array(*[F.struct(F.lit(n).alias("name"), F.try_element_at("scores", F.lit(n)).alias("value")) for n in names])
        rows = scored_rows(metadata).select(F.inline(pairs))
    else:
        rows = scored_rows(metadata).select(F.explode("scores").alias("name", "value"))
    return rows.where("value is not null and not isnan(value)")


def wide_scores(metadata: DataFrame, names: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Scores as columns."""
    return metadata.select(*keep, *[F.try_element_at("scores", F.lit(n)).alias(n) for n in names])


def _bucket(value: Column) -> Column:
    """An integer that never falls as the value rises, 256 for each factor of two."""
    size = F.when(F.abs(value) == F.lit(math.inf), F.lit(600_000)).otherwise(F.floor(F.log2(F.abs(value)) * 256) + 300_000)
    return F.when(value == 0, F.lit(0)).when(value < 0, -size).otherwise(size).cast("int")


def quantiles(metadata: DataFrame, qs: Sequence[float], names: Sequence[str] | None = None) -> DataFrame:
    """(name, q, value) with linear interpolation, exact at every size; models without values have no row.

    Counts of value buckets tell which ones hold the ranks asked for; only their distinct values are sorted.
    """
    long = long_scores(metadata, names).select("name", (F.col("value") + F.lit(0.0)).alias("value"))
    counted = long.groupBy("name", "value").agg(F.count(F.lit(1)).alias("c")).withColumn("bucket", _bucket(F.col("value")))
    counted = write_table(counted, "score-counts")
    w = Window.partitionBy("name")
    buckets = counted.groupBy("name", "bucket").agg(F.sum("c").alias("m"))
    upto = F.sum("m").over(w.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    buckets = buckets.select("name", "bucket", (upto - F.col("m")).alias("before"), upto.alias("upto"), F.sum("m").over(w).alias("n"))
    # Ranks count from 0; a position between two ranks asks for both.
    asked = F.array(*[F.lit(float(q)) for q in qs])
    place = buckets.select("*", F.posexplode(asked).alias("i", "q")).withColumn("at", F.col("q") * (F.col("n") - 1))
    place = place.select("*", F.explode(F.array_distinct(F.array(F.floor("at"), F.ceil("at")))).alias("rank"))
    place = place.where((F.col("before") <= F.col("rank")) & (F.col("rank") < F.col("upto")))
    place = write_table(place.select("name", "bucket", "before", "i", "q", "at", "rank"), "score-ranks")  # two a model and q at most
    inner = Window.partitionBy("name", "bucket").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    sought = counted.join(F.broadcast(place.select("name", "bucket").distinct()), ["name", "bucket"], "left_semi")
    sought = sought.withColumn("end", F.sum("c").over(inner))
    found = sought.join(F.broadcast(place), ["name", "bucket"])
    found = found.where((F.col("before") + F.col("end") - F.col("c") <= F.col("rank")) & (F.col("rank") < F.col("before") + F.col("end")))
    both = found.groupBy("name", "i", "q", "at").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    value = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise((F.ceil("at") - F.col("at")) * F.col("low") + (F.col("at") - F.floor("at")) * F.col("high"))
    return both.select("name", "q", value.alias("value"))


def capped(metadata: DataFrame, order: Sequence[str], sample_size: int = SAMPLE_SIZE) -> DataFrame:
    """The first ``sample_size`` scored rows over all shards; 0 or less is no cap."""
    rows = scored_rows(metadata)
    return rows.orderBy(*order).limit(sample_size) if sample_size > 0 else rows


def with_labels(rows: DataFrame, labels: DataFrame, key: str, label: str) -> DataFrame:
    """``rows`` with the label given for their key, null without one; of several labels of a key the greatest counts."""
    once = labels.groupBy(key).agg(F.max(F.col(label).try_cast("boolean")).alias("__label"))
    return rows.drop(label).join(once, key, "left").withColumnRenamed("__label", label)


def threshold_grid(rows: DataFrame, grid: dict[str, Sequence[float]], label: str, scores: str = "scores") -> DataFrame:
    """(a column per score, tp, fp, fn, prec, rec) of every threshold combination against a boolean label.

    A row is counted by how many of each score's thresholds it reaches, so the expressions over rows grow with the sum of
    the thresholds' numbers, and what follows with the combinations only. A missing score is -1; a null label doesn't
    count.
    """
    names = list(grid)
    steps = {n: sorted({float(t) for t in grid[n]}) for n in names}

    def reached(n: str) -> Column:
        x = F.coalesce(F.try_element_at(scores, F.lit(n)), F.lit(-1.0))
        return F.when(F.isnan(x), F.lit(0)).otherwise(sum((F.when(x >= F.lit(t), 1).otherwise(0) for t in steps[n]), F.lit(0)))

    codes = rows.where(F.col(label).isNotNull()).select(F.col(label).alias("__y"), *[reached(n).alias(f"__c{i}") for i, n in enumerate(names)])
    cells = codes.groupBy(*[f"__c{i}" for i in range(len(names))]).agg(F.count_if("__y").alias("__p"), F.count_if(~F.col("__y")).alias("__n"))
    said = cells
    for i in range(len(names)):  # every combination a cell reaches
        said = said.where(F.col(f"__c{i}") > 0).withColumn(f"__c{i}", F.explode(F.sequence(F.lit(1), F.col(f"__c{i}"))))
    hits = said.groupBy(*[f"__c{i}" for i in range(len(names))]).agg(F.sum("__p").alias("tp"), F.sum("__n").alias("fp"))
    combos = [(*[steps[n].index(float(t)) + 1 for n, t in zip(names, c)], *map(float, c)) for c in itertools.product(*[grid[n] for n in names])]
    schema = ", ".join([*[f"__c{i} int" for i in range(len(names))], *[f"`{n}` double" for n in names]])
    asked = rows.sparkSession.createDataFrame(combos, schema)
    total = F.broadcast(cells.agg(F.coalesce(F.sum("__p"), F.lit(0)).alias("__all")))  # one row
    table = asked.join(F.broadcast(hits), [f"__c{i}" for i in range(len(names))], "left").crossJoin(total)  # at most a row per combination
    none = F.lit(0).cast("bigint")
    table = table.select(*[F.col(f"`{n}`") for n in names], F.coalesce("tp", none).alias("tp"), F.coalesce("fp", none).alias("fp"), (F.col("__all") - F.coalesce("tp", none)).alias("fn"))
    return table.withColumn("prec", safe_ratio(F.col("tp"), F.col("fp"))).withColumn("rec", safe_ratio(F.col("tp"), F.col("fn")))


def best_thresholds(table: DataFrame, names: Sequence[str], n: int = 10) -> DataFrame:
    """The best rows by recall, then precision, then the thresholds themselves."""
    w = Window.orderBy(F.desc("rec"), F.desc("prec"), *names)  # one row per combination
    return table.withColumn("place", F.row_number().over(w)).where(F.col("place") <= n)
