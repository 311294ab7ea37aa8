"""One ranking from several differently scaled scores: median rank aggregation.

Every item's rank in each score is computed, 1 the best, ties sharing the mean of their places. Items are ordered by the
weighted median of their ranks, then the mean rank, then the identifier, so no score counts more for having a wider
range, a skewed distribution or outliers.

Ranks of all rows are found without a global sort in one task: cut points from a sample's quantiles divide each score
into intervals, whose exact counts give every interval's offset; only inside an interval are values sorted. A value
that many rows share is always a cut point itself, and all rows at a cut point have the same rank, so they need no sort
at all and no interval holds much more than its share, whatever the distribution.

Cases: a null or NaN score is missing; it ranks after all present ones and makes the item ``complete = false``, which
puts it after every complete item; infinite scores are extreme values like any other; repeated ids must be resolved
before (one row per item); an empty table gives an empty ranking.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cliploom.session import write_table

#: Rows an interval should hold, and the bounds of the number of intervals. Cut points and counts, all that reaches the
#: driver, are at most 2 * MAX_INTERVALS + 1 numbers a score.
ROWS_PER_INTERVAL, MIN_INTERVALS, MAX_INTERVALS = 100_000, 16, 32_768
#: Sampled rows for each interval and at least, from which cut points are taken; they only divide the work.
SAMPLED, LEAST_SAMPLED = 16, 4096


def cut_points(rows: DataFrame, id_column: str, names: list[str], prefix: str) -> tuple[dict[str, np.ndarray], int]:
    """Distinct quantiles of a bounded sample of each score, and the number of rows.

    The sample is taken by a hash of the id, so nothing is merged in one task. A value with an interval's share of all
    rows or more is found in the sample many times over, so it becomes a cut point.
    """
    n = rows.count()
    intervals = int(min(MAX_INTERVALS, max(MIN_INTERVALS, -(-n // ROWS_PER_INTERVAL))))
    wanted = max(LEAST_SAMPLED, SAMPLED * intervals)
    some = rows.where(F.pmod(F.xxhash64(F.lit("cut"), F.col(id_column)), F.lit(1 << 32)) < int(min(1.0, wanted / max(n, 1)) * (1 << 32)))
    # Twice the expected number is a bound only for ids that are not unique.
    found = some.select(*[F.col(f"`{prefix}{c}`").alias(f"v{i}") for i, c in enumerate(names)]).limit(2 * wanted + LEAST_SAMPLED).toArrow()
    cuts = {}
    for i, c in enumerate(names):
        v = np.sort(found.column(i).drop_null().to_numpy().astype(np.float64))
        cuts[c] = np.unique(v[(np.arange(1, intervals) * len(v)) // intervals]) if len(v) else v
    return cuts, n


def _interval(cuts: np.ndarray):
    """Code of a value: 2j + 1 at cut point j, 2j between cut points j - 1 and j; null for a missing value."""

    @F.arrow_udf(T.IntegerType())
    def code(values: pa.Array) -> pa.Array:
        v = values.fill_null(0).to_numpy(zero_copy_only=False)
        codes = np.searchsorted(cuts, v, "left") + np.searchsorted(cuts, v, "right")
        return pa.array(codes.astype(np.int32), mask=values.is_null().to_numpy(zero_copy_only=False))

    return code


def ranks(rows: DataFrame, id_column: str, names: list[str], prefix: str = "s_") -> DataFrame:
    """(id, complete, rank_0, rank_1, ...): exact mean-of-ties ranks of ``<prefix><name>`` columns, greater values first."""
    cuts, _ = cut_points(rows, id_column, names, prefix)
    coded = rows.select(F.col(id_column).alias("id"), *[F.col(f"`{prefix}{c}`").alias(f"v{i}") for i, c in enumerate(names)])
    coded = write_table(coded.select("*", *[_interval(cuts[c])(f"v{i}").alias(f"c{i}") for i, c in enumerate(names)]), "coded-scores")
    parts = F.array(*[F.struct(F.lit(i).cast("tinyint").alias("score"), F.coalesce(f"c{i}", F.lit(-1)).alias("code"), F.col(f"v{i}").alias("value")) for i in range(len(names))])
    long = coded.select("id", F.inline(parts))

    counted = {(r["score"], r["code"]): r["n"] for r in long.groupBy("score", "code").agg(F.count(F.lit(1)).alias("n")).collect()}
    stats = []
    for i in range(len(names)):
        above = 0
        for code in sorted((c for s, c in counted if s == i), reverse=True):  # -1, the missing ones, comes last
            stats.append((i, code, above, counted[i, code]))
            above += counted[i, code]
    stats = rows.sparkSession.createDataFrame(stats, "score tinyint, code int, above bigint, n bigint")
    long = long.join(F.broadcast(stats), ["score", "code"])  # at most 2 * MAX_INTERVALS + 2 rows a score

    shared = (F.col("code") < 0) | (F.col("code") % 2 == 1)
    same = long.where(shared).select("id", "score", (F.col("code") >= 0).alias("given"), (F.col("above") + (F.col("n") + 1) / 2).alias("rank"))
    w = Window.partitionBy("score", "code").orderBy(F.desc("value"))
    first, last = F.rank().over(w), F.count(F.lit(1)).over(w.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    inside = long.where(~shared).select("id", "score", "above", first.alias("first"), last.alias("last"))
    every = inside.select("id", "score", F.lit(True).alias("given"), (F.col("above") + (F.col("first") + F.col("last")) / 2).alias("rank")).unionAll(same)
    return every.groupBy("id").agg(F.bool_and("given").alias("complete"), *[F.sum(F.when(F.col("score") == i, F.col("rank"))).alias(f"rank_{i}") for i in range(len(names))])


def weighted_median(values: list[Column], weights: list[float]) -> Column:
    """Value at half the total weight; the midpoint of two values if the weight splits evenly between them."""
    half = sum(weights) / 2
    pairs = F.array_sort(F.array(*[F.struct(v.alias("v"), F.lit(float(w)).alias("w")) for v, w in zip(values, weights)]))

    def reach(acc: Column, x: Column) -> Column:
        upto = acc["w"] + x["w"]
        low = F.when(acc["low"].isNull() & (upto >= half), x["v"]).otherwise(acc["low"])
        high = F.when(acc["high"].isNull() & (upto > half), x["v"]).otherwise(acc["high"])
        return F.struct(upto.alias("w"), low.alias("low"), high.alias("high"))

    none = F.lit(None).cast("double")
    start = F.struct(F.lit(0.0).alias("w"), none.alias("low"), none.alias("high"))
    return F.aggregate(pairs, start, reach, lambda a: (a["low"] + F.coalesce(a["high"], a["low"])) / 2)


def fuse(rows: DataFrame, id_column: str, weights: Mapping[str, float], prefix: str = "s_") -> DataFrame:
    """(id, complete, median_rank, mean_rank, rank_<name>...) of each row of ``rows``.

    The ranking is the order by (not complete, median_rank, mean_rank, id). ``rows`` is read twice and should be a
    written table. Weights are positive; equal weights make each score count alike.
    """
    names = list(weights)
    if not names or any(w <= 0 for w in weights.values()):
        raise ValueError("weights must be positive")
    rows = rows.select(id_column, *[F.when(~F.isnan(f"`{prefix}{c}`"), F.col(f"`{prefix}{c}`") + F.lit(0.0)).alias(f"{prefix}{c}") for c in names])
    found = ranks(rows, id_column, names, prefix)
    each = [F.col(f"rank_{i}") for i in range(len(names))]
    total = float(sum(weights.values()))
    mean = sum((r * float(w) for r, w in zip(each[1:], list(weights.values())[1:])), each[0] * float(weights[names[0]])) / total
    return found.select(F.col("id").alias(id_column), "complete", weighted_median(each, list(weights.values())).alias("median_rank"), mean.alias("mean_rank"), *[r.alias(f"rank_{c}") for r, c in zip(each, names)])


def best_of(ranking: DataFrame, id_column: str, groups: DataFrame, group_column: str) -> DataFrame:
    """The complete member of each group that stands highest; groups without one yield no row."""
    members = groups.select(group_column, id_column).distinct()
    joined = members.join(ranking.where("complete"), id_column)
    key = F.struct("median_rank", "mean_rank", F.col(id_column).alias("id"))
    return joined.groupBy(group_column).agg(F.min(key).alias("k")).select(group_column, F.col("k.id").alias(id_column))
