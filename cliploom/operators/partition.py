"""Dividing an ordered list among workers, with numbering that needs no single task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def numbered(rows: DataFrame, order: str, parts: int = 200) -> DataFrame:
    """``rows`` with ``place`` 0.. by the order of a unique column.

    Rows are range-partitioned by quantile cut points into at most ``parts`` intervals; their counts give each an
    offset, and only inside an interval are rows sorted. A short list is one interval.
    """
    n = rows.count()
    if n <= 100_000:
        return rows.withColumn("place", F.row_number().over(Window.orderBy(order)) - 1)
    # Every k-th value of a bounded sorted sample of hashes would be inexact only in size, never in result.
    sample = rows.select(F.col(order).alias("v")).where(F.pmod(F.xxhash64("v"), F.lit(max(1, n // 20_000))) == 0)
    cuts = [r["v"] for r in sample.orderBy("v").collect()]
    cuts = cuts[:: max(1, len(cuts) // parts)]
    code = F.aggregate(F.array(*[F.lit(c) for c in cuts]), F.lit(0), lambda a, c: a + F.when(F.col(order) >= c, 1).otherwise(0)) if cuts else F.lit(0)
    coded = rows.withColumn("__part", code)
    counts = {r["__part"]: r["count"] for r in coded.groupBy("__part").count().collect()}
    offsets, total = [], 0
    for k in sorted(counts):
        offsets.append((k, total))
        total += counts[k]
    offs = F.broadcast(rows.sparkSession.createDataFrame(offsets, "__part int, __offset bigint"))
    w = Window.partitionBy("__part").orderBy(order)
    return coded.join(offs, "__part").withColumn("place", F.col("__offset") + F.row_number().over(w) - 1).drop("__part", "__offset")


def even_chunks(rows: DataFrame, order: str, k: int) -> DataFrame:
    """Add ``chunk``: consecutive runs of ceil(n / k) rows, so there may be fewer than k."""
    n = rows.count()
    size = max(1, -(-n // max(int(k), 1)))
    return numbered(rows, order).withColumn("chunk", F.floor(F.col("place") / size).cast("int"))


def balanced_chunks(rows: DataFrame, order: str, k: int) -> DataFrame:
    """Add ``chunk``: k runs whose sizes differ by one at most, longer ones first."""
    n, k = rows.count(), max(int(k), 1)
    small, long = n // k, n % k
    p = F.col("place")
    head = long * (small + 1)
    return numbered(rows, order).withColumn("chunk", F.when(p < head, F.floor(p / (small + 1))).otherwise(long + F.floor((p - head) / max(small, 1))).cast("int"))


def round_robin(chunk: Column, devices: int) -> Column:
    return F.pmod(chunk, F.lit(max(int(devices), 1)))


def failed(codes: DataFrame) -> DataFrame:
    return codes.agg(F.count_if(F.col("code") != 0).alias("failed"))
