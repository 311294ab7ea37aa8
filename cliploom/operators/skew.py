"""Joins that keep one hot key from becoming one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot if it has more than this share of all rows; so there are at most HOT of them.
HOT = 64


def join_unique(rows: DataFrame, facts: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join ``rows`` with ``facts``, which has at most one row per ``key``.

    Facts of the at most HOT hot keys are broadcast, the rest is a shuffle join; a null key counts as cold. ``rows`` and
    ``facts`` are each read twice.
    """
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = [r[0] for r in counts.where(F.col("n") * HOT > total).where(F.col("n") > 10_000).select(key).collect()]
    if not hot:
        return rows.join(facts, key, how)
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    near = F.broadcast(facts.where(F.col(key).isin(hot)))
    return rows.where(is_hot).join(near, key, how).unionByName(rows.where(~is_hot).join(facts, key, how))
