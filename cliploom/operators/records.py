"""Clip records: order-stable dedup, limits, resume, extras, upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_records(records: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    """The record with the smallest ordinal of each key; null is a key value of its own.

    An aggregate that combines on the map side: a key that fills the table is one row per task before the shuffle.
    """
    rest = [c for c in records.columns if c not in keys and c != ordinal]
    best = F.min_by(F.struct(ordinal, *rest), F.col(ordinal)).alias("__row")
    got = records.groupBy(*keys).agg(best)
    return got.select(*[F.col(c) if c in keys else F.col(f"__row.`{c}`").alias(c) for c in records.columns])


def limited(records: DataFrame, ordinal: str, n: int | None) -> DataFrame:
    """The first ``n`` records by ordinal; None is no limit, below 0 is 0."""
    return records if n is None else records.orderBy(ordinal).limit(max(int(n), 0))


def pending(records: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Records whose key, null included, isn't among ``done``."""
    a, b = records.alias("a"), done.select(*keys).distinct().alias("b")
    on = [F.col(f"a.`{k}`").eqNullSafe(F.col(f"b.`{k}`")) for k in keys]
    return a.join(b, on, "left_anti")


def with_extras(base: DataFrame, extras: DataFrame, key: str) -> DataFrame:
    """``base`` with the columns of ``extras``, whose values override base columns of the same name where present."""
    names = [c for c in extras.columns if c != key]
    joined = base.join(extras.select(key, *[F.col(c).alias(f"__x_{c}") for c in names]), key, "left")
    both = [F.coalesce(f"__x_{c}", c).alias(c) if c in names else F.col(c) for c in base.columns]
    return joined.select(*both, *[F.col(f"__x_{c}").alias(c) for c in names if c not in base.columns])


def upsert_downloaded(states: DataFrame, shards: DataFrame, defaults: dict) -> DataFrame:
    """States after staging ``shards``: defaults for new ones, existing values kept, downloaded forced to true."""
    staged = shards.select("shard").distinct().withColumn("__staged", F.lit(True))
    joined = states.join(staged, "shard", "full_outer")
    out = [F.col("shard")]
    for c in states.columns:
        if c == "shard":
            continue
        x = F.coalesce(F.col(c), F.lit(defaults[c])) if c in defaults else F.col(c)
        out.append((F.when(F.col("__staged"), F.lit(True)).otherwise(x) if c == "downloaded" else x).alias(c))
    return joined.select(*out)
