"""Views of the scored-clip table that several problems share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def score(name: str, scores: str = "scores") -> Column:
    """The entry ``name`` of the score map; null if the map or key is missing or the value null or NaN."""
    x = F.try_element_at(F.col(scores), F.lit(name))
    return F.when(~F.isnan(x), x + F.lit(0.0))


def current_versions(clips: DataFrame, columns: dict[str, Column], key: str = "clip_id", order: str = "scored_at") -> DataFrame:
    """One row per clip: ``columns`` of the row with the greatest ``order``.

    Identical copies collapse; rows that tie in ``order`` but differ are decided by their values, so the result does not
    depend on row order. A null ``order`` is below any other. Rows combine on the map side before the shuffle.
    """
    picked = clips.select(F.col(key), F.struct(F.col(order).alias("__at"), *[c.alias(n) for n, c in columns.items()]).alias("__row"))
    best = picked.groupBy(key).agg(F.max("__row").alias("__row"))
    return best.select(key, *[F.col(f"__row.`{n}`").alias(n) for n in columns])


def long_scores(rows: DataFrame, id_columns: Sequence[str], names: Sequence[str], prefix: str = "s_") -> DataFrame:
    """(id columns, name, value), one row per valid score."""
    pairs = F.array(*[F.struct(F.lit(n).alias("name"), F.col(f"`{prefix}{n}`").alias("value")) for n in names])
    return rows.select(*id_columns, F.inline(pairs)).where("value is not null")
