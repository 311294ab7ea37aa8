"""Previous-value access along an integer index without one task per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Index values of one block. A key's rows are spread over its blocks; only one row a block is looked at across blocks.
BLOCK = 65_536


def with_previous(df: DataFrame, keys: list[str], index: str, values: list[str], block: int = BLOCK) -> DataFrame:
    """Add ``prev_<value>``: the value at the key's next smaller index, null at its first.

    Within a block the value before is found by a window, and each block's first row takes the last value of the block
    before, so a key with most of all rows is still divided.
    """
    placed = df.withColumn("__block", F.floor(F.col(index) / block))
    w = Window.partitionBy(*keys, "__block").orderBy(index)
    inner = placed.select("*", F.row_number().over(w).alias("__place"), *[F.lag(v).over(w).alias(f"__lag_{v}") for v in values])
    last = placed.groupBy(*keys, "__block").agg(F.max_by(F.struct(*values), index).alias("__last"))
    over = Window.partitionBy(*keys).orderBy("__block")
    carry = last.select(*keys, "__block", F.lag("__last").over(over).alias("__carry"))
    on = [inner[k].eqNullSafe(carry[k]) for k in [*keys, "__block"]]
    joined = inner.join(carry, on, "left").drop(*[carry[k] for k in [*keys, "__block"]])
    found = [F.when(F.col("__place") == 1, F.col(f"__carry.{v}")).otherwise(F.col(f"__lag_{v}")).alias(f"prev_{v}") for v in values]
    return joined.select(*df.columns, *found)
