"""Percentiles of large numeric columns with tracked, bounded rank error, combinable across partitions and days.

A summary of n values is a short list of values, each with an interval (lo, hi) that certainly holds its rank among the
n. It is compressed by the permitted uncertainty: a value is left out as long as the ranks from the last value kept to
the next one stay within twice the permitted error. Merging two summaries adds up the rank intervals, so the accumulated
error is known exactly rather than estimated. Everything is deterministic.

The permitted error is a share of n (ERROR unless given). A summary that is final at once is compressed to it. Partial
summaries are compressed to a part of it, and each round of merging, of FAN_IN summaries at a time, is permitted as much
again, so that the last round ends within the whole. How many rounds follows from the number of partial summaries.

Cases: null and NaN values and null groups aren't counted; infinite values are; repeated values each count; an empty
table has no summaries; a percentile q of n values is the value of rank max(1, ceil(q * n)).
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cliploom.session import write_table

#: Permitted rank error as a share of n, summaries merged in one step, and values a task holds before it writes summaries.
ERROR, FAN_IN, BUFFER = 0.00125, 8, 2_000_000

SUMMARY = T.StructType([
    T.StructField("n", T.LongType()),
    T.StructField("v", T.ArrayType(T.DoubleType())),
    T.StructField("lo", T.ArrayType(T.LongType())),
    T.StructField("hi", T.ArrayType(T.LongType())),
])
ANSWERS = T.ArrayType(T.StructType([T.StructField("q", T.DoubleType()), T.StructField("value", T.DoubleType()), T.StructField("rank_error", T.LongType())]))

Summary = tuple[int, np.ndarray, np.ndarray, np.ndarray]


def exact(values: np.ndarray) -> Summary:
    """The summary that keeps every value."""
    v = np.sort(values)
    r = np.arange(1, len(v) + 1)
    return len(v), v, r, r


def thin(s: Summary, permitted: float = ERROR) -> Summary:
    """The values needed for a rank error of ``permitted`` * n at most; first and last always stay.

    Where a merge has left wider intervals than that, nothing is left out.
    """
    n, v, lo, hi = s
    gap = int(2 * permitted * n)
    if gap < 2 or len(v) <= 2:
        return s
    if len(v) == n:  # every rank is known
        at = np.r_[np.arange(0, n - 1, gap), n - 1]
        return n, v[at], lo[at], hi[at]
    reach = np.searchsorted(np.maximum.accumulate(hi), lo + gap, "right") - 1
    i, last, kept = 0, len(v) - 1, [0]
    while i < last:
        i = min(max(i + 1, int(reach[i])), last)
        kept.append(i)
    return n, v[kept], lo[kept], hi[kept]


def _shift(own: Summary, other: Summary, side: str) -> tuple[np.ndarray, np.ndarray]:
    """Rank intervals of own values in the union; of equal values, those of the side "left" come first."""
    before = np.searchsorted(other[1], own[1], side)  # the other's values that come before
    lo = own[2] + np.where(before > 0, other[2][np.maximum(before, 1) - 1], 0)
    upper = np.where(before < len(other[1]), other[3][np.minimum(before, len(other[1]) - 1)] - 1, other[0])
    return lo, own[3] + upper


def merge(a: Summary, b: Summary) -> Summary:
    """Summary of the union of both inputs, with exact bounds of every rank."""
    if not a[0] or not b[0]:
        return b if not a[0] else a
    (alo, ahi), (blo, bhi) = _shift(a, b, "left"), _shift(b, a, "right")
    v = np.concatenate([a[1], b[1]])
    order = np.argsort(v, kind="stable")
    return a[0] + b[0], v[order], np.concatenate([alo, blo])[order], np.concatenate([ahi, bhi])[order]


def answer(s: Summary, q: float) -> tuple[float, int]:
    """(value, bound of its rank's error) for percentile ``q``."""
    n, v, lo, hi = s
    r = max(1, int(np.ceil(q * n)))
    off = np.maximum(np.abs(r - lo), np.abs(hi - r))
    i = int(np.argmin(off))
    return float(v[i]), int(off[i])


def max_error(s: Summary) -> int:
    """Bound of the rank error over all percentiles."""
    return int(np.max((s[3][1:] - s[2][:-1] + 1) // 2, initial=0))


def _lists(parts: Sequence[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts) if len(parts) else np.empty(0), type=kind))


def _array(summaries: Sequence[Summary]) -> pa.StructArray:
    return pa.StructArray.from_arrays(
        [pa.array([s[0] for s in summaries], pa.int64()), _lists([s[1] for s in summaries], pa.float64()), _lists([s[2] for s in summaries], pa.int64()), _lists([s[3] for s in summaries], pa.int64())],
        ["n", "v", "lo", "hi"],
    )


def _read(items: pa.StructArray) -> list[Summary]:
    n = np.asarray(items.field("n"))
    cols = []
    for name in ("v", "lo", "hi"):
        x = items.field(name)
        flat, ends = np.asarray(x.flatten()), np.concatenate([[0], np.cumsum(np.asarray(x.value_lengths()))])
        cols.append([flat[a:b] for a, b in zip(ends[:-1], ends[1:])])
    return [(int(k), v, lo, hi) for k, v, lo, hi in zip(n, *cols)]


def _merge_lists(permitted: float):
    @F.arrow_udf(SUMMARY)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            summaries, sizes, out, at = _read(batch.flatten()), np.asarray(batch.value_lengths()), [], 0
            for k in sizes:
                todo = summaries[at : at + k]
                at += k
                while len(todo) > 1:
                    todo = [merge(*todo[i : i + 2]) if i + 1 < len(todo) else todo[i] for i in range(0, len(todo), 2)]
                out.append(thin(todo[0], permitted) if k > 1 else todo[0])
            yield _array(out)

    return run


def _summaries(keys: list[str], names: list[str], permitted: float, whole: float):
    """mapInArrow function: summaries of each key and score column in a task's rows."""

    def emit(table: pa.Table, part: int, partial: bool) -> Iterator[pa.RecordBatch]:
        group = table.select(keys).to_pandas().groupby(keys, sort=False, dropna=False).ngroup().to_numpy()
        first = np.full(int(group.max()) + 1 if len(group) else 0, -1, dtype=np.int64)
        first[group[::-1]] = np.arange(len(group))[::-1]
        labels = table.select(keys).take(pa.array(first))
        for name in names:
            column = table.column(name).combine_chunks()
            v = column.fill_null(np.nan).to_numpy(zero_copy_only=False)
            ok = ~np.isnan(v)
            g, v = group[ok], v[ok]
            order = np.lexsort((v, g))
            g, v = g[order], v[order]
            starts = np.flatnonzero(np.r_[True, g[1:] != g[:-1]]) if len(g) else np.empty(0, int)
            ends = np.r_[starts[1:], len(g)] if len(g) else starts
            salts = np.asarray(labels.column("salt")) if "salt" in keys else None
            final = lambda g: salts is not None and not partial and not salts[g]
            ranks = np.arange(1, int((ends - starts).max(initial=0)) + 1)
            found = [thin((b - a, v[a:b], ranks[: b - a], ranks[: b - a]), whole if final(k) else permitted) for a, b, k in zip(starts, ends, g[starts])]
            for i in range(0, len(found), 5000):
                some = labels.take(pa.array(g[starts[i : i + 5000]])).combine_chunks()
                m = some.num_rows
                arrays = [some.column(k).combine_chunks() for k in keys]
                arrays += [pa.array([name] * m), pa.array(np.full(m, part, np.int32)), pa.array(np.full(m, partial)), _array(found[i : i + 5000])]
                yield pa.RecordBatch.from_arrays(arrays, [*keys, "name", "part", "partial", "s"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, part = [], 0, 0
        for b in batches:
            if rows and (rows + b.num_rows) * len(names) > BUFFER:
                yield from emit(pa.Table.from_batches(held), part, True)
                held, rows, part = [], 0, part + 1
            held.append(b)
            rows += b.num_rows
        if rows:
            yield from emit(pa.Table.from_batches(held), part, part > 0)

    return run


def summarise(rows: DataFrame, keys: list[str], names: list[str], salt: str | None = None, permitted: float = ERROR / 4, whole: float = ERROR) -> DataFrame:
    """(keys, name, part, partial, s): summaries of the columns ``names`` by ``keys`` in each task of ``rows``.

    ``salt``: name of an integer column; 0 says that all rows of the key lie in this task, so its only summary is whole
    and may have the error ``whole``. ``partial`` rows still have to be merged; they have the error ``permitted``.
    """
    schema = T.StructType([*[rows.schema[k] for k in keys], T.StructField("name", T.StringType()), T.StructField("part", T.IntegerType()), T.StructField("partial", T.BooleanType()), T.StructField("s", SUMMARY)])
    if salt is None:
        return rows.select(*keys, *names).mapInArrow(_summaries(keys, names, permitted, whole), schema).withColumn("partial", F.lit(True))
    inner = T.StructType([schema[0], *schema.fields[1 : len(keys)], T.StructField(salt, T.IntegerType()), *schema.fields[len(keys) :]])
    found = rows.select(*keys, salt, *names).mapInArrow(_summaries([*keys, salt], names, permitted, whole), inner)
    return found.select(*keys, "name", (F.col(salt) * 1000 + F.col("part")).cast("int").alias("part"), (F.col("partial") | (F.col(salt) > 0)).alias("partial"), "s")


def rounds_for(parts: int) -> int:
    """Rounds of merging FAN_IN at a time that ``parts`` summaries of a key need."""
    return max(1, math.ceil(math.log(max(parts, 1), FAN_IN) - 1e-9))


def merge_summaries(parts: DataFrame, keys: list[str], rounds: int | None = None, have: float = ERROR / 4, error: float = ERROR) -> DataFrame:
    """(keys, s): merge the summaries of each key hierarchically, from the error ``have`` of each to ``error``.

    Each round merges about FAN_IN summaries of a key in one place, spread over tasks by a hash of ``part``, and is
    compressed at once, so even a key with a summary from every partition never lies in one task whole. Without
    ``rounds`` they follow from the greatest number of summaries of a key; ``parts`` should then be a written table.
    """
    if rounds is None:
        most = parts.groupBy(*keys).agg(F.count(F.lit(1)).alias("m")).agg(F.max("m")).first()[0]
        rounds = rounds_for(most or 1)
    rows = parts.select(*keys, F.pmod(F.xxhash64("part"), F.lit(1 << 40)).alias("slot"), "s")
    for r in range(rounds):
        by = [(F.col("slot") % FAN_IN ** (rounds - 1 - r)).alias("slot")] if r < rounds - 1 else []
        rows = rows.groupBy(*keys, *by).agg(F.collect_list("s").alias("l"))
        rows = rows.select(*keys, *(["slot"] if by else []), _merge_lists(have + (error - have) * (r + 1) / rounds)("l").alias("s"))
    return rows


def hot_keys(rows: DataFrame, key: str, share: int = 64) -> dict:
    """Keys with more than 1/``share`` of all rows and their rows: at most ``share`` keys, counted with map-side combining."""
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    return {r[0]: r[1] for r in counts.where((F.col("n") * share > total) & F.col(key).isNotNull()).select(key, "n").collect()}


def salted(rows: DataFrame, key: str, hot: list, by: list[str], salts: int) -> DataFrame:
    """Add ``salt``: 1..salts for rows of hot keys, by a hash of ``by``, 0 for the others; partition by key and salt."""
    salt = F.when(F.col(key).isin(hot), F.pmod(F.xxhash64(*by), F.lit(salts)) + 1).otherwise(0) if hot else F.lit(0)
    return rows.withColumn("salt", salt.cast("int")).repartition(F.col(key), F.col("salt"))


def grouped_summaries(rows: DataFrame, key: str, names: list[str], by: list[str], distinct: bool = True, salts: int | None = None, error: float = ERROR) -> DataFrame:
    """(key, name, s): one summary per key and score column, over rows counted once per (key, ``by``), within ``error``.

    Rows are partitioned by key, hot keys salted, so that a salt has about as many values as a task holds; summaries of
    unsalted keys are final at once and aren't shuffled.
    """
    rows = rows.where(F.col(key).isNotNull()).select(*dict.fromkeys([key, *by, *names]))
    hot = hot_keys(rows, key)
    if salts is None:
        salts = max(FAN_IN, -(-max(hot.values(), default=0) * len(names) // BUFFER))
    placed = salted(rows, key, list(hot), by, salts)
    if distinct:
        placed = placed.groupBy(key, "salt", *by).agg(*[F.max(c).alias(c) for c in names])
    have = error / 4
    parts = write_table(summarise(placed, [key], names, "salt", have, error), "summaries")
    whole = parts.where("not partial").select(key, "name", "s")
    return whole.unionByName(merge_summaries(parts.where("partial"), [key, "name"], None, have, error))


def percentiles(summaries: DataFrame, qs: Sequence[float]) -> DataFrame:
    """(other columns, n, q, value, rank_error): percentiles of each summary ``s`` with the bound of the rank's error."""
    asked = [float(q) for q in qs]

    @F.arrow_udf(ANSWERS)
    def ask(items: pa.Array) -> pa.Array:
        out = []
        for s in _read(items):
            out.append([{"q": q, "value": v, "rank_error": e} for q in asked for v, e in [answer(s, q)]])
        return pa.array(out, type=pa.list_(pa.struct([("q", pa.float64()), ("value", pa.float64()), ("rank_error", pa.int64())])))

    rest = [c for c in summaries.columns if c != "s"]
    return summaries.select(*rest, F.col("s.n").alias("n"), ask("s").alias("a")).select(*rest, "n", F.inline("a"))
