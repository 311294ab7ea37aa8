"""Score cutoffs that keep a target fraction of each source's records.

Scores are coded as 24-bit integers that preserve order (the leading bits of the IEEE form, infinities included). A
source's codes are counted in a dyadic tree that is stored as rows (source, name, page, n, nodes): a page is the upper 12
bits of the code, ``nodes`` holds the counts of every non-empty node of the 12 levels below. Counts of the same node add
up, so a batch joins a stored tree by addition, and records that are replaced leave it by subtraction (:class:`TreeStore`). To find the record of a target rank the descent picks the page, then the
branch at each level, and ends in a leaf with the rank left inside it; only the leaf's records are read again, counted by
distinct score, to give the exact cutoff. A page has at most 8191 nodes however many records it counts, so no source,
not even one with most of the rows, makes a large task.

Cases: a null source, null score or NaN score isn't counted; infinite scores count; ties at the cutoff are all kept, so
``kept`` may exceed the target; repeated rows count as often as they occur; an empty table gives no cutoffs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cliploom.operators.versions import Versions
from cliploom.session import write_table

CODE_BITS, PAGE_BITS = 24, 12
LEVELS = CODE_BITS - PAGE_BITS
#: Cutoff rows that are broadcast at most; beyond it the same join is a shuffle join.
BROADCAST_ROWS = 200_000
NODES = T.ArrayType(T.StructType([T.StructField("node", T.IntegerType()), T.StructField("n", T.LongType())]))
TREE = T.StructType([
    T.StructField("source", T.StringType()), T.StructField("name", T.StringType()), T.StructField("page", T.IntegerType()),
    T.StructField("n", T.LongType()), T.StructField("nodes", NODES),
])
PLACE = T.StructType([T.StructField("leaf", T.IntegerType()), T.StructField("rank", T.LongType())])


def integer_codes(values: np.ndarray) -> np.ndarray:
    """Order-preserving integer codes; equal scores have equal codes (0.0 and -0.0 included)."""
    bits = (np.asarray(values, dtype=np.float64) + 0.0).view(np.int64)
    ordered = np.where(bits < 0, ~bits, bits ^ np.int64(-(2**63))).view(np.uint64)
    return (ordered >> np.uint64(64 - CODE_BITS)).astype(np.int32)


@F.arrow_udf(T.IntegerType())
def _code(values: pa.Array) -> pa.Array:
    return pa.array(integer_codes(values.fill_null(0).to_numpy(zero_copy_only=False)), type=pa.int32())


def _expand(rows: np.ndarray, leaves: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All nodes of the trees given by leaf counts, ordered by row and node; node 1 is a root, 2k and 2k+1 children of k."""
    out_row, out_node, out_n = [], [], []
    row, node, n = rows.astype(np.int64), leaves.astype(np.int64) + (1 << LEVELS), counts
    for _ in range(LEVELS + 1):
        out_row.append(row), out_node.append(node), out_n.append(n)
        node = node >> 1
        first = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (node[1:] != node[:-1])]) if len(row) else np.empty(0, int)
        n = np.add.reduceat(n, first) if len(row) else n
        row, node = row[first], node[first]
    row, node, n = np.concatenate(out_row), np.concatenate(out_node), np.concatenate(out_n)
    order = np.lexsort((node, row))
    return row[order], node[order], n[order]


def _flat(batch: pa.Array, names: tuple[str, str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.asarray(batch.value_lengths().fill_null(0)).astype(np.int64)
    items = batch.flatten()
    return np.repeat(np.arange(len(batch)), sizes), np.asarray(items.field(names[0])).astype(np.int64), np.asarray(items.field(names[1])).astype(np.int64)


@F.arrow_udf(NODES)
def _nodes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        row, node, n = _expand(*_flat(batch, ("leaf", "n")))
        offsets = np.searchsorted(row, np.arange(len(batch) + 1)).astype(np.int32)
        items = pa.StructArray.from_arrays([pa.array(node.astype(np.int32)), pa.array(n)], ["node", "n"])
        yield pa.ListArray.from_arrays(pa.array(offsets), items)


@F.arrow_udf(PLACE)
def _descend(nodes: pa.Array, ranks: pa.Array) -> pa.Array:
    """Leaf that holds the rank-th greatest record of each page, and the rank within it; all rows descend together."""
    row, node, n = _flat(nodes, ("node", "n"))
    key, width = row * (1 << (LEVELS + 1)) + node, 1 << (LEVELS + 1)
    at, left = np.ones(len(nodes), dtype=np.int64), np.asarray(ranks).astype(np.int64)
    base = np.arange(len(nodes), dtype=np.int64) * width
    for _ in range(LEVELS):
        right = 2 * at + 1
        where = np.searchsorted(key, base + right)
        hit = (where < len(key)) & (key[np.minimum(where, len(key) - 1)] == base + right)
        count = np.where(hit, n[np.minimum(where, len(key) - 1)], 0)
        go = left <= count
        at, left = np.where(go, right, right - 1), np.where(go, left, left - count)
    return pa.StructArray.from_arrays([pa.array((at - (1 << LEVELS)).astype(np.int32)), pa.array(left)], ["leaf", "rank"])


def coded(scores: DataFrame, *others: str) -> DataFrame:
    """Valid rows of (source, name, id, value) with their code; columns but these and ``others`` are left out."""
    valid = scores.select(*[c for c in ("source", "name", "id", "value") if c in scores.columns], *others)
    valid = valid.where("source is not null and name is not null and value is not null and not isnan(value)")
    return valid.withColumn("code", _code("value"))


@F.arrow_udf(NODES)
def _sum_nodes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Sum of several node lists of a page; nodes whose count has become 0 are left out."""
    for batch in batches:
        outer, inner = np.asarray(batch.value_lengths()).astype(np.int64), batch.flatten()
        row = np.repeat(np.repeat(np.arange(len(batch)), outer), np.asarray(inner.value_lengths()))
        items = inner.flatten()
        node, n = np.asarray(items.field("node")).astype(np.int64), np.asarray(items.field("n")).astype(np.int64)
        order = np.lexsort((node, row))
        row, node, n = row[order], node[order], n[order]
        first = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (node[1:] != node[:-1])]) if len(row) else np.empty(0, int)
        n = np.add.reduceat(n, first) if len(row) else n
        if (n < 0).any():
            raise ValueError("more records are taken out of a count tree than it counts")
        row, node, n = row[first][n != 0], node[first][n != 0], n[n != 0]
        offsets = np.searchsorted(row, np.arange(len(batch) + 1)).astype(np.int32)
        yield pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([pa.array(node.astype(np.int32)), pa.array(n)], ["node", "n"]))


def build_tree(scores: DataFrame, weight: str | None = None) -> DataFrame:
    """Count tree of a batch (source, name, value): (source, name, page, n, nodes).

    Leaves are counted with map-side combining over (source, name, code), so a hot source is spread over all tasks.
    ``weight`` names a column of 1 for records that are added and -1 for ones taken out; such a tree is a change only.
    """
    rows = coded(scores) if weight is None else coded(scores, weight)
    leaves = rows.groupBy("source", "name", "code").agg((F.count(F.lit(1)) if weight is None else F.sum(weight)).alias("n")).where("n <> 0")
    leaf = F.struct(F.col("code").bitwiseAND((1 << LEVELS) - 1).alias("leaf"), F.col("n").alias("n"))
    pages = leaves.groupBy("source", "name", F.shiftright("code", LEVELS).alias("page"))
    pages = pages.agg(F.sum("n").alias("n"), F.sort_array(F.collect_list(leaf)).alias("leaves"))
    return pages.select("source", "name", "page", "n", _nodes("leaves").alias("nodes"))


def add_batch(tree: DataFrame, batch: DataFrame) -> DataFrame:
    """The tree with the node counts of another batch's tree (or change) added; a page is one row of each."""
    both = tree.unionByName(batch).groupBy("source", "name", "page").agg(F.sum("n").alias("n"), F.collect_list("nodes").alias("l"))
    return both.where("n <> 0").select("source", "name", "page", "n", _sum_nodes("l").alias("nodes"))


class TreeStore:
    """A count tree kept in versions of a folder, brought up to date by batches.

    A batch names the records that are added and those that are taken out (the old version of a record scored again), so
    counts follow the current records without reading any that haven't changed. Versions are committed by a pointer: a
    batch whose run dies has no effect.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.versions = spark, Versions(spark, path)

    def tree(self) -> DataFrame | None:
        """The tree of the newest version."""
        m = self.versions.head()
        return None if m is None else self.spark.read.schema(TREE).parquet(f"{self.versions.path}/{m['tree']}")

    def apply(self, added: DataFrame, removed: DataFrame | None = None) -> int:
        """Count ``added`` (source, name, value) in and ``removed`` out; returns the version committed."""
        m = self.versions.head() or {"version": 0}
        columns = ["source", "name", "value"]
        rows = added.select(*columns, F.lit(1).alias("__w"))
        if removed is not None:
            rows = rows.unionByName(removed.select(*columns, F.lit(-1).alias("__w")))
        batch, old = build_tree(rows, None if removed is None else "__w"), self.tree()
        folder = self.versions.attempt()
        (batch if old is None else add_batch(old, batch)).write.parquet(f"{self.versions.path}/{folder}")
        self.versions.commit(m["version"] + 1, {"tree": folder})
        return m["version"] + 1


def target_leaves(tree: DataFrame, targets: DataFrame) -> DataFrame:
    """Descend to the ceil(keep_fraction * n)-th greatest record of each source.

    ``targets`` (name, keep_fraction) is a small configuration; the result is (source, name, n, target, above, code, rank)
    with ``above`` the records beyond the leaf and ``rank`` the rank within it.
    """
    by_source = Window.partitionBy("source", "name")
    upto = F.sum("n").over(by_source.orderBy(F.desc("page")).rowsBetween(Window.unboundedPreceding, 0))
    # Pages are chosen by their counts alone; node arrays aren't shuffled for it.
    pages = tree.select("source", "name", "page", "n", upto.alias("upto"), F.sum("n").over(by_source).alias("total"))
    asked = pages.join(targets.select("name", "keep_fraction"), "name")
    asked = asked.withColumn("target", F.greatest(F.lit(1).cast("bigint"), F.least("total", F.ceil(F.col("keep_fraction") * F.col("total")).cast("bigint"))))
    chosen = asked.where("keep_fraction > 0 and target <= upto and target > upto - n").withColumn("left", F.expr("target - (upto - n)"))
    chosen = write_table(chosen.select("source", "name", "page", "total", "target", "left"), "target-pages")
    page = tree.select("source", "name", "page", "nodes").join(_near(chosen), ["source", "name", "page"])
    found = page.withColumn("at", _descend("nodes", "left"))
    return found.select(
        "source", "name", F.col("total").alias("n"), "target", (F.col("target") - F.col("at.rank")).alias("above"),
        F.shiftleft("page", LEVELS).bitwiseOR(F.col("at.leaf")).alias("code"), F.col("at.rank").alias("rank"),
    )


def _near(df: DataFrame) -> DataFrame:
    """Hint a broadcast if the written table is small enough; else leave a shuffle join, whose hot keys AQE splits."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def refine(scores: DataFrame, leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Exact cutoffs from the target leaves' records, counted by distinct score.

    Returns (source, name, n, target, cutoff, kept, at_cutoff) and the records of the target leaves.
    """
    inside = coded(scores).join(_near(leaves), ["source", "name", "code"]).drop("code")
    inside = write_table(inside, "leaf-records")
    distinct = inside.groupBy("source", "name", "n", "target", "above", "rank", "value").agg(F.count(F.lit(1)).alias("equal"))
    w = Window.partitionBy("source", "name").orderBy(F.desc("value")).rowsBetween(Window.unboundedPreceding, 0)
    hit = distinct.withColumn("upto", F.sum("equal").over(w)).where("rank <= upto and rank > upto - equal")
    cut = hit.select("source", "name", "n", "target", F.col("value").alias("cutoff"), (F.col("above") + F.col("upto")).alias("kept"), F.col("equal").alias("at_cutoff"))
    return cut, inside


def cutoffs(scores: DataFrame, targets: DataFrame, tree: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Cutoff of each (source, name) and the records exactly at it.

    ``scores`` (source, name, id, value) should be a written table, as it is read twice; ``tree`` may be a stored tree
    that already counts all of ``scores``.
    """
    tree = write_table(build_tree(scores), "count-tree") if tree is None else tree
    leaves = write_table(target_leaves(tree, targets), "target-leaves")
    cut, inside = refine(scores, leaves)
    cut = write_table(cut, "cutoffs")
    at = inside.join(_near(cut.select("source", "name", F.col("cutoff").alias("value"))), ["source", "name", "value"])
    return cut, at.select("source", "name", "id", "value")
