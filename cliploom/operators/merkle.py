"""Incremental processing by a Merkle tree over key-range hashes.

The 64-bit hash of a record's key places it in one of ``FANOUT ** depth`` equal ranges of hashes, the leaves; a node of a
level above stands for the range of its FANOUT children. A node's digest is the number of records in its range and two
64-bit sums (exclusive or) of their hashes over keys and compared values, so it follows from its children's digests
alone, and the nodes of one level compare whatever the depth of either tree. Comparing the current tree with the saved
one from the root down reaches only ranges whose content differs, and only the records of those leaves are read again
and compared one by one.

:class:`MerkleStore` keeps the tree of the last published state together with the records' compared values, both laid out
by range, so that a run reads from them no more than the differing ranges. The depth follows from the number of records
(ROWS_PER_LEAF in a leaf); nothing that grows with the data is broadcast by request or collected.

Cases: null is a value of its own, in keys as in values; NaN equals NaN; -0.0 equals 0.0; identical copies count once
(:func:`latest`); an empty current table yields no rows; an empty or absent saved table yields all rows. Columns that are
neither key nor value are carried along and not compared.
"""

from __future__ import annotations

import functools
import math
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cliploom.operators.versions import Versions
from cliploom.session import shared_dir, write_table

FANOUT_BITS = 4
FANOUT = 1 << FANOUT_BITS
#: Records a leaf should hold on average, and records that share a folder (a range of hashes) of the stored table.
ROWS_PER_LEAF, ROWS_PER_RANGE, MAX_RANGE_LEVEL = 16, 1_000_000, 3
LEAF, HASH, RANGE, KIND = "__leaf", "__hash", "__range", "__kind"
TREE = "node bigint, n bigint, a bigint, b bigint, level int"


def depth_for(n: int) -> int:
    """Depth at which a leaf holds at most ROWS_PER_LEAF of ``n`` records on average."""
    return max(1, min(15, math.ceil(math.log(max(n, 1) / ROWS_PER_LEAF, FANOUT)))) if n > ROWS_PER_LEAF else 1


def range_level_for(n: int) -> int:
    """Level of the tree whose nodes are folders: at most FANOUT ** MAX_RANGE_LEVEL = 4,096 of them."""
    return min(MAX_RANGE_LEVEL, math.ceil(math.log(n / ROWS_PER_RANGE, FANOUT))) if n > ROWS_PER_RANGE else 0


def canonical(df: DataFrame, columns: Sequence[str]) -> Column:
    """One string per row that differs whenever a value differs, null included."""
    parts, types = [], dict(df.dtypes)
    for c in columns:
        x = F.col(f"`{c}`")
        if types[c] in ("double", "float"):
            x = F.when(x == 0, F.lit(0.0).cast(types[c])).otherwise(x)
        x = F.to_json(F.struct(x.alias("v"))) if "<" in types[c] else x.cast("string")
        parts.append(F.when(F.col(f"`{c}`").isNull(), F.lit("-")).otherwise(F.concat(F.length(x).cast("string"), F.lit(":"), x)))
    return F.concat_ws("|", *parts)


def node_at(level: int, bits: Column | str = HASH) -> Column:
    """Node of a level (the leading bits of the key's hash); 0 at the root."""
    return F.shiftrightunsigned(bits, 64 - FANOUT_BITS * level) if level else F.lit(0).cast("bigint")


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The record with the greatest ``order`` of each key; of equal ones, the greatest by its canonical text.

    The aggregate combines on the map side, so a key with a third of all rows is no hot spot.
    """
    rest = [c for c in df.columns if c not in keys]
    # Maps cannot be ordered; the tie-break is text, which compares for every type.
    best = F.max_by(F.struct(*[F.col(f"`{c}`") for c in rest]), F.struct(*[F.col(f"`{c}`") for c in order], canonical(df, rest)))
    return df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(best.alias("__best")).select(*[F.col(f"`{k}`") for k in keys], *[F.col(f"__best.`{c}`").alias(c) for c in rest])


def keyed(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """``df`` with ``__key`` and ``__value`` (canonical texts) and the key's hash."""
    named = df.withColumn("__key", canonical(df, keys)).withColumn("__value", canonical(df, values))
    return named.withColumn(HASH, F.xxhash64("__key"))


def _nodes(rows: DataFrame, depth: int) -> DataFrame:
    """(level, node, n, a, b) from (__hash, __key, __value): leaves first, then every level from the leaves."""
    row = F.struct("__key", "__value")
    leaves = (
        rows.select(node_at(depth).alias(LEAF), F.xxhash64(F.lit("a"), row).alias("a"), F.xxhash64(F.lit("b"), row).alias("b"))
        .groupBy(LEAF)
        .agg(F.count(F.lit(1)).alias("n"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    )
    levels = F.array(*[F.struct(F.lit(k).alias("level"), F.shiftrightunsigned(LEAF, FANOUT_BITS * (depth - k)).alias("node")) for k in range(depth + 1)])
    each = leaves.select(F.inline(levels), "n", "a", "b")
    return each.groupBy("level", "node").agg(F.sum("n").alias("n"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))


def tree(df: DataFrame, keys: Sequence[str], values: Sequence[str], depth: int) -> DataFrame:
    """The Merkle tree of ``df``, whose keys are unique: (level, node, n, a, b), level 0 the root."""
    return _nodes(keyed(df, keys, values), depth)


def _differing(current: DataFrame, saved: DataFrame | None, level: int, above: DataFrame | None) -> DataFrame:
    """(node) of ``level`` whose digests differ in the two trees, below the nodes ``above`` only."""
    at = lambda t, sign: t.where(F.col("level") == level).select("node", (F.col("n") * sign).alias("n"), "a", "b")
    both = at(current, 1) if saved is None else at(current, 1).unionByName(at(saved, -1))
    if above is not None:
        both = both.withColumn("up", F.shiftrightunsigned("node", FANOUT_BITS)).join(above.select(F.col("node").alias("up")), "up", "left_semi")
    sums = both.groupBy("node").agg(F.sum("n").alias("n"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    return sums.where("n <> 0 or a <> 0 or b <> 0").select("node")


def changed_leaves(current: DataFrame, saved: DataFrame | None, depth: int) -> DataFrame:
    """Descend from the root where digests differ; the leaves reached, in either tree."""
    found = None
    for level in range(depth + 1):
        found = _differing(current, saved, level, found)
    return found.select(F.col("node").alias(LEAF))


def changed_records(current: DataFrame, saved: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Added or changed records of ``current`` against ``saved``, whose tree is stored first; the keys of both are unique."""
    store = MerkleStore(current.sparkSession, f"{shared_dir(current.sparkSession)}/cliploom/merkle-{uuid.uuid4().hex}", keys, values)
    store.bootstrap(saved)
    return store.changes(current).where(F.col(KIND) != "deleted").drop(KIND)


class MerkleStore:
    """Published output, the records it covers and their tree, committed together.

    Each run writes a folder of its own and then moves one small pointer file into place; the move is the commit. A run
    that dies before it leaves the old pointer, so the next run extracts the same records again and none twice. Only
    changed records are written: the saved state is the newest version of each key over the listed folders, which are
    laid out by range of hashes and sorted by hash. After ``compact_after`` versions they are merged into one.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], values: Sequence[str], compact_after: int = 16):
        self.spark, self.path, self.keys, self.values, self.compact_after = spark, path.rstrip("/"), list(keys), list(values), compact_after
        self.versions = Versions(spark, self.path)

    def manifest(self) -> dict:
        """The committed pointer with the greatest number, or the empty state."""
        return self.versions.head() or {"version": 0, "rows": [], "n": 0, "depth": 1, "range_level": 0, "tree": None}

    def _rows(self, m: dict, ranges: list[int] | None = None, leaves: DataFrame | None = None, depth: int = 0) -> DataFrame:
        """Newest record of each key, deleted ones included, of the given folders of ranges and leaves only."""
        read = self.spark.read.schema(T.StructType.fromJson(m["schema"]))
        parts = [read.parquet(f"{self.path}/{folder}/rows").withColumn("__version", F.lit(v)) for v, folder in m["rows"]]
        rows = functools.reduce(DataFrame.unionByName, parts)
        if ranges is not None:
            rows = rows.where(F.col(RANGE).isin(ranges))
        if leaves is not None:
            rows = rows.withColumn(LEAF, node_at(depth)).join(leaves, LEAF, "left_semi")
        newest = F.max_by(F.struct("__value", "__deleted", *[F.col(f"`{c}`") for c in (*self.keys, *self.values)]), "__version")
        best = rows.groupBy(HASH, "__key").agg(newest.alias("__r")) if len(parts) > 1 else rows.select(HASH, "__key", F.struct("__value", "__deleted", *[F.col(f"`{c}`") for c in (*self.keys, *self.values)]).alias("__r"))
        return best.select(HASH, "__key", "__r.*")

    def saved(self, manifest: dict | None = None) -> DataFrame | None:
        """The saved records, without deleted ones."""
        m = manifest or self.manifest()
        if not m["rows"]:
            return None
        return self._rows(m).where("not __deleted").select(*[F.col(f"`{c}`") for c in (*self.keys, *self.values)])

    def _write(self, rows: DataFrame, folder: str, level: int) -> dict:
        """Rows by range, each file an interval of hashes and sorted by it; returns their schema."""
        names = [HASH, "__key", "__value", "__deleted", *self.keys, *self.values]
        placed = rows.select(*[F.col(f"`{c}`") for c in names]).withColumn(RANGE, node_at(level))
        if level:
            placed = placed.repartition(F.col(RANGE), node_at(level + 1))
        placed.sortWithinPartitions(HASH).write.partitionBy(RANGE).parquet(f"{self.path}/{folder}")
        return placed.schema.jsonValue()

    def _write_tree(self, nodes: DataFrame, folder: str) -> None:
        nodes.write.partitionBy("level").parquet(f"{self.path}/{folder}")

    def bootstrap(self, records: DataFrame) -> None:
        """Version 1 from records handled elsewhere, which count as published; they have no output."""
        if self.versions.head() is not None:
            raise RuntimeError("the store has a version already")
        folder = self.versions.attempt()
        kept = keyed(records.select(*[F.col(f"`{c}`") for c in (*self.keys, *self.values)]), self.keys, self.values)
        # Most stores need no division into ranges, so that is done only when the number of records is known to need it.
        at, level = f"{folder}/rows", 0
        schema = self._write(kept.withColumn("__deleted", F.lit(False)), at, level)
        rows = self.spark.read.schema(T.StructType.fromJson(schema)).parquet(f"{self.path}/{at}")
        n = rows.count()
        if range_level_for(n):
            level = range_level_for(n)
            self._write(rows, f"{folder}/ranged/rows", level)
        self._write_tree(_nodes(rows, depth_for(n)), f"{folder}/tree")
        self.versions.commit(1, {"rows": [[1, f"{folder}/ranged" if level else folder]], "schema": schema, "n": n, "depth": depth_for(n), "range_level": level, "tree": f"{folder}/tree", "output": None})

    def _compare(self, current: DataFrame) -> tuple[DataFrame, DataFrame, int, dict]:
        """(changes, current rows, their number, manifest); the source is read once."""
        m = self.manifest()
        level = m["range_level"]
        now = keyed(current, self.keys, self.values).withColumn(RANGE, node_at(level))
        if level:
            now = now.repartition(F.col(RANGE), node_at(level + 1)).sortWithinPartitions(HASH)
        path = f"{shared_dir(self.spark)}/cliploom/current-{uuid.uuid4().hex}"
        now.write.partitionBy(RANGE).parquet(path)
        now = self.spark.read.schema(now.schema).parquet(path)
        n = now.count()
        self._tree = write_table(_nodes(now, depth_for(n)), "merkle")
        if not m["rows"]:
            return now.drop(RANGE, HASH, "__key", "__value").withColumn(KIND, F.lit("new")), now, n, m
        old = self.spark.read.schema(TREE).parquet(f"{self.path}/{m['tree']}")
        depth = min(depth_for(n), m["depth"])
        # Ranges are compared here: at most FANOUT ** MAX_RANGE_LEVEL nodes of each tree.
        new, was = ({r["node"]: (r["n"], r["a"], r["b"]) for r in t.where(F.col("level") == level).select("node", "n", "a", "b").collect()} for t in (self._tree, old))
        ranges = sorted(k for k in new.keys() | was.keys() if new.get(k) != was.get(k))
        top = self.spark.createDataFrame([(r,) for r in ranges], "node bigint")
        for k in range(level + 1, depth + 1):
            top = _differing(self._tree, old, k, top)
        leaves = write_table(top.select(F.col("node").alias(LEAF)), "leaves")
        at = max(depth, level)
        inside = now.where(F.col(RANGE).isin(ranges)).withColumn(LEAF, node_at(at)).join(leaves, LEAF, "left_semi")
        fields = current.columns
        inside = inside.select(HASH, "__key", F.col("__value").alias("__new"), F.struct(*[F.col(f"`{c}`") for c in fields]).alias("__now"))
        before = self._rows(m, ranges, leaves, at).where("not __deleted")
        before = before.select(HASH, "__key", F.col("__value").alias("__old"), F.struct(*[F.col(f"`{c}`") for c in (*self.keys, *self.values)]).alias("__was"))
        joined = inside.join(before, [HASH, "__key"], "full_outer").where(~F.col("__new").eqNullSafe(F.col("__old")))
        kind = F.when(F.col("__old").isNull(), "new").when(F.col("__new").isNull(), "deleted").otherwise("changed")
        known = set(self.keys) | set(self.values)
        out = [F.coalesce(F.col(f"__now.`{c}`"), F.when(F.col("__new").isNull(), F.col(f"__was.`{c}`"))).alias(c) if c in known else F.col(f"__now.`{c}`").alias(c) for c in fields]
        return joined.select(*out, kind.alias(KIND)), now, n, m

    def changes(self, current: DataFrame) -> DataFrame:
        """``current``'s records that are new or changed, and the saved ones that are gone, with ``__kind``; columns of ``current``."""
        return self._compare(current)[0]

    def run(self, current: DataFrame, process: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Process what is new or changed and publish output, records and tree as one version; returns the output.

        Without any change, deletions included, no version is made and the output is empty.
        """
        changes, _, n, m = self._compare(current)
        found = write_table(changes, "changes")
        todo = found.where(F.col(KIND) != "deleted").drop(KIND)
        if m["version"] and found.isEmpty():
            return process(todo)
        version, folder = m["version"] + 1, self.versions.attempt()
        process(todo).write.parquet(f"{self.path}/{folder}/output")
        kept = keyed(found.select(*[F.col(f"`{c}`") for c in (*self.keys, *self.values)], (F.col(KIND) == "deleted").alias("__deleted")), self.keys, self.values)
        level = m["range_level"] if m["rows"] else range_level_for(n)
        listed = [*m["rows"], [version, folder]]
        if len(listed) > self.compact_after:
            schema = self._write(kept, f"{folder}/changed/rows", level)
            full = self._rows({"rows": [*m["rows"], [version, f"{folder}/changed"]], "schema": schema}).where("not __deleted")
            level = range_level_for(n)
            self._write(full, f"{folder}/rows", level)
            listed = [[version, folder]]
        else:
            schema = self._write(kept, f"{folder}/rows", level)
        self._write_tree(self._tree, f"{folder}/tree")
        self.versions.commit(version, {"rows": listed, "schema": schema, "n": n, "depth": depth_for(n), "range_level": level, "tree": f"{folder}/tree", "output": f"{folder}/output"})
        return self.spark.read.parquet(f"{self.path}/{folder}/output")
