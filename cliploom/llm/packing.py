"""Filling fixed-capacity containers with items of varying length.

Only the histogram of lengths matters for the plan, and it has at most ``capacity`` bars however many items there are.
Shallow combinations of lengths that fill a window just below the capacity are enumerated; non-negative least squares
finds how often each should be used so that together they use up the histogram; the repeat counts are rounded down, and
what is left over is packed greedily, the longest first, each container topped up with the longest lengths that still
fit. The plan is a list of (combination, repeats), again bounded by the capacity, not by the data. Items then take their
places in the plan by their number within their length, which is computed in parallel.

Cases: an item longer than the capacity is divided into full pieces and a rest, no other item is divided; items of
length zero or null take no room and get no container (null); an empty table gives an empty plan; ids must be unique,
repeated rows with the same id are packed as separate items of that id.
"""

from __future__ import annotations

import bisect
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cliploom.session import write_table

#: Unused space the combinations may leave, as a share of the capacity; combinations led by a length; solver steps; pairs
#: of lengths tried for an exact filling.
WINDOW, PER_LENGTH, STEPS, TRIES = 0.01, 3, 200, 64
#: Items numbered within one bucket.
ROWS_PER_BUCKET = 50_000
Plan = list[tuple[tuple[tuple[int, int], ...], int]]


def combinations(histogram: dict[int, int], capacity: int, window: float = WINDOW, per_length: int = PER_LENGTH) -> list[dict[int, int]]:
    """Combinations of up to three distinct lengths that fill the capacity but for the window.

    A leading length is repeated one to four times, a middle one once or not at all, and a closing length, repeated as
    often as it fits, brings the sum into the window. Of those that a length leads, the ``per_length`` fullest are taken,
    equally full ones in an order that differs from length to length; so their number is in proportion to the lengths'.
    """
    lengths = np.array(sorted(k for k in histogram if k <= capacity), dtype=np.int64)
    if not len(lengths):
        return []
    slack = max(1, int(window * capacity))
    weight = np.array([histogram[int(x)] for x in lengths], dtype=np.float64) * lengths
    # Middle lengths are those at even steps of the total length, so heavy parts of the histogram get more of them.
    steps = np.interp(np.linspace(0, weight.sum(), 14)[1:-1], np.cumsum(weight), lengths)
    middles = [0, *dict.fromkeys(int(x) for x in lengths[np.clip(np.searchsorted(lengths, steps), 0, len(lengths) - 1)])]
    found = []
    for times in range(1, 5):
        for middle in middles:
            room = capacity - lengths * times - middle
            ok = (room >= 0) & (middle <= lengths)
            for copies in (0, 1, 2, 3, 5, 8):
                if copies:
                    at = np.searchsorted(lengths, room // copies, "right") - 1
                    close = np.where(at >= 0, lengths[np.maximum(at, 0)], 0)
                    unused = room - close * copies
                    good = ok & (room > 0) & (at >= 0) & (unused <= slack)
                else:
                    close, unused, good = np.zeros_like(lengths), room, ok & (room <= slack)
                i = np.flatnonzero(good)
                found.append(np.column_stack([i, unused[i], lengths[i], np.full(len(i), times), np.full(len(i), middle), close[i], np.full(len(i), copies)]))
    every = np.concatenate(found)
    turn = (every[:, 0] * 2654435761 + every[:, 3] * 40503 + every[:, 4] * 65599 + every[:, 6] * 97) & 0xFFFF
    every = every[np.lexsort((turn, every[:, 1], every[:, 0]))]
    # The same filling comes up in at most a few ways, so a few times as many are looked at.
    place = np.arange(len(every)) - np.searchsorted(every[:, 0], every[:, 0])
    every = every[place < 4 * per_length]
    seen: dict[tuple, dict[int, int]] = {}
    made: Counter = Counter()
    for i, _, lead, times, middle, close, copies in every.tolist():
        if made[i] == per_length:
            continue
        c = {lead: times}
        if middle:
            c[middle] = c.get(middle, 0) + 1
        if copies:
            c[close] = c.get(close, 0) + copies
        key = tuple(sorted(c.items()))
        if key not in seen:
            seen[key] = c
            made[i] += 1
    return list(seen.values())


def solve_counts(combos: list[dict[int, int]], histogram: dict[int, int], capacity: int, steps: int = STEPS) -> np.ndarray:
    """Non-negative least squares: repeats x >= 0 minimising the squared rest of the histogram, weighted by length.

    Solved by accelerated projected gradient on the sparse matrix of lengths by combinations.
    """
    lengths = sorted(histogram)
    index = {x: i for i, x in enumerate(lengths)}
    row = np.array([index[x] for c in combos for x in c], dtype=np.int64)
    col = np.array([j for j, c in enumerate(combos) for _ in c], dtype=np.int64)
    val = np.array([m for c in combos for m in c.values()], dtype=np.float64)
    scale = np.sqrt(np.array(lengths, dtype=np.float64) / capacity)
    target = np.array([histogram[x] for x in lengths], dtype=np.float64) * scale
    val = val * scale[row]
    forward = lambda x: np.bincount(row, val * x[col], len(lengths))
    back = lambda r: np.bincount(col, val * r[row], len(combos))
    # A column scaling makes the steps of all combinations comparable.
    norm = np.sqrt(np.bincount(col, val**2, len(combos)))
    val = val / norm[col]
    v = np.ones(len(combos))
    for _ in range(30):
        v = back(forward(v))
        v /= np.linalg.norm(v) or 1.0
    step = 1.0 / (1.05 * np.linalg.norm(back(forward(v))) + 1e-12)
    x = y = np.zeros(len(combos))
    t = 1.0
    for _ in range(steps):
        nxt = np.maximum(0.0, y - step * back(forward(y) - target))
        u = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y, x, t = nxt + (t - 1) / u * (nxt - x), nxt, u
    return x / norm


def plan(histogram: dict[int, int], capacity: int) -> Plan:
    """(combination as sorted (length, copies), repeats) entries that use up the histogram exactly."""
    left = {int(k): int(n) for k, n in histogram.items() if n > 0 and k > 0}
    if any(k > capacity for k in left):
        raise ValueError("divide items longer than the capacity first")
    out: Plan = []
    combos = combinations(left, capacity)
    if combos:
        x = solve_counts(combos, left, capacity)
        for j in np.argsort(-x, kind="stable"):
            take = min([int(x[j]), *[left.get(k, 0) // m for k, m in combos[j].items()]])
            if take > 0:
                out.append((tuple(sorted(combos[j].items())), take))
                for k, m in combos[j].items():
                    left[k] -= take * m
    out += _greedy({k: n for k, n in left.items() if n}, capacity)
    return out


class _Left:
    """What is left of a histogram: finds the greatest length up to a bound that is still there, used-up ones skipped."""

    def __init__(self, left: dict[int, int]):
        self.lengths = sorted(left)
        self.count = dict(left)
        self.before = list(range(-1, len(self.lengths)))  # [i + 1] leads towards the nearest length that is there

    def upto(self, room: int) -> int:
        """The greatest length of at most ``room``; 0 if there is none."""
        i = bisect.bisect_right(self.lengths, room)
        path = []
        while i and not self.count[self.lengths[i - 1]]:
            path.append(i)
            i = self.before[i] + 1 if self.before[i] < i - 1 else i - 1
        for j in path:
            self.before[j] = i - 1
        return self.lengths[i - 1] if i else 0

    def closing(self, room: int) -> list[int] | None:
        """One or two lengths that fill ``room`` exactly, if they are found among the longest."""
        if self.count.get(room, 0):
            return [room]
        k = self.upto(room - 1)
        for _ in range(TRIES):
            if 2 * k < room or not k:
                return None
            if self.count.get(room - k, 0) > (2 * k == room):
                return [k, room - k]
            k = self.upto(k - 1)
        return None


def _greedy(left: dict[int, int], capacity: int) -> Plan:
    """Longest first, topped up with the longest that fit, an exact filling by the last one or two preferred.

    A filling is repeated as often as the rest of the histogram allows, so the number of steps is bounded by the number
    of lengths, not of items.
    """
    out: Plan = []
    rest = _Left(left)
    while (k := rest.upto(capacity)):
        used: Counter = Counter()
        room = capacity
        while k:
            used[k] += 1
            rest.count[k] -= 1
            room -= k
            if not room:
                break
            if (last := rest.closing(room)) is not None:
                for x in last:
                    used[x] += 1
                    rest.count[x] -= 1
                break
            k = rest.upto(room)
        more = min(rest.count[x] // m for x, m in used.items())
        for x, m in used.items():
            rest.count[x] -= m * more
        out.append((tuple(sorted(used.items())), 1 + more))
    return out


def places(made: Plan) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length, (first item number, first container, copies a container) of the runs of containers it fills."""
    runs: dict[int, list[tuple[int, int, int]]] = {}
    used: Counter = Counter()
    container = 0
    for combo, times in made:
        for k, m in combo:
            runs.setdefault(k, []).append((used[k], container, m))
            used[k] += m * times
        container += times
    return {k: tuple(np.array(x, dtype=np.int64) for x in zip(*r)) for k, r in runs.items()}


def pieces(items: DataFrame, capacity: int, id_column: str = "id", size: str = "size") -> DataFrame:
    """(id, piece, length): items longer than the capacity become full pieces and a rest, the others one piece."""
    whole = F.floor(F.col(size) / capacity).cast("int")
    full = F.when(F.col(size) > capacity, F.array_repeat(F.lit(capacity), whole)).otherwise(F.array().cast("array<int>"))
    rest = F.when(F.col(size) > capacity, F.col(size) % capacity).otherwise(F.col(size)).cast("int")
    parts = F.concat(full, F.when((F.col(size) > capacity) & (rest == 0), F.array().cast("array<int>")).otherwise(F.array(rest)))
    return items.select(F.col(id_column).alias("id"), F.posexplode(parts).alias("piece", "length"))


def _assign(made: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Column:
    @F.arrow_udf(T.LongType())
    def container(lengths: pa.Array, numbers: pa.Array) -> pa.Array:
        k, i = np.asarray(lengths), np.asarray(numbers)
        out = np.empty(len(k), dtype=np.int64)
        for length in np.unique(k):
            first, base, copies = made[int(length)]
            at = k == length
            run = np.searchsorted(first, i[at], "right") - 1
            out[at] = base[run] + (i[at] - first[run]) // copies[run]
        return pa.array(out)

    return container("length", "number")


def pack(items: DataFrame, capacity: int, id_column: str = "id", size: str = "size") -> DataFrame:
    """(id, piece, length, container): ``items`` should be a written table of ids and sizes, as it is read twice."""
    every = pieces(items, capacity, id_column, size)
    sized = every.where("length > 0")
    n = max(1, sized.count())
    buckets = max(1, -(-n // ROWS_PER_BUCKET))
    sized = sized.withColumn("bucket", F.pmod(F.xxhash64("id", "piece"), F.lit(buckets)))
    # At most capacity x buckets counts; a bucket's offset within its length follows from those before it.
    counts = write_table(sized.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n")), "length-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    made = places(plan(histogram, capacity))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("length", "bucket", F.coalesce(before, F.lit(0)).alias("offset"))
    within = F.row_number().over(Window.partitionBy("bucket", "length").orderBy("id", "piece")) - 1
    numbered = sized.withColumn("within", within).join(offsets, ["length", "bucket"])
    numbered = numbered.select("id", "piece", "length", (F.col("offset") + F.col("within")).alias("number"))
    packed = numbered.select("id", "piece", "length", _assign(made).alias("container")) if made else numbered.select("id", "piece", "length", F.lit(0).cast("bigint").alias("container"))
    empty = every.where("length is null or length <= 0").select("id", "piece", F.coalesce("length", F.lit(0)).alias("length"), F.lit(None).cast("bigint").alias("container"))
    return packed.unionByName(empty)
