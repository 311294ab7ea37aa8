"""Numeric kernels of clips and frames as Column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the fused quality score: mean, spread and weight of the technical and the aesthetic branch.
TECHNICAL = (0.1107, 0.07355, 0.6104)
AESTHETIC = (-0.08285, 0.03774, 0.3896)


def fused(technical: Column, aesthetic: Column) -> Column:
    """Logistic of the weighted, standardised branches; a missing branch leaves the other as it is."""
    part = lambda v, c: (v - c[0]) / c[1] * c[2]
    both = 1 / (1 + F.exp(-(part(technical, TECHNICAL) + part(aesthetic, AESTHETIC))))
    return F.when(technical.isNull(), aesthetic).when(aesthetic.isNull(), technical).otherwise(both)


def branch_output(mode: Column, technical: Column, aesthetic: Column) -> Column:
    """Score by output mode; a mode whose branch is missing falls back to the first branch there is."""
    first = F.coalesce(technical, aesthetic)
    return F.when(mode == "technical", first).when(mode == "aesthetic", F.coalesce(aesthetic, first)).otherwise(fused(technical, aesthetic))


def array_mean(values: Column) -> Column:
    """Mean of an array, null if empty."""
    total = F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    return F.when(F.size(values) > 0, total / F.size(values))


def linear_head(embedding: Column, weights: Sequence[float], bias: float) -> Column:
    """Linear score of the L2-normalised vector; null for a null or zero vector."""
    e = F.transform(embedding, lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate(e, F.lit(0.0), lambda a, x: a + x * x))
    dot = F.aggregate(F.zip_with(e, F.array(*[F.lit(float(w)) for w in weights]), lambda x, w: x * w), F.lit(0.0), lambda a, x: a + x)
    return F.when(norm > 0, dot / norm + F.lit(float(bias)))


def flow_magnitude(u: Column, v: Column) -> Column:
    """Mean length of flow vectors of one frame pair."""
    return array_mean(F.zip_with(u, v, lambda a, b: F.sqrt(a.cast("double") * a + b.cast("double") * b)))


def uniform_indices(total: Column, wanted: Column) -> Column:
    """``wanted`` frame numbers at even steps; all frames if there are no more; empty without frames."""
    none = F.array().cast("array<int>")
    all_frames = F.sequence(F.lit(0), total - 1)
    some = F.transform(F.sequence(F.lit(0), wanted - 1), lambda i: (i * (total.cast("double") / wanted)).cast("int"))
    return F.when((total <= 0) | (wanted <= 0), none).when(wanted >= total, all_frames).otherwise(some).cast("array<int>")


def frame_pairs(total: Column, wanted: Column) -> Column:
    """First frames of adjacent pairs spread over the clip; none with fewer than two frames, one pair at least else."""
    n = F.greatest(wanted, F.lit(1))
    stride = F.greatest(F.floor(total / (n + 1)), F.lit(1)).cast("int")
    at = F.filter(F.transform(F.sequence(F.lit(0), n - 1), lambda i: (i * stride).cast("int")), lambda x: x + 1 < total)
    return F.when(total < 2, F.array().cast("array<int>")).otherwise(at)


def caption_indices(total: Column, wanted: Column) -> Column:
    """Distinct frame numbers from the first to the last, rounded half to even; the middle one if one is wanted."""
    span = F.greatest(total - 1, F.lit(1))
    spread = F.transform(
        F.sequence(F.lit(0), F.greatest(wanted - 1, F.lit(1))),
        lambda i: F.least(F.bround(i.cast("double") * span / F.greatest(wanted - 1, F.lit(1)), 0).cast("int"), (total - 1).cast("int")),
    )
    one = F.array(F.floor(total / 2).cast("int"))
    return F.when((total <= 0) | (wanted <= 0), F.array().cast("array<int>")).when(wanted == 1, one).otherwise(F.array_sort(F.array_distinct(spread)))


def polygon_area(points: Column) -> Column:
    """Area within a polygon of (x, y) structs; 0 for fewer than three."""
    n = F.size(points)
    cross = F.transform(
        F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))),
        lambda i: F.get(points, i)["x"] * F.get(points, F.pmod(i + 1, F.greatest(n, F.lit(1))))["y"] - F.get(points, F.pmod(i + 1, F.greatest(n, F.lit(1))))["x"] * F.get(points, i)["y"],
    )
    return F.when(n < 3, F.lit(0.0)).otherwise(F.abs(F.aggregate(cross, F.lit(0.0), lambda a, x: a + x)) / 2)


def text_area_ratio(polygons: Column, width: Column, height: Column) -> Column:
    """Share of the picture inside polygons; null polygons are skipped; 0 for a picture without area."""
    areas = F.transform(F.filter(F.coalesce(polygons, F.array().cast("array<array<struct<x:double,y:double>>>")), lambda p: p.isNotNull()), polygon_area)
    total = F.aggregate(areas, F.lit(0.0), lambda a, x: a + F.greatest(x, F.lit(0.0)))
    return F.when((width > 0) & (height > 0), total / (width.cast("double") * height)).otherwise(F.lit(0.0))


def fit_within(width: Column, height: Column, side: Column) -> Column:
    """(width, height) shrunk so that the longer side is at most ``side`` (64 at least); truncated, 1 at least."""
    limit = F.greatest(side, F.lit(64))
    longer = F.greatest(width, height)
    scale = limit.cast("double") / longer
    cut = lambda x: F.greatest((x * scale).cast("int"), F.lit(1))
    big = longer > limit
    return F.struct(F.when(big, cut(width)).otherwise(width).cast("int").alias("width"), F.when(big, cut(height)).otherwise(height).cast("int").alias("height"))


def span_frames(start: Column, end: Column, fps: Column) -> tuple[Column, Column]:
    """First and last frame of a span in seconds; the last is never before the first."""
    first = (start * fps).cast("int")
    return first, F.greatest((end * fps).cast("int") - 1, first)


def safe_ratio(part: Column, rest: Column) -> Column:
    return part / (part + rest + F.lit(1e-9))


def per_minute(now: Column, before: Column, seconds: Column) -> Column:
    """Rate between two readings; null without a span of time."""
    return F.when(seconds > 0, (now - before) * 60.0 / seconds)
