"""Filters and scene boundaries from per-frame features.

Frame tables have (path, frame_idx, ...), one row per frame. Order is the frame index, so results don't depend on how
rows are stored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cliploom.operators.ordered import BLOCK, with_previous


def sampled(frames: DataFrame, stride: int, index: str = "frame_idx") -> DataFrame:
    """Every ``stride``-th frame from frame 0; a stride below 1 is 1."""
    return frames.where(F.pmod(F.col(index), F.lit(max(int(stride), 1))) == 0)


def flash(frames: DataFrame, stride: int, delta: float, max_ratio: float, luma: str = "mean_luma") -> DataFrame:
    """(path, n_samples, n_events, flash_ratio, flash_hit): jumps of brightness between sampled frames.

    The ratio is taken of the samples, of which the first can't be an event.
    """
    seen = with_previous(sampled(frames, stride).select("path", "frame_idx", luma), ["path"], "frame_idx", [luma])
    counts = seen.groupBy("path").agg(F.count(F.lit(1)).alias("n_samples"), F.count_if(F.abs(F.col(luma) - F.col(f"prev_{luma}")) >= delta).alias("n_events"))
    ratio = F.col("n_events") / F.col("n_samples")
    return counts.select("path", "n_samples", "n_events", ratio.alias("flash_ratio"), (ratio >= max_ratio).alias("flash_hit"))


def text_hit(frames: DataFrame, stride: int, threshold: float, ratio: str = "text_ratio") -> DataFrame:
    """(path, ocr_hit): whether any sampled frame has that much text."""
    return sampled(frames, stride).groupBy("path").agg(F.coalesce(F.bool_or(F.col(ratio) >= threshold), F.lit(False)).alias("ocr_hit"))


def flag(clips: DataFrame, hits: DataFrame, column: str) -> DataFrame:
    """``clips`` with a hit column; clips without frames have no hit."""
    found = hits.select("path", F.col(column).alias("__hit"))
    return clips.join(found, "path", "left").withColumn(column, F.coalesce("__hit", F.lit(False))).drop("__hit")


def differences(frames: DataFrame, gray: str, chunk: int) -> DataFrame:
    """(path, frame_idx, diff): change against the frame before, 0 at the start of a chunk, over the chunk's maximum."""
    rows = frames.select("path", "frame_idx", F.col(gray).alias("g")).withColumn("chunk", F.floor(F.col("frame_idx") / max(int(chunk), 1)))
    w = Window.partitionBy("path", "chunk")
    before = F.lag("g").over(w.orderBy("frame_idx"))
    raw = F.coalesce(F.abs(F.col("g") - before), F.lit(0.0))
    return rows.withColumn("raw", raw).select("path", "frame_idx", (F.col("raw") / (F.max("raw").over(w) + F.lit(1e-6))).alias("diff"))


def neighbour_ratio(frames: DataFrame, content: str, reach: int = 2) -> DataFrame:
    """(path, frame_idx, ratio): a frame's content value over the mean of up to ``reach`` frames on each side.

    Blocks overlap by the reach, so a path with most of all frames is divided.
    """
    rows = frames.select("path", "frame_idx", F.col(content).cast("double").alias("c")).withColumn("b", F.floor(F.col("frame_idx") / BLOCK))
    copies = F.array_distinct(F.array(F.col("b"), F.floor((F.col("frame_idx") - reach) / BLOCK), F.floor((F.col("frame_idx") + reach) / BLOCK)))
    spread = rows.withColumn("block", F.explode(copies))
    w = Window.partitionBy("path", "block").orderBy("frame_idx").rowsBetween(-reach, reach)
    others, n = F.sum("c").over(w) - F.col("c"), F.count("c").over(w) - 1
    near = spread.withColumn("mean", F.when(n > 0, others / n)).where("b = block")
    ratio = F.when(F.col("mean") > 1e-5, F.least(F.col("c") / F.col("mean"), F.lit(255.0))).when(F.col("c") >= 15.0, F.lit(255.0)).otherwise(F.lit(0.0))
    return near.select("path", "frame_idx", ratio.alias("ratio"))


def boundary_spans(scores: DataFrame, videos: DataFrame, threshold: float, score: str = "boundary_score") -> DataFrame:
    """(path, span_idx, start, end) in seconds, from frames whose score reaches the threshold.

    ``videos``: (path, fps, total_frames). Each boundary after the first position ends a span; the last span ends at the
    last frame. A video without frames has the one span (0, 0).
    """
    cuts = scores.where(F.col(score) >= threshold).select("path", F.col("frame_idx").cast("bigint").alias("pos")).where("pos > 0")
    ends = videos.select("path", F.greatest(F.col("total_frames").cast("bigint") - 1, F.lit(0)).alias("pos"))
    edges = cuts.unionByName(ends).distinct().withColumn("at", F.col("pos"))
    edges = edges.join(videos.select("path", "fps", F.greatest(F.col("total_frames").cast("bigint") - 1, F.lit(0)).alias("stop")), "path").where("pos <= stop")
    spans = with_previous(edges, ["path"], "at", ["pos"])
    spans = spans.withColumn("prev_pos", F.coalesce("prev_pos", F.lit(0)))
    w = Window.partitionBy("path").orderBy("at")
    rate = F.when(F.col("fps") > 0, F.col("fps"))
    return spans.select("path", (F.row_number().over(w) - 1).alias("span_idx"), F.coalesce(F.col("prev_pos") / rate, F.lit(0.0)).alias("start"), F.coalesce(F.col("pos") / rate, F.lit(0.0)).alias("end"))


def _long_enough(threshold: float, least: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("frame_idx")
        kept, last = [], 0
        for i in pdf.loc[pdf["ratio"] >= threshold, "frame_idx"].to_numpy():
            if i - last >= least:
                kept.append(int(i))
                last = int(i)
        return pd.DataFrame({"path": [pdf["path"].iloc[0]] * len(kept), "frame_idx": np.array(kept, dtype=np.int64)})

    return run


def adaptive_cuts(ratios: DataFrame, threshold: float, min_scene_len: int) -> DataFrame:
    """(path, frame_idx): cuts where the neighbour ratio is high, none sooner than ``min_scene_len`` after the one before.

    The rule is sequential, but only frames over the threshold reach the per-video step.
    """
    return ratios.where(F.col("ratio") >= threshold).groupBy("path").applyInPandas(_long_enough(threshold, max(int(min_scene_len), 1)), "path string, frame_idx bigint")
