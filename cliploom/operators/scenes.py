"""Scene spans of videos from frame features, by splitter kind."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliploom import edge
from cliploom.operators import frames


def adaptive(rows: DataFrame, videos: DataFrame, threshold: float, min_scene_len: int, content: str = "content") -> DataFrame:
    """(path, span_idx, start, end): cuts where a frame's content stands out from its neighbours'.

    A video without cuts is one span over its whole duration.
    """
    ratios = frames.neighbour_ratio(rows, content)
    cuts = frames.adaptive_cuts(ratios, threshold, min_scene_len).withColumn("cut", F.lit(1.0))
    spans = frames.boundary_spans(cuts, videos, 1.0, "cut")
    last = videos.select("path", (F.col("total_frames") / F.when(F.col("fps") > 0, F.col("fps"))).alias("__duration"))
    ends = spans.groupBy("path").agg(F.max("span_idx").alias("__last"))
    done = spans.join(ends, "path").join(last, "path")
    end = F.when(F.col("span_idx") == F.col("__last"), F.coalesce("__duration", F.lit(0.0))).otherwise(F.col("end"))
    return done.select("path", "span_idx", "start", end.alias("end"))


def boundaries(rows: DataFrame, videos: DataFrame, threshold: float, model_threshold: float = 0.0, chunk: int = 1024) -> DataFrame:
    """(path, span_idx, start, end) from a model's boundary scores, or from frame differences where there is no model.

    A model threshold of zero stands for the general one.
    """
    if "boundary_score" in rows.columns:
        return frames.boundary_spans(rows, videos, model_threshold or threshold)
    return frames.boundary_spans(frames.differences(rows, "mean_luma", chunk), videos, model_threshold or threshold, "diff")


def scene_spans(rows: DataFrame, videos: DataFrame, kind: str, threshold: float, min_scene_len: int = 15, model_threshold: float = 0.0, content: str = "content") -> DataFrame:
    """Spans by splitter kind; a registered splitter of the kind comes first, an unknown kind is the adaptive one.

    ``transnet_dali`` is the adaptive one where there are no model scores; ``transnet`` then uses differences.
    """
    registered = edge.splitter(kind)
    if registered is not None:
        return registered(rows, videos, threshold=threshold, min_scene_len=min_scene_len, model_threshold=model_threshold)
    if kind == "transnet" or (kind == "transnet_dali" and "boundary_score" in rows.columns):
        return boundaries(rows, videos, threshold, model_threshold)
    return adaptive(rows, videos, threshold, min_scene_len, content)
