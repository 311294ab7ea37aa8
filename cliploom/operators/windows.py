"""Scene spans and sliding frame windows, as nested columns of a video row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cliploom.functions.kernels import span_frames


def sliding(first: Column, last: Column, length: int, stride: int) -> Column:
    """Windows [s, s + length - 1] inside the scene, every ``stride`` frames; length and stride are 1 at least."""
    length, stride = max(int(length), 1), max(int(stride), 1)
    starts = F.when(last - length + 1 >= first, F.sequence(first, last - length + 1, F.lit(stride))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda s: F.array(s, s + length - 1))


def scene_windows(spans: Column, fps: Column, length: int, stride: int) -> Column:
    """Array of (start_frame, end_frame, num_windows, windows) of each span; short scenes stay, without windows."""

    def scene(span: Column) -> Column:
        first, last = span_frames(span["start"], span["end"], fps)
        found = sliding(first, last, length, stride)
        return F.struct(first.alias("start_frame"), last.alias("end_frame"), F.size(found).alias("num_windows"), found.alias("windows"))

    return F.transform(spans, scene)


def video_metadata(videos: DataFrame, length: int, stride: int) -> DataFrame:
    """``videos`` (path, fps, total_frames, width, height, spans?) with duration, scenes, windows and their number.

    Without spans the whole video is one; without a positive frame rate there are neither duration nor windows.
    """
    known = F.col("fps") > 0
    duration = F.when(known, F.col("total_frames") / F.col("fps"))
    whole = F.array(F.struct(F.lit(0.0).alias("start"), duration.alias("end")))
    given = F.col("spans") if "spans" in videos.columns else F.lit(None).cast("array<struct<start:double,end:double>>")
    spans = F.when(F.size(given) > 0, given).otherwise(whole)
    scenes = F.when(known, scene_windows(spans, F.col("fps"), length, stride))
    done = videos.withColumn("duration_sec", duration).withColumn("scenes", scenes)
    return done.withColumn("windows", F.flatten(F.transform("scenes", lambda s: s["windows"]))).withColumn("num_windows", F.when(known, F.size("windows")))
