"""Keep or drop: reasons of a clip in their order of precedence, and counts over them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cliploom.strategy.context import lookup
from cliploom.strategy.ir import Strategy, compile_strategy


def invalid(scores: Column, names: list[str]) -> Column:
    """Whether a score of the named models is missing, null or NaN; infinite ones are valid. No names, no invalid score."""
    each = [F.try_element_at(scores, F.lit(n)) for n in names]
    bad = F.lit(False)
    for x in each:
        bad = bad | x.isNull() | F.coalesce(F.isnan(x), F.lit(False))
    return bad


def any_invalid(scores: Column) -> Column:
    """Whether any entry of the map is null or NaN, whatever its name."""
    return F.coalesce(F.exists(F.map_values(scores), lambda v: v.isNull() | F.isnan(v)), F.lit(False))


def passes(scores: Column, thresholds: Mapping[str, float]) -> Column:
    """Whether every score reaches its threshold."""
    ok = F.lit(True)
    for name, t in thresholds.items():
        ok = ok & (F.try_element_at(scores, F.lit(name)) >= F.lit(float(t)))
    return ok


def score_reason(scores: Column, thresholds: Mapping[str, float], strategy: Strategy | str | None = None, text: Column | None = None, meta: Column | None = None) -> Column:
    """Reason to drop a scored clip, or null. Without models every clip is kept."""
    if isinstance(strategy, str):
        strategy = compile_strategy(strategy)
    if not thresholds:
        return F.lit(None).cast("string")
    reason = F.when(invalid(scores, list(thresholds)), "scoring_error")
    if strategy is None:
        return reason.when(~passes(scores, thresholds), "score_below_threshold")
    kept, failed = strategy.columns(lookup(scores, thresholds, text, meta))
    return reason.when(failed, "strategy_error").when(~kept, "strategy_filtered")


def drop_reason(
    scored: Column, *, split_failed: Column | None = None, flash_hit: Column | None = None, ocr_hit: Column | None = None,
    init_failed: Column | None = None, record_only: bool = False, source_exists: Column | None = None,
) -> Column:
    """The first reason of the funnel that holds: splitting, flash, text overlay, scoring, a vanished source.

    With ``record_only`` flash and text hits are recorded by the caller but drop nothing.
    """
    yes = lambda c: F.coalesce(c, F.lit(False))
    steps: list[tuple[Column, Column]] = []
    if split_failed is not None:
        steps.append((yes(split_failed), F.lit("split_failed")))
    if not record_only:
        steps += [(yes(c), F.lit(r)) for c, r in ((flash_hit, "flash"), (ocr_hit, "ocr_text")) if c is not None]
    if init_failed is not None:
        steps.append((yes(init_failed), F.lit("scorer_init_failed")))
    steps.append((scored.isNotNull(), scored))
    if source_exists is not None:
        steps.append((~yes(source_exists), F.lit("source_missing")))
    reason = F.lit(None).cast("string")
    for condition, value in reversed(steps):
        reason = F.when(condition, value).otherwise(reason)
    return reason


def decide(clips: DataFrame, reason: Column) -> DataFrame:
    """``clips`` with reason and keep."""
    return clips.withColumn("reason", reason).withColumn("keep", F.col("reason").isNull())


def reason_histogram(decided: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Clips by outcome; dropped ones without a reason count as ``filtered``."""
    label = F.when(F.col("keep"), "kept").otherwise(F.coalesce("reason", F.lit("filtered")))
    return decided.groupBy(*(by or []), label.alias("outcome")).agg(F.count(F.lit(1)).alias("clips"))


def funnel(decided: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Clips left after each stage, in one pass."""
    r = F.coalesce(F.col("reason"), F.lit(""))
    return decided.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("files"),
        F.count_if(~r.isin("split_failed")).alias("clips_after_scene"),
        F.count_if(~r.isin("split_failed", "flash")).alias("clips_after_flash"),
        F.count_if(~r.isin("split_failed", "flash", "ocr_text")).alias("clips_after_ocr"),
        F.count_if(~r.isin("split_failed", "flash", "ocr_text", "scorer_init_failed")).alias("clips_scored"),
        F.count_if("keep").alias("clips_kept"),
    )
