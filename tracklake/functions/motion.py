"""Episodes, motion score and evidence fusion on arrays, as folds inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tracklake.params import FusionParams, MotionParams

EPISODE = "array<struct<s:int,e:int>>"


def smoothed(d: Column, k: int = 3) -> Column:
    """Centred moving average with repeated ends; a series shorter than k stays as it is."""
    if k <= 1:
        return d
    n = F.size(d)

    def at(i: Column) -> Column:
        return F.element_at(d, (F.greatest(F.lit(0), F.least(n - 1, i)) + 1).cast("int"))

    def mean(x: Column, i: Column) -> Column:
        total = F.lit(0.0)
        for j in range(k):
            total = total + at(i + (j - k // 2))
        return total / k

    return F.when(n < k, d).otherwise(F.transform(d, mean))


def episodes(d: Column, fps: float, p: MotionParams) -> Column:
    """``array<struct<s, e>>`` of a smoothed series; ``e`` is null for one that has not ended.

    An episode starts when the value falls below ``near_thr`` within the look-back of one above
    ``far_thr``, and ends when it rises above ``far_thr`` again.
    """
    lookback = max(1, round(p.lookback_s * fps))
    state = "struct<i:int,far:int,start:int,out:array<struct<s:int,e:int>>>"
    zero = F.struct(F.lit(0).alias("i"), F.lit(-(10**9)).alias("far"), F.lit(None).cast("int").alias("start"), F.array().cast(EPISODE).alias("out")).cast(state)

    def step(a: Column, v: Column) -> Column:
        idle, i = a["start"].isNull(), a["i"]
        beyond = v > p.far_thr
        starts = idle & ~beyond & (v < p.near_thr) & (i - a["far"] <= lookback)
        ends = ~idle & beyond
        done = F.array(F.struct(a["start"].alias("s"), i.alias("e")))
        return F.struct(
            (i + 1).alias("i"), F.when(beyond, i).otherwise(a["far"]).alias("far"),
            F.when(starts, i).when(ends, F.lit(None)).otherwise(a["start"]).alias("start"), F.when(ends, F.concat(a["out"], done)).otherwise(a["out"]).alias("out"),
        ).cast(state)

    def finish(a: Column) -> Column:
        rest = F.array(F.struct(a["start"].alias("s"), F.lit(None).cast("int").alias("e")))
        return F.when(a["start"].isNull(), a["out"]).otherwise(F.concat(a["out"], rest))

    return F.aggregate(d, zero, step, finish)


def motion_score(eps: Column, n: Column, fps: float, window: int, p: MotionParams) -> Column:
    """Score in [0, 1] that the last ``window`` of ``n`` frames hold a puff-like motion."""
    low, high = p.min_dwell_s * fps, p.max_dwell_s * fps
    since = F.greatest(F.lit(0), n - window)

    def one(x: Column) -> Column:
        end = F.coalesce(x["e"], n)
        dwell = end - x["s"]
        fits = (dwell >= low) & (dwell <= high)
        value = F.when(x["e"].isNotNull(), F.when(fits, 1.0).otherwise(0.2)).otherwise(F.when(fits, 0.7).when(dwell > high, 0.2).otherwise(0.3))
        return F.when(end > since, value).otherwise(0.0)

    score = F.coalesce(F.array_max(F.transform(eps, one)), F.lit(0.0))
    busy = F.size(F.filter(eps, lambda x: x["s"] >= n - round(p.busy_window_s * fps))) > p.busy_max_approaches
    return F.when(busy, score * p.busy_penalty).otherwise(score)


def fuse(obj: Column, mot: Column, p: FusionParams) -> Column:
    """``struct(decision, score, reason)``: agreement first, then a strong object, then a strong motion."""
    row = lambda d, s, r: F.struct(F.lit(d).alias("decision"), s.cast("double").alias("score"), F.lit(r).alias("reason"))
    weak = F.sqrt(F.greatest(obj, F.lit(0.0)) * F.greatest(mot, F.lit(0.0)))
    return (
        F.when((obj >= p.obj_thr) & (mot >= p.mot_thr), row(True, F.sqrt(F.greatest(obj * mot, F.lit(0.0))), "object+motion"))
        .when(obj >= p.obj_strong, row(True, obj, "object"))
        .when(mot >= p.mot_strong, row(True, mot, "motion"))
        .otherwise(row(False, weak, ""))
    )
