"""Events against marked intervals: which event stands for which interval, and what that says of the alarms.

An interval holds ``keys``, ``idx`` (unique within the keys), ``start`` and ``stop``; the stop is the first step behind it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklake.storage import discard, materialize


def _in_cells(rows: DataFrame, keys: list[str], side: str, cell: int) -> DataFrame:
    """A row for each stretch of ``cell`` steps that an interval reaches; intervals without a step have none."""
    cells = F.sequence(F.floor(F.col("start") / cell), F.floor((F.col("stop") - 1) / cell))
    named = [F.col(c).alias(f"{side}_{c}") for c in ("idx", "start", "stop")]
    return rows.where("stop > start").select(*keys, *named, F.explode(cells).alias("cell"))


def overlaps(events: DataFrame, marks: DataFrame, keys: list[str], cell: int = 64) -> DataFrame:
    """``keys, e_idx, e_start, e_stop, m_idx, m_start, m_stop, shared`` of all pairs that share a step.

    Intervals meet in stretches of ``cell`` steps, so a key of any length is spread over tasks and a long
    interval meets no more rows than lie beside it. A pair counts in the stretch where its overlap begins.
    """
    met = _in_cells(events, keys, "e", cell).join(_in_cells(marks, keys, "m", cell), [*keys, "cell"])
    first, behind = F.greatest("e_start", "m_start"), F.least("e_stop", "m_stop")
    return met.where((first < behind) & (F.floor(first / cell) == F.col("cell"))).withColumn("shared", behind - first).drop("cell")


def interval_iou(shared: str = "shared") -> Column:
    s = F.col(shared)
    return s / (F.col("e_stop") - F.col("e_start") + F.col("m_stop") - F.col("m_start") - s)


def assigned(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """One-to-one pairs, longest overlap first, then earliest event, earliest interval, and by idx.

    In each round the pairs that are the first of both their ends are taken, and pairs of taken ends leave: that is what taking one
    pair after the other in that order gives, for all keys at once.
    """
    rank = F.struct((-F.col("shared")).alias("down"), "e_start", "m_start", "e_idx", "m_idx")
    left, taken, spent = materialize(pairs.withColumn("rank", rank), "overlaps"), [], []
    while not left.isEmpty():
        ends = [left.groupBy(*keys, e).agg(F.min("rank").alias("rank")) for e in ("e_idx", "m_idx")]
        both = materialize(left.join(ends[0], [*keys, "e_idx", "rank"], "left_semi").join(ends[1], [*keys, "m_idx", "rank"], "left_semi"), "taken")
        taken.append(both)
        rest = materialize(left.join(both, [*keys, "e_idx"], "left_anti").join(both, [*keys, "m_idx"], "left_anti"), "overlaps")
        spent.append(left)
        left = rest
    out = materialize(reduce(DataFrame.unionByName, taken, left).drop("rank"), "assigned")
    discard(left, *taken, *spent)
    return out


def event_report(events: DataFrame, marks: DataFrame, matched: DataFrame, steps: DataFrame, fps: float) -> DataFrame:
    """``n_events, n_marked, n_hit, precision, recall, f1, false_alarms, camera_hours, false_alarms_per_hour, mean_delay``.

    ``matched`` are pairs of ``assigned``; ``steps`` holds the number of steps (n) of each camera's recording. The delay is in
    seconds, from the start of an interval to that of its event; rates without a denominator are null.
    """
    n = events.agg(F.count("*").alias("n_events")).join(marks.agg(F.count("*").alias("n_marked")))
    n = n.join(matched.agg(F.count("*").alias("n_hit"), (F.avg(F.col("e_start") - F.col("m_start")) / fps).alias("mean_delay")))
    n = n.join(steps.agg((F.coalesce(F.sum("n"), F.lit(0)) / (fps * 3600)).alias("camera_hours")))
    alarms = F.col("n_events") - F.col("n_hit")
    rates = {"precision": F.try_divide("n_hit", "n_events"), "recall": F.try_divide("n_hit", "n_marked"), "f1": F.try_divide(2 * F.col("n_hit"), F.col("n_events") + F.col("n_marked"))}
    return n.withColumns(rates | {"false_alarms": alarms, "false_alarms_per_hour": F.try_divide(alarms.cast("double"), F.col("camera_hours"))}).select(
        "n_events", "n_marked", "n_hit", "precision", "recall", "f1", "false_alarms", "camera_hours", "false_alarms_per_hour", "mean_delay"
    )
