"""Track sequences: sessions, gap filling, windows, decisions and events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracklake.functions.motion import episodes, fuse, motion_score, smoothed
from tracklake.params import EventParams, FusionParams, MotionParams, OnlineParams
from tracklake.storage import discard, materialize

FILL = 3.0  # distance of a hand that was never seen (fixed value)


BASE_FEATURES = (
    "d_left", "d_right", "d_min", "d_min_delta", "l_wrist_above_shoulder", "r_wrist_above_shoulder", "l_elbow_angle", "r_elbow_angle",
    "nose_conf", "l_wrist_conf", "r_wrist_conf", "present",
)  # fmt: skip  (fixed names and order)
FILLED = {"d_left": FILL, "d_right": FILL, "d_min": FILL, "l_elbow_angle": 1.0, "r_elbow_angle": 1.0}  # a hand far away, an arm straight (fixed values)


def _keys(obs: DataFrame) -> list[str]:
    """A track's numbers begin anew in each clip."""
    return ["clip", "track"] if "clip" in obs.columns else ["track"]


def sessions(obs: DataFrame, max_missing: int) -> DataFrame:
    """Adds ``session``: a track of a clip that stays unseen for more than ``max_missing`` steps begins anew."""
    order = Window.partitionBy(*_keys(obs)).orderBy("step")
    gap = F.col("step") - F.lag("step").over(order) > max_missing + 1
    return obs.withColumn("session", F.sum(F.coalesce(gap, F.lit(False)).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))


def clip_ends(obs: DataFrame) -> DataFrame:
    """``clip_end``: the last step of each clip, or of all where there is no clip."""
    return obs.groupBy("clip").agg(F.max("step").alias("clip_end")) if "clip" in obs.columns else obs.agg(F.max("step").alias("clip_end"))


def _with_clip_end(rows: DataFrame, obs: DataFrame) -> DataFrame:
    ends = clip_ends(obs)
    return rows.join(ends, "clip") if "clip" in obs.columns else rows.join(F.broadcast(ends))


def session_grid(obs: DataFrame, max_missing: int) -> DataFrame:
    """Every step of each session, and ``max_missing`` more as far as the clip goes, with ``present``; unseen steps have nulls."""
    keyed, keys = sessions(obs, max_missing), [*_keys(obs), "session"]
    ends = _with_clip_end(keyed.groupBy(*keys).agg(F.min("step").alias("_a"), F.max("step").alias("_b")), obs)
    stop = F.greatest("_b", F.least(F.col("_b") + max_missing, F.col("clip_end")))
    grid = ends.select(*keys, F.explode(F.sequence("_a", stop)).alias("step"))
    return grid.join(keyed.withColumn("present", F.lit(1)), [*keys, "step"], "left").withColumn("present", F.coalesce("present", F.lit(0)))


def sequence_features(grid: DataFrame, keys: list[str], classes: list[str]) -> DataFrame:
    """All features of each step of ``grid`` (keys, step, f), which holds every step; ``f`` is the struct of
    ``frame_features``, null at unseen steps.

    A seen step has its own values, with ``FILLED`` for missing distances and angles and 0 for other missing
    ones. An unseen step repeats the step before (``FILLED`` and 0 ahead of the first seen one) with present
    and object scores 0. ``d_min_delta`` is the change of the filled ``d_min``.
    """
    order = Window.partitionBy(*keys).orderBy("step")
    finite = lambda c: F.when(~F.isnan(c) & (F.abs(c) < float("inf")), c)
    own = [n for n in BASE_FEATURES if n not in ("d_min_delta", "present")]
    seen = F.when(F.col("f").isNotNull(), F.struct(*(F.coalesce(finite(F.col(f"f.{n}").cast("double")), F.lit(FILLED.get(n, 0.0))).alias(n) for n in own)))
    out = grid.withColumn("_seen", F.last(seen, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    values = {n: F.coalesce(F.col(f"_seen.{n}"), F.lit(FILLED.get(n, 0.0))) for n in own}
    values["d_min_delta"] = values["d_min"] - F.coalesce(F.lag(values["d_min"]).over(order), values["d_min"])
    values["present"] = F.col("f").isNotNull().cast("double")
    objects = {f"obj_{c}": F.coalesce(finite(F.col(f"f.obj_{c}").cast("double")), F.lit(0.0)) for c in classes}
    return out.select(*keys, "step", *((values | objects)[n].alias(n) for n in (*BASE_FEATURES, *objects)))


def window_frames(rows: DataFrame, keys: list[str], window: int, hop: int) -> DataFrame:
    """``keys, start, place`` and the columns of ``rows`` for each place of each window of ``sliding_windows``; the
    places that a short sequence lacks repeat its first row. ``rows`` hold every step. Only row numbers meet in the join."""
    order = Window.partitionBy(*keys).orderBy("step")
    numbered = rows.withColumn("_row", (F.row_number().over(order) - 1).cast("bigint"))
    windows = sliding_windows(rows.groupBy(*keys).agg(F.count("*").alias("n")), window, hop)
    places = windows.select(*keys, "start", "pad", F.explode(F.sequence(F.lit(0), F.lit(window - 1))).alias("place"))
    places = places.withColumn("_row", F.greatest(F.col("start") + F.col("place") - F.col("pad"), F.lit(0)).cast("bigint"))
    return places.drop("pad").join(numbered, [*keys, "_row"]).drop("_row")


def pooled_windows(frames: DataFrame, keys: list[str], features: list[str]) -> DataFrame:
    """Mean and maximum of each feature over each window of ``window_frames``."""
    return frames.groupBy(*keys, "start").agg(*(f(n).alias(f"{n}_{k}") for n in features for k, f in (("mean", F.avg), ("max", F.max))))


def dense(obs: DataFrame, keys: list[str]) -> DataFrame:
    """Every step from the first to the last of each sequence; unseen steps have nulls."""
    ends = obs.groupBy(*keys).agg(F.min("step").alias("_a"), F.max("step").alias("_b"))
    grid = ends.select(*keys, F.explode(F.sequence("_a", "_b")).alias("step"))
    return grid.join(obs, [*keys, "step"], "left")


def long_tracks(obs: DataFrame, fps: float, least_s: float) -> DataFrame:
    """The rows of tracks with int(least_s * fps) seen steps or more."""
    keys = _keys(obs)
    enough = obs.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") >= int(least_s * fps)).select(*keys)
    return obs.join(enough, keys, "left_semi")


def frame_stride(fps: Column, target: float) -> Column:
    """Every how manieth frame is used; halves round to the even neighbour."""
    return F.greatest(F.lit(1), F.bround(fps / target, 0)).cast("int")


def used_frames(frames: DataFrame, target: float = 10.0) -> DataFrame:
    """``frames`` (clip, frame_no, fps, start_s, end_s) that are used, with ``t``, the seconds in the clip, and
    ``step``. A missing fps is 30; the end of the range counts, a missing one is the clip's."""
    fps = F.coalesce(F.nullif(F.col("fps"), F.lit(0.0)), F.lit(30.0))
    t = F.coalesce("start_s", F.lit(0.0)) + F.col("frame_no") / fps
    stride = frame_stride(fps, target)
    timed = frames.withColumn("t", t).withColumn("step", F.floor(F.col("frame_no") / stride)).withColumn("effective_fps", fps / stride)
    return timed.where((F.col("frame_no") % stride == 0) & (F.col("end_s").isNull() | (F.col("t") <= F.col("end_s"))))


def box_area(box: Column) -> Column:
    return (box["x2"] - box["x1"]) * (box["y2"] - box["y1"])


def gap_filled(grid: DataFrame, keys: list[str], value: str = "d", objects: str = "obj") -> DataFrame:
    """Unseen steps repeat the last seen value (``FILL`` before the first), with objects 0; a seen step
    without a value gets ``FILL``. Adds ``delta``, the change since the step before."""
    order = Window.partitionBy(*keys).orderBy("step")
    seen = F.when(F.col("present") == 1, F.coalesce(F.col(value), F.lit(FILL)))
    carried = F.last(seen, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    out = grid.withColumn(value, F.coalesce(carried, F.lit(FILL))).withColumn(objects, F.when(F.col("present") == 1, F.coalesce(F.col(objects), F.lit(0.0))).otherwise(0.0))
    return out.withColumn("delta", F.col(value) - F.coalesce(F.lag(value).over(order), F.col(value)))


def moving_average(rows: DataFrame, keys: list[str], value: str = "d") -> DataFrame:
    """Centred mean of three with repeated ends; sequences of fewer than three steps stay as they are."""
    order = Window.partitionBy(*keys).orderBy("step")
    mean = (F.coalesce(F.lag(value).over(order), F.col(value)) + F.col(value) + F.coalesce(F.lead(value).over(order), F.col(value))) / 3
    n = F.count("*").over(Window.partitionBy(*keys))
    return rows.withColumn("smooth", F.when(n < 3, F.col(value)).otherwise(mean))


def sliding_windows(lengths: DataFrame, window: int, hop: int) -> DataFrame:
    """``start`` of each window of a sequence of ``n`` steps: every ``hop``, and one flush with the end.
    A shorter sequence has one window from 0, padded on the left by ``window - n``."""
    last = F.greatest(F.col("n") - window, F.lit(0))
    starts = F.array_sort(F.array_distinct(F.concat(F.sequence(F.lit(0).cast("bigint"), last.cast("bigint"), F.lit(hop).cast("bigint")), F.array(last.cast("bigint")))))
    return lengths.where("n > 0").withColumn("start", F.explode(starts)).withColumn("pad", F.greatest(window - F.col("n"), F.lit(0)))


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


SEEN = "array<struct<step:bigint,d:double,obj:double>>"


def buffer_scores(seen: Column, low: Column, step: Column, online: OnlineParams, motion: MotionParams, fusion: FusionParams) -> Column:
    """``struct(obj_score, mot_score, fused)`` of the buffer of steps ``low`` to ``step``; ``seen``, an array of
    (step, d, obj) in order, holds those of its steps that were seen, at least one.

    A seen step without a distance counts as ``FILL``; unseen ones repeat the step before, and ``FILL`` ahead of
    the first seen one. Their object score is 0. The object score looks at the last ``window`` steps alone.
    """
    until = F.transform(seen, lambda x, i: F.coalesce(F.try_element_at(seen, i + 2)["step"], step + 1))
    runs = F.arrays_zip(seen.alias("x"), until.alias("next"))
    ahead = (F.element_at(seen, 1)["step"] - low).cast("int")
    length = lambda r: (r["next"] - r["x"]["step"]).cast("int")
    series = F.concat(F.array_repeat(F.lit(FILL), ahead), F.flatten(F.transform(runs, lambda r: F.array_repeat(F.coalesce(r["x"]["d"], F.lit(FILL)), length(r)))))
    objects = F.concat(F.array_repeat(F.lit(0.0), ahead), F.flatten(F.transform(runs, lambda r: F.concat(F.array(F.coalesce(r["x"]["obj"], F.lit(0.0))), F.array_repeat(F.lit(0.0), length(r) - 1)))))
    recent = lambda o: F.slice(o, F.greatest(F.size(o) - online.window + 1, F.lit(1)), online.window)

    def judged(s: Column) -> Column:
        mot = _let(episodes(s, online.fps, motion), lambda e: motion_score(e, F.size(s), online.fps, online.window, motion))
        obj = _let(objects, lambda o: _let(recent(o), lambda r: percentile(r, fusion.obj_percentile)))
        return _let(F.struct(obj.alias("obj_score"), mot.alias("mot_score")), lambda x: F.struct(x["obj_score"].alias("obj_score"), x["mot_score"].alias("mot_score"), fuse(x["obj_score"], x["mot_score"], fusion).alias("fused")))

    return _let(series, lambda s: _let(smoothed(s, motion.smooth), judged))


def decisions(obs: DataFrame, online: OnlineParams, motion: MotionParams, fusion: FusionParams, first_seen: int | None = None) -> DataFrame:
    """``track, session, step, obj_score, mot_score, decision, score, reason`` (and clip, if given) at each due step.

    Every ``hop`` steps, a live track with enough seen steps in its buffer is judged. Each seen step is dealt to
    the due steps whose buffers hold it, so the rows made are ``buffer / hop`` times the observations; unseen
    steps are never rows. A row of ``obs`` is a seen step, with or without a distance.
    """
    need = first_seen if first_seen is not None else max(3, online.window // 3)
    keyed, keys = sessions(obs, online.max_missing), [*_keys(obs), "session"]
    ends = _with_clip_end(keyed.groupBy(*keys).agg(F.min("step").alias("a"), F.max("step").alias("b")), obs)
    ends = ends.withColumn("stop", F.greatest("b", F.least(F.col("b") + online.max_missing, F.col("clip_end"))))
    first = F.ceil(F.col("step") / online.hop) * online.hop
    last = F.least(F.col("step") + online.buffer - 1, F.col("stop"))
    dealt = keyed.join(ends.select(*keys, "a", "stop"), keys).where(first <= last).withColumn("due", F.explode(F.sequence(first, last, F.lit(online.hop).cast("bigint"))))
    seen = F.array_sort(F.collect_list(F.struct(F.col("step").cast("bigint").alias("step"), F.col("d").cast("double").alias("d"), F.col("obj").cast("double").alias("obj")))).cast(SEEN)
    due = dealt.groupBy(*keys, "due").agg(F.min("a").alias("a"), seen.alias("seen")).where(F.size("seen") >= need)
    low = F.greatest("a", F.col("due") - online.buffer + 1)
    scored = due.select(*keys, F.col("due").alias("step"), buffer_scores(F.col("seen"), low, F.col("due"), online, motion, fusion).alias("x"))
    return scored.select(*keys, "step", "x.obj_score", "x.mot_score", "x.fused.decision", "x.fused.score", "x.fused.reason")


def percentile(values: Column, q: float) -> Column:
    """The q-th percentile of an array with linear interpolation; 0 if it is empty."""
    s, n = F.array_sort(values), F.size(values)
    place = (n - 1) * (q / 100)
    low = F.floor(place).cast("int")
    a, b = F.element_at(s, low + 1), F.element_at(s, F.least(low + 2, n))
    return F.when(n == 0, 0.0).otherwise(a + (b - a) * (place - low))


def events(judged: DataFrame, p: EventParams, ends: DataFrame | None = None, ordered: bool = False, chunk: int = 8192) -> DataFrame:
    """Hysteresis events: ``track, session, start_step, end_step, peaks, n_positive, triggered_by`` (and clip, if given).

    ``k_on`` positives among the last ``n_on`` decisions open an event, ``m_off`` negatives in a row close
    it. ``ends`` (track, session, close_step) closes what is still open at the end of a session. ``ordered``: by start, then track.

    A session may be of any length: its decisions are handled in stretches of ``chunk`` steps, all at once. What a stretch does to those
    behind it is small: its last decisions, its last positive, whether it leaves an event open, and where that began. These
    summaries are composed in order, and each stretch then starts from what lies before it.
    """
    keys = [*_keys(judged), "session"]
    part = [*keys, "_chunk"]
    own, between = Window.partitionBy(*part).orderBy("step"), Window.partitionBy(*keys).orderBy("_chunk")
    upto, ahead = own.rowsBetween(Window.unboundedPreceding, 0), own.rowsBetween(Window.unboundedPreceding, -1)
    before = between.rowsBetween(Window.unboundedPreceding, -1)
    rows = judged.withColumn("_chunk", F.floor(F.col("step") / chunk)).withColumn("_n", F.row_number().over(own))
    rows = materialize(rows.select(*part, "step", "_n", "decision", "score", "obj_score", "mot_score", "reason"), "decisions")

    positive = F.when(F.col("decision"), F.col("_n"))
    tail = F.transform(F.slice(F.reverse(F.array_sort(F.collect_list(F.struct("_n", "decision")))), 1, max(1, p.n_on - 1)), lambda x: x["decision"])
    sums = rows.groupBy(*part).agg(F.max("_n").alias("_rows"), F.max(positive).alias("_own_last"), tail.alias("_own_tail"))
    sums = sums.withColumn("_base", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    last = F.coalesce(F.max(F.col("_base") + F.col("_own_last")).over(before), F.lit(0)).alias("_last")
    # newest first: the decisions just before the stretch, over as many stretches as it may take
    tails = F.flatten(F.reverse(F.collect_list("_own_tail").over(between.rowsBetween(-max(1, p.n_on - 1), -1)))).alias("_tail")
    lacking = F.lit(p.n_on) - F.col("_n")
    carried = F.when(lacking > 0, F.size(F.filter(F.slice("_tail", F.lit(1), F.greatest(lacking, F.lit(0))), lambda x: x))).otherwise(0)
    said = F.sum(F.col("decision").cast("int")).over(own.rowsBetween(-(p.n_on - 1), 0)) + carried
    negatives = F.col("_base") + F.col("_n") - F.coalesce(F.max(positive).over(upto) + F.col("_base"), F.col("_last"))
    flagged = rows.join(sums.select(*part, "_base", last, tails), part).withColumn("_on", said >= p.k_on).withColumn("_off", negatives >= p.m_off)
    state = F.when(F.col("_on") | F.col("_off"), F.col("_on") & ~F.col("_off"))  # null: as before
    flagged = materialize(flagged.withColumn("_state", state).drop("_base", "_last", "_tail"), "flagged")

    left = flagged.where("_state IS NOT NULL").groupBy(*part).agg(F.max_by("_state", "_n").alias("_left"))
    left = flagged.groupBy(*part).agg(F.count("*")).select(*part).join(left, part, "left")
    entered = left.select(*part, F.coalesce(F.last("_left", ignorenulls=True).over(before), F.lit(False)).alias("_entered"))
    was_open = F.coalesce(F.last("_state", ignorenulls=True).over(ahead), F.col("_entered"))
    held = flagged.join(entered, part).withColumn("_open", was_open).withColumn("_opens", F.col("_on") & ~F.col("_open"))
    held = materialize(held.where("_open OR _opens").drop("_entered", "_state", "_on"), "open-steps")
    began = held.groupBy(*part).agg(F.max(F.when(F.col("_opens"), F.col("step"))).alias("_began"))
    began = began.select(*part, F.max("_began").over(before).alias("_began"))
    start = F.coalesce(F.max(F.when(F.col("_opens"), F.col("step"))).over(upto), F.col("_began"))
    named = held.join(began, part).withColumn("start_step", start)

    value = lambda c: F.max(F.when(F.col("decision"), F.col(c))).alias(c)
    kinds = named.groupBy(*keys, "start_step", "reason").agg(F.max(F.when(F.col("_off"), F.col("step"))).alias("_stop"), *map(value, ("score", "obj_score", "mot_score")), F.count_if("decision").alias("_n"))
    histogram = F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("_n") > 0, F.struct("reason", F.col("_n").cast("int"))))))
    peak = lambda c, n: F.coalesce(F.max(c), F.lit(0.0)).alias(n)
    found = kinds.groupBy(*keys, "start_step").agg(F.max("_stop").alias("end_step"), peak("score", "peak_score"), peak("obj_score", "peak_object"), peak("mot_score", "peak_motion"), F.sum("_n").cast("int").alias("n_positive"), histogram.alias("triggered_by"))
    if ends is not None:
        found = found.join(ends, keys, "left").withColumn("end_step", F.coalesce("end_step", "close_step")).drop("close_step")
    found = materialize(found, "events")
    discard(rows, flagged, held)
    return found.orderBy("start_step", *keys) if ordered else found


def session_ends(obs: DataFrame, max_missing: int) -> DataFrame:
    """``close_step``: the step after ``max_missing`` unseen ones, or the step after the clip's last."""
    keyed, keys = sessions(obs, max_missing), [*_keys(obs), "session"]
    per = _with_clip_end(keyed.groupBy(*keys).agg(F.max("step").alias("b")), obs)
    return per.select(*keys, F.least(F.col("b") + max_missing + 1, F.col("clip_end") + 1).cast("bigint").alias("close_step"))


def active_tracks(found: DataFrame, step: Column) -> DataFrame:
    """The sessions with an event that is open at ``step``."""
    keys = [*_keys(found), "session"]
    return found.where((F.col("start_step") <= step) & (F.col("end_step").isNull() | (F.col("end_step") > step))).select(*keys).distinct()


def main_track(tracks: DataFrame) -> DataFrame:
    """Each clip's track with the largest product of seen steps and mean area."""
    per = tracks.groupBy("clip", "track").agg(F.count("*").alias("seen"), F.avg("area").alias("area"))
    top = per.groupBy("clip").agg(F.max(F.struct((F.col("seen") * F.col("area")).alias("weight"), (-F.col("track")).alias("t"), "seen")).alias("m"))
    return top.select("clip", (-F.col("m.t")).alias("track"), "m.seen")
