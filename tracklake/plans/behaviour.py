"""Queries on tracks: sequences, windows, decisions, events and learning."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tracklake.functions.names import is_positive
from tracklake.operators import event_evaluation as X
from tracklake.operators import learning as L
from tracklake.operators import temporal as N
from tracklake.operators import tracks as T
from tracklake.params import EventParams, FusionParams, MotionParams, OnlineParams
from tracklake.plans import views as V
from tracklake.plans.views import with_views
from tracklake.storage import discard, materialize

ONLINE = OnlineParams(fps=1.0, window=12, hop=6, buffer=48, max_missing=24)
MOTION, FUSION, EVENTS = MotionParams(), FusionParams(), EventParams()
SESSION = "sess AS (SELECT *, sum(coalesce((step - prev > 25)::INT, 0)) OVER (PARTITION BY track ORDER BY step) AS session FROM (SELECT *, lag(step) OVER (PARTITION BY track ORDER BY step) AS prev FROM obs))"
GRID = f"""{SESSION}, ends AS (SELECT track, session, min(step) AS a, max(step) AS b, (SELECT max(step) FROM obs) AS c FROM sess GROUP BY ALL),
steps AS (SELECT track, session, unnest(generate_series(a, greatest(b, least(b + 24, c)))) AS step FROM ends),
grid AS (SELECT s.track, s.session, s.step, o.d, o.obj, (o.step IS NOT NULL)::INT AS present FROM steps s LEFT JOIN sess o ON s.track = o.track AND s.session = o.session AND s.step = o.step)"""
FILLED = """filled AS (SELECT track, session, step, present, coalesce(last_value(d IGNORE NULLS) OVER (PARTITION BY track, session ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 3.0) AS d, CASE WHEN present = 1 THEN obj ELSE 0.0 END AS obj FROM grid)"""
# the buffered series of each due step, episodes and scores, as list folds
DECIDED = """buffered AS (SELECT track, session, step, list({'seen': present = 1, 'd': d, 'obj': obj}) OVER (PARTITION BY track, session ORDER BY step ROWS BETWEEN 47 PRECEDING AND CURRENT ROW) AS buf FROM grid),
due AS (SELECT track, session, step, buf, len(buf) AS n FROM buffered WHERE step % 6 = 0 AND len(list_filter(buf, lambda x: x.seen)) >= 4),
long AS (SELECT track, session, step, n, i, buf[i].d AS d, coalesce(buf[i].obj, 0.0) AS obj FROM due, LATERAL (SELECT unnest(range(1, n + 1)) AS i)),
carried AS (SELECT *, coalesce(last_value(d IGNORE NULLS) OVER (PARTITION BY track, session, step ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 3.0) AS f FROM long),
smooth AS (SELECT *, CASE WHEN n < 3 THEN f ELSE (0.0 + coalesce(lag(f) OVER w, f) + f + coalesce(lead(f) OVER w, f)) / 3 END AS v FROM carried WINDOW w AS (PARTITION BY track, session, step ORDER BY i)),
series AS (SELECT track, session, step, n, list(v ORDER BY i) AS vs, quantile_cont(obj, 0.8) FILTER (i > n - 12) AS obj_score FROM smooth GROUP BY ALL),
eps(track, session, step, n, i, vs, far, start, s, e) AS (SELECT track, session, step, n, 0::BIGINT, vs, -1000000000::BIGINT, NULL::BIGINT, NULL::BIGINT, NULL::BIGINT FROM series
UNION ALL SELECT track, session, step, n, i + 1, vs, CASE WHEN vs[i + 1] > 1.0 THEN i ELSE far END,
CASE WHEN start IS NULL AND vs[i + 1] <= 1.0 AND vs[i + 1] < 0.6 AND i - far <= 3 THEN i WHEN start IS NOT NULL AND vs[i + 1] > 1.0 THEN NULL ELSE start END,
CASE WHEN start IS NOT NULL AND vs[i + 1] > 1.0 THEN start END, CASE WHEN start IS NOT NULL AND vs[i + 1] > 1.0 THEN i END FROM eps WHERE i < n),
found AS (SELECT track, session, step, n, s, e FROM eps WHERE s IS NOT NULL UNION ALL SELECT track, session, step, n, start, NULL FROM eps WHERE i = n AND start IS NOT NULL),
scored AS (SELECT track, session, step, (max(CASE WHEN coalesce(e, n) <= greatest(0, n - 12) THEN 0.0 WHEN e IS NOT NULL THEN CASE WHEN e - s BETWEEN 0.3 AND 5.0 THEN 1.0 ELSE 0.2 END WHEN n - s BETWEEN 0.3 AND 5.0 THEN 0.7 WHEN n - s > 5.0 THEN 0.2 ELSE 0.3 END)
* CASE WHEN count(*) FILTER (s >= n - 20) > 4 THEN 0.5 ELSE 1.0 END)::DOUBLE AS mot FROM found GROUP BY ALL),
judged AS (SELECT x.track, x.session, x.step, obj_score, coalesce(mot, 0.0) AS mot_score, obj_score >= 0.35 AND coalesce(mot, 0.0) >= 0.5 OR obj_score >= 0.75 OR coalesce(mot, 0.0) >= 0.95 AS decision,
CASE WHEN obj_score >= 0.35 AND coalesce(mot, 0.0) >= 0.5 THEN 'object+motion' WHEN obj_score >= 0.75 THEN 'object' WHEN coalesce(mot, 0.0) >= 0.95 THEN 'motion' ELSE '' END AS reason,
CASE WHEN obj_score >= 0.35 AND coalesce(mot, 0.0) >= 0.5 THEN sqrt(obj_score * mot) WHEN obj_score >= 0.75 THEN obj_score WHEN coalesce(mot, 0.0) >= 0.95 THEN mot ELSE sqrt(obj_score * coalesce(mot, 0.0)) END AS score
FROM series x LEFT JOIN scored USING (track, session, step))"""
EVENT = """ordered AS (SELECT *, row_number() OVER (PARTITION BY track, session ORDER BY step) AS k FROM judged),
machine(track, session, k, step, hist, neg, open_at, n, done_start, done_end, done_n) AS (SELECT DISTINCT track, session, 0::BIGINT, NULL::BIGINT, []::BOOLEAN[], 0, NULL::BIGINT, 0, NULL::BIGINT, NULL::BIGINT, NULL::INT FROM ordered
UNION ALL SELECT m.track, m.session, o.k, o.step, h.hist, g.neg, CASE WHEN c.close THEN NULL ELSE p.start END, c.n, CASE WHEN c.close THEN p.start END, CASE WHEN c.close THEN o.step END, CASE WHEN c.close THEN c.n END
FROM machine m JOIN ordered o ON m.track = o.track AND m.session = o.session AND o.k = m.k + 1, LATERAL (SELECT list_append(m.hist, o.decision)[-4:] AS hist) h, LATERAL (SELECT CASE WHEN o.decision THEN 0 ELSE m.neg + 1 END AS neg) g,
LATERAL (SELECT coalesce(m.open_at, CASE WHEN len(list_filter(h.hist, lambda x: x)) >= 2 THEN o.step END) AS start) p,
LATERAL (SELECT p.start IS NOT NULL AND g.neg >= 5 AS close, CASE WHEN p.start IS NULL THEN 0 ELSE (CASE WHEN m.open_at IS NULL THEN 0 ELSE m.n END) + o.decision::INT END AS n) c),
evs AS (SELECT track, session, done_start AS start_step, done_end AS end_step, done_n AS n_positive FROM machine WHERE done_start IS NOT NULL
UNION ALL SELECT m.track, m.session, open_at, least(e.b + 25, e.c + 1), n FROM machine m JOIN ends e USING (track, session) WHERE open_at IS NOT NULL AND k = (SELECT max(k) FROM ordered o WHERE o.track = m.track AND o.session = m.session))"""


# pairs of events and marked intervals, and of these, longest overlap first, those whose ends are free
OVERLAP = """marks AS (SELECT track, step AS start, step + 1 + floor(conf * 60)::BIGINT AS stop FROM obs WHERE cls = 3 AND conf >= 0.5),
pairs AS (SELECT e.track, e.start_step, e.end_step, m.start AS marked_step, m.stop, least(e.end_step, m.stop) - greatest(e.start_step, m.start) AS shared FROM evs e JOIN marks m ON e.track = m.track AND e.start_step < m.stop AND m.start < e.end_step),
ranked AS (SELECT *, row_number() OVER (PARTITION BY track ORDER BY shared DESC, start_step, marked_step) AS k FROM pairs),
taking(track, k, es, ms, start_step, marked_step, shared) AS (SELECT DISTINCT track, 0::BIGINT, []::BIGINT[], []::BIGINT[], NULL::BIGINT, NULL::BIGINT, NULL::BIGINT FROM ranked
UNION ALL SELECT t.track, r.k, CASE WHEN f.free THEN list_append(t.es, r.start_step) ELSE t.es END, CASE WHEN f.free THEN list_append(t.ms, r.marked_step) ELSE t.ms END, CASE WHEN f.free THEN r.start_step END, r.marked_step, r.shared
FROM taking t JOIN ranked r ON t.track = r.track AND r.k = t.k + 1, LATERAL (SELECT NOT list_contains(t.es, r.start_step) AND NOT list_contains(t.ms, r.marked_step) AS free) f),
taken AS (SELECT track, start_step, marked_step, shared FROM taking WHERE start_step IS NOT NULL)"""


def _grid(spark, sf):
    return T.session_grid(V.observations(spark, sf).select("track", "step", "d", "obj"), ONLINE.max_missing)


def track_sessions(spark, sf):
    return T.sessions(V.observations(spark, sf), ONLINE.max_missing).groupBy("track", "session").agg(F.count("*").alias("seen"), F.min("step").alias("first_step"), F.max("step").alias("last_step"))


def track_grid(spark, sf):
    return _grid(spark, sf).select("track", "session", "step", "present")


def gap_filled(spark, sf):
    out = T.gap_filled(_grid(spark, sf), ["track", "session"])
    return out.select("track", "session", "step", "present", F.round("d", 9).alias("d"), F.round(F.col("delta") + 0.0, 9).alias("delta"))


def moving_average(spark, sf):
    out = T.moving_average(T.gap_filled(_grid(spark, sf), ["track", "session"]), ["track", "session"])
    return out.select("track", "session", "step", F.round("smooth", 6).alias("smooth"))


def sliding_windows(spark, sf):
    n = V.table(spark, sf, "conversations").groupBy("conv_id").agg(F.count("*").alias("n"))
    return T.sliding_windows(n, 4, 2).select("conv_id", "start", "pad")


def rolling_decisions(spark, sf):
    """k-of-n counts and runs of negatives over raw object decisions."""
    order = Window.partitionBy("track").orderBy("step")
    rows = V.observations(spark, sf).withColumn("decision", F.col("obj") >= FUSION.obj_thr).withColumn("rn", F.row_number().over(order))
    last = F.coalesce(F.max(F.when(F.col("decision"), F.col("rn"))).over(order.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0))
    return rows.select("track", "step", F.sum(F.col("decision").cast("int")).over(order.rowsBetween(-3, 0)).alias("positives"), (F.col("rn") - last).cast("bigint").alias("neg_run"))


def _decisions(spark, sf):
    return T.decisions(V.observations(spark, sf).select("track", "step", "d", "obj"), ONLINE, MOTION, FUSION)


def track_decisions(spark, sf):
    return _decisions(spark, sf).select("track", "session", "step", F.round("obj_score", 6).alias("obj_score"), F.round("mot_score", 6).alias("mot_score"), "decision", "reason", F.round("score", 6).alias("score"))


def track_events(spark, sf):
    out = T.events(_decisions(spark, sf), EVENTS, T.session_ends(V.observations(spark, sf), ONLINE.max_missing))
    return out.select("track", "session", "start_step", "end_step", "n_positive")


def event_peaks(spark, sf):
    """Peaks and reasons of each event, rounded for output."""
    out = T.events(_decisions(spark, sf), EVENTS, T.session_ends(V.observations(spark, sf), ONLINE.max_missing))
    return out.select("track", "session", "start_step", *(F.bround(c, 3).alias(c) for c in ("peak_score", "peak_object", "peak_motion")), F.to_json("triggered_by").alias("triggered_by"))


def _marked(spark, sf):
    """Purchases as hand-marked intervals of a track, and its events."""
    found = T.events(_decisions(spark, sf), EVENTS, T.session_ends(V.observations(spark, sf), ONLINE.max_missing))
    events = materialize(found.select("track", F.col("start_step").alias("idx"), F.col("start_step").alias("start"), F.col("end_step").alias("stop")), "events")
    own = V.observations(spark, sf).where("cls = 3 AND conf >= 0.5")
    marks = own.select("track", F.col("step").alias("idx"), F.col("step").alias("start"), (F.col("step") + 1 + F.floor(F.col("conf") * 60)).alias("stop"))
    return events, marks, materialize(X.overlaps(events, marks, ["track"], 24), "overlapping")


def event_overlaps(spark, sf):
    _, _, pairs = _marked(spark, sf)
    return pairs.select("track", F.col("e_idx").alias("start_step"), F.col("m_idx").alias("marked_step"), "shared", F.round(X.interval_iou(), 9).alias("iou"))


def event_matches(spark, sf):
    _, _, pairs = _marked(spark, sf)
    return X.assigned(pairs, ["track"]).select("track", F.col("e_idx").alias("start_step"), F.col("m_idx").alias("marked_step"), "shared")


def event_evaluation(spark, sf):
    """Events of tracks against marked intervals; a step is an hour."""
    events, marks, pairs = _marked(spark, sf)
    steps = V.observations(spark, sf).groupBy("track").agg((F.max("step") - F.min("step") + 1).alias("n"))
    out = X.event_report(events, marks, X.assigned(pairs, ["track"]), steps, 1 / 3600)
    return out.select(*(F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in out.dtypes))


def main_tracks(spark, sf):
    e = V.observations(spark, sf).select((F.col("step") % 24).alias("clip"), "track", (F.col("cls") + 1).alias("area"))
    return T.main_track(e)


def track_summary(spark, sf):
    n = V.observations(spark, sf).groupBy("track").agg(F.count("*").alias("seen"), F.max("obj").alias("top"))
    return n.where(F.col("seen") >= 20).agg(F.count("*").alias("n_tracks"), F.count_if(F.col("top") >= 0.9).alias("n_positive"), F.round(F.sum("seen") / 60, 6).alias("minutes"))


def median_interval(spark, sf):
    order = Window.partitionBy("track").orderBy("step")
    gaps = V.observations(spark, sf).withColumn("gap", F.col("step") - F.lag("step").over(order))
    return gaps.agg(F.expr("percentile(gap, 0.5)").alias("median_gap"))


def subsampled(spark, sf):
    """Every second step within a time range, both ends included."""
    return V.observations(spark, sf).where((F.col("step") % 2 == 0) & F.col("step").between(100, 400)).groupBy("track").agg(F.count("*").alias("n"))


def clip_roles(spark, sf):
    label = F.when(F.col("role") == "assistant", " Yes ").when(F.col("turn") == 0, "SMOKING").otherwise(F.col("role"))
    return V.table(spark, sf, "conversations").withColumn("label", label).groupBy("label").agg(F.count("*").alias("n"), F.count_if(is_positive(F.col("label"))).alias("n_positive"))


def feature_moments(spark, sf):
    out = L.moments(V.observations(spark, sf), ["d", "obj"])
    return out.select(*(F.round(c, 6).alias(c) for c in out.columns))


def standardised(spark, sf):
    obs = V.observations(spark, sf).select("track", "step", "d", "obj")
    return L.standardised(obs, L.moments(obs, ["d", "obj"]), ["d", "obj"]).groupBy("track").agg(F.round(F.sum("d"), 4).alias("d"), F.round(F.sum("obj"), 4).alias("obj"))


def _scored(spark, sf):
    return V.observations(spark, sf).select((F.col("d") < 0.6).alias("label"), F.col("conf").alias("score"))


def auroc(spark, sf):
    return L.auroc(_scored(spark, sf)).select("n_pos", "n_neg", F.round("auroc", 9).alias("auroc"))


def f1_score(spark, sf):
    return L.f1(_scored(spark, sf)).select("tp", "fp", "fn", F.round("f1", 9).alias("f1"))


def class_balance(spark, sf):
    return L.balance(_scored(spark, sf)).select("pos", "neg", F.round("pos_weight", 9).alias("pos_weight"))


def group_fold(spark, sf):
    rows = V.observations(spark, sf).groupBy(F.col("track").alias("group")).agg((F.max("obj") >= 0.99).alias("label"))
    return L.group_fold(rows, 0.2, F.md5(F.col("group").cast("string"))).select("group", "label", "val")


# cells of groups with like counts, heaviest first; each deals its rest to the folds that hold least
ROW_FOLDS = """own AS (SELECT track AS grp, count(*) FILTER (obj >= 0.8) AS n_pos, count(*) FILTER (obj < 0.8) AS n_neg FROM obs GROUP BY 1),
celled AS (SELECT *, CASE WHEN n_pos < 16 THEN n_pos ELSE floor(log2(n_pos) * 8)::BIGINT - 16 END AS cp, CASE WHEN n_neg < 16 THEN n_neg ELSE floor(log2(n_neg) * 8)::BIGINT - 16 END AS cn FROM own),
placed AS (SELECT *, row_number() OVER (PARTITION BY cp, cn ORDER BY md5(grp::VARCHAR), grp) AS place FROM celled),
wholes AS (SELECT greatest(sum(n_pos), 1) AS all_pos, greatest(sum(n_neg), 1) AS all_neg FROM own),
cells AS (SELECT cp, cn, n, w, row_number() OVER (ORDER BY w DESC, cp, cn) AS k FROM (SELECT cp, cn, count(*) AS n, ((sum(n_pos) * max(all_neg) + sum(n_neg) * max(all_pos)) // count(*))::BIGINT AS w FROM celled, wholes GROUP BY cp, cn)),
dealing(k, cp, cn, n, least, load) AS (SELECT 0::BIGINT, NULL::BIGINT, NULL::BIGINT, NULL::BIGINT, NULL::BIGINT[], [0, 0, 0, 0, 0]::BIGINT[]
UNION ALL SELECT c.k, c.cp, c.cn, c.n, x.least, list_transform(range(5), lambda f: d.load[f + 1] + c.w * (c.n // 5 + CASE WHEN list_contains(x.least[1:c.n % 5], f) THEN 1 ELSE 0 END))
FROM dealing d JOIN cells c ON c.k = d.k + 1, LATERAL (SELECT list_transform(list_sort(list_transform(range(5), lambda f: {'load': d.load[f + 1], 'fold': f})), lambda s: s.fold) AS least) x)"""
CLASSES = ["cigarette", "vape"]


def _frames(spark, sf, *more):
    """Observations as frames with features, some of which are missing, in two clips, and columns ``more``."""
    o = V.observations(spark, sf).where("step < 400").withColumn("clip", F.col("step") % 2)
    d = F.round("d", 6)
    left, right = F.when(F.col("cls") != 1, d), F.when(F.col("cls") != 2, F.least(F.lit(3.0), d + 0.25))
    values = {"d_left": left, "d_right": right, "d_min": F.least(left, right), "l_elbow_angle": F.when(F.col("cls") != 3, F.col("conf")), "nose_conf": F.when(F.col("cls") != 4, F.col("conf")), "obj_cigarette": F.col("obj"), "obj_vape": 1 - F.col("conf")}
    names = ["l_wrist_above_shoulder", "r_wrist_above_shoulder", "r_elbow_angle", "l_wrist_conf", "r_wrist_conf"]
    f = F.struct(*(v.alias(n) for n, v in values.items()), *(F.lit(0.5).alias(n) for n in names))
    return o.select("clip", "track", F.floor(F.col("step") / 2).alias("step"), f.alias("f"), *more)


def _features(spark, sf):
    return T.sequence_features(T.dense(_frames(spark, sf), ["clip", "track"]), ["clip", "track"], CLASSES)


def sequence_features(spark, sf):
    names = [*T.BASE_FEATURES, "obj_cigarette", "obj_vape"]
    return _features(spark, sf).select("clip", "track", "step", *(F.round(F.col(n) + 0.0, 6).alias(n) for n in names))


def window_frames(spark, sf):
    rows = V.table(spark, sf, "conversations").select("conv_id", F.col("turn").alias("step"), F.length("text").alias("n_chars"))
    return T.window_frames(rows, ["conv_id"], 4, 2).select("conv_id", "start", "place", "step", "n_chars")


def pooled_windows(spark, sf):
    frames = T.window_frames(_features(spark, sf), ["clip", "track"], 24, 12)
    return T.pooled_windows(frames, ["clip", "track"], ["d_min", "obj_cigarette"]).select("clip", "track", "start", *(F.round(F.col(c), 6).alias(c) for c in ("d_min_mean", "d_min_max", "obj_cigarette_mean", "obj_cigarette_max")))


def clip_decisions(spark, sf):
    """Decisions of tracks whose numbers begin anew in each of three clips."""
    o = V.observations(spark, sf).select(F.floor(F.col("step") / 200).alias("clip"), "track", (F.col("step") % 200).alias("step"), "d", "obj")
    out = T.decisions(o, ONLINE, MOTION, FUSION)
    return out.select("clip", "track", "session", "step", F.round("obj_score", 6).alias("obj_score"), F.round("mot_score", 6).alias("mot_score"), "decision", "reason")


def used_frames(spark, sf):
    """Frames of clips of 30, 25 and unknown frames a second, within a range of time."""
    e = V.table(spark, sf, "events").select((F.col("event_id") % 3).alias("clip"), F.floor(F.col("event_id") / 3).alias("frame_no"))
    fps = F.when(F.col("clip") == 0, 30.0).when(F.col("clip") == 1, 25.0)
    clips = e.withColumn("fps", fps).withColumn("start_s", F.when(F.col("clip") == 1, 2.0)).withColumn("end_s", F.when(F.col("clip") != 2, 40.0))
    return T.used_frames(clips, 10.0).select("clip", "frame_no", "step", F.round("t", 6).alias("t"), F.round("effective_fps", 6).alias("effective_fps"))


def long_tracks(spark, sf):
    return T.long_tracks(V.observations(spark, sf), 10.0, 1.95).groupBy("track").agg(F.count("*").alias("seen"))


def row_folds(spark, sf):
    """Tracks in folds that balance the rows of both labels."""
    rows = V.observations(spark, sf).select(F.col("track").alias("group"), (F.col("obj") >= 0.8).alias("label"))
    return L.row_folds(rows, 5, F.md5(F.col("group").cast("string")))


def _bought():
    return F.sum((F.col("cls") == 3).cast("int")) * 5 >= F.count("*")


def _held_out(rows):
    return L.row_folds(rows, 5, F.md5(F.col("group").cast("string"))).select("group", (F.col("fold") == 0).alias("val"))


def _labelled(spark, sf, windows):
    """Windows with ``label``, whether a fifth of the track's events in the clip or more are purchases, which is none of their features,
    and ``val``: a fifth of the tracks, balanced by windows of each label."""
    bought = V.observations(spark, sf).where("step < 400").groupBy((F.col("step") % 2).alias("clip"), "track").agg(_bought().alias("label"))
    rows = materialize(windows.join(bought, ["clip", "track"]).withColumnRenamed("track", "group"), "windows")
    return materialize(rows.join(_held_out(rows), "group").withColumnRenamed("group", "track"), "labelled-windows")


def window_classifier(spark, sf):
    """Scores of held-out windows by a classifier of pooled features; no SQL equivalent."""
    names = ["d_min", "obj_cigarette", "d_min_delta", "present"]
    rows = _labelled(spark, sf, T.pooled_windows(T.window_frames(_features(spark, sf), ["clip", "track"], 24, 12), ["clip", "track"], names))
    model, _ = L.fit_windows(rows.where("NOT val"), rows.where("val"), [f"{n}_{k}" for n in names for k in ("mean", "max")])
    return L.window_scores(model, rows.where("val")).select("clip", "track", "start", "label", F.round("score", 4).alias("score"))


def temporal_net(spark, sf):
    """Scores of held-out windows by a temporal convolution net; no SQL equivalent."""
    names = ["d_min", "obj_cigarette", "d_min_delta", "present"]
    keys, batches = ["clip", "track"], 3
    frames = materialize(_frames(spark, sf, "cls").where("track IS NOT NULL"), "frames")
    tracks = materialize(frames.groupBy(*keys).agg((F.max("step") - F.min("step") + 1).alias("n"), _bought().alias("label")), "tracks")
    val = _held_out(T.sliding_windows(tracks, 24, 12).select(F.col("track").alias("group"), "label"))  # labels and folds need no features
    known = [*keys, "label", "val"]
    seen = T.sequence_features(frames.join(tracks.join(val.withColumnRenamed("group", "track"), "track").select(*known), keys), known, CLASSES)
    rows = materialize(N.in_buckets(N.window_rows(seen, known, names, 24, 12), batches), "windows", by=["val", "bucket"])
    discard(frames, tracks)
    net, _, _ = N.fit_net(rows.where("NOT val"), rows.where("val"), len(names), 24, hidden=8, epochs=4, batches=batches, rate=0.01)
    return N.scored(net, rows.where("val").select("clip", "track", "start", "label", "x")).withColumn("score", F.round("score", 4))


QUERIES = {f.__name__: f for f in (track_sessions, track_grid, gap_filled, moving_average, sliding_windows, rolling_decisions, track_decisions, track_events, event_peaks, event_overlaps, event_matches, event_evaluation, main_tracks, track_summary, median_interval, subsampled, clip_roles, feature_moments, standardised, auroc, f1_score, class_balance, group_fold, row_folds, window_classifier, temporal_net, sequence_features, window_frames, pooled_windows, clip_decisions, used_frames, long_tracks)}
FEATURES = """fr AS (SELECT step % 2 AS clip, track, step // 2 AS step, cls, round(d, 6) AS d, conf, obj FROM obs WHERE step < 400),
f AS (SELECT clip, track, step, CASE WHEN cls <> 1 THEN d END AS l, CASE WHEN cls <> 2 THEN least(3.0, d + 0.25) END AS r, CASE WHEN cls <> 3 THEN conf END AS el, CASE WHEN cls <> 4 THEN conf END AS nc, obj AS oc, 1 - conf AS ov FROM fr),
allsteps AS (SELECT clip, track, unnest(generate_series(min(step), max(step))) AS step FROM f GROUP BY clip, track),
own AS (SELECT s.clip, s.track, s.step, f.step IS NOT NULL AS seen, CASE WHEN f.step IS NOT NULL THEN {'l': coalesce(l, 3.0), 'r': coalesce(r, 3.0), 'm': coalesce(least(l, r), 3.0), 'el': coalesce(el, 1.0), 'nc': coalesce(nc, 0.0)} END AS v, coalesce(oc, 0.0) AS oc, coalesce(ov, 0.0) AS ov FROM allsteps s LEFT JOIN f ON s.clip = f.clip AND s.track = f.track AND s.step = f.step),
held AS (SELECT clip, track, step, seen, last_value(v IGNORE NULLS) OVER (PARTITION BY clip, track ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v, oc, ov FROM own),
feats AS (SELECT clip, track, step, v.l AS d_left, v.r AS d_right, v.m AS d_min, v.m - coalesce(lag(v.m) OVER (PARTITION BY clip, track ORDER BY step), v.m) AS d_min_delta, 0.5::DOUBLE AS l_wrist_above_shoulder, 0.5::DOUBLE AS r_wrist_above_shoulder, v.el AS l_elbow_angle, 0.5::DOUBLE AS r_elbow_angle, v.nc AS nose_conf, 0.5::DOUBLE AS l_wrist_conf, 0.5::DOUBLE AS r_wrist_conf, seen::INT::DOUBLE AS present, oc AS obj_cigarette, ov AS obj_vape FROM held)"""
FEATURE_NAMES = ["d_left", "d_right", "d_min", "d_min_delta", "l_wrist_above_shoulder", "r_wrist_above_shoulder", "l_elbow_angle", "r_elbow_angle", "nose_conf", "l_wrist_conf", "r_wrist_conf", "present", "obj_cigarette", "obj_vape"]
CLIPPED = "clipped AS (SELECT step // 200 AS clip, track, step % 200 AS step, d, obj FROM obs)"
IN_CLIPS = ", ".join((GRID, DECIDED)).replace("FROM obs) AS c", "FROM clipped o WHERE o.clip = sess.clip) AS c").replace("FROM obs", "FROM clipped").replace("track, session", "clip, track, session").replace("PARTITION BY track", "PARTITION BY clip, track").replace("s.track = o.track", "s.clip = o.clip AND s.track = o.track").replace("SELECT s.track, s.session", "SELECT s.clip, s.track, s.session").replace("SELECT x.track, x.session", "SELECT x.clip, x.track, x.session")
SCORED = "sc AS (SELECT d < 0.6 AS label, conf AS score FROM obs)"
ORACLE_SQL = {
    "track_sessions": with_views("SELECT track, session::BIGINT AS session, count(*) AS seen, min(step) AS first_step, max(step) AS last_step FROM sess GROUP BY ALL", "obs", more=SESSION),
    "track_grid": with_views("SELECT track, session::BIGINT AS session, step, present FROM grid", "obs", more=GRID),
    "gap_filled": with_views("SELECT track, session::BIGINT AS session, step, present, round(d, 9) AS d, round(d - coalesce(lag(d) OVER (PARTITION BY track, session ORDER BY step), d) + 0.0, 9) AS delta FROM filled", "obs", more=f"{GRID}, {FILLED}"),
    "moving_average": with_views("SELECT track, session::BIGINT AS session, step, round(CASE WHEN count(*) OVER (PARTITION BY track, session) < 3 THEN d ELSE (coalesce(lag(d) OVER w, d) + d + coalesce(lead(d) OVER w, d)) / 3 END, 6) AS smooth FROM filled WINDOW w AS (PARTITION BY track, session ORDER BY step)", "obs", more=f"{GRID}, {FILLED}"),
    "sliding_windows": "WITH c AS (SELECT conv_id, count(*) AS n FROM conversations GROUP BY 1), s AS (SELECT DISTINCT conv_id, n, unnest(list_append(generate_series(0, greatest(n - 4, 0), 2), greatest(n - 4, 0))) AS start FROM c) SELECT conv_id, start, greatest(4 - n, 0) AS pad FROM s",
    "rolling_decisions": with_views("SELECT track, step, sum(dec) OVER (PARTITION BY track ORDER BY step ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)::BIGINT AS positives, rn - coalesce(max(CASE WHEN dec = 1 THEN rn END) OVER (PARTITION BY track ORDER BY step), 0) AS neg_run FROM (SELECT track, step, (obj >= 0.35)::INT AS dec, row_number() OVER (PARTITION BY track ORDER BY step) AS rn FROM obs)", "obs"),
    "track_decisions": with_views("SELECT track, session::BIGINT AS session, step, round(obj_score, 6) AS obj_score, round(mot_score, 6) AS mot_score, decision, reason, round(score, 6) AS score FROM judged", "obs", recursive=True, more=f"{GRID}, {DECIDED}"),
    "track_events": with_views("SELECT track, session::BIGINT AS session, start_step, end_step, n_positive FROM evs", "obs", recursive=True, more=f"{GRID}, {DECIDED}, {EVENT}"),
    "event_overlaps": with_views("SELECT track, start_step, marked_step, shared, round(shared / (end_step - start_step + stop - marked_step - shared), 9) AS iou FROM pairs", "obs", recursive=True, more=f"{GRID}, {DECIDED}, {EVENT}, {OVERLAP}"),
    "event_matches": with_views("SELECT * FROM taken", "obs", recursive=True, more=f"{GRID}, {DECIDED}, {EVENT}, {OVERLAP}"),
    "event_evaluation": with_views("SELECT n_events, n_marked, n_hit, round(n_hit / n_events, 6) AS precision, round(n_hit / n_marked, 6) AS recall, round(2 * n_hit / (n_events + n_marked), 6) AS f1, n_events - n_hit AS false_alarms, round(hours::DOUBLE, 6) AS camera_hours, round((n_events - n_hit) / hours, 6) AS false_alarms_per_hour, round(delay * 3600, 6) AS mean_delay FROM (SELECT (SELECT count(*) FROM evs) AS n_events, (SELECT count(*) FROM marks) AS n_marked, (SELECT count(*) FROM taken) AS n_hit, (SELECT avg(start_step - marked_step) FROM taken) AS delay, (SELECT sum(n) FROM (SELECT max(step) - min(step) + 1 AS n FROM obs GROUP BY track)) AS hours)", "obs", recursive=True, more=f"{GRID}, {DECIDED}, {EVENT}, {OVERLAP}"),
    "main_tracks": with_views("SELECT clip, track, seen FROM (SELECT step % 24 AS clip, track, count(*) AS seen, avg(cls + 1) AS area FROM obs GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY clip ORDER BY seen * area DESC, track) = 1", "obs"),
    "track_summary": with_views("SELECT count(*) AS n_tracks, count(*) FILTER (top >= 0.9) AS n_positive, round(sum(seen) / 60, 6) AS minutes FROM (SELECT track, count(*) AS seen, max(obj) AS top FROM obs GROUP BY 1) WHERE seen >= 20", "obs"),
    "median_interval": with_views("SELECT median(gap)::DOUBLE AS median_gap FROM (SELECT step - lag(step) OVER (PARTITION BY track ORDER BY step) AS gap FROM obs)", "obs"),
    "subsampled": with_views("SELECT track, count(*) AS n FROM obs WHERE step % 2 = 0 AND step BETWEEN 100 AND 400 GROUP BY 1", "obs"),
    "clip_roles": "SELECT label, count(*) AS n, count(*) FILTER (lower(trim(label)) IN ('1', 'smoking', 'smoke', 'yes', 'true', 'positive')) AS n_positive FROM (SELECT CASE WHEN role = 'assistant' THEN ' Yes ' WHEN turn = 0 THEN 'SMOKING' ELSE role END AS label FROM conversations) GROUP BY 1",
    "feature_moments": with_views("SELECT round(avg(d), 6) AS d_mean, round(avg(obj), 6) AS obj_mean, round(greatest(stddev_pop(d), 0.05), 6) AS d_std, round(greatest(stddev_pop(obj), 0.05), 6) AS obj_std FROM obs", "obs"),
    "standardised": with_views("SELECT track, round(sum(greatest(-10, least(10, (d - md) / sd))), 4) AS d, round(sum(greatest(-10, least(10, (obj - mo) / so))), 4) AS obj FROM obs, (SELECT avg(d) AS md, greatest(stddev_pop(d), 0.05) AS sd, avg(obj) AS mo, greatest(stddev_pop(obj), 0.05) AS so FROM obs) GROUP BY 1", "obs"),
    "auroc": with_views("SELECT sum(label::INT)::BIGINT AS n_pos, sum((NOT label)::INT)::BIGINT AS n_neg, round((sum(CASE WHEN label THEN r END) - sum(label::INT) * (sum(label::INT) + 1) / 2) / (sum(label::INT) * sum((NOT label)::INT)), 9) AS auroc FROM (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 AS r FROM sc)", "obs", more=SCORED),
    "f1_score": with_views("SELECT count(*) FILTER (score >= 0.5 AND label) AS tp, count(*) FILTER (score >= 0.5 AND NOT label) AS fp, count(*) FILTER (score < 0.5 AND label) AS fn, round(2 * tp / (2 * tp + fp + fn), 9) AS f1 FROM sc", "obs", more=SCORED),
    "class_balance": with_views("SELECT count(*) FILTER (label) AS pos, count(*) FILTER (NOT label) AS neg, round(neg / greatest(pos, 1), 9) AS pos_weight FROM sc", "obs", more=SCORED),
    "group_fold": with_views("SELECT grp AS \"group\", label, place <= ceil(n / f) AS val FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(grp::VARCHAR), grp) AS place, count(*) OVER (PARTITION BY label) AS n FROM g), (SELECT greatest(2, least(5, min(n))) AS f FROM (SELECT count(*) AS n FROM g GROUP BY label))", "obs", more="g AS (SELECT track AS grp, max(obj) >= 0.99 AS label FROM obs GROUP BY 1)"),
    "row_folds": with_views("""SELECT grp AS "group", n_pos, n_neg, CASE WHEN place <= n - n % 5 THEN (place - 1) % 5 ELSE least[place - (n - n % 5)] END::INT AS fold
        FROM placed JOIN dealing USING (cp, cn)""", "obs", recursive=True, more=ROW_FOLDS),
    "event_peaks": with_views("""SELECT track, session::BIGINT AS session, start_step, round_even(max(score), 3) AS peak_score, round_even(max(obj_score), 3) AS peak_object, round_even(max(mot_score), 3) AS peak_motion, '{' || string_agg('"' || reason || '":' || n, ',' ORDER BY reason) || '}' AS triggered_by
        FROM (SELECT e.track, e.session, start_step, reason, max(score) AS score, max(obj_score) AS obj_score, max(mot_score) AS mot_score, count(*) AS n FROM evs e JOIN judged j ON e.track = j.track AND e.session = j.session AND j.decision AND j.step BETWEEN e.start_step AND e.end_step GROUP BY ALL) GROUP BY ALL""", "obs", recursive=True, more=f"{GRID}, {DECIDED}, {EVENT}"),
    "sequence_features": with_views("SELECT clip, track, step, " + ", ".join(f"round({n} + 0.0, 6) AS {n}" for n in FEATURE_NAMES) + " FROM feats", "obs", more=FEATURES),
    "window_frames": "WITH c AS (SELECT conv_id, turn AS step, length(text)::INT AS n_chars, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS k, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations), s AS (SELECT DISTINCT conv_id, n, unnest(list_append(generate_series(0, greatest(n - 4, 0), 2), greatest(n - 4, 0))) AS start FROM c), p AS (SELECT *, unnest(range(4))::INT AS place FROM s) SELECT p.conv_id, start, place, step, n_chars FROM p JOIN c ON p.conv_id = c.conv_id AND c.k = greatest(start + place - greatest(4 - p.n, 0), 0)",
    "pooled_windows": with_views("SELECT clip, track, start, round(avg(d_min), 6) AS d_min_mean, round(max(d_min), 6) AS d_min_max, round(avg(obj_cigarette), 6) AS obj_cigarette_mean, round(max(obj_cigarette), 6) AS obj_cigarette_max FROM (SELECT p.clip, p.track, start, d_min, obj_cigarette FROM (SELECT *, unnest(range(24)) AS place FROM (SELECT DISTINCT clip, track, n, unnest(list_append(generate_series(0, greatest(n - 24, 0), 12), greatest(n - 24, 0))) AS start FROM numbered)) p JOIN numbered c ON p.clip = c.clip AND p.track = c.track AND c.k = greatest(start + place - greatest(24 - p.n, 0), 0)) GROUP BY ALL", "obs", more=FEATURES + ", numbered AS (SELECT *, row_number() OVER (PARTITION BY clip, track ORDER BY step) - 1 AS k, count(*) OVER (PARTITION BY clip, track) AS n FROM feats)"),
    "clip_decisions": with_views("SELECT clip, track, session::BIGINT AS session, step, round(obj_score, 6) AS obj_score, round(mot_score, 6) AS mot_score, decision, reason FROM judged", "obs", recursive=True, more=f"{CLIPPED}, {IN_CLIPS}"),
    "used_frames": "WITH e AS (SELECT event_id % 3 AS clip, event_id // 3 AS frame_no FROM events), c AS (SELECT clip, frame_no, CASE clip WHEN 1 THEN 25.0 ELSE 30.0 END::DOUBLE AS fps, CASE clip WHEN 1 THEN 2.0 ELSE 0.0 END::DOUBLE AS start_s, CASE clip WHEN 2 THEN NULL ELSE 40.0 END AS end_s, CASE clip WHEN 1 THEN 2 ELSE 3 END AS stride FROM e) SELECT clip, frame_no, frame_no // stride AS step, round(start_s + frame_no / fps, 6) AS t, round(fps / stride, 6) AS effective_fps FROM c WHERE frame_no % stride = 0 AND (end_s IS NULL OR start_s + frame_no / fps <= end_s)",
    "long_tracks": with_views("SELECT track, count(*) AS seen FROM obs GROUP BY 1 HAVING count(*) >= 19", "obs"),
}
