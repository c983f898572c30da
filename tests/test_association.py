"""Tracks of detections, with a plain version of the rules."""

import random

import numpy as np

from tracklake.operators import association as S

KIND = "clip long, frame_no long, det_idx long, conf double, x1 double, y1 double, x2 double, y2 double"


def iou(a, b):
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    shared = max(w, 0) * max(h, 0)
    whole = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - shared
    return shared / whole if whole > 0 else 0.0


def plain(rows, p):
    out = []
    for clip in {r[0] for r in rows}:
        live, made = [], 0  # number, box, motion, frame
        for frame in sorted({r[1] for r in rows if r[0] == clip}):
            dets = sorted(r[2:] for r in rows if r[:2] == (clip, frame))
            live = [t for t in live if frame - t[3] <= p.max_missing + 1]
            free, given = list(live), {}
            for lo, hi, near in ((p.high, 2.0, p.near), (p.low, p.high, p.near_low)):
                own = [d for d in dets if lo <= d[1] < hi]
                ranked = sorted((-iou([x + v * (frame - t[3]) for x, v in zip(t[1], t[2], strict=True)], d[2:]), i, j) for i, t in enumerate(free) for j, d in enumerate(own))
                used = set()
                for down, i, j in ranked:
                    if -down >= near and ("t", i) not in used and ("d", j) not in used:
                        used |= {("t", i), ("d", j)}
                        t, d = free[i], own[j]
                        gap = max(1, frame - t[3])
                        t[2] = [(1 - p.smooth) * v + p.smooth * (x - y) / gap for v, x, y in zip(t[2], d[2:], t[1], strict=True)]
                        t[1], t[3] = list(d[2:]), frame
                        given[d[0]] = t[0]
                free = [t for i, t in enumerate(free) if ("t", i) not in used]
            for d in dets:
                if d[0] not in given and d[1] >= p.start:
                    live.append([made, list(d[2:]), [0.0] * 4, frame])
                    given[d[0]], made = made, made + 1
            out += [(clip, frame, k, t) for k, t in given.items()]
    return sorted(out)


def test_against_the_plain_rules(spark):
    rnd = random.Random(5)
    rows = []
    for clip in range(3):
        movers = [[rnd.uniform(0, 400), rnd.uniform(0, 300), rnd.uniform(-9, 9), rnd.uniform(-9, 9)] for _ in range(6)]
        for frame in range(0, 120):
            for k, m in enumerate(movers):
                m[0], m[1] = m[0] + m[2], m[1] + m[3]
                if rnd.random() < 0.85:
                    rows.append((clip, frame, k, round(rnd.random(), 3), m[0] + rnd.gauss(0, 1), m[1] + rnd.gauss(0, 1), m[0] + 40.0, m[1] + 60.0))
    p = S.AssociationParams(max_missing=5)
    want = plain(rows, p)
    table = spark.createDataFrame(rows, KIND).repartition(7)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for size in ("3", "10000"):  # frames are cut by batches, and tracks go on
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            assert sorted(map(tuple, S.associated(table, p).collect())) == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert S.associated(table.limit(0), p).count() == 0


def test_tracks_keep_their_numbers_when_paths_cross():
    """Two boxes pass through each other; motion tells them apart, a gap and weak detections do not break them."""
    tracks, seen = S.Tracks(S.AssociationParams(max_missing=6)), []
    for frame in range(60):
        a, b = 100 + 5.0 * frame, 400 - 5.0 * frame
        boxes = np.array([[a, 0, a + 50, 80], [b, 30, b + 50, 110]])
        if 40 <= frame < 44:
            continue  # unseen
        seen.append(tracks.step(frame, np.array([0.9, 0.2 if 10 < frame < 15 else 0.8]), boxes))
    assert all(s == [0, 1] for s in seen) and tracks.made == 2
    assert tracks.step(200, np.array([0.4, 0.9]), boxes) == [None, 2]  # all have ended; weak ones begin nothing
