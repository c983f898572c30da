"""Events against marked intervals, with brute force."""

import random

from tracklake.operators import event_evaluation as X

KIND = "clip long, idx long, start long, stop long"


def intervals(rnd, n):
    return [(clip, k, a, a + rnd.choice((0, 1, 3, 9, 40, 400))) for clip in range(4) for k in range(n) for a in [rnd.randrange(500)]]


def brute(events, marks):
    pairs = [(e, m, min(e[3], m[3]) - max(e[2], m[2])) for e in events for m in marks if e[0] == m[0]]
    pairs = [p for p in pairs if p[2] > 0]
    taken, used = [], set()
    for e, m, shared in sorted(pairs, key=lambda p: (-p[2], p[0][2], p[1][2], p[0][1], p[1][1])):
        if ("e", e[:2]) not in used and ("m", m[:2]) not in used:
            used |= {("e", e[:2]), ("m", m[:2])}
            taken.append((e[0], e[1], m[1], shared))
    return sorted((e[0], e[1], m[1], s) for e, m, s in pairs), sorted(taken)


def test_overlaps_and_assignment(spark):
    rnd = random.Random(7)
    for n in (0, 6, 25):
        e, m = intervals(rnd, n), intervals(rnd, n)
        events, marks = spark.createDataFrame(e, KIND), spark.createDataFrame(m, KIND)
        pairs, taken = brute(e, m)
        for cell in (1, 16, 1000):  # long intervals lie in many cells and count once
            got = X.overlaps(events, marks, ["clip"], cell)
            assert sorted(map(tuple, got.select("clip", "e_idx", "m_idx", "shared").collect())) == pairs
        found = X.assigned(got, ["clip"])
        assert sorted(map(tuple, found.select("clip", "e_idx", "m_idx", "shared").collect())) == taken


def test_a_chain_is_taken_in_order(spark):
    """Each overlap is longer than the one before, so one pair a round is the first of both its ends."""
    e = [(1, k, at, at + 12 + 2 * k) for k, at in enumerate(range(0, 200, 20))]
    m = [(1, k, at + 8, at + 22) for k, at in enumerate(range(0, 200, 20))]
    got = X.assigned(X.overlaps(spark.createDataFrame(e, KIND), spark.createDataFrame(m, KIND), ["clip"]), ["clip"])
    assert sorted(map(tuple, got.select("clip", "e_idx", "m_idx", "shared").collect())) == brute(e, m)[1]


def test_report(spark):
    events = spark.createDataFrame([(1, 0, 10, 20), (1, 1, 50, 60), (2, 0, 0, 5)], KIND)
    marks = spark.createDataFrame([(1, 0, 4, 15), (2, 0, 90, 95)], KIND)
    steps = spark.createDataFrame([(1, 36_000), (2, 36_000)], "clip long, n long")
    r = X.event_report(events, marks, X.assigned(X.overlaps(events, marks, ["clip"]), ["clip"]), steps, 10.0).first()
    assert (r.n_events, r.n_marked, r.n_hit, r.false_alarms, r.camera_hours, r.false_alarms_per_hour) == (3, 2, 1, 2, 2.0, 1.0)
    assert abs(r.precision - 1 / 3) < 1e-12 and r.recall == 0.5 and abs(r.f1 - 0.4) < 1e-12 and r.mean_delay == 0.6
    none = events.limit(0)
    r = X.event_report(none, none, X.assigned(X.overlaps(none, none, ["clip"]), ["clip"]), steps.limit(0), 10.0).first()
    assert (r.n_hit, r.precision, r.recall, r.false_alarms_per_hour, r.mean_delay) == (0, None, None, None, None)


def test_cells_follow_the_values(spark, monkeypatch):
    from tracklake.operators import learning as L

    monkeypatch.setattr(L, "ONE_CELL", 10)
    rnd = random.Random(3)
    values = [rnd.choice((rnd.random(), 0.5, rnd.gauss(0, 1e-6), 1e9 * rnd.random())) for _ in range(3000)]
    rows = spark.createDataFrame([(v, bool(rnd.random() < 0.3)) for v in values], "score double, label boolean")
    got = sorted(map(tuple, L.in_cells(rows, "score").select("score", "cell").collect()))
    assert [c for _, c in got] == sorted(c for _, c in got) and len({c for _, c in got}) > 100
    assert all(a[1] == b[1] for a, b in zip(got, got[1:], strict=False) if a[0] == b[0])
    spread = L.auroc(rows).first()
    monkeypatch.setattr(L, "ONE_CELL", 10_000)
    assert abs(spread.auroc - L.auroc(rows).first().auroc) < 1e-12


def test_average_precision_over_stretches(spark, monkeypatch):
    from tracklake.operators import evaluate as E
    from tracklake.operators import learning as L

    rnd = random.Random(5)
    rows = [(rnd.choice((0, 0, 0, 1, 3)), i // 3, i % 3, rnd.choice((round(rnd.random(), 2), 0.9)), rnd.random() < 0.4) for i in range(2000)] + [(4, 1, 0, 0.5, False)]
    counts = {0: 700, 1: 300, 2: 9, 4: 2}
    want = {2: (9, 0.0), 3: (0, None)}
    for cls in (0, 1, 4):
        own = sorted((r for r in rows if r[0] == cls), key=lambda r: (-r[3], r[1], r[2]))
        hits = [sum(r[4] for r in own[: k + 1]) for k in range(len(own))]
        precision = [h / (k + 1) for k, h in enumerate(hits)]
        want[cls] = (counts[cls], sum(max(precision[k:]) for k, r in enumerate(own) if r[4]) / counts[cls])
    matched = spark.createDataFrame(rows, "cls int, image long, det_idx int, conf double, tp boolean")
    truth = spark.createDataFrame(list(counts.items()), "cls int, n_gt long")
    for size in (10, 10_000):
        monkeypatch.setattr(L, "ONE_CELL", size)
        got = {r.cls: (r.n_gt, r.ap) for r in E.average_precision(matched, truth).collect()}
        assert got.keys() == want.keys()
        for cls, (n, ap) in want.items():
            assert got[cls][0] == n and (got[cls][1] == ap if ap is None else abs(got[cls][1] - ap) < 1e-12)
