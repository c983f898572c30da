"""The temporal net: gradients, a task that only order solves, and balanced folds."""

import numpy as np
from pyspark.sql import functions as F

from tracklake.operators import learning as L
from tracklake.operators import temporal as N
from tracklake.operators import tracks as T


def test_gradient_equals_differences():
    rnd = np.random.RandomState(3)
    net = N.started(3, 12, 4, 1)
    net.theta[:] += 0.1 * rnd.randn(len(net.theta))
    x, y = rnd.randn(5, 12, 3), np.array([0.0, 1.0, 1.0, 0.0, 1.0])
    keep = (rnd.random_sample((5, 4)) > 0.3) / 0.7
    loss, grad = N.gradient(net, x, y, 1.7, keep)
    for i in rnd.choice(len(net.theta), 60, replace=False):
        ends = []
        for h in (1e-6, -1e-6):
            net.theta[i] += h
            ends.append(N.gradient(net, x, y, 1.7, keep)[0])
            net.theta[i] -= h
        assert abs((ends[0] - ends[1]) / 2e-6 - grad[i]) < 1e-4 * (1 + abs(grad[i]))
    assert N.size_of(3, 4) == len(net.theta) == sum(p.size for p in net.layers()) and loss > 0


def test_step_sums_over_tasks(spark):
    rnd = np.random.RandomState(5)
    net = N.started(2, 6, 4, 2, np.array([0.5, 0.0]), np.array([2.0, 1.0]))
    x, y = rnd.randn(40, 6, 2), rnd.randint(0, 2, 40).astype(float)
    rows = spark.createDataFrame([(v.ravel().tolist(), bool(t)) for v, t in zip(x, y, strict=True)], "x array<double>, label boolean").repartition(5)
    n, loss, grad = N.step_gradient(rows, net, 2.0, 0.0, 0.0, 1)
    want = N.gradient(net, (x - net.mean) / net.std, y, 2.0)
    assert n == 40 and abs(loss - want[0]) < 1e-9 and np.allclose(grad, want[1])


def test_net_learns_order_that_pooling_cannot_see(spark):
    rnd = np.random.RandomState(11)
    rows = []
    for i in range(360):
        x = 0.1 * rnd.randn(24, 2)
        a, b = sorted(rnd.choice(np.arange(2, 22, 3), 2, replace=False))
        label = bool(i % 2)
        x[a, 0], x[b, 0] = (1.0, -1.0) if label else (-1.0, 1.0)  # up then down, or down then up
        rows.append((i, label, x.ravel().tolist()))
    table = spark.createDataFrame(rows, "i long, label boolean, x array<double>").repartition(3)
    train, val = table.where("i % 4 <> 0 AND i % 4 <> 3"), table.where("i % 4 = 0 OR i % 4 = 3")
    net, area, losses = N.fit_net(train, val, 2, 24, hidden=8, epochs=10, batches=3, rate=0.02, dropout=0.0)
    one = lambda c: F.filter("x", lambda v, i: i % 2 == c)
    kinds = {"max": F.array_max, "mean": lambda a: F.aggregate(a, F.lit(0.0), lambda s, v: s + v) / 24}
    pooled = lambda t: t.select("label", *(f(one(c)).alias(f"p{c}_{n}") for c in (0, 1) for n, f in kinds.items()))
    names = [f"p{c}_{n}" for c in (0, 1) for n in ("max", "mean")]
    _, linear = L.fit_windows(pooled(train), pooled(val), names, strengths=(0.01,), steps=20)
    assert area > 0.9 > linear and losses[-1] < 0.7 * losses[0]
    assert N.scored(net, val.select("i", "x")).columns == ["i", "score"] and N.scored(net, val.limit(0)).count() == 0


def test_folds_balance_rows_of_both_labels(spark):
    rnd = np.random.RandomState(2)
    rows = [(g, bool(rnd.random_sample() < 0.2)) for g in range(200) for _ in range(int(rnd.pareto(1.2) * 4) + 1)]
    rows += [(1000, True)] * 300 + [(1001, False)] * 900  # two heavy groups
    got = L.row_folds(spark.createDataFrame(rows, "group long, label boolean"), 4, F.md5(F.col("group").cast("string"))).collect()
    assert sorted(r.group for r in got) == sorted({g for g, _ in rows}) and {r.fold for r in got} == {0, 1, 2, 3}
    total = sum(r.n_pos for r in got) / 4, sum(r.n_neg for r in got) / 4
    for f in range(4):
        shares = sum(r.n_pos for r in got if r.fold == f) / total[0] + sum(r.n_neg for r in got if r.fold == f) / total[1]
        assert 1.5 < shares < 2.6, shares
    one = L.row_folds(spark.createDataFrame([(1, True)], "group long, label boolean"), 4, F.md5(F.col("group").cast("string"))).collect()
    assert [(r.group, r.n_pos, r.n_neg, r.fold) for r in one] == [(1, 1, 0, 0)]


def test_windows_of_runs_equal_windows_of_all_steps(spark):
    rnd = np.random.RandomState(4)
    rows = [(k, int(s), None if rnd.random_sample() < 0.2 else float(rnd.random_sample()), float(rnd.random_sample())) for k in range(12) for s in sorted(rnd.choice(5 + 6 * k, 2 + 2 * k, replace=False))]
    f = F.struct(F.col("d").alias("d_min"), F.col("o").alias("obj_vape"), *(F.lit(0.5).alias(n) for n in T.BASE_FEATURES if n not in ("d_min", "d_min_delta", "present")), F.lit(0.0).alias("obj_cigarette"))
    frames = spark.createDataFrame(rows, "k long, step long, d double, o double").select("k", "step", f.alias("f"))
    names, classes = ["d_min", "obj_vape", "d_min_delta", "present"], ["cigarette", "vape"]
    for window, hop in ((8, 4), (5, 7), (40, 3)):
        every = T.window_frames(T.sequence_features(T.dense(frames, ["k"]), ["k"], classes), ["k"], window, hop).collect()
        want = {}
        for r in sorted(every, key=lambda r: (r.k, r.start, r.place)):
            want.setdefault((r.k, r.start), []).extend(r[n] for n in names)
        got = N.window_rows(T.sequence_features(frames, ["k"], classes), ["k"], names, window, hop)
        found = got.collect()
        assert len(found) == len(want) and {(r.k, r.start): r.x for r in found} == want
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and plan.count("Exchange") <= 2  # windows meet nothing and are moved by their keys alone


def test_steps_read_their_bucket_in_many_tasks(spark, monkeypatch):
    rnd = np.random.RandomState(8)
    rows = spark.createDataFrame([(bool(i % 2), rnd.randn(12).tolist()) for i in range(200)], "label boolean, x array<double>").repartition(4)
    step, files, seen = N.step_gradient, [], []

    def watched(rows, *rest):
        files.append(rows.select(F.input_file_name()).distinct().count())
        found = step(rows, *rest)
        seen.append(found[0])
        return found

    monkeypatch.setattr(N, "step_gradient", watched)
    for train in (rows, N.in_buckets(rows, 5)):  # buckets that the net did not make are all used too
        N.fit_net(train, rows, 2, 6, hidden=4, epochs=1, batches=2)
        assert sum(seen) == 200 and len(seen) == 2 and (train is not rows or min(files) > 1), (seen, files)
        files.clear(), seen.clear()
