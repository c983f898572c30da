"""Expected values of the operators on small literal tables."""

import pytest
from pyspark.sql import functions as F

from tracklake.functions import geometry, motion, names
from tracklake.functions.pose import frame_features
from tracklake.operators import annotations, dedupe, evaluate, learning, tracks
from tracklake.operators.graph import connected_components
from tracklake.params import EventParams, FusionParams, MotionParams, OnlineParams
from tracklake.sources import files


def test_components_are_smallest_members(spark):
    edges = spark.createDataFrame([(5, 4), (4, 3), (9, 8), (3, 1), (7, 7), (None, 2)], "src long, dst long")
    found = {r.node: r.component for r in connected_components(edges).collect()}
    assert found == {1: 1, 3: 1, 4: 1, 5: 1, 8: 8, 9: 8}
    assert connected_components(edges.limit(0)).count() == 0


def test_long_chain(spark):
    edges = spark.range(60).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    assert {r.component for r in connected_components(edges).collect()} == {0}


def test_names(spark):
    rows = spark.createDataFrame([("IMG_42_jpg.rf.abc123.jpg",), ("plain.png",)], "n string")
    assert [r[0] for r in rows.select(names.photo_stem(F.col("n"))).collect()] == ["IMG_42_jpg", "plain"]
    path = spark.createDataFrame([("/a/images/b/images/c.jpg",)], "p string").select(names.label_path(F.col("p"))).first()[0]
    assert path == "/a/images/b/labels/c.txt"


def test_labels(spark):
    lines = spark.createDataFrame([("x", 0, "1 0.5 0.5 0.2 0.4"), ("x", 1, "0 0.1 0.1 0.3 0.1 0.3 0.5 0.1 0.5"), ("x", 2, "0 1 2"), ("x", 3, "2 0.5 0.5 0 0.1")], "path string, line_no int, value string")
    got = [(r.cls, round(r.cx, 6), round(r.cy, 6), round(r.w, 6), round(r.h, 6)) for r in files.parse_labels(lines).orderBy("line_no").collect()]
    assert got == [(1, 0.5, 0.5, 0.2, 0.4), (0, 0.2, 0.3, 0.2, 0.4)]


def test_taxonomy(spark):
    tax = files.taxonomy(spark, {"classes": ["cigarette", "vape"], "objects": ["vape"], "prompts": {"vape": ["e-cig", "pod"]}})
    assert [(r.class_id, r.prompt) for r in annotations.prompts(tax).orderBy("class_id", "place").collect()] == [(0, "cigarette"), (1, "e-cig"), (1, "pod")]
    with pytest.raises(ValueError):
        files.taxonomy(spark, {"classes": ["a"], "objects": ["b"]})
    mapping = spark.createDataFrame([("s", "Cigarette", "cigarette"), ("s", "person", None)], files.CLASS_MAP)
    own = spark.createDataFrame([("s", "cigarette "), ("s", "Person"), ("s", "weird")], "source string, name string")
    assert {r.name: r.status for r in annotations.remap(own, mapping, tax).collect()} == {"cigarette ": "mapped", "Person": "dropped", "weird": "unmapped"}
    with pytest.raises(ValueError):
        annotations.refuse_unmapped(own, mapping)


def test_hamming_pairs(spark):
    far = 0xFFFF0000FFFF0000 - (1 << 64)
    rows = spark.createDataFrame([(0, 0, None), (1, 1, None), (2, 3, None), (3, far, None), (4, far + 7, None), (5, None, None)], "idx long, h long, mirror long")
    assert sorted((r.i, r.j) for r in dedupe.hamming_pairs(rows, 3, 5).collect()) == [(0, 1), (0, 2), (1, 2), (3, 4)]


def test_keep_policy(spark):
    rows = [(1, "a", "train", 0, 1), (2, "b", "train", 1, 1), (3, "a", "train", 0, 3), (4, "t", "test", 2, 3), (5, "a", "train", 0, 5), (6, "a", "train", 0, 5)]
    got = dedupe.keep_policy(spark.createDataFrame(rows, "idx long, source string, role string, priority int, group_id long"))
    assert {r.idx: r.drop_reason for r in got.collect()} == {1: "", 2: "cross_source_dup", 3: "test_leak", 4: "", 5: "", 6: ""}


def test_group_split(spark):
    rows = spark.range(300).select(F.col("id").alias("idx"), F.lit("s").alias("source"), (F.col("id") / 3).cast("long").alias("group_id"))
    out = dedupe.group_split(rows, 0.1).groupBy("group_id").agg(F.countDistinct("split").alias("n"), F.max("split").alias("split")).collect()
    assert all(r.n == 1 for r in out) and 8 <= sum(r.split == "val" for r in out) <= 15
    with pytest.raises(ValueError):
        dedupe.group_split(rows, 1.0)


def test_average_precision(spark):
    kind = "cls int, image long, det_idx int, conf double, tp boolean"
    rows = [(0, 1, 1, 0.9, True), (0, 1, 2, 0.8, True), (1, 1, 1, 0.9, True), (1, 1, 2, 0.8, False), (2, 1, 1, 0.9, False), (2, 1, 2, 0.8, True)]
    counts = spark.createDataFrame([(0, 2), (1, 2), (2, 1), (3, 0)], "cls int, n_gt long")
    got = {r.cls: r.ap for r in evaluate.average_precision(spark.createDataFrame(rows, kind), counts).collect()}
    assert got == {0: 1.0, 1: 0.5, 2: 0.5, 3: None}


def test_suppression_and_matching(spark):
    kind = "image long, det_idx int, cls int, conf double, x1 double, y1 double, x2 double, y2 double"
    pred = spark.createDataFrame([(1, 1, 0, 0.9, 0.0, 0.0, 10.0, 10.0), (1, 2, 0, 0.8, 0.0, 1.0, 10.0, 10.0), (1, 3, 1, 0.7, 0.0, 0.0, 10.0, 10.0)], kind)
    assert sorted(r.det_idx for r in evaluate.suppress(pred).collect()) == [1, 3]
    gt = spark.createDataFrame([(1, 1, 0, 0.0, 0.0, 10.0, 10.0)], "image long, gt_idx int, cls int, x1 double, y1 double, x2 double, y2 double")
    assert {r.det_idx: r.tp for r in evaluate.match(gt, pred).collect()} == {1: True, 2: False, 3: False}


def _score(spark, d, window=60):
    p = MotionParams()
    df = spark.createDataFrame([([float(x) for x in d],)], "d array<double>").select(motion.smoothed(F.col("d")).alias("s"))
    return df.select(motion.motion_score(motion.episodes(F.col("s"), 10, p), F.size("s"), 10, window, p)).first()[0]


def test_motion(spark):
    assert _score(spark, [2.0] * 20 + [0.3] * 12 + [2.0] * 28) == 1.0
    assert _score(spark, [2.0] * 10 + [0.3] * 190) <= 0.2
    assert _score(spark, [2.0] * 60) == 0.0
    assert _score(spark, ([2.0] * 10 + [0.3] * 10) * 8 + [2.0] * 10) <= 0.5


def test_fusion(spark):
    rows = spark.createDataFrame([(0.4, 0.6), (0.8, 0.0), (0.1, 0.96), (0.3, 0.9), (0.0, 0.0)], "o double, m double")
    got = rows.select(motion.fuse(F.col("o"), F.col("m"), FusionParams()).alias("f")).select("f.*").collect()
    assert [(r.decision, r.reason) for r in got] == [(True, "object+motion"), (True, "object"), (True, "motion"), (False, ""), (False, "")]


def test_events(spark):
    rows = [(1, 0, t, d, 0.9, 0.9, 0.9, "object" if d else "") for t, d in enumerate([False, True, True, True, False, False, False, False])]
    judged = spark.createDataFrame(rows, "track long, session long, step long, decision boolean, score double, obj_score double, mot_score double, reason string")
    got = [(r.start_step, r.end_step, r.n_positive) for r in tracks.events(judged, EventParams(4, 2, 3)).collect()]
    assert got == [(2, 6, 2)]


def test_gap_filling(spark):
    grid = spark.createDataFrame([(1, 0, None, None, 0), (1, 1, 0.5, 0.8, 1), (1, 2, None, None, 0), (1, 3, 0.7, 0.1, 1)], "track long, step long, d double, obj double, present int")
    got = tracks.gap_filled(grid, ["track"]).orderBy("step").collect()
    assert [(r.present, r.d, r.obj) for r in got] == [(0, 3.0, 0.0), (1, 0.5, 0.8), (0, 0.5, 0.0), (1, 0.7, 0.1)]


def test_pose(spark):
    kp = [(0.0, 0.0, 0.0)] * 17
    for k, x, y in ((0, 100, 100), (1, 95, 95), (2, 105, 95), (5, 80, 140), (6, 120, 140), (9, 100, 106)):
        kp[k] = (float(x), float(y), 0.9)
    objects = [("cigarette", 0.8, 98.0, 100.0, 104.0, 106.0), ("vape", 0.9, 300.0, 300.0, 310.0, 310.0)]
    kind = "kp array<struct<x:double,y:double,conf:double>>, box struct<x1:double,y1:double,x2:double,y2:double>, objects array<struct<name:string,conf:double,x1:double,y1:double,x2:double,y2:double>>"
    f = frame_features(spark.createDataFrame([(kp, (60.0, 80.0, 140.0, 300.0), objects)], kind), ["cigarette", "vape"]).first().f
    assert f.d_min < 0.6 and f.obj_cigarette == 0.8 and f.obj_vape == 0.0 and f.l_wrist_above_shoulder == 1.0 and f.r_elbow_angle is None


def test_geometry(spark):
    one = spark.range(1)
    lit = lambda *v: [F.lit(float(x)) for x in v]
    assert one.select(geometry.iou(lit(0, 0, 10, 10), lit(5, 0, 15, 10))).first()[0] == pytest.approx(1 / 3)
    assert one.select(geometry.iou(lit(0, 0, 0, 0), lit(0, 0, 0, 0))).first()[0] == 0.0
    crop = one.select(geometry.crop_box(*lit(0, 0, 10, 10), F.lit(100), F.lit(100)).alias("c")).first().c
    assert (crop.x1, crop.y1, crop.x2, crop.y2) == (0, 0, 13, 13)


def test_percentile_and_auroc(spark):
    one = spark.createDataFrame([([0.0] * 59 + [0.9],), ([0.6] * 30 + [0.0] * 30,)], "v array<double>")
    assert [r[0] for r in one.select(tracks.percentile(F.col("v"), 80)).collect()] == [0.0, 0.6]
    scored = spark.createDataFrame([(True, 0.9), (True, 0.5), (False, 0.5), (False, 0.1)], "label boolean, score double")
    assert learning.auroc(scored).first().auroc == 0.875


def test_params():
    assert OnlineParams.from_seconds(10) == OnlineParams()
    with pytest.raises(TypeError):
        MotionParams(nothing=1)
