"""Per-frame features of one person from 17 keypoints and the objects in the frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklake.functions.geometry import distance
from tracklake.params import FeatureParams

NOSE, L_EYE, R_EYE, L_SH, R_SH, L_EL, R_EL, L_WR, R_WR = 0, 1, 2, 5, 6, 7, 8, 9, 10


def frame_features(frames: DataFrame, classes: list[str], p: FeatureParams | None = None) -> DataFrame:
    """Adds ``f`` to frames with ``kp`` (array of x, y, conf), ``box`` (x1..y2) and ``objects``
    (array of name, conf, x1..y2). Missing distances and angles are null; a keypoint without a
    confidence counts as missing in all but the confidence features, which are 1 then.
    """
    p = p or FeatureParams()
    at = lambda k: F.element_at("kp", k + 1)
    ok = lambda k: F.coalesce(at(k)["conf"] >= p.kp_conf_thr, F.lit(False))
    box = F.col("box")
    tall = box["y2"] - box["y1"]
    shoulders = F.when(ok(L_SH) & ok(R_SH), distance(at(L_SH), at(R_SH)))
    scale = F.when(F.coalesce(shoulders >= 1, F.lit(False)), shoulders).otherwise(F.greatest(0.25 * tall, F.lit(1.0)))
    nose = at(NOSE)

    def mouth_axis(c: str) -> Column:
        both = ok(L_EYE) & ok(R_EYE)
        return F.when(both, nose[c] + 0.6 * (nose[c] - (at(L_EYE)[c] + at(R_EYE)[c]) / 2)).otherwise(nose[c])

    frames = frames.withColumn("_scale", scale).withColumn("_mouth", F.when(ok(NOSE), F.struct(mouth_axis("x").alias("x"), mouth_axis("y").alias("y"))))
    mouth, s = F.col("_mouth"), F.col("_scale")
    wrist = lambda k: F.when(mouth.isNotNull() & ok(k), distance(at(k), mouth) / s)
    above = lambda w, sh: (ok(w) & ok(sh) & (at(w)["y"] < at(sh)["y"])).cast("double")

    def elbow(sh: int, el: int, wr: int) -> Column:
        ax, ay, bx, by = at(sh)["x"] - at(el)["x"], at(sh)["y"] - at(el)["y"], at(wr)["x"] - at(el)["x"], at(wr)["y"] - at(el)["y"]
        n = F.sqrt(ax * ax + ay * ay) * F.sqrt(bx * bx + by * by)
        cos = F.try_divide(ax * bx + ay * by, n)
        return F.when(ok(sh) & ok(el) & ok(wr) & (n > 0), F.degrees(F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), cos)))) / 180)

    def near(o: Column) -> Column:
        centre = F.struct(((o["x1"] + o["x2"]) / 2).alias("x"), ((o["y1"] + o["y2"]) / 2).alias("y"))
        smoke = o["name"] == p.smoke_class
        face = F.when(mouth.isNotNull(), distance(centre, mouth) / s <= F.when(smoke, p.radius_smoke).otherwise(p.radius_face)).otherwise(
            centre["x"].between(box["x1"], box["x2"]) & centre["y"].between(box["y1"], box["y1"] + 0.35 * tall)
        )
        hand = F.lit(False)
        for k in (L_WR, R_WR):
            hand = hand | (ok(k) & F.coalesce(distance(centre, at(k)) / s <= p.radius_hand, F.lit(False)))
        return face | (~smoke & hand)

    def best(c: str) -> Column:
        own = F.transform(F.filter("objects", lambda o: (o["name"] == c) & near(o)), lambda o: o["conf"])
        return F.coalesce(F.array_max(own), F.lit(0.0))

    conf = lambda k: F.coalesce(at(k)["conf"], F.lit(1.0))
    f = F.struct(
        wrist(L_WR).alias("d_left"), wrist(R_WR).alias("d_right"), F.least(wrist(L_WR), wrist(R_WR)).alias("d_min"),
        above(L_WR, L_SH).alias("l_wrist_above_shoulder"), above(R_WR, R_SH).alias("r_wrist_above_shoulder"),
        elbow(L_SH, L_EL, L_WR).alias("l_elbow_angle"), elbow(R_SH, R_EL, R_WR).alias("r_elbow_angle"),
        conf(NOSE).alias("nose_conf"), conf(L_WR).alias("l_wrist_conf"), conf(R_WR).alias("r_wrist_conf"),
        *(best(c).alias(f"obj_{c}") for c in classes),
    )
    return frames.withColumn("f", f).drop("_scale", "_mouth")
