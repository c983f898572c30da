"""Queries on frames: features of poses and objects, boxes, crops, prompts and names."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracklake.functions import geometry as G
from tracklake.functions.names import clip_name, safe_name
from tracklake.functions.pose import frame_features as features_of
from tracklake.operators import annotations as A
from tracklake.operators import association as S
from tracklake.plans import views as V
from tracklake.plans.views import with_views

NAMES = ["cigarette", "vape", "smoke"]
BASE = ["d_left", "d_right", "d_min", "l_wrist_above_shoulder", "r_wrist_above_shoulder", "l_elbow_angle", "r_elbow_angle", "nose_conf", "l_wrist_conf", "r_wrist_conf"]
WIDTH, HEIGHT = 640.0, 480.0


def frame_features(spark, sf):
    """Vectors read as 17 keypoints of a person, the boxes of an order as the objects in the frame."""
    e = V.table(spark, sf, "embeddings").select(F.col("vec_id").alias("image"), F.transform("embedding", lambda x: x.cast("double")).alias("e"))
    at = lambda k, c: F.element_at("e", (3 * k + c + 1).cast("int"))
    point = lambda k: F.struct((200 + 800 * at(k, 0)).alias("x"), (150 + 800 * at(k, 1)).alias("y"), F.least(F.lit(1.0), F.abs(at(k, 2)) * 6).alias("conf"))
    box = F.struct(*(F.lit(v).alias(c) for c, v in (("x1", 100.0), ("y1", 50.0), ("x2", 300.0), ("y2", 450.0))))
    poses = e.select("image", F.transform(F.sequence(F.lit(0), F.lit(16)), point).alias("kp"), box.alias("box"))
    name = F.element_at(F.array(*(F.lit(c) for c, _ in V.CLASSES)), F.col("cls") + 1)
    objects = V.boxes(spark, sf).groupBy("image").agg(F.collect_list(F.struct(name.alias("name"), (F.col("disc") / 10).alias("conf"), "x1", "y1", "x2", "y2")).alias("objects"))
    frames = poses.join(objects, "image", "left").withColumn("objects", F.coalesce("objects", F.array().cast("array<struct<name:string,conf:double,x1:double,y1:double,x2:double,y2:double>>")))
    return features_of(frames, NAMES).select("image", *(F.round(F.col(f"f.{c}"), 6).alias(c) for c in (*BASE, *(f"obj_{n}" for n in NAMES))))


def box_forms(spark, sf):
    """Boxes in shares of the image, back in corners, and their padded crops."""
    w, h = F.lit(WIDTH), F.lit(HEIGHT)
    b = V.boxes(spark, sf)
    normal = G.to_normal(*(F.col(c) for c in ("x1", "y1", "x2", "y2")), w, h)
    n = b.select("image", "idx", *(v.alias(c) for v, c in zip(normal, ("cx", "cy", "nw", "nh"), strict=True)), G.crop_box(*(F.col(c) for c in ("x1", "y1", "x2", "y2")), F.lit(int(WIDTH)), F.lit(int(HEIGHT))).alias("crop"))
    corners = G.to_corners(*(F.col(c) for c in ("cx", "cy", "nw", "nh")), w, h)
    return n.select("image", "idx", *(F.round(c, 9).alias(c) for c in ("cx", "cy", "nw", "nh")), *(F.round(v, 6).alias(c) for v, c in zip(corners, ("bx1", "by1", "bx2", "by2"), strict=True)), *(F.col(f"crop.{c}").alias(f"crop_{c}") for c in ("x1", "y1", "x2", "y2")))


def polygon_boxes(spark, sf):
    """Vectors read as polygons, the last value of some without a partner, as boxes."""
    e = V.table(spark, sf, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("e"))
    cut = F.slice("e", F.lit(1), (8 + F.col("vec_id") % 9).cast("int"))
    return e.select("vec_id", G.polygon_box(cut).alias("b")).select("vec_id", *(F.round(f"b.{c}", 9).alias(c) for c in ("cx", "cy", "w", "h")))


def part_prompts(spark, sf):
    """Part types as classes whose words are their prompts; types of one kind have none and so are their own."""
    types = V.table(spark, sf, "part").select(F.col("p_type").alias("class")).distinct()
    words = F.when(F.col("class").startswith("STANDARD"), F.array().cast("array<string>")).otherwise(F.split("class", " "))
    taxonomy = types.select(F.crc32("class").alias("class_id"), "class", words.alias("prompts"))
    rows = A.prompts(taxonomy.withColumn("class_id", F.length("class")), background=True)
    return rows.groupBy("class_id", "place", "prompt").agg(F.count("*").alias("n"))


def dropped_sources(spark, sf):
    """Suppliers as sources, of some of which no line maps to a class."""
    b = V.table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("source"), F.when(F.expr("l_quantity > 44 AND l_suppkey % 4 <> 1"), "big").alias("target"))
    return A.all_dropped(b.where("source % 3 = 0").groupBy("source", "target").agg(F.count("*").alias("n")).where("n > 5"))


def latest_versions(spark, sf):
    """The largest number at the end of each customer's paths; paths that end otherwise do not count."""
    o = V.table(spark, sf, "orders").select(F.col("o_custkey").alias("source"), F.concat(F.lit("space/"), "o_orderstatus", F.lit("/"), F.when(F.col("o_orderkey") % 7 == 0, "draft").otherwise((F.col("o_orderkey") % 1000).cast("string"))).alias("p"))
    return A.latest_version(o, F.col("p"))


def clip_names(spark, sf):
    p = V.table(spark, sf, "pages")
    return p.select("page_id", clip_name(F.col("url")).alias("clip"), safe_name(F.col("url")).alias("folder"))


def subset_boxes(spark, sf):
    return A.class_subset(V.truth(spark, sf), [0, 2]).groupBy("cls").agg(F.count("*").alias("n"), F.sum("x1").alias("x1"))


def box_tracks(spark, sf):
    """Orders as frames, 500 to a clip, and their boxes as detections, joined to tracks; no SQL equivalent."""
    b = V.boxes(spark, sf).where("cls < 2").select(F.floor(F.col("image") / 500).alias("clip"), (F.col("image") % 500).alias("frame_no"), F.col("idx").alias("det_idx"), ((F.col("disc") + 1) / 11).alias("conf"), "x1", "y1", "x2", "y2")
    return S.associated(b, S.AssociationParams(near_low=0.3, max_missing=8))


QUERIES = {f.__name__: f for f in (box_tracks, frame_features, box_forms, polygon_boxes, part_prompts, dropped_sources, latest_versions, clip_names, subset_boxes)}


def _features_sql() -> str:
    """The features by the keypoints' fixed numbers: nose 0, eyes 1 and 2, shoulders 5 and 6, elbows 7 and 8, wrists 9 and 10."""
    ok = lambda k: f"kp[{k + 1}].c >= 0.3"
    gap = lambda a, b: f"sqrt(pow({a}.x - {b}.x, 2) + pow({a}.y - {b}.y, 2))"
    wrist = lambda k: f"CASE WHEN m IS NOT NULL AND {ok(k)} THEN {gap(f'kp[{k + 1}]', 'm')} / s END"
    above = lambda w, s: f"({ok(w)} AND {ok(s)} AND kp[{w + 1}].y < kp[{s + 1}].y)::INT::DOUBLE"

    def elbow(a: int, b: int, c: int) -> str:
        ax, ay, bx, by = (f"(kp[{p + 1}].{v} - kp[{b + 1}].{v})" for p in (a, c) for v in "xy")
        n = f"(sqrt({ax} * {ax} + {ay} * {ay}) * sqrt({bx} * {bx} + {by} * {by}))"
        return f"CASE WHEN {ok(a)} AND {ok(b)} AND {ok(c)} AND {n} > 0 THEN degrees(acos(least(1.0, greatest(-1.0, ({ax} * {bx} + {ay} * {by}) / {n})))) / 180 END"

    hands = " OR ".join(f"({ok(k)} AND sqrt(pow(o.ox - kp[{k + 1}].x, 2) + pow(o.oy - kp[{k + 1}].y, 2)) / s <= 0.6)" for k in (9, 10))
    face = "CASE WHEN m IS NOT NULL THEN sqrt(pow(o.ox - m.x, 2) + pow(o.oy - m.y, 2)) / s <= CASE WHEN o.cls = 4 THEN 1.5 ELSE 0.8 END ELSE o.ox BETWEEN 100 AND 300 AND o.oy BETWEEN 50 AND 50 + 0.35 * 400 END"
    near = f"near AS (SELECT h.image, o.cls, max(o.conf) AS conf FROM held h JOIN (SELECT image, cls, disc / 10 AS conf, (x1 + x2) / 2 AS ox, (y1 + y2) / 2 AS oy FROM boxes) o ON o.image = h.image WHERE ({face}) OR (o.cls <> 4 AND ({hands})) GROUP BY ALL)"
    point = "{'x': 200 + 800 * e[3 * k + 1], 'y': 150 + 800 * e[3 * k + 2], 'c': least(1.0, abs(e[3 * k + 3]) * 6)}"
    eyes = lambda v: f"CASE WHEN {ok(1)} AND {ok(2)} THEN kp[1].{v} + 0.6 * (kp[1].{v} - (kp[2].{v} + kp[3].{v}) / 2) ELSE kp[1].{v} END"
    ctes = [
        f"pose AS (SELECT vec_id AS image, list_transform(range(17), lambda k: {point}) AS kp FROM (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings))",
        f"held AS (SELECT image, kp, CASE WHEN {ok(5)} AND {ok(6)} AND {gap('kp[6]', 'kp[7]')} >= 1 THEN {gap('kp[6]', 'kp[7]')} ELSE 100.0 END AS s, CASE WHEN {ok(0)} THEN {{'x': {eyes('x')}, 'y': {eyes('y')}}} END AS m FROM pose)",
        near,
    ]
    values = {"d_left": wrist(9), "d_right": wrist(10), "d_min": f"least({wrist(9)}, {wrist(10)})", "l_wrist_above_shoulder": above(9, 5), "r_wrist_above_shoulder": above(10, 6), "l_elbow_angle": elbow(5, 7, 9), "r_elbow_angle": elbow(6, 8, 10), "nose_conf": "kp[1].c", "l_wrist_conf": "kp[10].c", "r_wrist_conf": "kp[11].c"}
    values |= {f"obj_{n}": f"coalesce((SELECT conf FROM near WHERE near.image = held.image AND cls = {k}), 0.0)" for n, k in (("cigarette", 0), ("vape", 1), ("smoke", 4))}
    return with_views("SELECT image, " + ", ".join(f"round({v}, 6) AS {n}" for n, v in values.items()) + " FROM held", "boxes", more=", ".join(ctes))


ORACLE_SQL = {
    "frame_features": _features_sql(),
    "box_forms": with_views("""SELECT image, idx, round((x1 + x2) / 2 / 640, 9) AS cx, round((y1 + y2) / 2 / 480, 9) AS cy, round((x2 - x1) / 640, 9) AS nw, round((y2 - y1) / 480, 9) AS nh, round(x1, 6) AS bx1, round(y1, 6) AS by1, round(x2, 6) AS bx2, round(y2, 6) AS by2,
        l AS crop_x1, t AS crop_y1, greatest(trunc(least(x2 + (x2 - x1) * 0.3, 640))::INT, l + 2) AS crop_x2, greatest(trunc(least(y2 + (y2 - y1) * 0.3, 480))::INT, t + 2) AS crop_y2 FROM (SELECT *, trunc(greatest(x1 - (x2 - x1) * 0.3, 0))::INT AS l, trunc(greatest(y1 - (y2 - y1) * 0.3, 0))::INT AS t FROM boxes)""", "boxes"),
    "polygon_boxes": """SELECT vec_id, round((list_min(xs) + list_max(xs)) / 2, 9) AS cx, round((list_min(ys) + list_max(ys)) / 2, 9) AS cy, round(list_max(xs) - list_min(xs), 9) AS w, round(list_max(ys) - list_min(ys), 9) AS h
        FROM (SELECT vec_id, list_transform(range(n // 2), lambda i: e[2 * i + 1]) AS xs, list_transform(range(n // 2), lambda i: e[2 * i + 2]) AS ys FROM (SELECT vec_id, 8 + vec_id % 9 AS n, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings))""",
    "part_prompts": """SELECT class_id, place, prompt, count(*) AS n FROM (SELECT length(class)::INT AS class_id, i::INT AS place, p[i + 1] AS prompt FROM (SELECT *, unnest(range(len(p))) AS i FROM (SELECT DISTINCT p_type AS class, CASE WHEN p_type LIKE 'STANDARD%' THEN [p_type] ELSE string_split(p_type, ' ') END AS p FROM part)) UNION ALL SELECT NULL, 0, '') GROUP BY ALL""",
    "dropped_sources": "SELECT source FROM (SELECT l_suppkey AS source, CASE WHEN l_quantity > 44 AND l_suppkey % 4 <> 1 THEN 'big' END AS target FROM lineitem WHERE l_suppkey % 3 = 0 GROUP BY ALL HAVING count(*) > 5) GROUP BY 1 HAVING bool_and(target IS NULL)",
    "latest_versions": "SELECT o_custkey AS source, max(CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey % 1000 END)::INT AS version FROM orders GROUP BY 1",
    "clip_names": r"SELECT page_id, regexp_replace(regexp_replace(b, '(.)\.[^.]*$', '\1'), '[^A-Za-z0-9_-]+', '_', 'g') AS clip, left(regexp_replace(url, '[^A-Za-z0-9]+', '_', 'g'), 40) AS folder FROM (SELECT *, string_split(url, '/')[-1] AS b FROM pages)",
    "subset_boxes": with_views("SELECT cls, count(*) AS n, sum(x1) AS x1 FROM truth WHERE cls IN (0, 2) GROUP BY 1", "truth"),
}
