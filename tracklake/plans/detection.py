"""Queries on detections against ground truth."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracklake.functions.geometry import size_bucket
from tracklake.operators import evaluate as E
from tracklake.plans import views as V
from tracklake.plans.views import OBJECTS, with_views
from tracklake.storage import materialize

INTER = "greatest(least({a}.x2, {b}.x2) - greatest({a}.x1, {b}.x1), 0) * greatest(least({a}.y2, {b}.y2) - greatest({a}.y1, {b}.y1), 0)"
AREA = "({a}.x2 - {a}.x1) * ({a}.y2 - {a}.y1)"


def _iou(a: str, b: str) -> str:
    inter = INTER.format(a=a, b=b)
    return f"({inter}) / ({AREA.format(a=a)} + {AREA.format(a=b)} - ({inter}))"


MATCH = f"""ranked AS (SELECT *, row_number() OVER (PARTITION BY image, cls ORDER BY conf DESC, det_idx) AS k FROM pred),
cands AS (SELECT p.image, p.cls, p.k, p.det_idx, coalesce(list({{'v': {_iou('p', 'g')}, 'neg': -g.gt_idx}}) FILTER (g.gt_idx IS NOT NULL), []) AS c FROM ranked p LEFT JOIN truth g ON p.image = g.image AND p.cls = g.cls GROUP BY ALL),
fold(image, cls, k, det_idx, tp, used) AS (SELECT DISTINCT image, cls, 0::BIGINT, NULL::INT, false, []::INT[] FROM ranked
UNION ALL SELECT f.image, f.cls, c.k, c.det_idx, coalesce(b.v >= 0.5, false), CASE WHEN coalesce(b.v >= 0.5, false) THEN list_append(f.used, b.neg::INT) ELSE f.used END
FROM fold f JOIN (SELECT * FROM cands) c ON f.image = c.image AND f.cls = c.cls AND c.k = f.k + 1, LATERAL (SELECT list_max(list_filter(c.c, lambda x: NOT list_contains(f.used, x.neg::INT))) AS b)),
matched AS (SELECT p.*, tp FROM pred p JOIN fold f ON p.image = f.image AND p.cls = f.cls AND p.det_idx = f.det_idx)"""
NMS = f"""ranked AS (SELECT *, row_number() OVER (PARTITION BY image, cls ORDER BY conf DESC, det_idx) AS k FROM pred),
near AS (SELECT p.image, p.cls, p.k, p.det_idx, coalesce(list(q.det_idx) FILTER (q.det_idx IS NOT NULL), []) AS c FROM ranked p LEFT JOIN ranked q ON p.image = q.image AND p.cls = q.cls AND q.k < p.k AND {_iou('p', 'q')} >= 0.6 GROUP BY ALL),
fold(image, cls, k, det_idx, keep, kept) AS (SELECT DISTINCT image, cls, 0::BIGINT, NULL::INT, false, []::INT[] FROM ranked
UNION ALL SELECT f.image, f.cls, n.k, n.det_idx, NOT list_has_any(f.kept, n.c), CASE WHEN list_has_any(f.kept, n.c) THEN f.kept ELSE list_append(f.kept, n.det_idx) END FROM fold f JOIN near n ON f.image = n.image AND f.cls = n.cls AND n.k = f.k + 1)"""
AP = """counted AS (SELECT *, sum(tp::INT) OVER w AS ctp, row_number() OVER w AS n FROM matched WINDOW w AS (PARTITION BY cls ORDER BY conf DESC, image, det_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
env AS (SELECT *, max(ctp / n) OVER (PARTITION BY cls ORDER BY conf DESC, image, det_idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS e FROM counted),
areas AS (SELECT cls, sum(CASE WHEN tp THEN e ELSE 0 END) AS area FROM env GROUP BY 1),
ap AS (SELECT cls, n_gt, area / n_gt AS ap FROM (SELECT cls, count(*) AS n_gt FROM truth GROUP BY 1) JOIN areas USING (cls))"""


def _matched(spark, sf):
    return materialize(E.match(V.truth(spark, sf), V.predictions(spark, sf)), "matched")


def match_detections(spark, sf):
    return _matched(spark, sf).select("image", "cls", "det_idx", "conf", "tp")


def nms(spark, sf):
    return E.suppress(V.predictions(spark, sf)).select("image", "cls", "det_idx", "conf")


def _ap(spark, sf):
    counts = V.truth(spark, sf).groupBy("cls").agg(F.count("*").alias("n_gt"))
    return E.average_precision(_matched(spark, sf), counts)


def average_precision(spark, sf):
    return _ap(spark, sf).select("cls", "n_gt", F.round("ap", 9).alias("ap"))


def mean_average_precision(spark, sf):
    return _ap(spark, sf).agg(F.round(F.avg("ap"), 9).alias("map50"), F.count("ap").alias("n_classes"))


def image_level(spark, sf):
    out = E.image_level(V.images(spark, sf), V.truth(spark, sf), V.predictions(spark, sf), OBJECTS)
    return out.select("tp", "fp", "fn", "tn", *(F.round(c, 9).alias(c) for c in ("precision", "recall", "fpr")))


def recall_by_size(spark, sf):
    return E.recall_by_size(V.truth(spark, sf), V.predictions(spark, sf)).select("size", "n", "n_hit", F.round("recall", 9).alias("recall"))


def size_counts(spark, sf):
    return V.truth(spark, sf).groupBy("cls", size_bucket(*(F.col(c) for c in ("x1", "y1", "x2", "y2"))).alias("size")).agg(F.count("*").alias("n"))


def best_objects(spark, sf):
    return E.best_object(V.predictions(spark, sf), OBJECTS)


def mined_top(spark, sf):
    return E.mined(V.predictions(spark, sf), OBJECTS)


def screened(spark, sf):
    return E.screen(V.images(spark, sf), V.predictions(spark, sf), OBJECTS, 0.45).groupBy("use").agg(F.count("*").alias("n"), F.round(F.sum("screen_conf"), 6).alias("conf"))


def evaluation_report(spark, sf):
    """The whole report in long form."""
    ap = materialize(_ap(spark, sf), "ap")
    level = materialize(E.image_level(V.images(spark, sf), V.truth(spark, sf), V.predictions(spark, sf), OBJECTS), "level")
    rows = ap.select(F.lit("ap50").alias("metric"), F.col("cls").cast("string").alias("key"), F.col("ap").alias("value"))
    rows = rows.unionByName(ap.agg(F.avg("ap").alias("value")).select(F.lit("map50").alias("metric"), F.lit("").alias("key"), "value"))
    wide = F.explode(F.array(*(F.struct(F.lit(c).alias("key"), F.col(c).cast("double").alias("value")) for c in ("tp", "fp", "fn", "tn", "precision", "recall", "fpr"))))
    rows = rows.unionByName(level.select(wide.alias("x")).select(F.lit("image_level").alias("metric"), "x.key", "x.value"))
    size = E.recall_by_size(V.truth(spark, sf), V.predictions(spark, sf))
    rows = rows.unionByName(size.select(F.lit("recall_by_size").alias("metric"), F.col("size").alias("key"), F.col("recall").alias("value")))
    return rows.withColumn("value", F.round("value", 9))


HAS = "SELECT image, EXISTS (SELECT 1 FROM truth t WHERE t.image = i.image AND cls < 4) AS has, EXISTS (SELECT 1 FROM pred p WHERE p.image = i.image AND cls < 4 AND conf >= 0.25) AS said FROM images i"
HIT = f"SELECT g.*, EXISTS (SELECT 1 FROM pred p WHERE p.image = g.image AND p.cls = g.cls AND p.conf >= 0.25 AND {_iou('g', 'p')} >= 0.5) AS hit FROM truth g"
SIZE = "CASE WHEN sqrt((x2 - x1) * (y2 - y1)) < 32 THEN 'small' WHEN sqrt((x2 - x1) * (y2 - y1)) < 96 THEN 'medium' ELSE 'large' END"
LEVEL = f"lvl AS (SELECT count(*) FILTER (has AND said) AS tp, count(*) FILTER (NOT has AND said) AS fp, count(*) FILTER (has AND NOT said) AS fn, count(*) FILTER (NOT has AND NOT said) AS tn FROM ({HAS}))"
BEST = "best AS (SELECT image, det_idx, cls, conf FROM pred WHERE cls < 4 QUALIFY row_number() OVER (PARTITION BY image ORDER BY conf DESC, det_idx, cls) = 1)"
QUERIES = {f.__name__: f for f in (match_detections, nms, average_precision, mean_average_precision, image_level, recall_by_size, size_counts, best_objects, mined_top, screened, evaluation_report)}
ORACLE_SQL = {
    "match_detections": with_views("SELECT image, cls, det_idx, conf, tp FROM matched", "truth", "pred", recursive=True, more=MATCH),
    "nms": with_views("SELECT f.image, f.cls, f.det_idx, p.conf FROM fold f JOIN pred p ON f.image = p.image AND f.det_idx = p.det_idx WHERE keep", "pred", recursive=True, more=NMS),
    "average_precision": with_views("SELECT cls, n_gt, round(ap, 9) AS ap FROM ap", "truth", "pred", recursive=True, more=f"{MATCH}, {AP}"),
    "mean_average_precision": with_views("SELECT round(avg(ap), 9) AS map50, count(ap) AS n_classes FROM ap", "truth", "pred", recursive=True, more=f"{MATCH}, {AP}"),
    "image_level": with_views("SELECT tp, fp, fn, tn, round(tp / (tp + fp), 9) AS precision, round(tp / (tp + fn), 9) AS recall, round(fp / (fp + tn), 9) AS fpr FROM lvl", "truth", "pred", "images", more=LEVEL),
    "recall_by_size": with_views(f"SELECT {SIZE} AS size, count(*) AS n, count(*) FILTER (hit) AS n_hit, round(count(*) FILTER (hit) / count(*), 9) AS recall FROM ({HIT}) GROUP BY 1", "truth", "pred"),
    "size_counts": with_views(f"SELECT cls, {SIZE} AS size, count(*) AS n FROM truth GROUP BY ALL", "truth"),
    "best_objects": with_views("SELECT * FROM best", "pred", more=BEST),
    "mined_top": with_views("SELECT * FROM best ORDER BY conf DESC, image LIMIT 200", "pred", more=BEST),
    "screened": with_views("SELECT conf < 0.45 AS use, count(*) AS n, round(sum(conf), 6) AS conf FROM (SELECT i.image, coalesce(max(p.conf), 0.0) AS conf FROM images i LEFT JOIN pred p ON i.image = p.image AND p.cls < 4 GROUP BY 1) GROUP BY 1", "pred", "images"),
    "evaluation_report": with_views(f"""SELECT 'ap50' AS metric, cls::VARCHAR AS key, round(ap, 9) AS value FROM ap UNION ALL SELECT 'map50', '', round(avg(ap), 9) FROM ap
        UNION ALL SELECT 'image_level', key, round(value, 9) FROM (SELECT tp::DOUBLE AS tp, fp::DOUBLE AS fp, fn::DOUBLE AS fn, tn::DOUBLE AS tn, tp / (tp + fp) AS precision, tp / (tp + fn) AS recall, fp / (fp + tn) AS fpr FROM lvl) UNPIVOT (value FOR key IN (tp, fp, fn, tn, precision, recall, fpr))
        UNION ALL SELECT 'recall_by_size', {SIZE}, round(count(*) FILTER (hit) / count(*), 9) FROM ({HIT}) GROUP BY 2""", "truth", "pred", "images", recursive=True, more=f"{MATCH}, {AP}, {LEVEL}"),
}
