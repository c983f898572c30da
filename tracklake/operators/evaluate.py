"""Detection evaluation: matching, average precision, image level, recall by size, suppression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracklake.functions.geometry import iou, size_bucket
from tracklake.operators.learning import in_cells
from tracklake.storage import materialize

BOX = ("x1", "y1", "x2", "y2")


def _corners(s: Column) -> list[Column]:
    return [s[c] for c in BOX]


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def match(gt: DataFrame, pred: DataFrame, iou_thr: float = 0.5, images: DataFrame | None = None) -> DataFrame:
    """``pred`` (image, det_idx, cls, conf, box) with ``tp``; with ``images``, of these alone.

    Within image and class, predictions in descending confidence (then det_idx) each take the ground
    truth of largest overlap that is still free, the first of equals, and hit if it reaches
    ``iou_thr``. Each group is one array, folded in the JVM; groups are the boxes of one image.
    """
    if images is not None:
        pred = pred.join(images.select("image"), "image", "left_semi")
    truth = gt.groupBy("image", "cls").agg(F.array_sort(F.collect_list(F.struct("gt_idx", *BOX))).alias("truth"))
    order = F.array_sort(F.collect_list(F.struct((-F.col("conf")).alias("down"), "det_idx", *BOX)))
    grouped = pred.groupBy("image", "cls").agg(order.alias("found")).join(truth, ["image", "cls"], "left")
    state = "struct<used:array<int>,out:array<struct<det_idx:int,tp:boolean>>>"
    zero = F.struct(F.array().cast("array<int>").alias("used"), F.array().cast("array<struct<det_idx:int,tp:boolean>>").alias("out")).cast(state)

    def step(a: Column, p: Column) -> Column:
        free = F.filter(F.coalesce("truth", F.array()), lambda g: ~F.array_contains(a["used"], g["gt_idx"]))
        best = F.array_max(F.transform(free, lambda g: F.struct(iou(_corners(p), _corners(g)).alias("v"), (-g["gt_idx"]).alias("k"))))

        def take(b: Column) -> Column:
            hit = F.coalesce(b["v"] >= iou_thr, F.lit(False))
            used = F.when(hit, F.concat(a["used"], F.array((-b["k"]).cast("int")))).otherwise(a["used"])
            return F.struct(used.alias("used"), F.concat(a["out"], F.array(F.struct(p["det_idx"].alias("det_idx"), hit.alias("tp")))).alias("out")).cast(state)

        return _let(best, take)

    matched = grouped.select("image", "cls", F.explode(F.aggregate("found", zero, step, lambda a: a["out"])).alias("m"))
    return pred.join(matched.select("image", "cls", "m.det_idx", "m.tp"), ["image", "cls", "det_idx"])


def suppress(pred: DataFrame, iou_thr: float = 0.6) -> DataFrame:
    """Class-wise greedy suppression: in descending confidence, keep what overlaps no kept box by ``iou_thr`` or more."""
    kind = "array<struct<down:double,det_idx:int,x1:double,y1:double,x2:double,y2:double>>"
    own = F.array_sort(F.collect_list(F.struct((-F.col("conf")).alias("down"), "det_idx", *BOX)))
    grouped = pred.groupBy("image", "cls").agg(own.alias("found"))

    def step(a: Column, p: Column) -> Column:
        return F.when(F.exists(a, lambda k: iou(_corners(k), _corners(p)) >= iou_thr), a).otherwise(F.concat(a, F.array(p)))

    kept = F.aggregate(F.col("found").cast(kind), F.array().cast(kind), step)
    return grouped.select("image", "cls", F.explode(kept).alias("k")).select("image", "cls", "k.det_idx", (-F.col("k.down")).alias("conf"), *(f"k.{c}" for c in BOX))


def average_precision(matched: DataFrame, gt_counts: DataFrame) -> DataFrame:
    """``cls, n_gt, ap``: area under the precision envelope at all points; null without ground truth.

    Ranks are by confidence, image and detection, a total order. Running sums and maxima go over stretches
    of confidence first and then within each, so that a class of any size is spread over tasks. The envelope
    is made of hits alone, as a miss never has a higher precision than the hit before it; equal heights of a stretch are one
    row before stretches meet. ``matched`` is read twice: give a written table.
    """
    placed = in_cells(matched, "conf")
    sums = placed.groupBy("cls", "cell").agg(F.count_if("tp").alias("hits"), F.count("*").alias("rows"))
    higher = Window.partitionBy("cls").orderBy(F.desc("cell")).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("cls", "cell", F.coalesce(F.sum("hits").over(higher), F.lit(0)).alias("hits"), F.coalesce(F.sum("rows").over(higher), F.lit(0)).alias("rows"))
    order = Window.partitionBy("cls", "cell").orderBy(F.desc("conf"), "image", "det_idx")
    own = F.sum(F.col("tp").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    hits = placed.select("cls", "cell", "tp", own.alias("own"), F.row_number().over(order).alias("n")).where("tp").join(starts, ["cls", "cell"])
    # from the last rank on, as a frame that ends at the last row is summed anew for every row
    back = Window.partitionBy("cls", "cell").orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, 0)
    height = F.max((F.col("hits") + F.col("own")) / (F.col("rows") + F.col("n"))).over(back)
    steps = materialize(hits.select("cls", "cell", height.alias("height")).groupBy("cls", "cell", "height").agg(F.count("*").alias("n")), "envelope")
    lower = Window.partitionBy("cls").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    later = steps.groupBy("cls", "cell").agg(F.max("height").alias("top")).select("cls", "cell", F.coalesce(F.max("top").over(lower), F.lit(0.0)).alias("later"))
    area = steps.join(later, ["cls", "cell"]).groupBy("cls").agg(F.sum(F.col("n") * F.greatest("height", "later")).alias("area"))
    # a class with predictions and no hit has an area of zero, not none
    area = sums.select("cls").distinct().join(area, "cls", "left").withColumn("area", F.coalesce("area", F.lit(0.0)))
    joined = gt_counts.join(area, "cls", "full")
    ap = F.when(F.coalesce("n_gt", F.lit(0)) > 0, F.coalesce("area", F.lit(0.0)) / F.col("n_gt"))
    return joined.select("cls", F.coalesce("n_gt", F.lit(0).cast("bigint")).alias("n_gt"), ap.alias("ap"))


def image_level(images: DataFrame, gt: DataFrame, pred: DataFrame, objects: list[int], conf_thr: float = 0.25) -> DataFrame:
    """tp, fp, fn, tn over images by whether an object stands in truth and in prediction, with the rates."""
    has = gt.where(F.col("cls").isin(objects)).select("image").distinct().withColumn("has", F.lit(True))
    said = pred.where(F.col("cls").isin(objects) & (F.col("conf") >= conf_thr)).select("image").distinct().withColumn("said", F.lit(True))
    flags = images.select("image").join(has, "image", "left").join(said, "image", "left").fillna(False)
    n = flags.agg(F.count_if(F.expr("has AND said")).alias("tp"), F.count_if(F.expr("NOT has AND said")).alias("fp"), F.count_if(F.expr("has AND NOT said")).alias("fn"), F.count_if(F.expr("NOT has AND NOT said")).alias("tn"))
    return n.select("*", F.try_divide("tp", F.expr("tp + fp")).alias("precision"), F.try_divide("tp", F.expr("tp + fn")).alias("recall"), F.try_divide("fp", F.expr("fp + tn")).alias("fpr"))


def recall_by_size(gt: DataFrame, pred: DataFrame, iou_thr: float = 0.5, conf_thr: float = 0.25) -> DataFrame:
    """Share of ground truth boxes that some prediction of the class overlaps, by size; not one-to-one."""
    p = pred.where(F.col("conf") >= conf_thr).select("image", "cls", *(F.col(c).alias(f"p_{c}") for c in BOX))
    over = iou([F.col(c) for c in BOX], [F.col(f"p_{c}") for c in BOX]) >= iou_thr
    hit = gt.join(p, ["image", "cls"]).where(over).select("image", "cls", "gt_idx").distinct().withColumn("hit", F.lit(1))
    judged = gt.join(hit, ["image", "cls", "gt_idx"], "left").withColumn("size", size_bucket(*(F.col(c) for c in BOX)))
    return judged.groupBy("size").agg(F.count("*").alias("n"), F.count("hit").alias("n_hit")).withColumn("recall", F.try_divide("n_hit", "n"))


def best_object(pred: DataFrame, objects: list[int]) -> DataFrame:
    """Each image's most confident detection among the object classes, the first of equals."""
    own = pred.where(F.col("cls").isin(objects))
    top = own.groupBy("image").agg(F.min(F.struct((-F.col("conf")).alias("down"), "det_idx", "cls")).alias("t"))
    return top.select("image", "t.det_idx", "t.cls", (-F.col("t.down")).alias("conf"))


def mined(pred: DataFrame, objects: list[int], most: int = 200) -> DataFrame:
    return best_object(pred, objects).orderBy(F.desc("conf"), "image").limit(most)


def screen(images: DataFrame, pred: DataFrame, objects: list[int], conf_thr: float = 0.15) -> DataFrame:
    """Images that may be used as negatives: those without an object at ``conf_thr`` or more."""
    top = pred.where(F.col("cls").isin(objects)).groupBy("image").agg(F.max("conf").alias("screen_conf"))
    return images.join(top, "image", "left").withColumn("screen_conf", F.coalesce("screen_conf", F.lit(0.0))).withColumn("use", F.col("screen_conf") < conf_thr)
