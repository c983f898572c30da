"""Standardising, balance, ranking quality, folds, and a window classifier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracklake.storage import discard, materialize


def moments(rows: DataFrame, features: list[str], floor: float = 0.05) -> DataFrame:
    """Mean and population deviation of each feature, the latter at least ``floor``."""
    return rows.agg(*(F.avg(f).alias(f"{f}_mean") for f in features), *(F.greatest(F.stddev_pop(f), F.lit(floor)).alias(f"{f}_std") for f in features))


def standardised(rows: DataFrame, stats: DataFrame, features: list[str], most: float = 10.0) -> DataFrame:
    z = {f: F.greatest(F.lit(-most), F.least(F.lit(most), (F.col(f) - F.col(f"{f}_mean")) / F.col(f"{f}_std"))) for f in features}
    return rows.join(F.broadcast(stats)).withColumns(z).drop(*(f"{f}_{k}" for f in features for k in ("mean", "std")))


ONE_CELL, MOST_CELLS = 1 << 16, 1 << 10  # rows that one task may as well order; stretches at most


def in_cells(rows: DataFrame, value: str) -> DataFrame:
    """``rows`` with ``cell``, the stretch of ``value`` a row is in: larger values are in later stretches, equal ones in the same,
    nulls in the first. The cuts are approximate quantiles, one for each ``ONE_CELL`` rows, found in one pass. ``rows`` are read twice: give a written table.
    """
    from pyspark.ml.feature import Bucketizer

    found = rows.agg(F.count("*").alias("n"), F.percentile_approx(F.col(value).cast("double"), [k / MOST_CELLS for k in range(1, MOST_CELLS)], 10_000).alias("cuts")).first()
    cells = min(MOST_CELLS, -(-found.n // ONE_CELL))
    cuts = [found.cuts[MOST_CELLS * k // cells - 1] for k in range(1, cells)] if found.cuts else []
    infinite = float("inf")
    cuts = sorted({c for c in cuts if -infinite < c < infinite})
    if not cuts:
        return rows.withColumn("cell", F.lit(0))
    placed = Bucketizer(splits=[-infinite, *cuts, infinite], inputCol=value, outputCol="cell", handleInvalid="keep").transform(rows)
    return placed.withColumn("cell", F.when(F.col(value).isNull(), 0).otherwise(F.col("cell").cast("int")))


def auroc(scored: DataFrame) -> DataFrame:
    """Area under the curve from the counts of each distinct score; null with one class only.

    The running count goes over stretches of scores first and then within each, so that no task orders all
    scores.
    """
    per = scored.groupBy("score").agg(F.count_if("label").alias("pos"), F.count_if(~F.col("label")).alias("neg"))
    placed = in_cells(materialize(per, "distinct-scores"), "score")
    within = F.coalesce(F.sum("neg").over(Window.partitionBy("cell").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # a pair is won within a stretch or between two, so each stretch is summed up before stretches meet
    cells = placed.withColumn("within", within).groupBy("cell").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.sum(F.col("pos") * (F.col("within") + F.col("neg") / 2)).alias("won"))
    lower = F.coalesce(F.sum("neg").over(Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # MOST_CELLS rows
    won = cells.withColumn("won", F.col("won") + F.col("pos") * lower)
    return won.agg(F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"), F.try_divide(F.sum("won"), F.sum("pos") * F.sum("neg")).alias("auroc"))


def f1(scored: DataFrame, thr: float = 0.5) -> DataFrame:
    said = F.col("score") >= thr
    n = scored.agg(F.count_if(said & F.col("label")).alias("tp"), F.count_if(said & ~F.col("label")).alias("fp"), F.count_if(~said & F.col("label")).alias("fn"))
    return n.withColumn("f1", F.coalesce(F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")), F.lit(0.0)))


def balance(labelled: DataFrame) -> DataFrame:
    return labelled.agg(F.count_if("label").alias("pos"), F.count_if(~F.col("label")).alias("neg"), (F.count_if(~F.col("label")) / F.greatest(F.count_if("label"), F.lit(1))).alias("pos_weight"))


def group_fold(rows: DataFrame, val_frac: float, key: Column) -> DataFrame:
    """Adds ``val``: within each label, groups in a seeded order until one of n folds is filled; the
    number of folds is that of the smaller class of groups, at most 1 / val_frac. Fewer than two groups in a
    class, or one class alone, is an error when the rows are read.

    Groups are numbered by leading digits of ``key``, a hexadecimal hash, and then within, so no task sorts all.
    """
    groups = rows.groupBy("group").agg(F.max(F.col("label").cast("int")).alias("y")).withColumn("key", key).withColumn("head", F.substring("key", 1, 3))
    heads = groups.groupBy("y", "head").agg(F.count("*").alias("n"))
    starts = heads.select("y", "head", F.coalesce(F.sum("n").over(Window.partitionBy("y").orderBy("head").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"))
    sizes = heads.groupBy("y").agg(F.sum("n").alias("n"))
    folds = sizes.agg(F.least(F.lit(max(2, round(1 / val_frac))), F.min("n")).alias("folds"), F.count("*").alias("kinds"))
    within = F.row_number().over(Window.partitionBy("y", "head").orderBy("key", "group"))
    chosen = groups.withColumn("within", within).join(F.broadcast(starts), ["y", "head"]).join(F.broadcast(sizes), "y").join(F.broadcast(folds))
    quota = F.when((F.col("folds") < 2) | (F.col("kinds") < 2), F.raise_error(F.lit("both classes need two groups at least"))).otherwise(F.ceil(F.col("n") / F.col("folds")))
    return rows.join(chosen.select("group", (F.col("start") + F.col("within") <= quota).alias("val")), "group")


FINE = 16  # counts below stand for themselves, above an eighth of an octave is one cell


def _cell(n: Column) -> Column:
    return F.when(n < FINE, n).otherwise(F.floor(F.log2(n.cast("double")) * 8) - F.lit(4 * 8 - FINE)).cast("bigint")


def row_folds(rows: DataFrame, folds: int, key: Column) -> DataFrame:
    """``group, n_pos, n_neg, fold``: every group in one of ``folds`` folds that hold about as many rows of each label.

    Groups with about the same counts of rows are a cell. Cells are dealt heaviest first: every fold gets the same
    number of a cell's groups, and the rest go one each to the folds that hold least so far, in shares of both labels. The groups of a
    cell are numbered by ``key``, a hexadecimal hash, over its leading digits and then within. What the driver holds are the
    cells, some hundreds at most for each power of two in the counts, whatever the number of groups. A label may be rare or missing.
    """
    own = rows.groupBy("group").agg(F.count_if("label").alias("n_pos"), F.count_if(~F.col("label")).alias("n_neg"))
    own = materialize(own.withColumn("cp", _cell(F.col("n_pos"))).withColumn("cn", _cell(F.col("n_neg"))).withColumn("key", key).withColumn("head", F.substring("key", 1, 3)), "groups")
    cells = own.groupBy("cp", "cn").agg(F.count("*").alias("n"), F.sum("n_pos").alias("pos"), F.sum("n_neg").alias("neg")).collect()
    all_pos, all_neg = max(1, sum(c.pos for c in cells)), max(1, sum(c.neg for c in cells))
    weighed = sorted(((-((c.pos * all_neg + c.neg * all_pos) // c.n), c.cp, c.cn, c.n) for c in cells))
    load, dealt = [0] * folds, []
    for down, cp, cn, n in weighed:
        least = sorted(range(folds), key=lambda f: (load[f], f))
        for f in range(folds):
            load[f] -= down * (n // folds)
        for f in least[: n % folds]:
            load[f] -= down
        dealt.append((cp, cn, n - n % folds, least))
    table = rows.sparkSession.createDataFrame(dealt, "cp long, cn long, even long, least array<int>")
    heads = own.groupBy("cp", "cn", "head").agg(F.count("*").alias("n"))
    before = Window.partitionBy("cp", "cn").orderBy("head").rowsBetween(Window.unboundedPreceding, -1)
    starts = heads.select("cp", "cn", "head", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = F.row_number().over(Window.partitionBy("cp", "cn", "head").orderBy("key", "group"))
    placed = own.withColumn("within", within).join(starts, ["cp", "cn", "head"]).join(F.broadcast(table), ["cp", "cn"])
    place = F.col("start") + F.col("within") - 1
    fold = F.when(place < F.col("even"), place % folds).otherwise(F.element_at("least", (place - F.col("even") + 1).cast("int")))
    return placed.select("group", "n_pos", "n_neg", fold.cast("int").alias("fold"))


def fit_windows(train: DataFrame, val: DataFrame, features: list[str], noise: float = 0.02, strengths: tuple[float, ...] = (0.003, 0.01, 0.03, 0.1), steps: int = 60, seed: int = 0):
    """A classifier of windows on pooled features (label, features); the model and its AUROC on ``val``.

    A linear stand-in for a convolution net: values are standardised and clipped to 10, classes weighted by
    their balance, and normal noise is added to the training values. Of the penalties in ``strengths`` the
    snapshot with the best AUROC on ``val`` is kept. Its ``write().overwrite().save`` and
    ``PipelineModel.load`` are the checkpoint's save and load.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import SQLTransformer, VectorAssembler

    stats = moments(train, features).first()
    weight = float(balance(train).first().pos_weight)
    z = {f: f"greatest(-10D, least(10D, (`{f}` - {stats[f + '_mean']!r}D) / {stats[f + '_std']!r}D))" for f in features}
    scaled = SQLTransformer(statement=f"SELECT *, {', '.join(f'{e} AS `z_{f}`' for f, e in z.items())} FROM __THIS__")
    noisy = train.withColumns({f: F.col(f) + noise * float(stats[f + "_std"]) * F.randn(seed + i) for i, f in enumerate(features)})
    noisy = materialize(noisy.withColumn("_weight", F.when(F.col("label"), F.lit(weight)).otherwise(1.0)).withColumn("_target", F.col("label").cast("double")), "noisy-windows")
    best = (None, -1.0)
    for c in strengths:
        stages = [scaled, VectorAssembler(inputCols=[f"z_{f}" for f in features], outputCol="features"), LogisticRegression(labelCol="_target", weightCol="_weight", maxIter=steps, regParam=c)]
        model = Pipeline(stages=stages).fit(noisy)
        area = auroc(window_scores(model, val).select("label", "score")).first().auroc
        if best[0] is None or (area is not None and area > best[1]):
            best = (model, -1.0 if area is None else area)
    discard(noisy)
    return best


def window_scores(model, windows: DataFrame) -> DataFrame:
    """``windows`` with ``score``, the probability of a positive."""
    from pyspark.ml.functions import vector_to_array

    return model.transform(windows).withColumn("score", F.element_at(vector_to_array("probability"), 2)).select(*windows.columns, "score")
