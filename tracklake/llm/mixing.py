"""Mixing sources to target weights by hash-threshold histograms, in DataFrame functions only."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracklake.storage import discard, materialize

SPACES = " \t\n\x0b\f\r"
BITS, LEVELS = 12, 3


def word_count(text: Column) -> Column:
    """Number of runs of characters outside ``\\x20\\x09-\\x0D``; 0 for null."""
    bare = F.btrim(text, F.lit(SPACES))
    return F.when(text.isNull() | (bare == ""), 0).otherwise(F.size(F.split(bare, r"[\x20\x09-\x0D]+"))).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """One row for each source: ``source, source_size, target``.

    Sources in code point order, null last, take the weights in turn and share the sum of all
    sizes. No target exceeds ``most`` times its source's size; what is cut is shared by weight
    among the others until none is above. With sources in the order of size over weight, that
    level is found by running sums.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    ranked = totals.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int")))
    ranked = ranked.withColumn("cap", (most * F.col("source_size")).cast("double")).withColumn("ratio", F.col("cap") / F.col("weight"))
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    ranked = ranked.withColumn("level", level)
    ranked = ranked.withColumn("level", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level"))).over(whole)["level"])
    share = F.least(F.col("cap"), F.col("weight") * F.coalesce(F.col("level"), F.col("ratio")))
    return ranked.select("source", "source_size", share.alias("target"))


def _keyed(df: DataFrame) -> DataFrame:
    return df.withColumn("no_source", F.col("source").isNull()).withColumn("source", F.coalesce("source", F.lit("")))


def draw(doc_id: Column, text: Column) -> Column:
    """36 bits of a hash of the document; other rows, even without doc_id, draw for themselves."""
    whole = F.concat_ws(":", F.coalesce(doc_id.cast("bigint").cast("string"), F.lit("")), F.coalesce(text.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(whole.cast("binary")), 1, BITS * LEVELS // 4), 16, 10).cast("bigint")


def mix_thresholds(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """``no_source, source, source_size, target, whole, limit`` for each source of ``sizes`` (source, size,
    place): documents are taken ``whole`` times, and those with a place below ``limit`` once more. A null
    source is "" with ``no_source``.

    The limit is read from histograms: the sizes are summed by source and by the first 12 bits of the
    place; the bucket in which the running sum passes the budget is refined by the next 12 bits, and
    again, and the last cell is taken if more than half of it fits. Only the boundary buckets are read
    again, nothing is sorted, and a larger budget takes a superset.
    """
    budgets = source_targets(sizes, weights, most)
    copies = F.when(F.col("source_size") > 0, F.least(F.lit(float(most)), F.floor(F.col("target") / F.col("source_size")))).otherwise(0).cast("bigint")
    budgets = budgets.withColumn("whole", copies).withColumn("need", F.col("target") - F.col("whole") * F.col("source_size"))
    budgets = materialize(_keyed(budgets), "budgets")
    keyed = _keyed(sizes)
    keys = ["no_source", "source"]
    edge = budgets.select(*keys, F.lit(0).cast("bigint").alias("prefix"), "need")
    read = []
    for level in range(LEVELS):
        shift = BITS * (LEVELS - 1 - level)
        cell = F.shiftrightunsigned("place", shift)
        inside = keyed.withColumn("prefix", F.shiftrightunsigned("place", shift + BITS)).join(edge, [*keys, "prefix"])
        cells = inside.groupBy(*keys, cell.alias("cell")).agg(F.sum("size").alias("size"), F.first("need").alias("need"))
        run = Window.partitionBy(*keys).orderBy("cell")
        cells = cells.withColumn("upto", F.sum("size").over(run))
        passing = F.min(F.when(F.col("upto") > F.col("need"), F.struct("cell", "size", (F.col("need") - F.col("upto") + F.col("size")).alias("need"))))
        at = cells.groupBy(*keys).agg(passing.alias("at")).where("at IS NOT NULL")
        read.append(materialize(at.select(*keys, F.col("at.cell").alias("prefix"), F.col("at.need").alias("need"), F.col("at.size").alias("size")), "edge"))
        edge = read[-1].drop("size")
    # a source whose budget no cell passes has none left over: it needs nothing more
    limit = read[-1].select(*keys, (F.col("prefix") + F.when(2 * F.col("need") >= F.col("size"), 1).otherwise(0)).alias("limit"))
    found = materialize(budgets.join(limit, keys, "left").select(*keys, "source_size", "target", "whole", F.coalesce("limit", F.lit(0)).cast("bigint").alias("limit")), "thresholds")
    discard(budgets, *read)
    return found


def _sizes(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"), draw(F.col("doc_id"), F.col("text")).alias("place"))


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken`` for every row of ``docs``.

    Every document of a source is taken ``floor(target / source_size)`` times, and those whose
    hash lies below the source's threshold once more (``mix_thresholds``). The hash depends on doc_id
    and text alone, so reruns and other partitionings agree.

    Null or blank texts have size 0. A null source is a source of its own, the last. Equal rows are
    taken alike. With no words at all, nothing is taken. Other columns are ignored.
    """
    sizes = materialize(_sizes(docs), "sizes")
    joined = _keyed(sizes).join(mix_thresholds(sizes, weights, most), ["no_source", "source"])
    taken = F.col("whole") + F.when(F.col("place") < F.col("limit"), 1).otherwise(0)
    source = F.when(~F.col("no_source"), F.col("source"))
    return joined.select("doc_id", source.alias("source"), "size", "source_size", "target", taken.alias("copies"), (F.col("size") * taken).alias("taken"))


def mixed(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it; no text is moved."""
    sizes = materialize(_sizes(docs), "sizes")
    limits = mix_thresholds(sizes, weights, most)
    discard(sizes)
    none, source, whole, limit, copy = (f"{c}_{uuid.uuid4().hex}" for c in ("none", "source", "whole", "limit", "copy"))
    limits = limits.select(F.col("no_source").alias(none), F.col("source").alias(source), F.col("whole").alias(whole), F.col("limit").alias(limit))
    own = docs["source"].cast("string")
    joined = docs.join(limits, (own.isNull() == F.col(none)) & (F.coalesce(own, F.lit("")) == F.col(source)))
    taken = F.col(whole) + F.when(draw(F.col("doc_id"), F.col("text")) < F.col(limit), 1).otherwise(0)
    return joined.withColumn(copy, F.explode(F.array_repeat(F.lit(1), taken.cast("int")))).select(*docs.columns)
