"""Connected components over an edge table, without collecting nodes or edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklake.storage import discard, materialize


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """``(node, component)`` for every endpoint; the component is its smallest member.

    Each round hooks every node to its smallest neighbour, flattens the resulting forest by
    pointer doubling, and contracts the edges onto the roots. Every tree holds at least two
    nodes, so the rounds are logarithmic in the size of a component, and a star of any degree
    takes one. Self loops and rows with a null end are ignored; no edges give no rows.
    """
    a, b = F.col(src).cast("bigint"), F.col(dst).cast("bigint")
    pairs = edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where(F.col(src).isNotNull() & F.col(dst).isNotNull())
    pairs = materialize(pairs.where("a < b").distinct(), "edges")
    labels, spent = None, [pairs]
    while not pairs.isEmpty():
        ends = pairs.select(F.col("a").alias("node"), F.col("b").alias("other")).unionAll(pairs.select("b", "a"))
        parent = materialize(ends.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("parent")), "hooks")
        spent.append(parent)
        while True:
            up = parent.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
            flat = materialize(parent.join(up, "parent").select("node", F.col("grand").alias("parent"), (F.col("grand") != F.col("parent")).alias("moved")), "flat")
            spent.append(flat)
            done = flat.where("moved").isEmpty()
            parent = flat.select("node", "parent")
            if done:
                break
        if labels is None:
            labels = parent.select("node", F.col("parent").alias("component"))
        else:
            moved = parent.select(F.col("node").alias("component"), F.col("parent").alias("root"))
            labels = labels.join(moved, "component", "left").select("node", F.coalesce("root", "component").alias("component"))
        labels = materialize(labels, "labels")
        spent.append(labels)
        left = parent.select(F.col("node").alias("a"), F.col("parent").alias("ra"))
        right = parent.select(F.col("node").alias("b"), F.col("parent").alias("rb"))
        crossing = pairs.join(left, "a").join(right, "b").where("ra <> rb")
        pairs = materialize(crossing.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "edges")
        spent.append(pairs)
    if labels is None:
        return pairs.select(F.col("a").alias("node"), F.col("b").alias("component"))
    discard(*(t for t in spent if t is not labels))
    return labels
