"""Lookups of unique keys by rows of which one key may hold any share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklake.storage import materialize

SHARE = 1000


def lookup(rows: DataFrame, table: DataFrame, on: list[str]) -> tuple[DataFrame, DataFrame]:
    """``rows`` LEFT JOIN ``table``, whose ``on`` are unique, and the written table of hot keys, to be discarded in the end.

    Keys that more than one row in ``SHARE`` asks for are fewer than ``SHARE``, so their answers are a
    table of bounded size and are broadcast; all other rows meet the table in a shuffle, where
    no key can fill a task. ``rows`` are read three times: give a written table, or a cheap plan.
    """
    total = rows.count()
    asked = rows.groupBy(*on).agg(F.count("*").alias("_n")).where(F.col("_n") * SHARE > total).select(*on)
    hot = materialize(table.join(F.broadcast(asked), on, "left_semi"), "hot-keys")
    often = rows.join(F.broadcast(hot), on)
    seldom = rows.join(F.broadcast(hot.select(*on)), on, "left_anti").join(table, on, "left")
    return often.unionByName(seldom), hot
