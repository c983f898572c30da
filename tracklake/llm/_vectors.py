"""Vectors in Arrow batches, and the choice of best rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklake.storage import materialize


def usable(vector: Column, zero: bool = True) -> Column:
    """Neither null nor empty, without null or non-finite components; ``zero``: may be all zeros."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    fine = vector.isNotNull() & (F.size(vector) > 0) & ~bad
    return F.coalesce(fine if zero else fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(values) != len(column) * width:
        raise ValueError(f"all vectors must have {width} components")
    return values.reshape(len(column), width)


def without_repeats(vectors: DataFrame) -> DataFrame:
    """``vec_id, vector`` without repeats of the same row and without null ids; nothing is moved where no id stands twice."""
    vectors = vectors.where("vec_id IS NOT NULL").select(F.col("vec_id").cast("bigint").alias("vec_id"), "vector")
    if vectors.groupBy("vec_id").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        return vectors
    return materialize(vectors.distinct(), "vectors")


def one_a_query(queries: DataFrame) -> DataFrame:
    """``vec_id, vector`` with one row an id; of several vectors the smallest. Null ids ask nothing."""
    return queries.where("vec_id IS NOT NULL").withColumn("vec_id", F.col("vec_id").cast("bigint")).groupBy("vec_id").agg(F.min("vector").alias("vector"))


def width_of(vectors: DataFrame, column: str) -> int:
    first = vectors.select(F.size(column)).first()
    return first[0] if first else 0


def exact(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Row-wise inner products, each summed in the same order wherever its rows stand."""
    return np.einsum("ij,ij->i", q, v)


def ranked(hits: DataFrame, k: int) -> DataFrame:
    """``query_id, rank, vec_id, score`` from rows ``(query_id, ids, scores)`` of local best lists.

    A query has one list for each part of the data that it met, each of at most k entries.
    """
    entries = F.arrays_zip(F.transform("scores", lambda s: -s).alias("down"), F.col("ids").alias("vec_id"))
    lists = hits.select("query_id", entries.alias("own")).groupBy("query_id").agg(F.flatten(F.collect_list("own")).alias("own"))
    ordered = lists.select("query_id", F.array_sort("own").alias("own"))
    fresh = F.filter("own", lambda x, i: (i == 0) | (x != F.col("own")[F.greatest(i - 1, F.lit(0))]))  # equal entries stand together
    top = ordered.select("query_id", F.posexplode(F.slice(fresh, 1, k)).alias("rank", "hit"))
    return top.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.down")).alias("score"))
