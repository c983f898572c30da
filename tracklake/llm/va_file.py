"""Exact top-k search by inner product with vector-approximation files."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracklake.llm._vectors import exact, matrix, one_a_query, width_of, without_repeats
from tracklake.storage import discard, materialize

CODES = "part long, level int, ids binary, codes binary"
ASKED = "query_ids binary, queries binary, sure binary"
BOUNDS = "query_id long, ids array<long>, uppers array<double>, floors array<double>"


def _ranges(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                v = matrix(batch.column("vector"), width)
                yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array(v.min(axis=0)), pa.array(v.max(axis=0))], names=["place", "low", "high"])

    return run


def block_level(part: int, base: int) -> int:
    """How often ``base`` divides a hash of the block's number: one block in ``base ** l`` is of level l or above."""
    mixed = (part * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF
    mixed = ((mixed ^ mixed >> 31) * 0xBF58476D1CE4E5B9 & 0xFFFFFFFFFFFFFFFF) >> 20
    level = 0
    while level < 16 and mixed % base == 0:
        mixed, level = mixed // base, level + 1
    return level


def _encoded(shared, bits: int, rows: int, base: int):
    """Blocks of the file: ids, and one byte a component that names its cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, cell = shared.value
        number = TaskContext.get().partitionId() << 32
        for big in batches:
            for first in range(0, big.num_rows, rows):
                batch = big.slice(first, rows)
                v = matrix(batch.column("vector"), len(low))
                codes = np.clip((v - low) // cell, 0, (1 << bits) - 1).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([block_level(number, base)], pa.int32()), pa.array([batch.column("vec_id").to_numpy(zero_copy_only=False).astype(np.int64).tobytes()], pa.binary()), pa.array([codes.tobytes()], pa.binary())], names=["part", "level", "ids", "codes"])
                number += 1

    return run


def _asked(width: int, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for first in range(0, big.num_rows, block):
                batch = big.slice(first, block)
                q = matrix(batch.column("vector"), width)
                sure = batch.column("sure").to_numpy(zero_copy_only=False).astype(np.float64)
                columns = (batch.column("vec_id").to_numpy(zero_copy_only=False).astype(np.int64), q, sure)
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in columns], names=["query_ids", "queries", "sure"])

    return run


def cell_bounds(q: np.ndarray, codes: np.ndarray, low: np.ndarray, cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For queries and coded vectors, the middle of the inner product's bounds, and for each query how
    far the product can be from it. Products of codes are taken in single precision, which the
    distance allows for."""
    steep = q * cell
    scaled = np.abs(steep).sum(axis=1)
    middle = (steep.astype(np.float32) @ codes.T.astype(np.float32)).astype(np.float64) + (q @ (low + cell / 2))[:, None]
    return middle, scaled / 2 + scaled * 256 * len(low) * 2.0**-23 + 1e-9 * (1 + np.abs(q) @ np.abs(low))


def _scanned(shared, k: int, chunk: int = 256):
    """For each query and block of the file, the vectors that may be among the query's k best of the block and whose
    bound reaches ``sure``, a score that k vectors are known to reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, cell = shared.value
        for batch in batches:
            for r in range(batch.num_rows):
                ids, query_ids = (np.frombuffer(batch.column(c)[r].as_py(), np.int64) for c in ("ids", "query_ids"))
                codes = np.frombuffer(batch.column("codes")[r].as_py(), np.uint8).reshape(len(ids), -1)
                queries = np.frombuffer(batch.column("queries")[r].as_py(), np.float64).reshape(len(query_ids), -1)
                sure = np.frombuffer(batch.column("sure")[r].as_py(), np.float64)
                for first in range(0, len(query_ids), chunk):
                    own = query_ids[first : first + chunk]
                    middle, reach = cell_bounds(queries[first : first + chunk], codes, low, cell)
                    middle[own[:, None] == ids[None, :]] = -np.inf
                    kth = np.partition(middle, len(ids) - k, axis=1)[:, len(ids) - k] - reach if len(ids) > k else np.full(len(own), -np.inf)
                    kth = np.maximum(kth, sure[first : first + chunk])
                    row, column = np.nonzero((middle + reach[:, None] >= kth[:, None]) & (middle > -np.inf))
                    at = pa.array(np.searchsorted(row, np.arange(len(own) + 1)).astype(np.int32))
                    lists = [pa.ListArray.from_arrays(at, pa.array(x)) for x in (ids[column], middle[row, column] + reach[row], middle[row, column] - reach[row])]
                    yield pa.RecordBatch.from_arrays([pa.array(own), *lists], names=["query_id", "ids", "uppers", "floors"])

    return run


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        score = np.zeros(0)
        if batch.num_rows:
            q, v = (batch.column(c).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1) for c in ("query", "vector"))
            score = exact(q, v)
        yield pa.RecordBatch.from_arrays([batch.column("query_id"), batch.column("vec_id"), pa.array(score)], names=["query_id", "vec_id", "score"])


def fewest_copies(vectors: DataFrame, most: int) -> DataFrame:
    """Of rows with one vector, those with the ``most`` smallest ids. Rows beyond them share every score with ``most``
    rows that go before them. The counts move hashes alone; where none is above ``most``, ``vectors`` stay as they are."""
    if vectors.groupBy(F.xxhash64("vector").alias("h")).count().where(F.col("count") > most).isEmpty():
        return vectors
    place = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))  # cut to ``most`` before the shuffle as well
    return materialize(vectors.withColumn("place", place).where(F.col("place") <= most).drop("place"), "va-vectors")


def exact_top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, bits: int = 8, rows: int = 8192, block: int = 1024, base: int = 16) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k rows of ``vectors`` with the largest inner product.

    Both tables hold ``vec_id`` and ``vector``, whole and finite and of one width; a vector of another
    width raises. The vectors are quantised once, to ``2**bits`` cells (at most 256) of each dimension's
    range over the whole table, and stored as a file of one byte a component in blocks of ``rows``.
    Each block of ``block`` queries meets each block of the file, which bounds all inner products from
    both sides; whole vectors are then read in the order of the upper bounds: first the ``2 * k``
    highest of each query, which gives a kth score, then those whose bound still reaches it. No query
    passes through the driver.

    So that a query does not keep k vectors of every block, one block in ``base ** l`` is scanned first, l falling
    from the logarithm of the number of blocks: the kth lower bound found there is one that k vectors reach, and the
    next scan, of ``base`` times as many blocks, passes on only what reaches it, about ``base * k`` vectors a query
    if blocks are alike. The scans before the last cost 1 / (base - 1) of it.

    Of one vector's copies only the k + 1 with the smallest ids are candidates, as the others cannot be among the k
    best of any query.

    Of equal scores the smaller vec_id comes first; the row with the query's own vec_id is no
    candidate. Repeated rows count once, rows without id not at all; an id with several vectors is a candidate with each, and
    asks with the smallest. No vectors or no queries give no rows.
    """
    spark = vectors.sparkSession
    width = width_of(vectors, "vector")
    if not width or queries.isEmpty():
        return spark.sql("SELECT 0L AS query_id, 0 AS rank, 0L AS vec_id, 0D AS score WHERE false")
    vectors, queries = fewest_copies(without_repeats(vectors), k + 1), one_a_query(queries)
    ranges = vectors.mapInArrow(_ranges(width), "place int, low double, high double").groupBy("place").agg(F.min("low").alias("low"), F.max("high").alias("high")).orderBy("place").collect()  # a row a dimension
    low = np.array([r.low for r in ranges])
    shared = spark.sparkContext.broadcast((low, np.maximum((np.array([r.high for r in ranges]) - low) / (1 << bits), 1e-12)))
    codes = materialize(vectors.mapInArrow(_encoded(shared, bits, rows, base), CODES), "va-file")
    kth = F.element_at(F.sort_array(F.flatten(F.collect_list("floors")), False), F.least(F.lit(k), F.size(F.flatten(F.collect_list("floors")))))
    known = F.when(F.sum(F.size("floors")) >= k, kth)  # fewer than k vectors bound nothing

    def scan(part: DataFrame, sure: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        """Each block of the stated queries against each of these blocks of the file; and the blocks of queries."""
        knowing = queries.withColumn("sure", F.lit(float("-inf"))) if sure is None else queries.join(sure, "vec_id", "left").na.fill(float("-inf"), ["sure"])
        asked = materialize(knowing.select("vec_id", "vector", "sure").mapInArrow(_asked(width, block), ASKED), "va-queries")
        met = part.crossJoin(asked).select("ids", "codes", "query_ids", "queries", "sure")
        return met.mapInArrow(_scanned(shared, k), BOUNDS).where(F.size("ids") > 0), asked

    blocks, sure = codes.count(), None
    for level in range(int(np.log(max(1, blocks)) / np.log(base)), 0, -1):
        found, asked = scan(codes.where(F.col("level") >= level), sure)
        better = materialize(found.groupBy("query_id").agg(known.alias("sure")).select(F.col("query_id").alias("vec_id"), "sure"), "va-sure")
        discard(asked, sure)
        sure = better
    found, asked = scan(codes, sure)
    bounds = materialize(found, "va-bounds")
    found = F.flatten(F.collect_list(F.arrays_zip(F.col("uppers").alias("upper"), F.col("ids").alias("vec_id"))))
    whole = bounds.groupBy("query_id").agg(found.alias("found"), kth.alias("kth"))
    ordered = F.sort_array(F.filter("found", lambda x: x["upper"] >= F.col("kth")), False)
    candidates = materialize(whole.select("query_id", F.posexplode(ordered).alias("place", "x")).select("query_id", "place", F.col("x.vec_id").alias("vec_id"), F.col("x.upper").alias("upper")), "va-candidates")
    asking = queries.select(F.col("vec_id").alias("query_id"), F.col("vector").alias("query"))

    def read(chosen: DataFrame) -> DataFrame:
        return chosen.select("query_id", "vec_id").join(vectors, "vec_id").join(asking, "query_id").select("query_id", "vec_id", "query", "vector").mapInArrow(_read, "query_id long, vec_id long, score double")

    first = materialize(read(candidates.where(F.col("place") < 2 * k)), "va-read")
    floor = first.groupBy("query_id").agg(F.element_at(F.sort_array(F.collect_list("score"), False), F.least(F.lit(k), F.count("*").cast("int"))).alias("sure"))
    rest = candidates.where(F.col("place") >= 2 * k).join(floor, "query_id").where("upper >= sure")
    scored = materialize(first.unionAll(read(rest)).distinct(), "va-scores")
    discard(codes, asked, sure, bounds, candidates, first)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
