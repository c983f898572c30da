"""MinHash near-duplicate detection: one-permutation hashing, optimal densification, bands, stars."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklake.llm._links import Close, linked_components, shared_buckets
from tracklake.llm._text import TEXT_ROWS, encoded, hashes, long_column, mix, pieces, shingles, words
from tracklake.storage import discard, materialize

SKETCH = "doc_id long, n_shingles long, k1 long, k2 long, bands array<long>, lanes binary"
BROADCAST_BYTES = 64 << 20
SHORT, WORDS = 256, 32  # sets of at most SHORT shingles have a bitmap of WORDS * 64 bits, larger ones four bits of WORDS * 16 bins


@lru_cache
def _orders(bins: int) -> np.ndarray:
    """For each bin, the pseudo-random order in which it probes all bins when it is empty."""
    rng = np.random.RandomState(20240607)
    return np.stack([np.argsort(rng.random_sample(bins)).argsort() for _ in range(bins)]).astype(np.int32)


def sketch(values: np.ndarray, bins: int) -> np.ndarray:
    """One-permutation MinHash of a sorted, non-empty array of distinct hashes.

    Every hash falls into one bin and each bin keeps its smallest. An empty bin copies the first
    non-empty bin on its own probing order, which is optimal densification: the probability that
    two sketches agree in a bin is the Jaccard similarity.
    """
    out = np.empty(bins, np.uint64)
    where = ((mix(values ^ np.uint64(0xA5A5A5A5A5A5A5A5)) >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)
    where = where.astype(np.int64)
    out[where[::-1]] = values[::-1]
    filled = np.zeros(bins, bool)
    filled[where] = True
    empty = np.flatnonzero(~filled)
    if len(empty):
        full = np.flatnonzero(filled)
        out[empty] = out[full[_orders(bins)[np.ix_(empty, full)].argmin(axis=1)]]
    return out


def _sketches(bands: int, rows: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = mix(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        for batch in pieces(batches):
            flat, at = words(batch.column("text"))
            ids, vocabulary = encoded(flat)
            h, bounds = shingles(hashes(vocabulary)[ids] if len(ids) else np.zeros(0, np.uint64), at, width)
            n = batch.num_rows
            size, k1, k2 = np.zeros(n, np.int64), np.zeros(n, np.uint64), np.zeros(n, np.uint64)
            signs = np.zeros((n, bands * rows), np.uint64)
            for i in range(n):
                if bounds[i] < bounds[i + 1]:
                    own = np.unique(h[bounds[i] : bounds[i + 1]])
                    size[i], k1[i], k2[i] = len(own), own.sum(), mix(own).sum()
                    signs[i] = sketch(own, bands * rows)
            key = np.tile(salt, (n, 1))
            for r in range(rows):
                key = mix(key + signs.reshape(n, bands, rows)[:, :, r])
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.where(size > 0, bands, 0))]).astype(np.int32)), long_column(key[size > 0].ravel()))
            short = (size > 0) & (size <= SHORT)
            marks = np.zeros((n, 64 * WORDS), bool)
            for i in np.flatnonzero(short):
                marks[i, (h[bounds[i] : bounds[i + 1]] >> np.uint64(20)) % np.uint64(64 * WORDS)] = True
            wide = np.zeros((n, 16 * WORDS), np.uint64)
            wide[:, : bands * rows] = signs[:, : 16 * WORDS] & np.uint64(15)
            lanes = (wide.reshape(n, WORDS, 16) << (np.uint64(4) * np.arange(16, dtype=np.uint64))).sum(axis=2, dtype=np.uint64)
            lanes[short] = np.packbits(marks[short], axis=1).view(np.uint64)
            packed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(8 * WORDS), n, [None, pa.py_buffer(np.ascontiguousarray(lanes))]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(size), long_column(k1), long_column(k2), lists, packed], names=["doc_id", "n_shingles", "k1", "k2", "bands", "lanes"])

    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            flat, at = words(batch.column("text"))
            ids, vocabulary = encoded(flat)
            h, bounds = shingles(hashes(vocabulary)[ids] if len(ids) else np.zeros(0, np.uint64), at, width)
            own = [np.unique(h[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(x) for x in own])]).astype(np.int32)), long_column(np.concatenate(own)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), lists], names=["doc_id", "hashes"])

    return run


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``pairs`` (hub, rep) with ``linked``: 100 * intersection >= percent * union on the full sets."""
    a = sets.select(F.col("doc_id").alias("hub"), F.col("hashes").alias("ha"))
    b = sets.select(F.col("doc_id").alias("rep"), F.col("hashes").alias("hb"))
    common = F.size(F.array_intersect("ha", "hb")).cast("bigint")
    union = F.size("ha") + F.size("hb") - F.col("common")
    return pairs.join(b, "rep").join(a, "hub").withColumn("common", common).select("hub", "rep", (100 * F.col("common") >= percent * union).alias("linked"))


def _linked(percent: int):
    """Which pairs of sets, each the bytes of its distinct hashes, are at the threshold."""

    def run(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        out = np.empty(len(x), bool)
        for i, ends in enumerate(zip(x, y, strict=True)):
            a, b = (np.frombuffer(end, np.int64) for end in ends)
            common = len(np.intersect1d(a, b, assume_unique=True))
            out[i] = 100 * common >= percent * (len(a) + len(b) - common)
        return out

    return run


def _close(percent: int, bins: int) -> Close:
    """Sizes and signatures that two sets at the threshold can have.

    For small sets the signature is a bitmap of the shingles: the union has as many members as the two
    bitmaps together have bits at least, which bounds the similarity from above for certain. For larger ones it
    is a part of the sketch: it differs in as many bins as the similarity says, and 4.75 standard deviations more.
    """
    bins = min(bins, 16 * WORDS)
    apart = (1 - percent / 100) * 15 / 16
    most = bins * (apart + 4.75 * np.sqrt(apart * (1 - apart) / (bins * (1 - np.exp(-SHORT / bins)))))

    def near(x: dict, y: dict) -> np.ndarray:
        low, high = np.minimum(x["n"], y["n"]), np.maximum(x["n"], y["n"])
        fits = 100 * low >= percent * high
        small, large = np.flatnonzero(fits & (high <= SHORT)), np.flatnonzero(fits & (low > SHORT))
        union = np.bitwise_count(x["lanes"][small] | y["lanes"][small]).sum(axis=1, dtype=np.int64)
        fits[small] = (100 + percent) * union <= 100 * (low + high)[small]
        differ = x["lanes"][large] ^ y["lanes"][large]
        differ |= differ >> np.uint64(2)
        differ |= differ >> np.uint64(1)
        fits[large] = np.bitwise_count(differ & np.uint64(0x1111111111111111)).sum(axis=1, dtype=np.int64) <= most
        return fits

    return Close(["n", "lanes"], near, _linked(percent))


def near_duplicates(docs: DataFrame, percent: int = 75, width: int = 5, bands: int = 64, rows: int = 6) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs`` (doc_id, text).

    Documents with the same shingle set are collapsed first. The representatives are banded;
    each bucket gives star edges from the member that shares most buckets with others. Pairs whose
    signatures exclude the threshold are left out, and every other one is verified on the full sets. Buckets whose members still lie in different components are read
    again, with the full sets of at most ``SHORT`` shingles, until no pair across components is untested, so all pairs that share a band count. Two documents at the
    threshold share one of the 64 bands of 6 with a probability above 0.99999.

    Null, empty and blank texts have no shingles and stay alone; a null ``doc_id`` gives a null
    ``component_id`` unless equal texts carry an id, and is kept only without shingles or ids. Repeated rows come
    back as often as they were given. Other columns of ``docs`` are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketches = materialize(docs.mapInArrow(_sketches(bands, rows, width), SKETCH), "sketches", TEXT_ROWS)
    reps = sketches.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"), F.min_by("bands", "doc_id").alias("bands"), F.any_value("n_shingles").alias("n"), F.any_value("lanes").alias("lanes"))
    reps = materialize(reps, "representatives")
    keys = reps.select("rep", F.explode("bands").alias("key"))
    members = shared_buckets(keys, reps.select("rep", "n", "lanes"))
    wanted = materialize(members.select(F.col("rep").alias("doc_id")).distinct(), "wanted")
    small = 48 * wanted.count() <= BROADCAST_BYTES  # beyond, the texts are shuffled
    sets = materialize(docs.join(F.broadcast(wanted) if small else wanted, "doc_id", "left_semi").dropDuplicates(["doc_id"]).mapInArrow(_sets(width), "doc_id long, hashes array<long>"), "sets", TEXT_ROWS)
    # a task holds the sets of a bucket that is read again, so only small ones
    small = sets.where(F.size("hashes") <= SHORT).select(F.col("doc_id").alias("rep"), F.col("hashes").alias("whole"))
    components = linked_components(members, lambda pairs: _verified(pairs, sets, percent), _close(percent, bands * rows), "company", bands // 4, lambda reps: small.join(reps, "rep", "left_semi"))
    discard(members, sets, wanted)
    named = reps.select("k1", "k2", "rep").join(components.withColumnRenamed("node", "rep"), "rep", "left").select("k1", "k2", F.coalesce("component", "rep").alias("component"))
    out = sketches.select("doc_id", "n_shingles", "k1", "k2").join(materialize(named, "classes"), ["k1", "k2"], "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))
