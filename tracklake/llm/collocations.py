"""Phrase collocations: words that follow one another more often than their parts let expect.

Identical pieces become one row with a multiplicity. Tasks count the phrases of their pieces ahead of the
shuffle; each hash bucket of phrases is then summed by duckdb, which takes the parts as a
stream and spills what exceeds its memory. A phrase is no more frequent than any part of it, so phrases below
``least`` are dropped where they are counted and the rest can still be judged from what is left; and
phrases of three words or more are only made where a filter of bounded size may know all their pairs.
The counts of the parts come by lookup requests that are shuffled to the parts' buckets.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tracklake.llm._lookup import lookup
from tracklake.llm._text import _LOWER, encoded, hashes, mix, pieces, text_bytes, tidy
from tracklake.storage import discard, materialize

LONGEST = 4
BLOCK_BYTES = 4 << 20
MEMORY = "192MB"  # of duckdb in a task, before it spills
SALTS = 64

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 32]] = True
_CUT = np.zeros(256, dtype=bool)
_CUT[[*b".,;:!?", 10, 11, 12, 13]] = True
PIECE = "lang string, piece string"
COUNT = "lang string, phrase string, size int, f long"
COLUMNS = ["lang", "phrase", "size", "f"]
PROBES = 4
CHUNK_BITS = 1 << 19
MOST_BITS = 1 << 29  # 64 MB, the most that is broadcast


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pieces of each text that hold a word, lower-cased, their words joined by single spaces."""
    for batch in pieces(batches):
        data, at = text_bytes(batch.column("text"))
        data = _LOWER[data]
        cut = _CUT[data]
        inside = ~(_BLANK[data] | cut)
        fresh = np.zeros(len(data) + 1, bool)
        fresh[at] = True  # a piece ends with its text
        begins = inside.copy()
        begins[1:] &= ~inside[:-1] | fresh[1 : len(data)]
        where = np.flatnonzero(begins)
        if not len(where):
            continue
        length = np.diff(np.append(np.cumsum(inside)[where] - 1, inside.sum()))
        piece = (np.cumsum(cut) + np.cumsum(fresh[: len(data)]))[where]
        first = np.concatenate([[True], piece[1:] != piece[:-1]])
        spaces = np.cumsum(~first)
        out = np.full(int(inside.sum() + spaces[-1]), 32, np.uint8)
        out[np.arange(int(inside.sum())) + np.repeat(spaces, length)] = data[inside]
        heads = np.flatnonzero(first)
        starts = np.cumsum(np.concatenate([[0], length[:-1]])) + spaces
        bounds = np.append(starts[heads], len(out)).astype(np.int32)
        flat = pa.Array.from_buffers(pa.string(), len(heads), [None, pa.py_buffer(bounds), pa.py_buffer(out)])
        row = np.searchsorted(at, where[heads], side="right") - 1
        yield pa.RecordBatch.from_arrays([batch.column("lang").take(pa.array(row)), flat], names=["lang", "piece"])


def _totals(key: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Dense numbers of the keys, the place at which each first stands, and the weights summed by it."""
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    number = np.empty(len(key), np.int64)
    number[order] = np.cumsum(new) - 1
    heads = np.flatnonzero(new)
    return number, order[heads], np.add.reduceat(weight[order], heads)


def _phrases(batch: pa.RecordBatch, sizes: tuple[int, ...], known: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """``(lang, phrase, size, f)`` of the phrases within one block of distinct pieces, and with size 1 a row
    for each language with an empty phrase and the number of its words. Phrases are numbered exactly, no hash is taken for
    them. Where pairs are ``known``, only phrases all of whose pairs may be among these are made."""
    texts = batch.column("piece")
    data, at = text_bytes(texts)
    counts = batch.column("n").to_numpy(zero_copy_only=False)
    space = data == 32
    begins = np.concatenate([[True], space[:-1]])
    begins[at[:-1]] = True
    starts = np.flatnonzero(begins)
    ends = np.append(starts[1:], len(data))
    ends = ends - space[ends - 1]  # without the space that follows, if one does
    row = np.searchsorted(at, starts, side="right") - 1
    lang, names = encoded(batch.column("lang"))
    weight, lang = counts[row], lang.astype(np.int64)[row]
    token = encoded(_slices(data, starts, ends))[0].astype(np.int64)
    place, number = np.arange(len(starts)), lang
    if 1 in sizes:
        totals = np.zeros(len(names), np.int64)
        np.add.at(totals, lang, weight)
        yield pa.RecordBatch.from_arrays([names, pa.array([""] * len(names)), pa.array(np.zeros(len(names), np.int32)), pa.array(totals)], names=COLUMNS)
    for size in range(1, max(sizes) + 1):
        fits = place + size <= len(starts)
        place, number = place[fits], number[fits]
        fits = row[place] == row[place + size - 1]
        if known is not None and size > 2:
            fits &= often[place] & often[place + size - 2]
        place, number = place[fits], number[fits]
        if not len(place):
            return
        number, head, total = _totals((number << 32) | token[place + size - 1], weight[place])
        chosen = place[head]
        phrase = _slices(data, starts[chosen], ends[chosen + size - 1])
        if known is not None and size == 2:
            often = np.zeros(len(starts), bool)
            often[place] = _may_hold(known, _marks(names.cast(pa.binary()).take(pa.array(lang[chosen])), phrase))[number]
        if size in sizes:
            yield pa.RecordBatch.from_arrays([names.take(pa.array(lang[chosen])), phrase.cast(pa.string()), pa.array(np.full(len(chosen), size, np.int32)), pa.array(total)], names=COLUMNS)


def _slices(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The slices of ``data`` from ``starts`` to ``ends`` as binaries."""
    length = ends - starts
    offsets = np.concatenate([[0], np.cumsum(length)])
    at = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], length)
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data[at])])


def _marks(lang: pa.Array, phrase: pa.Array) -> np.ndarray:
    return mix(hashes(lang) + hashes(phrase))


def _bits(marks: np.ndarray, size: int) -> np.ndarray:
    """The places of each mark in a filter of ``size`` bits, a power of two."""
    step = (marks >> np.uint64(32)) | np.uint64(1)
    return (marks[:, None] + np.arange(PROBES, dtype=np.uint64) * step[:, None]) & np.uint64(size - 1)


def _may_hold(known: np.ndarray, marks: np.ndarray) -> np.ndarray:
    at = _bits(marks, 8 * len(known))
    return (known[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).all(axis=1)


def _places(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = _bits(_marks(batch.column("lang").cast(pa.binary()), batch.column("phrase").cast(pa.binary())), size).ravel().astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at // CHUNK_BITS), pa.array(at % CHUNK_BITS)], names=["chunk", "bit"])

    return run


def _chunk(key: tuple, rows: pa.Table) -> pa.Table:
    bits = np.zeros(CHUNK_BITS, np.uint8)
    bits[rows.column("bit").to_numpy()] = 1
    return pa.table({"chunk": [key[0].as_py()], "bits": [np.packbits(bits, bitorder="little").tobytes()]})


def pair_filter(pairs: DataFrame, most_bits: int = MOST_BITS) -> np.ndarray:
    """A Bloom filter of (lang, phrase) of at most ``most_bits`` bits: it may take other pairs for known ones, and never the reverse.
    A table too large for it makes more work for the counts, and no difference to them."""
    size = CHUNK_BITS
    while size < min(16 * pairs.count(), most_bits):
        size *= 2
    parts = pairs.mapInArrow(_places(size), "chunk long, bit long").distinct().groupBy("chunk").applyInArrow(_chunk, "chunk long, bits binary").collect()
    known = np.zeros(size // 8, np.uint8)
    for r in parts:
        known[r.chunk * CHUNK_BITS // 8 :][: CHUNK_BITS // 8] = np.frombuffer(r.bits, np.uint8)
    return known


def _counted(sizes: tuple[int, ...], known: Broadcast | None = None):
    """``_phrases`` over blocks of about ``BLOCK_BYTES``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        whole = lambda: _phrases(pa.Table.from_batches(held).combine_chunks().to_batches()[0], sizes, None if known is None else known.value)
        for batch in batches:
            for part in pieces(iter([batch]), "piece", BLOCK_BYTES):
                held.append(part)
                size += part.nbytes
                if size >= BLOCK_BYTES:
                    yield from whole()
                    held, size = [], 0
                    tidy()
        if held:
            yield from whole()
        tidy()

    return run


def scratch() -> str:
    """Where this executor's own spills go, by its environment; Spark clears it with the application."""
    named = next((os.environ[k] for k in ("SPARK_EXECUTOR_DIRS", "LOCAL_DIRS", "SPARK_LOCAL_DIRS") if os.environ.get(k)), tempfile.gettempdir())
    return named.replace(os.pathsep, ",").split(",")[0]


def _summed(least: int, memory: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        first = next(batches, None)
        if first is None:
            return

        def stream() -> Iterator[pa.RecordBatch]:
            yield first
            yield from batches

        with tempfile.TemporaryDirectory(prefix="phrases-", dir=scratch()) as spill, duckdb.connect(config={"memory_limit": memory, "threads": 1, "temp_directory": spill, "preserve_insertion_order": False}) as con:
            con.register("parts", pa.RecordBatchReader.from_batches(first.schema, stream()))
            found = con.sql(f"SELECT lang, phrase, size, sum(f)::BIGINT AS f FROM parts GROUP BY lang, phrase, size HAVING sum(f) >= {least} OR size = 0").to_arrow_reader(65536)
            yield from found
        tidy()

    return run


def phrase_counts(documents: DataFrame, least: int = 30, memory: str = MEMORY) -> DataFrame:
    """``lang, phrase, size, f`` of all phrases of 1 to 4 words that occur ``least`` times or more in a language, and a row of size 0
    with the number of all words of each language. Null languages are ``und``; null texts are empty."""
    docs = documents.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    distinct = materialize(docs.mapInArrow(_split, PIECE).groupBy("lang", "piece").agg(F.count("*").alias("n")), "pieces")
    summed = lambda parts: parts.repartition("lang", "phrase").mapInArrow(_summed(least, memory), COUNT)
    short = materialize(summed(distinct.mapInArrow(_counted((1, 2)), COUNT)), "short-phrases")
    known = documents.sparkSession.sparkContext.broadcast(pair_filter(short.where("size = 2")))
    long = materialize(summed(distinct.mapInArrow(_counted(tuple(range(3, LONGEST + 1)), known), COUNT)), "long-phrases")
    known.unpersist()
    out = materialize(short.unionByName(long), "phrase-counts")
    discard(distinct, short, long)
    return out


def collocations(documents: DataFrame, least: int = 30, covered: int = 80, top: int = 2000) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of 2 to 4 words of each language.

    ``a`` counts the phrase, ``l`` and ``r`` the parts of its worst cut, and the score is
    floor(2000000 a / (l + r)) there. Phrases that lie within a longer one which has ``covered`` percent of their count or more are left out. Ties go to
    the greater count, then to the first in byte order. Texts without words add nothing; an empty table gives no rows. Rows count
    as often as they stand in the table; other columns are ignored.
    """
    counts = phrase_counts(documents, least)
    candidates = counts.where("size >= 2").select("lang", "phrase", "size", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    joined = lambda start, n: F.array_join(F.slice("w", start, n), " ")
    k = F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    cuts = candidates.select("lang", F.col("phrase").alias("whole"), "size", "w", k)
    sides = F.array(F.struct(F.lit("l").alias("side"), joined(F.lit(1), F.col("k")).alias("part")), F.struct(F.lit("r").alias("side"), joined(F.col("k") + 1, F.col("size") - F.col("k")).alias("part")))
    requests = materialize(cuts.select("lang", "whole", "k", F.explode(sides).alias("s")).select("lang", "whole", F.concat("s.side", F.col("k").cast("string")).alias("slot"), F.col("s.part").alias("phrase")), "requests")
    found, hot = lookup(requests, counts.select("lang", "phrase", "f"), ["lang", "phrase"])
    answers = found.select("lang", F.col("whole").alias("phrase"), "slot", "f")
    spans = F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda n: F.transform(F.sequence(F.lit(1), F.col("size") - n + 1), lambda i: F.array_join(F.slice("w", i, n), " "))))
    within = candidates.where("size >= 3").select("lang", F.explode(spans).alias("phrase"), F.lit("cover").alias("slot"), F.col("a").alias("f"))
    own = candidates.select("lang", "phrase", F.lit("a").alias("slot"), F.col("a").alias("f"))
    slots = ["a", "cover", *(f"{s}{i}" for i in range(1, LONGEST) for s in "lr")]
    gathered = answers.unionByName(within).unionByName(own).groupBy("lang", "phrase").agg(*(F.max(F.when(F.col("slot") == s, F.col("f"))).alias(s) for s in slots))
    score = lambda i: F.expr(f"2000000 * CAST(a AS DECIMAL(25, 0)) div (CAST(l{i} AS DECIMAL(20, 0)) + CAST(r{i} AS DECIMAL(20, 0)))")
    worst = F.array_min(F.filter(F.array(*(F.struct(score(i).alias("score"), F.lit(i).alias("k"), F.col(f"l{i}").alias("l"), F.col(f"r{i}").alias("r")) for i in range(1, LONGEST))), lambda c: c["l"].isNotNull()))
    kept = gathered.where(F.expr(f"cover IS NULL OR 100 * CAST(cover AS DECIMAL(25, 0)) < {covered} * CAST(a AS DECIMAL(25, 0))"))
    scored = kept.select("lang", "phrase", "a", worst.alias("c")).select("lang", "phrase", "a", "c.l", "c.r", "c.score")
    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salted = scored.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    heads = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*best))).where(F.col("rank") <= top)
    ranked = heads.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("bigint")).where(F.col("rank") <= top)
    words = counts.where("size = 0").select("lang", F.col("f").alias("n"))
    out = materialize(ranked.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score"), "collocations")
    discard(counts, requests, hot)
    return out
