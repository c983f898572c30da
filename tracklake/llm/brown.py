"""Brown class-based bigrams: distributed exchange clustering and smoothed perplexity.

A block is a stretch of documents with its own list of words; all passes work on numbered words
of blocks. Buckets by word hash hold what all blocks know of a word. Counts, classes and
transitions are taken over all training documents. Blocks and buckets are stored as bucketed
tables, so that a pass moves only classes and contexts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklake.llm._text import TEXT_ROWS, encoded, hashes, pieces, tidy, words
from tracklake.storage import discard, materialize, materialize_by

END = b" "  # no word holds a space
NONE = 255  # the class of a word that has none yet
BLOCK_BYTES = 6 << 20
BUCKET_TOKENS = 2 << 20

BLOCK = "block long, docs array<long>, train binary, at binary, ids binary, data binary, ends binary, tokens long"
SLICE = "bucket int, block long, data binary, ends binary, counts binary"
MERGED = "bucket int, block long, gid binary, counts binary, top array<struct<word:binary,n:long,gid:int>>"
CONTEXT = "bucket int, block long, keys binary, n binary"
CLASSED = "bucket int, block long, cls binary, counts binary, stats array<long>"
SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _binary(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers of 32 bits as compressed byte planes."""
    return zstandard.ZstdCompressor(level=1).compress(_binary(values.astype("<i4").view(np.uint8).reshape(-1, 4).T))


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<i4").ravel()


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    for batch in pieces(batches, limit=BLOCK_BYTES):
        flat, at = words(batch.column("text"))
        ids, vocabulary = encoded(flat)
        values = [*vocabulary.to_pylist(), END]
        rank = np.argsort(hashes(pa.array(values, pa.binary())), kind="stable")
        place = np.empty(len(rank), np.int32)
        place[rank] = np.arange(len(rank))
        n = batch.num_rows
        sequence = np.empty(len(ids) + n, np.int32)
        tail = at[1:] + np.arange(n)
        inner = np.ones(len(sequence), bool)
        inner[tail] = False
        sequence[inner] = place[ids]
        sequence[tail] = place[-1]
        ordered = [values[i] for i in rank]
        yield pa.RecordBatch.from_pydict(
            {
                "block": [number], "docs": [batch.column("doc_id").to_pylist()], "train": [_binary(batch.column("train").to_numpy(zero_copy_only=False).astype(bool))],
                "at": [_binary(np.append(0, tail + 1).astype(np.int64))], "ids": [_packed(sequence)], "data": [b"".join(ordered)], "ends": [_binary(np.cumsum([len(x) for x in ordered]).astype(np.int32))], "tokens": [len(sequence)],
            },
            schema=pa.schema([("block", pa.int64()), ("docs", pa.list_(pa.int64())), *((k, pa.binary()) for k in ("train", "at", "ids", "data", "ends")), ("tokens", pa.int64())]),
        )
        number += 1


class _Block:
    """One row of the block table."""

    def __init__(self, batch: pa.RecordBatch | pa.Table, row: int):
        get = lambda name: batch.column(name)[row].as_py()
        self.block, self.docs = get("block"), get("docs")
        self.train = np.frombuffer(get("train"), bool)
        self.at = np.frombuffer(get("at"), np.int64)
        self.ids = _unpacked(get("ids"))
        ends = np.frombuffer(get("ends"), np.int32)
        self.words = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(np.append(np.int32(0), ends)), pa.py_buffer(get("data"))])
        self.used = np.repeat(self.train, np.diff(self.at))
        self.end = int(self.ids[self.at[1] - 1])

    def counts(self) -> np.ndarray:
        return np.bincount(self.ids[self.used], minlength=len(self.words))

    def bounds(self, buckets: int) -> np.ndarray:
        """Where each bucket's words begin; they lie in the order of their hashes."""
        top = (hashes(self.words) >> np.uint64(44)).astype(np.int64) * buckets >> 20
        return np.searchsorted(top, np.arange(buckets + 1))

    def previous(self) -> np.ndarray:
        return np.append(self.end, self.ids[:-1])


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[_Block]:
    for batch in batches:
        for row in range(batch.num_rows):
            yield _Block(batch, row)
            tidy()


def _slices(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own in _each(batches):
            counts, bounds = own.counts(), own.bounds(buckets)
            ends = np.append(0, np.frombuffer(own.words.buffers()[1], np.int32)[1:])
            data = own.words.buffers()[2].to_pybytes() if own.words.buffers()[2] else b""
            rows = [(b, own.block, data[ends[x] : ends[y]], _binary((ends[x + 1 : y + 1] - ends[x]).astype(np.int32)), _packed(counts[x:y])) for b, (x, y) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)) if x < y]
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()), *(pa.array(c, pa.binary()) for c in columns[2:])], names=["bucket", "block", "data", "ends", "counts"])

    return run


def _merge(most: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        parts, counts = [], []
        for r in range(table.num_rows):
            ends = np.frombuffer(table.column("ends")[r].as_py(), np.int32)
            parts.append(pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(np.append(np.int32(0), ends)), pa.py_buffer(table.column("data")[r].as_py())]))
            counts.append(_unpacked(table.column("counts")[r].as_py()))
        flat = pa.concat_arrays(parts).dictionary_encode()
        gid = flat.indices.to_numpy(zero_copy_only=False)
        total = np.bincount(gid, np.concatenate(counts), len(flat.dictionary)).astype(np.int64)
        best = np.argsort(-total, kind="stable")[:most]
        top = [{"word": flat.dictionary[int(g)].as_py(), "n": int(total[g]), "gid": int(g)} for g in best if total[g]]
        at = np.append(0, np.cumsum([len(p) for p in parts]))
        bucket = table.column("bucket")[0].as_py()
        kind = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64()), ("gid", pa.int32())]))
        return pa.table(
            {
                "bucket": pa.array([bucket] * (len(parts) + 1), pa.int32()), "block": pa.array([*table.column("block").to_pylist(), -1], pa.int64()),
                "gid": pa.array([*(_packed(gid[x:y]) for x, y in zip(at[:-1], at[1:], strict=True)), None], pa.binary()), "counts": pa.array([None] * len(parts) + [_binary(total)], pa.binary()), "top": pa.array([None] * len(parts) + [top], kind),
            }
        )

    return run


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for x in batch.column("counts"):
            c = np.frombuffer(x.as_py(), np.int64)
            yield pa.RecordBatch.from_pydict({"tokens": [int(c.sum())], "types": [int((c > 0).sum())], "once": [int((c == 1).sum())], "twice": [int((c == 2).sum())]})


def _seed_pairs(shared):
    """Rows of the bigram matrix of the seed words, summed over a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = shared.value
        m = len(seeds)
        total = np.zeros(m * m, np.int64)
        for own in _each(batches):
            seed = pc.index_in(own.words, pa.array(seeds, pa.binary())).fill_null(-1).to_numpy(zero_copy_only=False)
            a, b = seed[own.previous()], seed[own.ids]
            use = own.used & (a >= 0) & (b >= 0)
            total += np.bincount(a[use].astype(np.int64) * m + b[use], minlength=m * m)
        rows = total.reshape(m, m)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(m, dtype=np.int32)), pa.array([_binary(r) for r in rows], pa.binary())], names=["a", "row"])

    return run


def _row_sum(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x.as_py(), np.int64) for x in table.column("row"))
    return pa.table({"a": table.column("a")[:1], "row": pa.array([_binary(total)], pa.binary())})


def _phi(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def likelihood(g: np.ndarray) -> float:
    """Log-likelihood of class bigrams, but for what words within classes add, which no exchange changes."""
    return float(_phi(g).sum() - _phi(g.sum(axis=0)).sum() - _phi(g.sum(axis=1)).sum())


def exchange(pairs: np.ndarray, classes: int, sweeps: int = 8) -> np.ndarray:
    """Exchange clustering: each word in turn moves to the class in which the class bigrams are most
    likely, until a sweep moves none. ``pairs[a, b]``: how often b follows a."""
    m = len(pairs)
    cls = np.arange(m) % classes
    member = np.eye(classes)[cls]
    f = pairs.astype(float)
    g = member.T @ f @ member
    for _ in range(sweeps):
        moved = False
        for w in range(m):
            c, own = cls[w], f[w, w]
            right, left = f[w] @ member, f[:, w] @ member
            right[c] -= own
            left[c] -= own
            g[c] -= right
            g[:, c] -= left
            g[c, c] -= own
            rows, columns = g.sum(axis=1) + left, g.sum(axis=0) + right
            across = _phi(g + right) - _phi(g)
            down = _phi(g + left[:, None]) - _phi(g)
            d = np.diag(g)
            gain = across.sum(axis=1) + down.sum(axis=0) - np.diag(across) - np.diag(down) + _phi(d + right + left + own) - _phi(d)
            gain -= _phi(rows + right.sum() + own) - _phi(rows) + _phi(columns + left.sum() + own) - _phi(columns)
            k = int(gain.argmax()) if gain.max() > gain[c] + 1e-9 else c
            g[k] += right
            g[:, k] += left
            g[k, k] += own
            if k != c:
                member[w] = 0
                member[w, k] = 1
                cls[w], moved = k, True
        if not moved:
            break
    return cls


def _local_classes(classed: pa.Table) -> np.ndarray:
    """The class of each word of a block; its words lie in the order of the buckets."""
    classed = classed.sort_by("bucket")
    return np.concatenate([np.zeros(0, np.uint8), *(np.frombuffer(x.as_py(), np.uint8) for x in classed.column("cls"))])


def _contexts(classes: int, buckets: int, half: int | None):
    """For each word of a block, how often its neighbours on either side are of each class, as rows of
    its bucket; and the block's class bigrams, as a row of bucket -1. ``half``: only for words whose
    hash has this last bit; -1: for none."""

    def run(blocks: pa.Table, classed: pa.Table) -> pa.Table:
        out = []
        for own in _each(blocks.to_batches()):
            cls = _local_classes(classed)
            moving = np.ones(len(cls), bool) if half is None else np.zeros(len(cls), bool) if half < 0 else (hashes(own.words) & np.uint64(1)).astype(int) == half
            token, previous = own.ids, own.previous()
            here, before = cls[token], cls[previous]
            both = own.used & (here < NONE) & (before < NONE)
            code = np.bincount(before[both].astype(np.int64) * classes + here[both], minlength=classes * classes)
            pairs = np.flatnonzero(code)
            rows = [(-1, own.block, _packed(pairs), _packed(code[pairs]))]
            use = own.used & (before < NONE) & moving[token]
            keys = token[use].astype(np.int64) * (2 * classes) + before[use]
            use = own.used & (here < NONE) & moving[previous]
            keys = np.sort(np.concatenate([keys, previous[use].astype(np.int64) * (2 * classes) + classes + here[use]]))
            heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)])
            n, keys = np.diff(np.append(heads, len(keys))), keys[heads]
            bounds = own.bounds(buckets)
            cut = np.searchsorted(keys, bounds * (2 * classes))
            for b in np.flatnonzero(cut[:-1] < cut[1:]).tolist():
                part = keys[cut[b] : cut[b + 1]] - bounds[b] * 2 * classes
                rows.append((b, own.block, _packed(np.diff(part, prepend=0)), _packed(n[cut[b] : cut[b + 1]])))
            columns = list(zip(*rows, strict=True))
            out.append(pa.table([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.binary()), pa.array(columns[3], pa.binary())], names=["bucket", "block", "keys", "n"]))
        return pa.concat_tables(out) if out else pa.table({"bucket": pa.array([], pa.int32()), "block": pa.array([], pa.int64()), "keys": pa.array([], pa.binary()), "n": pa.array([], pa.binary())})

    return run


def _bigram_sums(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for keys, n in zip(batch.column("keys").to_pylist(), batch.column("n").to_pylist(), strict=True):
                total[_unpacked(keys)] += _unpacked(n)
        use = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(use.astype(np.int32)), pa.array(total[use])], names=["code", "n"])

    return run


def move_gains(word: np.ndarray, side: np.ndarray, other: np.ndarray, n: np.ndarray, cls: np.ndarray, g: np.ndarray, chunk: int = 1 << 16) -> np.ndarray:
    """For each word and class, what the likelihood of the class bigrams ``g`` gains if the word stands in
    that class and its counts are taken out of its present one (NONE: it has none).

    The word's neighbours are entries, one for each class on each side, sorted by word: ``n`` times class
    ``other`` stands before it (``side`` 0) or after it (1). Other words stay where they are, so bigrams of
    a word with itself count as if the other were one of them.
    """
    classes = len(g)
    gain, sides = np.zeros((len(cls), classes)), np.zeros((2, len(cls), classes), np.float32)
    sides[side, word, other] = n
    for first in range(0, len(word), chunk):
        w, s, j, m = (x[first : first + chunk] for x in (word, side, other, n))
        base = np.where((s == 0)[:, None], g[j], g.T[j]).astype(float)
        home = cls[w]
        meets = np.flatnonzero(home == j)
        base[meets] -= sides[1 - s[meets], w[meets]]
        own = np.flatnonzero(home != NONE)
        base[own, home[own]] -= m[own]
        base = np.maximum(base, 0)
        heads = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
        gain[w[heads]] += np.add.reduceat(_phi(base + m[:, None]) - _phi(base), heads, axis=0)
    w, k = np.nonzero((sides[0] > 0) & (sides[1] > 0))  # both go into one cell of the diagonal
    x, y = sides[0, w, k].astype(float), sides[1, w, k].astype(float)
    base = np.maximum(g[k, k] - (x + y) * (cls[w] == k), 0)
    gain[w, k] += _phi(base + x + y) - _phi(base + x) - _phi(base + y) + _phi(base)
    for k, margin in ((0, g.sum(axis=0)), (1, g.sum(axis=1))):
        total = sides[k].sum(axis=1, dtype=float)
        base = np.broadcast_to(margin.astype(float), gain.shape).copy()
        own = cls != NONE
        base[np.flatnonzero(own), cls[own]] -= total[own]
        base[~own] += sides[1 - k, ~own]
        base = np.maximum(base, 0)
        gain -= _phi(base + total[:, None]) - _phi(base)
    return gain


def _assign(shared, classes: int, with_counts: bool):
    """Move every word of a bucket into the class that its neighbours make most likely; words without
    counted neighbours stay, and get the class with most bigrams if they have none."""

    def run(merged: pa.Table, contexts: pa.Table) -> pa.Table:
        tidy()
        g = shared.value
        empty = pa.table({"bucket": pa.array([], pa.int32()), "block": pa.array([], pa.int64()), "cls": pa.array([], pa.binary()), "counts": pa.array([], pa.binary()), "stats": pa.array([], pa.list_(pa.int64()))})
        if not merged.num_rows:
            return empty
        bucket = merged.column("bucket")[0].as_py()
        gids, counts = {}, None
        for r in range(merged.num_rows):
            if (block := merged.column("block")[r].as_py()) >= 0:
                gids[block] = merged.column("gid")[r].as_py()
            else:
                counts = np.frombuffer(merged.column("counts")[r].as_py(), np.int64)
        cls = np.full(len(counts), NONE, np.uint8)
        seen = np.zeros(len(counts) * 2 * classes, np.int32)
        for r in range(contexts.num_rows):
            keys, n = contexts.column("keys")[r].as_py(), contexts.column("n")[r].as_py()
            if n is None:
                cls = np.frombuffer(keys, np.uint8).copy()
                continue
            keys = np.cumsum(_unpacked(keys), dtype=np.int64)
            gid = _unpacked(gids[contexts.column("block")[r].as_py()]).astype(np.int64)
            seen[gid[keys // (2 * classes)] * (2 * classes) + keys % (2 * classes)] += _unpacked(n)
        entry = np.flatnonzero(seen)
        word, rest = entry // (2 * classes), entry % (2 * classes)
        moving, own = np.unique(word, return_inverse=True)
        if len(moving):
            gain = move_gains(own, rest // classes, rest % classes, seen[entry].astype(float), cls[moving], g)
            best = gain.argmax(axis=1)
            here = cls[moving]
            held = np.where(here == NONE, -np.inf, gain[np.arange(len(moving)), np.where(here == NONE, 0, here)])
            cls[moving] = np.where(gain.max(axis=1) > held + 1e-9, best, here)
        cls[cls == NONE] = g.sum(axis=1).argmax()
        known = counts > 0
        stats = [np.bincount(cls[known], None if weight is None else weight[known], classes).astype(np.int64) for weight in (counts, None)]
        blocks = sorted(gids)
        local = [_unpacked(gids[b]) for b in blocks]
        return pa.table(
            {
                "bucket": pa.array([bucket] * (len(blocks) + 1), pa.int32()), "block": pa.array([*blocks, -1], pa.int64()),
                "cls": pa.array([*(_binary(cls[x]) for x in local), _binary(cls)], pa.binary()), "counts": pa.array([*(_packed(counts[x]) if with_counts else None for x in local), None], pa.binary()),
                "stats": pa.array([*[None] * len(blocks), np.concatenate(stats).tolist()], pa.list_(pa.int64())),
            }
        )

    return run


def _seeded(shared):
    """The first classes: those of the seed words; the others have none."""

    def run(merged: pa.Table) -> pa.Table:
        fixed = shared.value
        merged = merged.sort_by("block")
        bucket = merged.column("bucket")[0].as_py()
        cls = np.full(len(np.frombuffer(merged.column("counts")[0].as_py(), np.int64)), NONE, np.uint8)
        for gid, c in fixed.get(bucket, {}).items():
            cls[gid] = c
        blocks = merged.column("block").to_pylist()
        rows = [_binary(cls), *(_binary(cls[_unpacked(x)]) for x in merged.column("gid").to_pylist()[1:])]
        none = [None] * len(blocks)
        return pa.table({"bucket": pa.array([bucket] * len(blocks), pa.int32()), "block": pa.array(blocks, pa.int64()), "cls": pa.array(rows, pa.binary()), "counts": pa.array(none, pa.binary()), "stats": pa.array(none, pa.list_(pa.int64()))})

    return run


def _emit(shared, classes: int):
    """Scores of the documents of a block."""

    def run(blocks: pa.Table, classed: pa.Table) -> pa.Table:
        mass, discount, tokens, types, logs = shared.value
        out = []
        for own in _each(blocks.to_batches()):
            cls = _local_classes(classed).astype(np.int64)
            count = np.concatenate([_unpacked(x.as_py()) for x in classed.sort_by("bucket").column("counts")]).astype(np.int64)
            known = count > 0
            cls[~known] = classes
            emission = np.where(known, np.log10(np.maximum(count - discount, 1e-9) / np.append(mass, 1)[cls]), 0.0)
            base = np.log10((count + 1) / (tokens + types + 1))
            here = cls[own.ids]
            starts = own.at[:-1]
            last = np.where(here < classes, np.arange(len(here)), -1)
            last = np.maximum.accumulate(np.append(-1, last[:-1]))
            first = np.repeat(starts, np.diff(own.at))
            history = np.where(last >= first, here[np.maximum(last, 0)], cls[own.end] if cls[own.end] < classes else 0)
            score = emission[own.ids] + logs[history, here]
            sums = [np.add.reduceat(x, starts) for x in (known[own.ids].astype(np.int64), base[own.ids], score)]
            out.append(pa.table({"doc_id": pa.array(own.docs, pa.int64()), "held_out": pa.array(~own.train), "n_tokens": pa.array(np.diff(own.at)), "n_known": pa.array(sums[0]), "base_score": pa.array(sums[1]), "score": pa.array(sums[2])}))
        kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        return pa.concat_tables(out) if out else pa.table([pa.array([], k) for k in kinds], names=[c.split()[0] for c in SCORED.split(", ")])

    return run


def brown_scores(docs: DataFrame, train: Column, classes: int = 32, seeds: int = 512, rise: float = 0.05) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity`` of every row.

    ``train`` says which rows are learnt from. Tokens are the words, A-Z lower-cased, and one end a text.
    Words are clustered by exchange on the class bigrams of all training texts. It starts from the
    ``seeds`` most frequent words, exchanged one by one on their own bigrams; the first sweep gives every
    word of the vocabulary the class in which its neighbours are most likely. In each further sweep half of
    the words (by a bit of their hash, in turn) move to the class of the largest gain in likelihood, with all
    neighbours and class bigrams counted anew. Sweeps end when two of them, one for each half, have raised the
    log-likelihood by ``rise`` a bigram or less; one that lowered it, as words that move together may, is taken
    back and is the last. The model is P(class | last known class) P(word | class):
    transitions are smoothed with the class frequencies, emissions by an absolute discount, whose mass goes
    to one unknown type. Scores are log10 probabilities of whole texts; ``base_score`` is the unigram with
    one added.

    Null, empty and blank texts hold the end alone. Without training rows all scores are 0, as the unknown
    type is all there is. A null doc_id is scored by the value of ``train`` (null: not learnt from). Repeated
    rows count each; other columns are ignored. ``classes`` is at most 254.
    """
    spark = docs.sparkSession
    share = spark.sparkContext.broadcast
    chosen = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = materialize_by(chosen.mapInArrow(_blocks, BLOCK), "block", parts, "brown-blocks", TEXT_ROWS)
    buckets = int(max(16, -(-(blocks.agg(F.sum("tokens")).first()[0] or 0) // BUCKET_TOKENS)))
    merged = materialize_by(blocks.mapInArrow(_slices(buckets), SLICE).groupBy("bucket").applyInArrow(_merge(seeds), MERGED), "bucket", parts, "brown-vocabulary")
    sums = merged.where("block < 0").select("counts").mapInArrow(_sums, "tokens long, types long, once long, twice long")
    tokens, types, once, twice = (x or 0 for x in sums.groupBy().sum("tokens", "types", "once", "twice").first())
    top = merged.where("block < 0").select("bucket", F.explode("top").alias("x")).select("bucket", "x.*").orderBy(F.desc("n"), "word").limit(seeds).collect()
    classes = max(1, min(classes, len(top)))
    names = [bytes(r.word) for r in top]
    fixed: dict[int, dict[int, int]] = {}
    if names:
        rows = blocks.mapInArrow(_seed_pairs(share(names)), "a int, row binary").groupBy("a").applyInArrow(_row_sum, "a int, row binary")
        pairs = np.stack([np.frombuffer(r.row, np.int64) for r in sorted(rows.collect(), key=lambda r: r.a)])
        for r, c in zip(top, exchange(pairs, classes).tolist(), strict=True):
            fixed.setdefault(r.bucket, {})[r.gid] = c
    members = merged.select("bucket", "block", "gid", "counts")
    classed = materialize(members.groupBy("bucket").applyInArrow(_seeded(share(fixed)), CLASSED), "brown-classes")

    def contexts(half: int | None) -> tuple[DataFrame, np.ndarray]:
        """What the blocks count under the present classes, and the bigrams of these."""
        own = classed.where("block >= 0").select("bucket", "block", "cls")
        found = materialize(blocks.groupBy("block").cogroup(own.groupBy("block")).applyInArrow(_contexts(classes, buckets, half), CONTEXT), "brown-contexts")
        g = np.zeros(classes * classes)
        summed = found.where("bucket < 0").select("keys", "n").mapInArrow(_bigram_sums(classes * classes), "code int, n long").groupBy("code").agg(F.sum("n").alias("n"))
        for r in summed.collect():  # a cell of the class bigrams each
            g[r.code] = r.n
        return found, g.reshape(classes, classes)

    def moved(found: DataFrame | None, g: np.ndarray) -> DataFrame:
        """The classes after all counted words have moved; without ``found`` none does, and known words' counts are added."""
        counted = classed.where("block < 0").select("bucket", "block", F.col("cls").alias("keys"), F.lit(None).cast("binary").alias("n"))
        if found is not None:
            counted = counted.unionByName(found.where("bucket >= 0"))
        return materialize(members.groupBy("bucket").cogroup(counted.groupBy("bucket")).applyInArrow(_assign(share(g), classes, found is None), CLASSED), "brown-classes")

    before, reached, total = None, [], None
    while True:
        found, g = contexts(None if total is None else (len(reached) + 1) % 2)
        if total is not None:
            reached.append(likelihood(g))
            fell = len(reached) > 1 and reached[-1] < reached[-2]
            if fell:
                discard(classed)
                classed, before = before, None
            else:
                total = g
            if fell or not g.any() or len(reached) > 2 and reached[-1] - reached[-3] <= rise * g.sum():
                break
        discard(before)
        total, before, classed = g, classed, moved(found, g)
        discard(found)
    settled = moved(None, total)
    discard(found, before, classed, merged)
    classed = settled
    stats = np.zeros(2 * classes, np.int64)
    summed = classed.where("block < 0").select(F.posexplode("stats").alias("k", "n")).groupBy("k").agg(F.sum("n").alias("n"))
    for r in summed.collect():
        stats[r.k] = r.n
    mass, kinds = stats[:classes], stats[classes:]
    discount = once / (once + 2 * twice) if once and twice else 0.5
    prior = (mass + 1) / (mass + 1).sum()
    after = (total + 50 * prior) / (total.sum(axis=1, keepdims=True) + 50)
    unknown = (after * np.where(mass > 0, discount * kinds / np.maximum(mass, 1), 1.0)).sum(axis=1)
    logs = np.log10(np.column_stack([after, np.maximum(unknown, 1e-300)]))
    own = classed.where("block >= 0").select("bucket", "block", "cls", "counts")
    scored = materialize(blocks.groupBy("block").cogroup(own.groupBy("block")).applyInArrow(_emit(share((np.maximum(mass, 1), discount, tokens, types, logs)), classes), SCORED), "brown-scores")
    discard(classed, blocks)
    return scored.withColumn("train_tokens", F.lit(int(tokens))).withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
