"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracklake.llm._text import encoded, located_words, pieces, text_bytes

BUCKETS = 1 << 18
RUN = 64
EDGES = b".,;:!?\"'()[]"


@dataclass
class Field:
    """Feature weights for the toxic tag, transition weights, and the document calibration."""

    theta: np.ndarray
    trans: np.ndarray
    calibration: np.ndarray
    scale: np.ndarray


def _digests(words: list[bytes]) -> np.ndarray:
    """Feature numbers of each word: itself, prefixes, suffix, and itself as a neighbour on either side."""
    digest, mask = xxhash.xxh32_intdigest, BUCKETS - 1
    flat: list[int] = []
    for w in words:
        w = w.strip(EDGES)
        flat += (digest(w, 1) & mask, digest(w[:4], 2) & mask, digest(w[:5], 3) & mask, digest(w[-3:], 4) & mask, digest(w, 5) & mask, digest(w, 6) & mask)
    return np.array(flat, np.int32).reshape(-1, 6)


def chains(ids: np.ndarray, at: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Offsets of the chains: a chain ends after a word that ends a sentence, and with its row."""
    cut = np.zeros(len(ids) + 1, bool)
    cut[at] = True
    cut[1:] |= ends[ids]
    cut[-1] = True
    starts = np.flatnonzero(cut)
    return starts if len(ids) else starts[:1]


def _forward(psi: np.ndarray, bounds: np.ndarray, t00: float, t01: float, t10: float, t11: float) -> np.ndarray:
    """Forward messages of all chains at once, as ratios of the two tags.

    Chains are cut into runs of ``RUN`` tokens. A step is a map of the ratio given by a matrix of two by
    two, so the runs of a long chain are first multiplied out, then their ends are found run by run, and
    then all runs are filled from where they begin: the messages are those of the whole chain.
    """
    out = np.empty_like(psi)
    size = np.diff(bounds)
    parts = -(-size // RUN)
    nth = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
    start = np.repeat(bounds[:-1], parts) + RUN * nth
    length = np.minimum(RUN, np.repeat(bounds[1:], parts) - start)

    def fill(which: np.ndarray, before: np.ndarray | None) -> None:
        order = np.argsort(-length[which], kind="stable")
        s, n = start[which][order], length[which][order]
        ratio = None if before is None else before[order]
        active = np.searchsorted(-n, -np.arange(1, RUN + 1), side="right")
        for t in range(int(n[0]) if len(n) else 0):
            k = s[: active[t]] + t
            ratio = psi[k] if ratio is None else psi[k] * (t01 + ratio[: active[t]] * t11) / (t00 + ratio[: active[t]] * t10)
            out[k] = ratio

    fill(np.flatnonzero(nth == 0), None)
    later = np.flatnonzero(nth > 0)
    if len(later):
        later = later[np.argsort(nth[later], kind="stable")]
        low, high = np.tile([1.0, 0.0], (len(start), 1)), np.tile([0.0, 1.0], (len(start), 1))
        for t in range(RUN):
            k = later[length[later] > t]
            a, b = low[k] * t00 + high[k] * t10, psi[start[k] + t][:, None] * (low[k] * t01 + high[k] * t11)
            scale = np.maximum(a.max(axis=1), b.max(axis=1))[:, None]
            low[k], high[k] = a / scale, b / scale
        ended, begun = np.empty(len(start)), np.empty(len(start))
        first = np.flatnonzero(nth == 0)
        ended[first] = out[start[first] + length[first] - 1]
        for k in np.split(later, np.flatnonzero(np.diff(nth[later])) + 1):
            begun[k] = ended[k - 1]
            ended[k] = (high[k, 0] + high[k, 1] * begun[k]) / np.maximum(low[k, 0] + low[k, 1] * begun[k], 1e-300)
        fill(later, begun[later])
    return out


def marginals(emission: np.ndarray, bounds: np.ndarray, trans: np.ndarray, pairs: bool = False):
    """Probability of the toxic tag at each token by forward-backward over all chains at once.

    With two tags each message is a ratio. ``pairs`` also gives the expected count of each transition.
    """
    t00, t01, t10, t11 = np.exp(trans)
    psi = np.exp(np.clip(emission, -30, 30))
    fore = _forward(psi, bounds, t00, t01, t10, t11)
    back = _forward(psi[::-1], len(psi) - bounds[::-1], t00, t10, t01, t11)[::-1]  # with the token's own weight
    odds = fore * back / psi
    p = odds / (1 + odds)
    if not pairs:
        return p
    linked = np.ones(len(psi), bool)
    linked[bounds[:-1]] = False
    k = np.flatnonzero(linked)
    joint = np.stack([np.full(len(k), t00), t01 * back[k], fore[k - 1] * t10, fore[k - 1] * t11 * back[k]])
    return p, (joint / joint.sum(axis=0)).sum(axis=1), k


def _emission(field_parts: np.ndarray, ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Own, left-neighbour and right-neighbour weights, summed within the chain. ``field_parts``: three columns a word."""
    e = field_parts[ids, 0].copy()
    if len(ids) > 1:
        inner = np.ones(len(ids), bool)
        inner[bounds[:-1]] = False
        k = np.flatnonzero(inner)
        e[k] += field_parts[ids[k - 1], 1]
        e[k - 1] += field_parts[ids[k], 2]
    return e


def _summary(p: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each row: logarithm of the expected number of toxic tokens, and the largest marginal."""
    out = np.zeros((len(at) - 1, 2))
    full = at[:-1] < at[1:]
    if full.any():
        out[full, 0] = np.log1p(np.add.reduceat(p, at[:-1][full]))
        out[full, 1] = np.maximum.reduceat(p, at[:-1][full])
    return out


def _tags(words: list[bytes], ids: np.ndarray, at: np.ndarray, toxic: np.ndarray, rate: float, weight: float) -> np.ndarray:
    """Token labels from document labels: a token of a toxic document is toxic if its word, or the
    word's first four or five letters, occurs in toxic documents only beyond chance."""
    found, clean = Counter(), Counter()
    for i in range(len(at) - 1):
        keys: set[tuple[int, bytes]] = set()
        for w in set(ids[at[i] : at[i + 1]].tolist()):
            x = words[w].strip(EDGES)
            keys.update(((0, x), (4, x[:4]), (5, x[:5])))
        (found if toxic[i] else clean).update(keys)
    log_rate = np.log(max(rate, 1e-6))
    marked = {k for k, n in found.items() if n >= 3 and n * log_rate <= np.log(3e-4 if k[0] else 1e-5) and n / (n + weight * clean.get(k, 0)) >= 0.9}
    hit = np.fromiter(((0, x) in marked or (4, x[:4]) in marked or (5, x[:5]) in marked for x in (w.strip(EDGES) for w in words)), bool, len(words))
    return hit[ids] & np.repeat(toxic, np.diff(at))


def fit(docs: DataFrame, labels: DataFrame, most_toxic: int = 1500, most_clean: int = 3000, most_chars: int = 8_000_000, most_tokens: int = 300_000, steps: int = 60) -> Field | None:
    """Learn from a bounded sample: of the toxic and of the clean labelled documents the first in hash
    order, at most ``most_toxic`` and ``most_clean`` and of ``most_chars`` characters together in each
    class; texts with more than an eighth of these come after all others, and the first text is taken whatever its length. The field is trained on all their chains with a marked token and on
    others, by a fixed draw, of ``most_tokens`` tokens together; the calibration uses the whole sample.
    The rates of the labels are counted over all labels. ``labels`` holds doc_id and toxic and is filtered
    by the caller; null labels are left out and of repeated ones the larger holds. None if a class is missing.
    """
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg((F.max("toxic") > 0).alias("toxic"))
    counts = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return None
    rate = counts[True] / sum(counts.values())
    drawn = F.xxhash64("doc_id", F.lit(3))
    chosen = [known.where("toxic").orderBy(drawn).limit(most_toxic), known.where("NOT toxic").orderBy(drawn).limit(most_clean)]
    chosen = chosen[0].unionAll(chosen[1])  # at most 4,500 rows of two narrow columns
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    order = Window.partitionBy("toxic").orderBy(F.length("text") > most_chars // 8, drawn, "doc_id", F.xxhash64("text"))
    upto = F.sum(F.length("text")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    found = texts.join(F.broadcast(chosen), "doc_id").withColumn("upto", upto).withColumn("place", F.row_number().over(order))
    sample = found.where((F.col("upto") <= most_chars) | (F.col("place") == 1)).select("doc_id", "text", "toxic").toArrow().sort_by([("doc_id", "ascending"), ("text", "ascending")])
    toxic = np.array(sample.column("toxic").to_pylist(), bool)
    if toxic.all() or not toxic.any():
        return None
    texts = sample.column("text").combine_chunks() if sample.num_rows else pa.array([], pa.string())
    flat, at, _ = located_words(texts)
    ids, vocabulary = encoded(flat)
    words = vocabulary.to_pylist()
    weight = (counts[False] / max(1, (~toxic).sum())) / (counts[True] / max(1, toxic.sum()))
    tag = _tags(words, ids, at, toxic, rate, weight)
    ends = np.fromiter((w.endswith(b".") for w in words), bool, len(words))
    bounds = chains(ids, at, ends)
    features = _digests(words)
    theta, trans = _train(features, ids, bounds, tag, steps, most_tokens)
    parts = np.stack([theta[features[:, :4]].sum(axis=1), theta[features[:, 4]], theta[features[:, 5]]], axis=1)
    x = _summary(marginals(_emission(parts, ids, bounds) + theta[BUCKETS], bounds, trans), at)
    scale = np.maximum(x.std(axis=0), 1e-6)
    return Field(theta, trans, _logistic(x / scale, toxic, np.where(toxic, 1.0, weight)), scale)


def _train(features: np.ndarray, ids: np.ndarray, bounds: np.ndarray, tag: np.ndarray, steps: int, most_tokens: int) -> tuple[np.ndarray, np.ndarray]:
    """Penalised likelihood by full-batch Adam on all chains with a toxic token and, by a fixed draw, others of ``most_tokens`` tokens."""
    marked = np.add.reduceat(tag, bounds[:-1]) > 0
    size = np.diff(bounds)
    rank = np.random.RandomState(7).random_sample(len(size))
    others = np.flatnonzero(~marked)[np.argsort(rank[~marked])]
    use = np.sort(np.concatenate([np.flatnonzero(marked), others[np.cumsum(size[others]) <= most_tokens]]))
    token = np.concatenate([np.arange(bounds[c], bounds[c + 1]) for c in use]) if len(use) else np.zeros(0, np.int64)
    own, y = ids[token], tag[token].astype(float)
    at = np.concatenate([[0], np.cumsum(size[use])])
    inner = np.ones(len(token), bool)
    inner[at[:-1]] = False
    k = np.flatnonzero(inner)
    columns = [(np.arange(len(token)), features[own, j]) for j in range(4)] + [(k, features[own[k - 1], 4]), (k - 1, features[own[k], 5])]
    seen = np.bincount(((tag[token][k - 1] * 2) + tag[token][k]).astype(int), minlength=4).astype(float)
    theta, trans = np.zeros(BUCKETS + 1), np.zeros(4)
    theta[BUCKETS] = np.log((y.sum() + 1) / (len(y) - y.sum() + 1))
    moment, square = np.zeros(BUCKETS + 5), np.zeros(BUCKETS + 5)
    for step in range(1, steps + 1):
        e = np.full(len(token), theta[BUCKETS])
        for rows, number in columns:
            e[rows] += theta[number]
        p, pairs, _ = marginals(e, at, trans, pairs=True)
        gap = y - p
        grad = np.zeros(BUCKETS + 5)
        for rows, number in columns:
            grad[:BUCKETS] += np.bincount(number, gap[rows], BUCKETS)
        grad[BUCKETS] = gap.sum()
        grad[BUCKETS + 1 :] = seen - pairs - trans
        grad[:BUCKETS] -= 0.5 * theta[:BUCKETS]
        moment = 0.9 * moment + 0.1 * grad
        square = 0.99 * square + 0.01 * grad * grad
        move = 0.2 * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
        theta += move[: BUCKETS + 1]
        trans += move[BUCKETS + 1 :]
    return theta, trans


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression with a light penalty, by Newton steps."""
    x = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(x.shape[1])
    ridge = np.diag([1e-6] + [0.5] * (x.shape[1] - 1))
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge
        step = np.linalg.solve(h + 1e-9 * np.eye(len(beta)), x.T @ (weight * (y - p)) - ridge @ beta)
        beta += np.clip(step, -3, 3)
    return beta


def _scored(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field: Field | None = shared.value
        for batch in pieces(batches):
            texts = batch.column("text")
            flat, at, where = located_words(texts)
            ids, vocabulary = encoded(flat)
            n = batch.num_rows
            score, spans = np.full(n, 0.0), [[] for _ in range(n)]
            if field is not None:
                words = vocabulary.to_pylist()
                ends = np.fromiter((w.endswith(b".") for w in words), bool, len(words))
                features = _digests(words)
                parts = np.stack([field.theta[features[:, :4]].sum(axis=1), field.theta[features[:, 4]], field.theta[features[:, 5]]], axis=1) if words else np.zeros((0, 3))
                bounds = chains(ids, at, ends)
                p = marginals(_emission(parts, ids, bounds) + field.theta[BUCKETS], bounds, field.trans) if len(ids) else np.zeros(0)
                x = np.column_stack([np.ones(n), _summary(p, at) / field.scale])
                score = 1 / (1 + np.exp(-np.clip(x @ field.calibration, -30, 30)))
                hits = np.flatnonzero(p >= 0.5)
                if len(hits):
                    data, starts = text_bytes(texts)
                    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                    length = np.diff(np.frombuffer(flat.buffers()[1], np.int32))
                    row = np.searchsorted(at, hits, side="right") - 1
                    begin = points[where[hits]] - points[starts[row]]
                    stop = points[where[hits] + length[hits]] - points[starts[row]]
                    for r, a, b, m in zip(row.tolist(), begin.tolist(), stop.tolist(), p[hits].tolist(), strict=True):
                        spans[r].append({"begin": a, "end": b, "marginal": m})
            kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("marginal", pa.float64())]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(score), pa.array(spans, kind)], names=["doc_id", "score", "spans"])

    return run


def score_documents(docs: DataFrame, field: Field | None) -> DataFrame:
    """``doc_id, score, spans`` of every row; spans are the offending tokens in code points, end exclusive.

    The field tags chains, a sentence each whatever its length, over the whole text. The score is
    a calibrated function of the expected number of toxic tokens and of the largest marginal; the
    text is the only input. Null, empty and blank texts get the score of a text without toxic
    tokens. Without a field (labels of one kind only) every score is 0. Repeated rows are scored
    each; a null doc_id stays null; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)
    chosen = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(_scored(shared), "doc_id long, score double, spans array<struct<begin:long,end:long,marginal:double>>")
