"""A temporal convolution net on windows of features, trained on Spark: tasks sum gradients, the driver moves the parameters.

Three dilated convolutions of five steps each, rectified, then mean and maximum over time and one linear output. Batch
normalisation, whose statistics would need a pass for each layer, is left out: values are standardised ahead, and
weights start at a scale that keeps variances.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracklake.operators.learning import auroc, balance, f1
from tracklake.storage import discard, materialize

TAPS, DILATIONS, FLOOR, MOST = 5, (1, 2, 4), 0.05, 10.0
SEEN_ONLY = ("d_min_delta", "present")  # features that are 0 at unseen steps, as objects are
SUMMING_TASKS = 8
CHUNK = 64  # windows that go through the net at once, so that their layers stay in a core's cache


@dataclass(frozen=True)
class Net:
    """Weights as one vector, the moments of the features, and the shape of a window; ``np.savez`` of its fields is the checkpoint."""

    theta: np.ndarray
    mean: np.ndarray
    std: np.ndarray
    window: int
    hidden: int

    def layers(self, theta: np.ndarray | None = None) -> list[np.ndarray]:
        """Views into ``theta``: weights and offsets of each convolution, then of the output."""
        theta, width, at, out = self.theta if theta is None else theta, len(self.mean), 0, []
        for shape in [s for c in (width, self.hidden, self.hidden) for s in ((TAPS * c, self.hidden), (self.hidden,))] + [(2 * self.hidden,), (1,)]:
            n = int(np.prod(shape))
            out.append(theta[at : at + n].reshape(shape))
            at += n
        return out


def size_of(features: int, hidden: int) -> int:
    return sum(TAPS * c * hidden + hidden for c in (features, hidden, hidden)) + 2 * hidden + 1


def started(features: int, window: int, hidden: int, seed: int, mean: np.ndarray | None = None, std: np.ndarray | None = None) -> Net:
    net = Net(np.zeros(size_of(features, hidden)), np.zeros(features) if mean is None else mean, np.ones(features) if std is None else std, window, hidden)
    rnd = np.random.RandomState(seed)
    for w in net.layers()[::2]:
        w[...] = rnd.randn(*w.shape) * np.sqrt(2.0 / w.shape[0])
    return net


def _reaches(dilation: int, time: int) -> list[tuple[slice, slice]]:
    """For each tap, the steps it is used at and, beside them, the steps it reads there; beyond the ends are zeros."""
    offsets = [(k - TAPS // 2) * dilation for k in range(TAPS)]
    return [(slice(max(0, -o), max(0, time - max(0, o))), slice(max(0, o), max(0, time + min(0, o)))) for o in offsets]


def _taps(x: np.ndarray, dilation: int) -> np.ndarray:
    """(taps x channels, time, windows): each step beside its neighbours. With windows last, shifts in time are copies of whole stretches."""
    channels, time, n = x.shape
    taps = np.zeros((TAPS, channels, time, n))
    for tap, (at, of) in zip(taps, _reaches(dilation, time), strict=True):
        tap[:, at] = x[:, of]
    return taps.reshape(TAPS * channels, time, n)


def _untaps(d: np.ndarray, dilation: int, channels: int) -> np.ndarray:
    out = np.zeros((channels, *d.shape[1:]))
    for tap, (at, of) in zip(d.reshape(TAPS, channels, *d.shape[1:]), _reaches(dilation, d.shape[1]), strict=True):
        out[:, of] += tap[:, at]
    return out


def _forward(layers: list[np.ndarray], x: np.ndarray, keep: np.ndarray | None) -> tuple[np.ndarray, list]:
    held, h = [], np.ascontiguousarray(x.transpose(2, 1, 0))
    _, time, n = h.shape
    for k, dilation in enumerate(DILATIONS):
        taps = _taps(h, dilation).reshape(-1, time * n)
        h = layers[2 * k].T @ taps
        h += layers[2 * k + 1][:, None]
        h = np.maximum(h, 0.0, out=h).reshape(-1, time, n)
        held.append((taps, h))
    if keep is not None:
        h = h * keep.T[:, None]
    top = h.argmax(axis=1)
    pooled = np.concatenate([h.mean(axis=1), np.take_along_axis(h, top[:, None], axis=1)[:, 0]])
    return layers[6] @ pooled + layers[7][0], [*held, (top, pooled)]


def _chunks(n: int) -> list[slice]:
    return [slice(a, a + CHUNK) for a in range(0, n, CHUNK)]


def logits(net: Net, x: np.ndarray, keep: np.ndarray | None = None) -> np.ndarray:
    """Outputs of windows (n, time, features). ``keep`` scales the last layer's channels."""
    layers = net.layers()
    return np.concatenate([np.zeros(0), *(_forward(layers, x[c], None if keep is None else keep[c])[0] for c in _chunks(len(x)))])


def gradient(net: Net, x: np.ndarray, y: np.ndarray, weight: float, keep: np.ndarray | None = None) -> tuple[float, np.ndarray]:
    """The summed cross entropy of windows, positives counted ``weight`` times, and its gradient."""
    loss, grad = 0.0, np.zeros_like(net.theta)
    layers, parts = net.layers(), net.layers(grad)
    for c in _chunks(len(x)):
        loss += _backward(layers, parts, x[c], y[c], weight, None if keep is None else keep[c])
    return loss, grad


def _backward(layers: list[np.ndarray], parts: list[np.ndarray], x: np.ndarray, y: np.ndarray, weight: float, keep: np.ndarray | None) -> float:
    """The loss of a few windows; their gradient is added to ``parts``."""
    out, held = _forward(layers, x, keep)
    top, pooled = held[-1]
    w = np.where(y > 0, weight, 1.0)
    d = w * (1 / (1 + np.exp(-out)) - y)
    parts[6] += pooled @ d
    parts[7] += d.sum()
    pool = layers[6][:, None] * d
    h, (n, time) = len(pool) // 2, x.shape[:2]
    dh = np.repeat(pool[:h, None] / time, time, axis=1)
    dh[np.arange(h)[:, None], top, np.arange(n)] += pool[h:]
    if keep is not None:
        dh *= keep.T[:, None]
    for k in (2, 1, 0):
        taps, value = held[k]
        dh = (dh * (value > 0)).reshape(h, time * n)
        parts[2 * k] += taps @ dh.T
        parts[2 * k + 1] += dh.sum(axis=1)
        if k:
            dh = _untaps((layers[2 * k] @ dh).reshape(-1, time, n), DILATIONS[k], h)
    return float((w * (np.logaddexp(0.0, out) - y * out)).sum())


def window_rows(seen: DataFrame, keys: list[str], features: list[str], window: int, hop: int) -> DataFrame:
    """``keys, start, x`` of each window of ``sliding_windows``: the features of its places one after the other in one array.

    ``seen`` are the features of the seen steps alone. The unseen ones behind a step repeat it, but for ``SEEN_ONLY`` and objects,
    which are 0 there; so a step and those behind it are one run, runs meet in windows, and only these hold all places. A short
    sequence is padded by its first step.
    """
    every, order = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy("step")
    first, last = F.min("step").over(every), F.max("step").over(every)
    fades = {f for f in features if f in SEEN_ONLY or f.startswith("obj_")}
    value = lambda faded: F.array(*(F.lit(0.0) if faded and f in fades else F.col(f).cast("double") for f in features))
    runs = seen.select(*keys, value(False).alias("own"), value(True).alias("after"), (F.col("step") - first).alias("at"), (F.coalesce(F.lead("step").over(order), last + 1) - first).alias("until"), (last - first + 1).alias("n"))
    pad, end = F.greatest(window - F.col("n"), F.lit(0)), F.greatest(F.col("n") - window, F.lit(0))
    low, high, shown = F.when(F.col("at") == 0, 0).otherwise(F.col("at") + pad), F.col("until") + pad, F.col("at") + pad + 1  # ``own`` up to ``shown``, ``after`` from there
    runs = runs.select(*keys, "own", "after", low.alias("low"), high.alias("high"), shown.alias("shown"), end.alias("end"))
    least = F.greatest(F.floor((F.col("low") - window) / hop) + 1, F.lit(0)) * hop
    most = F.least("end", F.col("high") - 1)
    starts = F.when(least <= most, F.sequence(least, most, F.lit(hop).cast("bigint"))).otherwise(F.array().cast("array<bigint>"))
    flush = (F.col("end") % hop != 0) & F.col("end").between(F.col("low") - window + 1, F.col("high") - 1)
    met = runs.withColumn("start", F.explode(F.concat(starts, F.when(flush, F.array("end")).otherwise(F.array().cast("array<bigint>")))))
    a, b = F.greatest("low", "start"), F.least("high", F.col("start") + window)
    n_own = F.least(F.greatest(F.col("shown") - a, F.lit(0)), b - a)
    met = met.select(*keys, "start", F.struct(a.alias("a"), n_own.cast("int").alias("n_own"), (b - a - n_own).cast("int").alias("n_after"), "own", "after").alias("run"))
    places = F.transform(F.array_sort(F.collect_list("run")), lambda r: F.concat(F.array_repeat(r["own"], r["n_own"]), F.array_repeat(r["after"], r["n_after"])))
    return met.groupBy(*keys, "start").agg(F.flatten(F.flatten(places)).alias("x"))


def in_buckets(windows: DataFrame, batches: int, seed: int = 0) -> DataFrame:
    return windows.withColumn("bucket", F.pmod(F.xxhash64("x", F.lit(seed)), F.lit(batches)).cast("int"))


def _windows(batch: pa.RecordBatch, net: Net) -> np.ndarray:
    x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, net.window, len(net.mean))
    return np.clip((x - net.mean) / net.std, -MOST, MOST)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for n, loss, grad in zip(batch.column("n").to_pylist(), batch.column("loss").to_pylist(), batch.column("grad"), strict=True):
            own = np.frombuffer(grad.as_py())
            total = (n, loss, own.copy()) if total is None else (total[0] + n, total[1] + loss, total[2] + own)
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total[0]]), pa.array([total[1]]), pa.array([total[2].tobytes()])], names=["n", "loss", "grad"])


def step_gradient(rows: DataFrame, net: Net, weight: float, noise: float, dropout: float, seed: int) -> tuple[int, float, np.ndarray]:
    """Windows, loss and gradient over ``rows`` (x, label): a sum in each task, then in ``SUMMING_TASKS`` tasks, whose sums the driver adds.
    Noise and dropout depend on the seed and the task, so a task that runs again draws the same."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rnd = np.random.default_rng([seed, TaskContext.get().partitionId()])
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = _windows(batch, net), batch.column("label").cast(pa.int8()).to_numpy().astype(float)
            keep = (rnd.random((len(x), net.hidden)) >= dropout) / (1 - dropout)
            loss, grad = gradient(net, x + noise * rnd.standard_normal(x.shape), y, weight, keep)
            yield pa.RecordBatch.from_arrays([pa.array([len(x)]), pa.array([loss]), pa.array([grad.tobytes()])], names=["n", "loss", "grad"])

    kind = "n long, loss double, grad binary"
    own = rows.select("x", "label").mapInArrow(run, kind).mapInArrow(_summed, kind)
    n, loss, grad = 0, 0.0, np.zeros_like(net.theta)
    for r in own.repartition(SUMMING_TASKS).mapInArrow(_summed, kind).collect():
        n, loss, grad = n + r.n, loss + r.loss, grad + np.frombuffer(r.grad)
    return n, loss, grad


def scored(net: Net, rows: DataFrame) -> DataFrame:
    """``rows`` (x, ...) with ``score``, the probability of a positive, in place of ``x``."""
    others = [c for c in rows.columns if c != "x"]
    kind = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes if c != "x") + ", score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                score = 1 / (1 + np.exp(-logits(net, _windows(batch, net))))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), pa.array(score)], names=[*others, "score"])

    return rows.mapInArrow(run, kind)


def fit_net(train: DataFrame, val: DataFrame, features: int, window: int, hidden: int = 64, epochs: int = 40, batches: int = 8, rate: float = 1e-3, decay: float = 1e-4, noise: float = 0.02, dropout: float = 0.2, seed: int = 0) -> tuple[Net, float, list[float]]:
    """A net on windows (x, label); the net, its AUROC on ``val``, and the mean loss of each epoch.

    An epoch takes ``batches`` steps of AdamW, each on the windows of one hash bucket; the rate falls along a cosine over the epochs. The snapshot of
    the epoch with the best AUROC on ``val`` is kept (with one class in ``val``, the best F1). Training windows are written in a
    folder for each bucket, without being moved, so a step reads its own in many tasks; with a column ``bucket`` (``in_buckets``, written by it)
    they are not written again. What reaches the driver in a step is ``SUMMING_TASKS`` vectors of the size of the net.
    """
    flat = train.select(F.posexplode("x").alias("i", "v")).groupBy((F.col("i") % features).alias("f")).agg(F.avg("v").alias("m"), F.stddev_pop("v").alias("s"))
    moments = sorted(flat.collect())
    net = started(features, window, hidden, seed, np.array([r.m for r in moments]), np.maximum([r.s for r in moments], FLOOR))
    weight = float(balance(train).first().pos_weight)
    held = train if "bucket" in train.columns else materialize(in_buckets(train.select("x", "label"), batches, seed), "windows", by=["bucket"])
    first, second, taken = np.zeros_like(net.theta), np.zeros_like(net.theta), 0
    best, losses = (net, -1.0), []
    for epoch in range(epochs):
        now, total, seen = rate * 0.5 * (1 + np.cos(np.pi * epoch / epochs)), 0.0, 0
        for b in range(batches):
            n, loss, grad = step_gradient(held.where(F.pmod(F.col("bucket"), F.lit(batches)) == b), net, weight, noise, dropout, seed * 1_000_003 + epoch * batches + b)
            if not n:
                continue
            taken, seen, total, grad = taken + 1, seen + n, total + loss, grad / n
            first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad * grad
            move = first / (1 - 0.9**taken) / (np.sqrt(second / (1 - 0.999**taken)) + 1e-8)
            net = replace(net, theta=net.theta - now * (move + decay * net.theta))
        losses.append(total / max(1, seen))
        judged = scored(net, val.select("label", "x"))
        area = auroc(judged).first().auroc
        area = f1(judged).first().f1 if area is None else area
        if area > best[1]:
            best = (net, float(area))
    discard(held if held is not train else None)
    return *best, losses
