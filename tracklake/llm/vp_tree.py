"""SimHash near duplicates by vantage-point trees over Hamming distance.

Fingerprints, each once, are dealt to the shards of a tree: a node holds a vantage point and a radius, nearer
fingerprints go left. By the triangle inequality what links with a fingerprint within ``DISTANCE`` can lie on
the other side only if the fingerprint's own distance is that close to the radius, so it also visits the shards that its ball
reaches into and no others. Within a shard the same split goes on, down to blocks that are compared
whole. A shard returns the edges of a spanning forest of what it linked, not its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklake.llm._lookup import lookup
from tracklake.llm._text import pieces
from tracklake.operators.graph import connected_components
from tracklake.storage import discard, materialize

DISTANCE = 2
SHARD = 16_384  # fingerprints at home in a shard
BLOCK = 512
SAMPLE = 65_536
CHUNK = 1 << 16
SEED = 42


def fingerprint(text: bytes, width: int = 3) -> int:
    """The SimHash of a text's shingles, repeats included: a bit is 1 if it is set in over half of their hashes.
    A text with fewer words than ``width`` is one shingle; one without words has 0."""
    words = text.lower().split()  # of bytes: A-Z alone, and \\x20\\x09-\\x0D alone
    if not words:
        return 0
    line, length = b" ".join(words), np.fromiter(map(len, words), np.int64, len(words))
    starts = np.concatenate([[0], np.cumsum(length + 1)[:-1]])
    width = min(width, len(words))
    ends = (starts + length)[width - 1 :]
    starts = starts[: len(ends)]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), CHUNK):
        h = np.array([xxhash.xxh64_intdigest(line[a:b], SEED) for a, b in zip(starts[at : at + CHUNK].tolist(), ends[at : at + CHUNK].tolist(), strict=True)], np.uint64)
        ones += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches):
        texts = batch.column("text").cast(pa.binary())
        marks = np.array([fingerprint(t.as_py() or b"") for t in texts], np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(marks.view(np.int64))], names=["doc_id", "mark"])


@dataclass
class Tree:
    """Nodes as lists; a child below zero is the shard -1 - child."""

    point: list[int] = field(default_factory=list)
    radius: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    root: int = -1
    shards: int = 1

    def grow(self, shard: int, sample: np.ndarray, target: int) -> bool:
        """Split a shard by a sample of it until ``target`` of the sample are left in each part; False if it cannot be split."""
        spot = next(((side, i) for side in (self.left, self.right) for i, child in enumerate(side) if child == -1 - shard), None)
        made = self._grown(sample, target, shard)
        if made < 0:
            return False
        if spot is None:
            self.root = made
        else:
            spot[0][spot[1]] = made
        return True

    def _grown(self, sample: np.ndarray, target: int, shard: int | None) -> int:
        cut = vantage(sample) if len(sample) > target else None
        if cut is None:
            if shard is None:
                shard, self.shards = self.shards, self.shards + 1
            return -1 - shard
        point, radius = cut
        inner = distance(sample, point) <= radius
        left = self._grown(sample[inner], target, shard)
        right = self._grown(sample[~inner], target, None)
        self.point.append(point)
        self.radius.append(radius)
        self.left.append(left)
        self.right.append(right)
        return len(self.point) - 1

    def reached(self, marks: np.ndarray, ball: int) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and the shards that balls of this radius reach; radius 0: the shard at home."""
        rows, shards, open_ = [], [], [(self.root, np.arange(len(marks)))]
        while open_:
            node, at = open_.pop()
            if not len(at):
                continue
            if node < 0:
                rows.append(at)
                shards.append(np.full(len(at), -1 - node))
                continue
            d = distance(marks[at], self.point[node])
            open_.append((self.left[node], at[d <= self.radius[node] + ball]))
            open_.append((self.right[node], at[d > self.radius[node] - ball]))
        return (np.concatenate(rows), np.concatenate(shards)) if rows else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def distance(marks: np.ndarray, point: int) -> np.ndarray:
    return np.bitwise_count(marks ^ np.uint64(point)).astype(np.int16)


def vantage(marks: np.ndarray, tries: int = 8) -> tuple[int, int] | None:
    """Of some points and of the radii that leave a quarter or more on each side, those whose boundary the fewest
    marks come near; of a point without such a radius, the most even one. None if no radius of any tried point parts the marks."""
    best = None
    for i in np.linspace(0, len(marks) - 1, min(tries, len(marks))).astype(int):
        inside = np.cumsum(np.bincount(distance(marks, int(marks[i])), minlength=65))
        for radius in range(64):
            part = min(inside[radius], len(marks) - inside[radius])
            if part == 0:
                continue
            near = inside[min(64, radius + DISTANCE)] - (inside[radius - DISTANCE] if radius >= DISTANCE else 0)
            rank = (0, near) if 4 * part >= len(marks) else (1, -part)
            if best is None or rank < best[0]:
                best = (rank, int(marks[i]), radius)
    return best and best[1:]


def forest(home: np.ndarray, guests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The edges (guest, root) of a forest that joins what is linked between ``home`` and ``guests``; ``home`` are among the guests."""
    order = np.argsort(guests)
    guests = guests[order]
    root = np.arange(len(guests))
    open_ = [(np.searchsorted(guests, home), np.arange(len(guests)))]
    while open_:
        a, b = open_.pop()
        if not len(a) or not len(b):
            continue
        cut = vantage(guests[a]) if len(a) > BLOCK else None
        if cut is None:
            for i in range(0, len(a), BLOCK):
                for j in range(0, len(b), 8 * BLOCK):
                    x, y = a[i : i + BLOCK], b[j : j + 8 * BLOCK]
                    p, q = np.nonzero(np.bitwise_count(guests[x][:, None] ^ guests[y][None, :]) <= DISTANCE)
                    root = _joined(root, x[p], y[q])
            continue
        point, radius = cut
        da, db = distance(guests[a], point), distance(guests[b], point)
        open_.append((a[da <= radius], b[db <= radius + DISTANCE]))
        open_.append((a[da > radius], b[db > radius - DISTANCE]))
    moved = np.flatnonzero(root != np.arange(len(root)))
    return guests[moved], guests[root[moved]]


def _joined(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Roots after the further edges: greater roots hook to smaller ones, and paths are halved until flat."""
    while True:
        x, y = root[a], root[b]
        differ = x != y
        if not differ.any():
            return root
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]


def fitted(marks: DataFrame, shard: int = SHARD, sample: int = SAMPLE) -> Tree:
    """A tree whose shards hold about ``shard`` of the distinct ``marks`` each. The first one is fitted on about ``sample`` marks
    drawn by hash; shards that are still too full, by counts of all marks, are split again by as large a sample of them."""
    tree, total = Tree(), marks.count()
    share = min(1.0, sample / max(1, total))
    picked = sorted(r.mark for r in marks.where(_drawn(F.lit(0), F.lit(share))).select("mark").collect())
    tree.grow(0, np.array(picked, np.int64).view(np.uint64), max(8, int(shard * share)))
    stuck: set[int] = set()
    while total > len(picked):
        sizes = dealt(marks, tree, 0).groupBy("shard").count().where(F.col("count") > 2 * shard).collect()
        full = {r.shard: r["count"] for r in sizes if r.shard not in stuck}
        if not full:
            break
        each = sample // len(full) + 64
        home = dealt(marks, tree, 0).join(F.broadcast(marks.sparkSession.createDataFrame([(s, each / n) for s, n in full.items()], "shard int, share double")), "shard")
        drawn: dict[int, list[int]] = {s: [] for s in full}
        for r in home.where(_drawn(F.lit(len(tree.point)), F.col("share"))).select("shard", "mark").collect():
            drawn[r.shard].append(r.mark)
        for s, n in full.items():
            own = np.array(sorted(drawn[s]), np.int64).view(np.uint64)
            if len(own) < 16 or not tree.grow(s, own, max(8, shard * len(own) // n)):
                stuck.add(s)
    return tree


def _drawn(turn: Column, share: Column) -> Column:
    return F.pmod(F.xxhash64("mark", turn), F.lit(1 << 30)) < share * (1 << 30)


def dealt(marks: DataFrame, tree: Tree, ball: int) -> DataFrame:
    """``(shard, mark, home)``: the shards that each mark's ball reaches, and whether it is at home there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("mark").to_numpy(zero_copy_only=False).view(np.uint64)
            rows, shards = tree.reached(own, ball)
            at_home = np.empty(len(own), np.int64)
            where, home = tree.reached(own, 0)
            at_home[where] = home
            yield pa.RecordBatch.from_arrays([pa.array(shards.astype(np.int32)), pa.array(own[rows].view(np.int64)), pa.array(at_home[rows] == shards)], names=["shard", "mark", "home"])

    return marks.select("mark").mapInArrow(run, "shard int, mark long, home boolean")


def _linked(table: pa.Table) -> pa.Table:
    marks = table.column("mark").to_numpy().view(np.uint64)
    a, b = forest(marks[table.column("home").to_numpy()], marks)
    return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})


def simhash_groups(documents: DataFrame, shard: int = SHARD) -> DataFrame:
    """``doc_id, mark, component_id`` for each row of ``documents`` (doc_id, text): the 64 bits of its fingerprint as a signed number, and
    the smallest doc_id of those it is linked with, directly or through others, itself included.

    Fingerprints are linked if at most ``DISTANCE`` bits differ. Null texts are empty; texts without words have
    fingerprint 0 and are linked like any other. Rows without doc_id are in their groups but name none: a group
    of such rows only has a null component. Repeated rows are repeated; other columns are ignored.
    """
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    marked = materialize(docs.mapInArrow(_fingerprints, "doc_id long, mark long"), "fingerprints")
    classes = materialize(marked.groupBy("mark").agg(F.min("doc_id").alias("least")), "classes")
    tree = fitted(classes.select("mark"), shard)
    edges = materialize(dealt(classes, tree, DISTANCE).groupBy("shard").applyInArrow(_linked, "a long, b long"), "links")
    found = connected_components(edges, "a", "b")
    named = classes.join(found.withColumnRenamed("node", "mark"), "mark", "left").withColumn("component", F.coalesce("component", "mark"))
    groups = named.groupBy("component").agg(F.min("least").alias("component_id"))
    of = materialize(named.join(groups, "component").select("mark", "component_id"), "groups")
    rows, hot = lookup(marked, of, ["mark"])
    out = materialize(rows.select("doc_id", "mark", "component_id"), "simhash-groups")
    discard(marked, classes, edges, found, of, hot)
    return out
