"""Tracks from detections: boxes of following frames are joined where they overlap what a track's motion lets expect.

A clip's frames depend on one another, so a clip is one task's work, but only its live tracks are held: the frames
stream past in order, whatever their number.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


@dataclass(frozen=True)
class AssociationParams:
    """``high`` and ``low``: confidences of the first and of the second stage; ``start``: of a detection that begins a track; ``near`` and
    ``near_low``: least overlaps of the stages; ``max_missing``: frames that a track outlives unseen; ``smooth``: weight of
    the newest motion."""

    high: float = 0.5
    low: float = 0.1
    start: float = 0.5
    near: float = 0.3
    near_low: float = 0.5
    max_missing: int = 30
    smooth: float = 0.5


def overlap(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Intersection over union of every box of ``a`` with every one of ``b``."""
    low, high = np.maximum(a[:, None, :2], b[None, :, :2]), np.minimum(a[:, None, 2:], b[None, :, 2:])
    shared = np.prod(np.maximum(high - low, 0.0), axis=2)
    area = lambda x: np.prod(x[:, 2:] - x[:, :2], axis=1)
    whole = area(a)[:, None] + area(b)[None, :] - shared
    return np.where(whole > 0, shared / np.where(whole > 0, whole, 1.0), 0.0)


def pairs_of(values: np.ndarray, least: float) -> list[tuple[int, int]]:
    """One-to-one pairs (row, column) in descending value, the first row and then the first column of equals."""
    rows, columns = np.nonzero(values >= least)
    out, used_rows, used_columns = [], set(), set()
    for k in np.lexsort((columns, rows, -values[rows, columns])):
        r, c = int(rows[k]), int(columns[k])
        if r not in used_rows and c not in used_columns:
            used_rows.add(r)
            used_columns.add(c)
            out.append((r, c))
    return out


@dataclass
class Tracks:
    """The live tracks of a clip: their numbers, last boxes, motions a frame, and the frames they were last seen in."""

    p: AssociationParams
    number: list[int] = field(default_factory=list)
    box: list[np.ndarray] = field(default_factory=list)
    motion: list[np.ndarray] = field(default_factory=list)
    seen: list[int] = field(default_factory=list)
    made: int = 0

    def step(self, frame: int, conf: np.ndarray, boxes: np.ndarray) -> list[int | None]:
        """The track of each detection of a frame, None for those that are no track's."""
        alive = [k for k in range(len(self.number)) if frame - self.seen[k] <= self.p.max_missing + 1]
        for name in ("number", "box", "motion", "seen"):
            setattr(self, name, [getattr(self, name)[k] for k in alive])
        given: list[int | None] = [None] * len(conf)
        open_ = list(range(len(self.number)))
        stages = [(np.flatnonzero(conf >= self.p.high), self.p.near), (np.flatnonzero((conf >= self.p.low) & (conf < self.p.high)), self.p.near_low)]
        for own, least in stages:
            if not len(own) or not open_:
                continue
            expected = np.array([self.box[k] + self.motion[k] * (frame - self.seen[k]) for k in open_])
            taken = set()
            for r, c in pairs_of(overlap(expected, boxes[own]), least):
                k, d = open_[r], int(own[c])
                moved = (boxes[d] - self.box[k]) / max(1, frame - self.seen[k])
                self.motion[k] = (1 - self.p.smooth) * self.motion[k] + self.p.smooth * moved
                self.box[k], self.seen[k], given[d] = boxes[d], frame, self.number[k]
                taken.add(k)
            open_ = [k for k in open_ if k not in taken]
        for d in np.flatnonzero(conf >= self.p.start):
            if given[d] is None:
                self.number.append(self.made)
                self.box.append(boxes[d])
                self.motion.append(np.zeros(4))
                self.seen.append(frame)
                given[d], self.made = self.made, self.made + 1
        return given


BOX = ("x1", "y1", "x2", "y2")


def associated(detections: DataFrame, p: AssociationParams | None = None) -> DataFrame:
    """``clip, frame_no, det_idx, track`` of the detections (clip, frame_no, det_idx, conf, box) that belong to a track.

    In each frame, confident detections go to the tracks whose expected boxes they overlap most, then weak ones to the tracks left;
    confident ones left begin tracks, numbered from 0 in each clip. A track's expected box is its last one, moved on by its smoothed
    motion for as many frames as have passed. Frames without detections need no rows. Detections with nulls are left out.
    """
    params = p or AssociationParams()
    kind = f"clip {dict(detections.dtypes)['clip']}, frame_no long, det_idx long, track long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tracks, at, held = None, None, []

        def done() -> list[tuple]:
            found = tracks.step(at[1], np.array([h[1] for h in held]), np.array([h[2:] for h in held]))
            return [(*at, h[0], t) for h, t in zip(held, found, strict=True) if t is not None]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = [pa.array(c, clip_type if k == 0 else pa.int64()) for k, c in enumerate(zip(*rows, strict=True))]
            return pa.RecordBatch.from_arrays(columns, names=["clip", "frame_no", "det_idx", "track"])

        for batch in batches:
            out, clip_type = [], batch.schema.field("clip").type
            for clip, frame, *row in zip(*(batch.column(c).to_pylist() for c in ("clip", "frame_no", "det_idx", "conf", *BOX)), strict=True):
                if at != (clip, frame):
                    if held:
                        out += done()
                    if at is None or at[0] != clip:
                        tracks = Tracks(params)
                    at, held = (clip, frame), []
                held.append(row)
            if out:
                yield batch_of(out)
        if held and (out := done()):
            yield batch_of(out)

    own = detections.select("clip", *(detections[c].cast("bigint").alias(c) for c in ("frame_no", "det_idx")), *(detections[c].cast("double").alias(c) for c in ("conf", *BOX))).dropna()
    return own.repartition("clip").sortWithinPartitions("clip", "frame_no", "det_idx").mapInArrow(run, kind)
