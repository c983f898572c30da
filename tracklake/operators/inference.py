"""Where models come in: detectors on images and trackers on clips are the caller's, the tables are ours."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from tracklake.operators.annotations import taxonomy_detections
from tracklake.operators.association import BOX, AssociationParams, Tracks
from tracklake.operators.evaluate import suppress

DETECTION = "image string, det_idx int, cls int, conf double, x1 double, y1 double, x2 double, y2 double"
Detector = Callable[[list[bytes]], list[list[tuple]]]


def detect(images: DataFrame, load: Callable[[], Detector], least: float = 0.01, batch: int = 16) -> DataFrame:
    """Raw detections of ``images`` (path, content), ``det_idx`` numbered within the image.

    ``load`` is called once a task and gives a function from contents to one list of (cls, conf, x1, y1, x2, y2)
    for each; it gets ``batch`` images at a time. Detections below ``least`` are left out.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for frame in frames:
            for first in range(0, len(frame), batch):
                part = frame.iloc[first : first + batch]
                rows = []
                for path, found in zip(part["path"], model([bytes(x) for x in part["content"]]), strict=True):
                    rows += [(path, i, *d) for i, d in enumerate(x for x in found if x[1] >= least)]
                yield pd.DataFrame(rows, columns=["image", "det_idx", "cls", "conf", "x1", "y1", "x2", "y2"])

    return images.select("path", "content").mapInPandas(run, DETECTION)


def predictions(images: DataFrame, load: Callable[[], Detector], model_names: DataFrame, taxonomy: DataFrame, least: float = 0.01, iou_thr: float = 0.6, batch: int = 16) -> DataFrame:
    """Detections in classes of the taxonomy, after class-wise suppression; other classes are left out first."""
    return suppress(taxonomy_detections(detect(images, load, least, batch), model_names, taxonomy), iou_thr)


def frame_objects(images: DataFrame, load: Callable[[], Detector], model_names: DataFrame, taxonomy: DataFrame, least: float = 0.25, batch: int = 16) -> DataFrame:
    """Objects of single frames: detections in classes of the taxonomy, as the model gives them, without suppression."""
    return taxonomy_detections(detect(images, load, least, batch), model_names, taxonomy)


def track_people(frames: DataFrame, start: Callable[[], Callable[[int, bytes], list[dict]]], schema: str) -> DataFrame:
    """People of each frame by a tracker with memory: ``frames`` (clip, frame_no, content) of one clip go through one
    tracker in order. ``start`` makes a new one for each clip, so numbers begin anew; it maps a frame to rows
    of ``schema`` without clip and frame_no, which are added in front. A clip is one task's work, since its tracker has a memory;
    its frames stream past in batches.
    """
    names = [c.strip().split(" ")[0] for c in schema.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        clip = tracker = None
        for batch in batches:
            out = []
            for own, number, content in batch.itertuples(index=False):
                if tracker is None or own != clip:
                    clip, tracker = own, start()
                out += [{"clip": own, "frame_no": number, **person} for person in tracker(int(number), bytes(content))]
            yield pd.DataFrame(out, columns=["clip", "frame_no", *names])

    ordered = frames.select("clip", F.col("frame_no").cast("long").alias("frame_no"), "content").repartition("clip").sortWithinPartitions("clip", "frame_no")
    return ordered.mapInPandas(run, f"clip {dict(frames.dtypes)['clip']}, frame_no long, {schema}")


def register_detector(spark: SparkSession, name: str, load: Callable[[], Detector], least: float = 0.01) -> None:
    """``detect`` for SQL: ``FROM images, LATERAL name(content)`` gives det_idx, cls, conf and the box of each detection."""

    class Detect:
        def __init__(self) -> None:
            self.model = load()

        def eval(self, content: bytes) -> Iterator[tuple]:
            found = self.model([bytes(content)])[0] if content is not None else []
            yield from ((i, *d) for i, d in enumerate(x for x in found if x[1] >= least))

    spark.udtf.register(name, udtf(Detect, returnType="det_idx int, cls int, conf double, x1 double, y1 double, x2 double, y2 double"))


def register_people(spark: SparkSession, name: str, start: Callable[[], Callable[[int, bytes], list[dict]]], schema: str) -> None:
    """``track_people`` for SQL: ``FROM name(TABLE(frames) PARTITION BY clip ORDER BY frame_no)``."""
    names = [c.strip().split(" ")[0] for c in schema.split(",")]

    class People:
        def __init__(self) -> None:
            self.tracker = start()

        def eval(self, row: Row) -> Iterator[tuple]:
            for person in self.tracker(int(row["frame_no"]), bytes(row["content"])):
                yield (row["clip"], row["frame_no"], *(person.get(n) for n in names))

    spark.udtf.register(name, udtf(People, returnType=f"clip string, frame_no long, {schema}"))


def register_association(spark: SparkSession, name: str = "track_boxes", p: AssociationParams | None = None) -> None:
    """``associated`` for SQL: ``FROM name(TABLE(detections) PARTITION BY clip ORDER BY (frame_no, det_idx))``. A clip's
    rows pass one by one; those of the current frame are held."""
    params = p or AssociationParams()

    class Associate:
        def __init__(self) -> None:
            self.tracks, self.clip, self.frame, self.held = Tracks(params), None, None, []

        def flush(self) -> Iterator[tuple]:
            if self.held:
                found = self.tracks.step(self.frame, np.array([h[1] for h in self.held]), np.array([h[2:] for h in self.held]))
                yield from ((self.clip, self.frame, h[0], t) for h, t in zip(self.held, found, strict=True) if t is not None)
            self.held = []

        def eval(self, row: Row) -> Iterator[tuple]:
            own = [row[c] for c in ("clip", "frame_no", "det_idx", "conf", *BOX)]
            if None in own:
                return
            if self.frame != own[1]:
                yield from self.flush()
                self.clip, self.frame = str(own[0]), int(own[1])
            self.held.append([int(own[2]), *map(float, own[3:])])

        def terminate(self) -> Iterator[tuple]:
            yield from self.flush()

    spark.udtf.register(name, udtf(Associate, returnType="clip string, frame_no long, det_idx long, track long"))
