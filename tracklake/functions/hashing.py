"""Perceptual hashes of images and of their mirror images."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SIDE, KEPT = 32, 8  # size of the reduced image, and of the corner of its cosine transform (fixed values)


def _cosines() -> np.ndarray:
    k = np.arange(SIDE)
    return np.cos(np.pi * k[:, None] * (2 * k[None, :] + 1) / (2 * SIDE))


def reduced(grey: np.ndarray) -> np.ndarray:
    """Means over SIDE by SIDE cells of nearly equal size; smaller images repeat pixels."""
    for axis in (0, 1):
        n = grey.shape[axis]
        if n < SIDE:
            grey = np.take(grey, np.arange(SIDE) * n // SIDE, axis=axis)
        else:
            cuts = np.arange(SIDE) * n // SIDE
            size = np.diff(np.append(cuts, n))
            grey = np.add.reduceat(grey, cuts, axis=axis) / (size[:, None] if axis == 0 else size[None, :])
    return grey


def perceptual_hash(grey: np.ndarray) -> int:
    """64 bits, row by row: which low frequencies of the reduced image lie above their median."""
    c = _cosines()[:KEPT]
    low = (c @ reduced(grey.astype(float)) @ c.T).ravel()
    return int("".join("1" if x else "0" for x in low > np.median(low)), 2)


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def grey_image(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """Brightness of an image as Spark's image source has it: rows of blue, green, red (and alpha)."""
    pixels = np.frombuffer(data, np.uint8).reshape(height, width, channels).astype(float)
    return pixels[:, :, 0] if channels == 1 else pixels[:, :, :3] @ np.array([0.114, 0.587, 0.299])


def orientation(content: bytes) -> int:
    """How an image file says that its pixels are turned: 1 to 8, 1 where it does not say. JPEG and PNG.

    The tag 0x0112 of the first directory of the file's EXIF block (fixed values).
    """
    block = None
    if content[:2] == b"\xff\xd8":
        at = 2
        while block is None and at + 4 <= len(content) and content[at] == 0xFF and content[at + 1] not in (0xDA, 0xD9):
            size = int.from_bytes(content[at + 2 : at + 4], "big")
            if content[at + 1] == 0xE1 and content[at + 4 : at + 10] == b"Exif\0\0":
                block = content[at + 10 : at + 2 + size]
            at += 2 + size
    elif content[:8] == b"\x89PNG\r\n\x1a\n":
        at = 8
        while block is None and at + 8 <= len(content):
            size = int.from_bytes(content[at : at + 4], "big")
            if content[at + 4 : at + 8] == b"eXIf":
                block = content[at + 8 : at + 8 + size]
            at += 12 + size
    if block is None or block[:2] not in (b"II", b"MM"):
        return 1
    order = "little" if block[:2] == b"II" else "big"
    number = lambda at, n: int.from_bytes(block[at : at + n], order)
    first = number(4, 4)
    for entry in range(first + 2, first + 2 + 12 * number(first, 2), 12):
        if number(entry, 2) == 0x0112:
            value = number(entry + 8, 2)
            return value if 1 <= value <= 8 else 1
    return 1


def upright(grey: np.ndarray, turned: int) -> np.ndarray:
    """The pixels as they are meant to be seen: orientations 5 to 8 swap the axes, then rows and columns may be reversed."""
    grey = grey.T if turned >= 5 else grey
    grey = grey[::-1] if turned in (3, 4, 7, 8) else grey
    return grey[:, ::-1] if turned in (2, 3, 6, 7) else grey


def orientations(spark: SparkSession, folder: str) -> DataFrame:
    """``path, turned`` of the image files below a folder that are not upright."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"path": batch["path"], "turned": [orientation(bytes(c)) for c in batch["content"]]})

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.select("path", "content").mapInPandas(run, "path string, turned int").where("turned > 1")


def image_hashes(images: DataFrame, turned: DataFrame | None = None) -> DataFrame:
    """``path, h, mirror`` from the rows of ``spark.read.format("image")``; unreadable images have null hashes. Images of which
    ``orientations`` says that they are turned are set upright first."""
    rows = images.select("image.*")
    if turned is not None:
        one_slash = lambda c: F.regexp_replace(c, "^(\\w+):/+", "$1:/")
        named = turned.select(one_slash(F.col("path")).alias("_path"), "turned")
        rows = rows.join(named, one_slash(F.col("origin")) == F.col("_path"), "left").drop("_path")
    else:
        rows = rows.withColumn("turned", F.lit(1))
    rows = rows.withColumn("turned", F.coalesce("turned", F.lit(1)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for path, data, h, w, c, t in zip(batch["origin"], batch["data"], batch["height"], batch["width"], batch["nChannels"], batch["turned"], strict=True):
                if data is None or h <= 0 or w <= 0:
                    out.append((path, None, None))
                else:
                    grey = upright(grey_image(data, h, w, c), int(t))
                    out.append((path, _signed(perceptual_hash(grey)), _signed(perceptual_hash(grey[:, ::-1]))))
            yield pd.DataFrame(out, columns=["path", "h", "mirror"]).astype({"h": "Int64", "mirror": "Int64"})

    return rows.select("origin", "data", "height", "width", "nChannels", "turned").mapInPandas(run, "path string, h long, mirror long")
