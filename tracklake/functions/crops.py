"""Cut-outs of images as PNG, for looking at samples of an audit."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


def png(pixels: np.ndarray) -> bytes:
    """An image of 8 bits a channel, rows of red, green, blue, as PNG."""
    height, width, _ = pixels.shape
    part = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    lines = np.concatenate([np.zeros((height, 1), np.uint8), pixels.reshape(height, width * 3)], axis=1).tobytes()
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + part(b"IDAT", zlib.compress(lines)) + part(b"IEND", b"")


def crop_images(images: DataFrame, crops: DataFrame) -> DataFrame:
    """``path, name, png``: the cut-outs ``crops`` (path, name, crop: x1..y2 in pixels) of images as the image source reads
    them, with ``path`` as in ``sources.files``. Crops of unreadable images are left out."""
    from pyspark.sql import functions as F

    rows = images.select(F.regexp_replace("image.origin", r"^(\w+):///", "$1:/").alias("path"), "image.data", "image.height", "image.width", "image.nChannels")
    joined = rows.join(crops, "path").select("path", "name", "data", "height", "width", "nChannels", "crop.x1", "crop.y1", "crop.x2", "crop.y2")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                if r.data is None or r.height <= 0:
                    continue
                whole = np.frombuffer(r.data, np.uint8).reshape(r.height, r.width, r.nChannels)
                rgb = np.repeat(whole, 3, axis=2) if r.nChannels == 1 else whole[:, :, 2::-1]
                out.append((r.path, r.name, png(np.ascontiguousarray(rgb[r.y1 : r.y2, r.x1 : r.x2]))))
            yield pd.DataFrame(out, columns=["path", "name", "png"])

    return joined.mapInPandas(run, "path string, name string, png binary")
