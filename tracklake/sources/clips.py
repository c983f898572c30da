"""Frames of clips as a data source, ``spark.read.format("clip_frames")``, and as a stream of clips as they arrive.

``register`` takes the caller's decoder. Options: ``path``, a folder; ``segment``, the frames of one task (500); ``types``, the
suffixes of clips. Rows are clip, frame_no and what the decoder gives.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, In, InputPartition
from pyspark.sql.types import StructType

TYPES = "mp4,avi,mov,mkv"


@dataclass
class Decoder:
    """``decode`` (path, first, last) gives the rows, tuples of ``schema``, of the frames from first up to last, seeking on its own;
    ``frames`` (path) their number."""

    decode: Callable[[str, int, int], Iterator[tuple]]
    frames: Callable[[str], int]
    schema: str


@dataclass
class Segment(InputPartition):
    clip: str
    first: int
    last: int


class _Folder:
    def __init__(self, options: dict, decoder: Decoder) -> None:
        self.options, self.decoder = options, decoder
        self.segment = int(options.get("segment", 500))

    def clips(self) -> list[tuple[int, str]]:
        """(time of change, path) of the clips below the folder, oldest first."""
        from pyarrow import fs

        from tracklake.sources.files import file_system

        system, path = file_system(self.options["path"])
        types = tuple("." + t for t in self.options.get("types", TYPES).split(","))
        found = system.get_file_info(fs.FileSelector(path, recursive=True))
        return sorted((f.mtime_ns or 0, f.path) for f in found if f.is_file and f.path.lower().endswith(types))

    def segments(self, clips: list[str]) -> list[InputPartition]:
        return [Segment(c, a, min(n, a + self.segment)) for c in clips for n in [self.decoder.frames(c)] for a in range(0, n, self.segment)]

    def rows(self, part: Segment) -> Iterator[tuple]:
        for number, row in enumerate(self.decoder.decode(part.clip, part.first, part.last), part.first):
            yield (part.clip, number, *row)


class _Reader(DataSourceReader):
    """One task for each segment of each clip; tests of clip for equality choose among the clips before any is opened."""

    def __init__(self, folder: _Folder) -> None:
        self.folder, self.only = folder, None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            wanted = {f.value} if isinstance(f, EqualTo) else set(f.value) if isinstance(f, In) else None
            if wanted is None or f.attribute != ("clip",):
                yield f
            else:
                self.only = wanted if self.only is None else self.only & wanted

    def partitions(self) -> list[InputPartition]:
        return self.folder.segments([c for _, c in self.folder.clips() if self.only is None or c in self.only]) or [Segment("", 0, 0)]

    def read(self, part: InputPartition) -> Iterator[tuple]:
        return self.folder.rows(part) if part.last > part.first else iter(())


class _Arrivals(DataSourceStreamReader):
    """Clips in the order of their arrival; an offset is the time and the path of the last clip that has been read."""

    def __init__(self, folder: _Folder) -> None:
        self.folder = folder

    def initialOffset(self) -> dict:
        return {"time": -1, "path": ""}

    def latestOffset(self) -> dict:
        found = self.folder.clips()
        return {"time": found[-1][0], "path": found[-1][1]} if found else self.initialOffset()

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        low, high = (start["time"], start["path"]), (end["time"], end["path"])
        return self.folder.segments([c for t, c in self.folder.clips() if low < (t, c) <= high])

    def read(self, part: InputPartition) -> Iterator[tuple]:
        return self.folder.rows(part)

    def commit(self, end: dict) -> None:
        pass


def register(spark: SparkSession, decoder: Decoder, name: str = "clip_frames") -> None:
    """Make the format known to a session, which must let filters reach Python sources."""

    class ClipFrames(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return f"clip string, frame_no long, {decoder.schema}"

        def reader(self, schema: StructType) -> DataSourceReader:
            return _Reader(_Folder(dict(self.options), decoder))

        def streamReader(self, schema: StructType) -> DataSourceStreamReader:
            return _Arrivals(_Folder(dict(self.options), decoder))

    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ClipFrames)
