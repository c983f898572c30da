"""Clips as a data source and as a stream, and table functions in SQL."""

import os

from tracklake.operators import association as S
from tracklake.operators import inference as I
from tracklake.sources.clips import Decoder, Segment, _Folder, _Reader, register


def decoder():
    """A clip's bytes are its frames."""

    def decode(path, first, last):
        with open(path, "rb") as f:
            f.seek(first)
            for b in f.read(last - first):
                yield (b,)

    def frames(path):
        import os

        return os.path.getsize(path)

    return Decoder(decode, frames, "value int")


def test_frames_by_segments(spark, tmp_path):
    folder = tmp_path / "clips"
    folder.mkdir()
    for name, n in (("a.mp4", 10), ("b.MOV", 3), ("c.txt", 5), ("d.avi", 0)):
        (folder / name).write_bytes(bytes(range(n)))
    register(spark, decoder())
    frames = spark.read.format("clip_frames").options(path=str(folder), segment=4).load()
    assert sorted((os.path.basename(r.clip), r.frame_no, r.value) for r in frames.collect()) == [("a.mp4", i, i) for i in range(10)] + [("b.MOV", i, i) for i in range(3)]
    assert frames.rdd.getNumPartitions() == 4
    one = frames.where(f"clip = '{folder}/b.MOV' AND value > 0")
    assert [r.value for r in one.collect()] == [1, 2] and one.rdd.getNumPartitions() == 1
    assert _Reader(_Folder({"path": str(folder), "segment": "4", "types": "mp4"}, decoder())).partitions() == [Segment(f"{folder}/a.mp4", a, min(10, a + 4)) for a in (0, 4, 8)]


def test_stream_goes_on_from_its_offset(spark, tmp_path):
    folder = tmp_path / "clips"
    folder.mkdir()
    register(spark, decoder())

    def run():
        stream = spark.readStream.format("clip_frames").options(path=str(folder), segment=4).load()
        query = stream.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/check").start()
        query.processAllAvailable()
        query.stop()
        return sorted((os.path.basename(r.clip), r.value) for r in spark.read.parquet(f"{tmp_path}/out").collect())

    (folder / "a.mp4").write_bytes(bytes(range(6)))
    assert run() == [("a.mp4", i) for i in range(6)]
    (folder / "b.mp4").write_bytes(bytes(range(50, 53)))
    assert run() == [("a.mp4", i) for i in range(6)] + [("b.mp4", i) for i in range(50, 53)]


def test_table_functions_equal_the_frames(spark):
    rows = [(clip, f, d, 0.4 + 0.05 * ((f + d) % 10), 10.0 * d + f, 5.0, 30.0 + 10 * d + f, 45.0) for clip in ("x", "y") for f in range(30) for d in range(3)]
    boxes = spark.createDataFrame(rows, "clip string, frame_no long, det_idx long, conf double, x1 double, y1 double, x2 double, y2 double")
    boxes.repartition(5).createOrReplaceTempView("found_boxes")
    I.register_association(spark, "track_boxes")
    got = spark.sql("SELECT * FROM track_boxes(TABLE(found_boxes) PARTITION BY clip ORDER BY (frame_no, det_idx))")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, S.associated(boxes).collect())) and got.count() > 100
    frames = spark.createDataFrame([(c, f, bytes([f, k])) for k, c in enumerate(("x", "y")) for f in range(9)], "clip string, frame_no long, content binary")

    def start():
        seen = []

        def tracker(number, content):
            seen.append(number)
            return [{"track": content[1], "age": len(seen)}] * (number % 3)

        return tracker

    frames.repartition(4).createOrReplaceTempView("some_frames")
    I.register_people(spark, "people_of", start, "track long, age int")
    want = sorted(map(tuple, I.track_people(frames, start, "track long, age int").collect()))
    assert sorted(map(tuple, spark.sql("SELECT * FROM people_of(TABLE(some_frames) PARTITION BY clip ORDER BY frame_no)").collect())) == want and len(want) == 18
    I.register_detector(spark, "objects_in", lambda: lambda images: [[(x[0] % 4, 0.1 * (x[0] % 5), 0.0, 0.0, 1.0, float(x[1]))] for x in images], least=0.15)
    found = spark.sql("SELECT clip, frame_no, d.* FROM some_frames, LATERAL objects_in(content) d").collect()
    assert sorted((r.clip, r.frame_no, r.cls) for r in found) == sorted((c, f, f % 4) for c in ("x", "y") for f in range(9) if 0.1 * (f % 5) >= 0.15)
