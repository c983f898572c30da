"""Readers, writers, image hashes, model seams and the curation run on files of their own."""

import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracklake.functions import hashing
from tracklake.operators import annotations, dedupe, evaluate, inference, learning, tracks
from tracklake.plans.run import curate, write_curation
from tracklake.sources import files


def png(pixels):
    h, w, _ = pixels.shape
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    raw = b"".join(b"\0" + row.tobytes() for row in pixels.astype(np.uint8))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def picture(seed, size=(64, 80)):
    rng = np.random.RandomState(seed)
    coarse = rng.randint(0, 255, (8, 10, 3))
    return np.kron(coarse, np.ones((size[0] // 8, size[1] // 10, 1)))


@pytest.fixture()
def dataset(tmp_path):
    for split in ("valid", "train"):
        for kind in ("images", "labels"):
            (tmp_path / "d" / split / kind).mkdir(parents=True)
    for split, name, seed in (("train", "b.png", 1), ("train", "a.png", 2), ("valid", "c.png", 3)):
        (tmp_path / "d" / split / "images" / name).write_bytes(png(picture(seed)))
    (tmp_path / "d" / "train" / "labels" / "a.txt").write_text("0 0.5 0.5 0.25 0.5\n1 0.1 0.1 0.1 0.1\n")
    (tmp_path / "d" / "train" / "labels" / "b.txt").write_text("")
    (tmp_path / "d" / "stray.png").write_bytes(png(picture(4)))
    return tmp_path / "d"


def test_images_and_labels(spark, dataset, tmp_path):
    images = files.list_images(spark, str(dataset), ordered=True)
    names = [(r.split, r.path.rsplit("/", 1)[1]) for r in images.collect()]
    assert names == [("train", "a.png"), ("train", "b.png"), ("valid", "c.png")]
    (tmp_path / "flat").mkdir()
    (tmp_path / "flat" / "x.PNG").write_bytes(png(picture(5)))
    assert [r.split for r in files.list_images(spark, str(tmp_path / "flat")).collect()] == [""]
    rows = files.labelled(images, files.read_labels(spark, str(dataset)))
    assert sorted((r.path[-5:], r.cls) for r in rows.collect() if r.cls is not None) == [("a.png", 0), ("a.png", 1)] and rows.count() == 4
    truth = files.pixel_truth(rows, files.image_sizes(spark, str(dataset))).where("cls = 0").first()
    assert (truth.x1, truth.y1, truth.x2, truth.y2) == (30.0, 16.0, 50.0, 48.0)


def test_crops(spark, dataset):
    from tracklake.functions.crops import crop_images

    path = files.list_images(spark, str(dataset), ordered=True).first().path
    asked = spark.createDataFrame([(path, "00", (8, 8, 24, 40))], "path string, name string, crop struct<x1:int,y1:int,x2:int,y2:int>")
    read = spark.read.format("image").option("recursiveFileLookup", True).load(str(dataset))
    got = crop_images(read, asked).collect()
    assert len(got) == 1 and bytes(got[0].png) == png(picture(2)[8:40, 8:24])


def test_prompts_and_candidates(spark):
    taxonomy = spark.createDataFrame([(0, "cigarette", []), (1, "vape", ["e-cig", "pod"])], "class_id int, class string, prompts array<string>")
    assert sorted((r.class_id is None, r.prompt) for r in annotations.prompts(taxonomy, background=True).collect()) == [(False, "cigarette"), (False, "e-cig"), (False, "pod"), (True, "")]
    sources = spark.createDataFrame([("a", "train"), ("b", "skip"), ("c", "test")], "source string, role string")
    assert sorted(r.source for r in annotations.chosen_sources(sources).collect()) == ["a", "c"] and annotations.chosen_sources(sources, ["c", "b"]).count() == 1
    boxes = spark.createDataFrame([(0,), (1,), (4,)], "cls int")
    assert annotations.class_subset(boxes, [1, 4]).count() == 2 and annotations.usable(boxes).count() == 3


def test_decoded_clips(spark, tmp_path):
    (tmp_path / "a.mp4").write_bytes(b"xyz")
    (tmp_path / "note.txt").write_text("no clip")
    rows = files.decoded_frames(spark, str(tmp_path), lambda path, data: ({"clip": path[-5:], "frame_no": i, "value": b} for i, b in enumerate(data)), "clip string, frame_no long, value int")
    assert [(r.clip, r.frame_no, r.value) for r in rows.orderBy("frame_no").collect()] == [("a.mp4", 0, 120), ("a.mp4", 1, 121), ("a.mp4", 2, 122)]


def test_hashes_of_mirrored_images(spark, tmp_path):
    one = picture(7)
    for name, pixels in (("a", one), ("b", np.clip(one * 0.9 + 5, 0, 255)), ("c", one[:, ::-1]), ("d", picture(8))):
        (tmp_path / f"{name}.png").write_bytes(png(pixels))
    found = {r.path[-5]: r for r in hashing.image_hashes(spark.read.format("image").load(str(tmp_path))).collect()}
    assert found["a"].mirror == found["c"].h and found["c"].mirror == found["a"].h
    rows = spark.createDataFrame([(i, found[k].h, found[k].mirror) for i, k in enumerate("abcd")], "idx long, h long, mirror long")
    assert {(r.i, r.j) for r in dedupe.hamming_pairs(rows).collect()} == {(0, 1), (0, 2), (1, 2)}
    linked = dedupe.groups(rows, dedupe.hamming_edges(rows)).collect()
    assert {r.idx: r.group_id for r in linked} == {0: 0, 1: 0, 2: 0, 3: 3}


def test_edges_connect_the_groups_of_pairs(spark):
    rng = np.random.RandomState(3)
    base = rng.randint(0, 1 << 62, 40)
    rows = []
    for i in range(600):
        h = int(base[rng.randint(40)])
        for b in rng.randint(0, 62, rng.randint(0, 5)):
            h ^= 1 << int(b)
        rows.append((i, h, h ^ 5 if i % 3 else int(base[rng.randint(40)])))
    df = spark.createDataFrame(rows, "idx long, h long, mirror long")
    pairs = dedupe.hamming_pairs(df, 4, 6).select(F.col("i").alias("src"), F.col("j").alias("dst"))
    whole = {r.idx: r.group_id for r in dedupe.groups(df, pairs).collect()}
    assert {r.idx: r.group_id for r in dedupe.groups(df, dedupe.hamming_edges(df, 4)).collect()} == whole


def test_tables_round_trip(spark, tmp_path):
    row = ("i.jpg", "s", "train", 1, "i.jpg", "i", 3, {"cigarette": 2, "vape": 1}, False, False)
    df = spark.createDataFrame([row], files.MANIFEST)
    for form in ("parquet", "csv"):
        files.write_table(df, str(tmp_path / form), form)
        assert tuple(files.read_manifest(spark, str(tmp_path / form), form).first()) == row
    seq = spark.createDataFrame([(1, 0, 5, s, [0.1, 0.2]) for s in range(3)], "label int, clip long, track long, step long, features array<double>")
    files.write_tracks(seq, str(tmp_path / "tracks"))
    assert files.read_tracks(spark, str(tmp_path / "tracks")).count() == 3
    (tmp_path / "clips.csv").write_text("video_path,label,start_s,end_s,notes\na/b.mp4,smoking,,3.5,\n/abs/c.mp4,no,1,,x\n")
    clips = files.read_clip_labels(spark, str(tmp_path / "clips.csv"), "/root")
    assert [(r.video_path, r.start_s, r.end_s) for r in clips.collect()] == [("/root/a/b.mp4", None, 3.5), ("/abs/c.mp4", 1.0, None)]


def test_texts(spark):
    import yaml

    config = yaml.safe_load(files.dataset_config(["cigarette", "e: cig"], "/data/x"))
    assert config["names"] == {0: "cigarette", 1: "e: cig"} and config["val"] == "splits/val.txt"
    level = {"conf_thr": 0.25, "precision": 0.5, "recall": None, "fpr": 0.1, "tp": 1, "fp": 1, "fn": 0, "tn": 9}
    text = files.format_report({"map50": 0.5, "ap50": {"vape": 0.5, "pipe": None}, "n_gt": {"vape": 4}, "image_level": level, "recall_by_size": {"small": 0.25}, "n_by_size": {"small": 4}})
    assert text.splitlines()[0] == "mAP@0.5: 0.500" and "vape          0.500   4" in text and "recall nan" in text and "small 0.250 (n=4)" in text
    shown = files.audit_text({"name": "s", "role": "train", "version": 3, "license": "CC"}, {"n_images": 4, "n_empty": 1}, [{"src_id": 0, "name": "Cig", "n_boxes": 3, "n_images": 2, "target": "cigarette"}, {"src_id": 1, "name": "odd", "n_boxes": 1, "n_images": 1, "target": None}])
    assert "4 images, 1 with no boxes." in shown and "| 1 | odd | 1 | 1 | **UNMAPPED** |" in shown
    assert [tuple(r) for r in files.names_table(spark, {"a": {"1": "y", "0": "x"}, "b": ["z"]}).collect()] == [("a", 0, "x"), ("a", 1, "y"), ("b", 0, "z")]


def test_unique_names_skip_taken_ones(spark):
    rows = [(0, "s", "a.jpg"), (1, "s", "a.jpg"), (2, "s", "a_1.jpg"), (3, "s", "a.jpg"), (4, "t", "a.jpg"), (5, "s", "a.png")]
    got = {r.idx: r.out_name for r in annotations.unique_names(spark.createDataFrame(rows, "idx long, source string, name string")).collect()}
    assert got == {0: "a.jpg", 1: "a_2.jpg", 2: "a_1.jpg", 3: "a_3.jpg", 4: "a.jpg", 5: "a.png"}


def test_curation_run(spark, tmp_path):
    images = spark.createDataFrame([(i, "ab"[i % 2], f"p{i // 4}.rf.{i}.jpg") for i in range(40)] + [(90, "off", "z.jpg")], "idx long, source string, name string")
    boxes = spark.createDataFrame([("ab"[i % 2], i, "Cig" if i % 3 else "junk") for i in range(36)], "source string, image long, name string")
    sources = spark.createDataFrame([("a", "train", 0), ("b", "test", 1), ("off", "skip", 2)], "source string, role string, priority int")
    mapping = spark.createDataFrame([(s, n, t) for s in "ab" for n, t in (("cig", "cigarette"), ("junk", None))], "source string, name string, target string")
    taxonomy = spark.createDataFrame([(0, "cigarette"), (1, "vape")], "class_id int, class string")
    hashes = spark.createDataFrame([(i, 7 if i in (1, 2) else (i * 0x9E3779B97F4A7C15) % (1 << 62), None) for i in range(40)], "idx long, h long, mirror long")
    negatives = spark.createDataFrame([(1000 + i, i % 2 == 0) for i in range(20)], "idx long, use boolean")
    args = [images, boxes, boxes.select("source", "name").distinct(), sources, mapping, taxonomy, hashes, negatives]
    run = curate(*args)
    rows = {r.idx: r for r in run.grouped.collect()}
    assert set(rows) == {i for i in range(40) if i >= 36 or i % 3}  # emptied images go, those never labelled stay
    assert rows[4].group_id == 4 and rows[10].group_id == 8  # photos of one source and stem
    assert rows[2].drop_reason == "test_leak" and rows[1].keep  # a train image that is near a test image
    split = {r.idx: r.split for r in run.split.where("NOT negative").collect()}
    assert all(split[i] == "test" for i in split if i % 2) and {split[i] for i in split if not i % 2} <= {"train", "val"}
    assert all((r.idx - 1000) % 2 == 0 for r in run.split.where("negative").collect())
    table = {(r.split, r["class"]): r.n for r in annotations.split_class_boxes(run.split, run.grouped.select("idx", "boxes_per_class"), taxonomy).collect()}
    assert table["test", "cigarette"] == sum(1 for i in split if i % 2 and i < 36) and table["test", "vape"] == 0
    write_curation(run, str(tmp_path / "out"), "csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "out" / "manifest_dedup")).count() == len(rows)
    counts = dedupe.group_counts(run.grouped).first()
    assert counts.n_images == len(rows) and counts.n_kept == sum(r.keep for r in rows.values())
    args[4] = mapping.unionAll(spark.createDataFrame([("a", "x", "bong")], mapping.schema))
    with pytest.raises(ValueError, match="bong"):
        curate(*args)
    args[4] = mapping.where("name <> 'junk'")
    with pytest.raises(ValueError, match="junk"):
        curate(*args)


def test_model_seams(spark):
    def load():
        return lambda contents: [[(0, 0.9, 0.0, 0.0, 10.0, 10.0), (0, 0.8, 0.0, 0.5, 10.0, 10.0), (1, 0.7, 0.0, 0.0, 5.0, 5.0), (0, 0.001, 0, 0, 1, 1)] for _ in contents]

    images = spark.createDataFrame([("p1", b"x"), ("p2", b"y")], "path string, content binary")
    names = spark.createDataFrame([(0, "Vape"), (1, "dog")], "cls int, name string")
    taxonomy = spark.createDataFrame([(3, "vape")], "class_id int, class string")
    assert sorted((r.image, r.cls, r.conf) for r in inference.predictions(images, load, names, taxonomy).collect()) == [("p1", 3, 0.9), ("p2", 3, 0.9)]
    assert inference.frame_objects(images, load, names, taxonomy).count() == 4

    def start():
        seen = []
        return lambda number, content: seen.append(number) or [{"track": len(seen), "area": float(number)}]

    frames = spark.createDataFrame([(c, n, b"f") for c in (1, 2) for n in (2, 0, 1)], "clip long, frame_no long, content binary")
    got = inference.track_people(frames, start, "track long, area double").collect()
    assert sorted((r.clip, r.frame_no, r.track) for r in got) == [(c, n, n + 1) for c in (1, 2) for n in range(3)]


def test_predictions_of_unknown_images(spark):
    kind = "image long, det_idx int, cls int, conf double, x1 double, y1 double, x2 double, y2 double"
    pred = spark.createDataFrame([(1, 1, 0, 0.9, 0.0, 0.0, 10.0, 10.0), (7, 1, 0, 0.8, 0.0, 0.0, 10.0, 10.0)], kind)
    truth = spark.createDataFrame([(1, 1, 0, 0.0, 0.0, 10.0, 10.0)], "image long, gt_idx int, cls int, x1 double, y1 double, x2 double, y2 double")
    known = spark.createDataFrame([(1,), (2,)], "image long")
    assert [r.image for r in evaluate.match(truth, pred, images=known).collect()] == [1]


def test_classifier_is_saved_and_refused(spark, tmp_path):
    from pyspark.ml import PipelineModel

    rng = np.random.RandomState(1)
    rows = spark.createDataFrame([(i, bool(i % 2), float(rng.normal(i % 2)), float(rng.normal())) for i in range(200)], "group long, label boolean, x double, y double")
    parted = learning.group_fold(rows, 0.25, F.md5(F.col("group").cast("string")))
    assert parted.where("val").groupBy("label").count().count() == 2 and parted.where("val").count() == 50
    model, area = learning.fit_windows(parted.where("NOT val"), parted.where("val"), ["x", "y"])
    assert area > 0.6
    model.write().overwrite().save(str(tmp_path / "model"))
    again = learning.window_scores(PipelineModel.load(str(tmp_path / "model")), parted.where("val"))
    assert [r.score for r in again.orderBy("group").collect()] == [r.score for r in learning.window_scores(model, parted.where("val")).orderBy("group").collect()]
    with pytest.raises(Exception, match="two groups"):
        learning.group_fold(rows.where("group < 2"), 0.25, F.md5(F.col("group").cast("string"))).collect()


def test_windows_of_short_sequences(spark):
    rows = spark.createDataFrame([(1, s, s) for s in range(3)] + [(2, s, s) for s in range(7)], "k long, step long, v long")
    got = {}
    for r in tracks.window_frames(rows, ["k"], 4, 2).orderBy("k", "start", "place").collect():
        got.setdefault((r.k, r.start), []).append(r.v)
    assert got == {(1, 0): [0, 0, 1, 2], (2, 0): [0, 1, 2, 3], (2, 2): [2, 3, 4, 5], (2, 3): [3, 4, 5, 6]}


def test_labels_and_splits_are_read_back(spark, tmp_path):
    """Label files lie at the label paths, the split lists where the description says."""
    import yaml

    paths = []
    for split, name in (("train", "a.b"), ("train", "b"), ("valid", "c")):
        (tmp_path / "d" / split / "images").mkdir(parents=True, exist_ok=True)
        (tmp_path / "d" / split / "images" / f"{name}.png").write_bytes(png(picture(len(paths))))
        paths.append(str(tmp_path / "d" / split / "images" / f"{name}.png"))
    kind = "image string, box_idx int, cls int, cx double, cy double, w double, h double"
    boxes = spark.createDataFrame([(paths[0], 1, 3, 0.25, 0.5, 0.125, 0.0625), (paths[0], 0, 2, 0.5, 0.5, 0.1, 0.25), (f"file:{paths[2]}", 0, 1, 0.5, 0.5, 1.0, 1.0)], kind)
    images = spark.createDataFrame([(paths[0],), (paths[1],), (f"file:{paths[2]}",), (paths[0],)], "image string")
    for _ in range(2):  # again is the same
        assert files.write_labels(images, boxes) == 3
    assert (tmp_path / "d" / "train" / "labels" / "a.b.txt").read_text() == "2 0.500000 0.500000 0.100000 0.250000\n3 0.250000 0.500000 0.125000 0.062500\n"
    read = files.labelled(files.list_images(spark, f"{tmp_path}/d"), files.read_labels(spark, f"{tmp_path}/d"))
    got = sorted((r.path.rpartition("/")[2], r.cls, r.w) for r in read.collect() if r.cls is not None)
    assert got == [("a.b.png", 2, 0.1), ("a.b.png", 3, 0.125), ("c.png", 1, 1.0)] and read.count() == 4
    split = spark.createDataFrame([("train", paths[1]), ("train", paths[0]), ("test", paths[2])], "split string, path string").repartition(3)
    for _ in range(2):
        files.write_splits(split, f"{tmp_path}/out/splits")
    config = yaml.safe_load(files.dataset_config(["x"], f"{tmp_path}/out"))
    lists = {s: files.read_paths(spark, f"{config['path']}/{config[s]}").collect() for s in ("train", "val", "test")}
    assert [r.path for r in lists["train"]] == sorted(paths[:2]) and [r.path for r in lists["test"]] == paths[2:] and lists["val"] == []


def test_turned_images_hash_as_upright(spark, tmp_path):
    import struct
    import zlib

    upright = picture(9)
    turned = {1: upright, 2: upright[:, ::-1], 3: upright[::-1, ::-1], 4: upright[::-1], 5: upright.transpose(1, 0, 2), 6: np.rot90(upright), 7: np.rot90(upright, 2).transpose(1, 0, 2), 8: np.rot90(upright, -1)}
    for tag, pixels in turned.items():
        data = png(np.ascontiguousarray(pixels))
        for order, mark in (("<", b"II*\0"), (">", b"MM\0*")):
            tiff = mark + struct.pack(f"{order}IHHHIHHI", 8, 1, 0x0112, 3, 1, tag, 0, 0)
            chunk = b"eXIf" + tiff
            (tmp_path / f"{tag}{'l' if order == '<' else 'b'}.png").write_bytes(data[:33] + struct.pack(">I", len(tiff)) + chunk + struct.pack(">I", zlib.crc32(chunk)) + data[33:])
        app = b"Exif\0\0" + tiff
        assert hashing.orientation(b"\xff\xd8\xff\xe0\x00\x04ab\xff\xe1" + struct.pack(">H", len(app) + 2) + app + b"\xff\xda") == tag
    assert hashing.orientation(b"") == hashing.orientation(b"\xff\xd8\xff\xda") == hashing.orientation(png(upright)) == 1
    images = spark.read.format("image").load(str(tmp_path))
    found = hashing.image_hashes(images, hashing.orientations(spark, str(tmp_path))).collect()
    assert len(found) == 16 and len({(r.h, r.mirror) for r in found}) == 1
    assert len({r.h for r in hashing.image_hashes(images).collect()}) > 4
