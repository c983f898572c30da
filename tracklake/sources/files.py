"""Readers and writers: taxonomy and source registers, label text, image lists, manifests, reports."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Iterator
from itertools import islice
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tracklake.functions.geometry import polygon_box
from tracklake.functions.names import IMAGE_TYPES, label_path, name_key

TAXONOMY = "class_id int, class string, is_object boolean, prompts array<string>"
SOURCES = "source string, workspace string, project string, version string, role string, priority int, license string"
CLASS_MAP = "source string, name string, target string"
MANIFEST = "image string, source string, role string, priority int, orig_name string, orig_stem string, n_boxes int, boxes_per_class map<string,bigint>, orig_empty boolean, emptied boolean"
CLIP_LABELS = "video_path string, label string, start_s double, end_s double, notes string"
ROLES = ("train", "test", "skip")
FRAMES = 64


def read_yaml(path: str) -> dict:
    import yaml

    return yaml.safe_load(Path(path).read_text()) or {}


def taxonomy(spark: SparkSession, config: dict) -> DataFrame:
    """The class table; an object class that is not a class raises."""
    classes, objects, prompts = list(config.get("classes", [])), config.get("smoking_objects", config.get("objects", [])), config.get("prompts") or {}
    if strange := [c for c in objects if c not in classes]:
        raise ValueError(f"not among the classes: {strange}")
    return spark.createDataFrame([(i, c, c in objects, list(prompts.get(c, []))) for i, c in enumerate(classes)], TAXONOMY)


def source_register(spark: SparkSession, config: dict) -> tuple[DataFrame, DataFrame]:
    """Sources and their class map (target null: drop). Missing settings get their defaults; an unknown role raises."""
    rows, pairs = [], []
    for s in config.get("sources", []):
        role = s.get("role", "train")
        if role not in ROLES:
            raise ValueError(f"role of {s['name']}: {role}")
        rows.append((s["name"], s.get("workspace", ""), s.get("project", ""), str(s.get("version", "latest")), role, int(s.get("priority", 100)), s.get("license", "")))
        pairs += [(s["name"], str(k), v) for k, v in (s.get("class_map") or {}).items()]
    return spark.createDataFrame(rows, SOURCES), spark.createDataFrame(pairs, CLASS_MAP).withColumn("name", name_key(F.col("name")))


def names_table(spark: SparkSession, names: dict[str, list | dict]) -> DataFrame:
    """``source, src_id, name``: the class names of each source by number."""
    rows = [(source, i, str(n)) for source, own in names.items() for i, n in enumerate(class_names(own))]
    return spark.createDataFrame(rows, "source string, src_id int, name string")


def class_names(names: list | dict) -> list[str]:
    """Names of a dataset, given as a list or by number."""
    return [names[k] for k in sorted(names, key=int)] if isinstance(names, dict) else list(names)


def parse_labels(lines: DataFrame) -> DataFrame:
    """``path, line_no, cls, cx, cy, w, h`` from label lines (path, line_no, value).

    Lines of fewer than five numbers and boxes without width or height are left out; more than four
    coordinates are a polygon.
    """
    parts = lines.withColumn("_p", F.split(F.trim("value"), r"\s+")).where(F.size("_p") >= 5)
    parts = parts.withColumn("_v", F.expr("transform(slice(_p, 2, size(_p) - 1), x -> try_cast(x AS DOUBLE))")).where(~F.exists("_v", lambda v: v.isNull()))
    plain = F.struct(*(F.element_at("_v", k + 1).alias(n) for k, n in enumerate(("cx", "cy", "w", "h"))))
    box = F.when(F.size("_v") == 4, plain).otherwise(polygon_box(F.col("_v")))
    cls = F.expr("try_cast(try_cast(_p[0] AS DOUBLE) AS INT)")
    return parts.select("path", "line_no", cls.alias("cls"), box.alias("b")).select("path", "line_no", "cls", "b.*").where("w > 0 AND h > 0")


def read_labels(spark: SparkSession, folder: str) -> DataFrame:
    """All label files under a folder; line numbers follow the file."""
    text = spark.read.option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").text(folder)
    whole = text.select(F.col("_metadata.file_path").alias("path"), F.posexplode(F.split("value", "\r?\n")).alias("line_no", "value"))
    return parse_labels(whole)


SPLITS = ("train", "valid", "val", "test")


def list_images(spark: SparkSession, folder: str, types: tuple[str, ...] = IMAGE_TYPES, ordered: bool = False) -> DataFrame:
    """``path, split, label`` of the images under a folder; only names are read.

    With folders ``<split>/images`` these alone count; without any, every image below the folder does,
    with an empty split. ``ordered``: by split as trainers name them, then by path.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path")
    named = files.where(F.lower(F.substring_index("path", ".", -1)).isin(*types)).withColumn("split", F.regexp_extract("path", r"/(train|valid|val|test)/images/[^/]*$", 1))
    some = named.agg(F.coalesce(F.max(F.col("split") != ""), F.lit(False)).alias("some"))
    out = named.join(F.broadcast(some)).where(~F.col("some") | (F.col("split") != "")).select("path", "split", label_path(F.col("path")).alias("label"))
    rank = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, SPLITS)), F.col("split")), F.lit(0)), F.lit(len(SPLITS) + 1))
    return out.orderBy(rank, "path") if ordered else out


def image_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """``path, width, height`` from the image files; unreadable ones are left out."""
    read = spark.read.format("image").option("dropInvalid", True).option("recursiveFileLookup", True).load(folder)
    # the image source writes an empty host, the other sources do not
    return read.select(F.regexp_replace("image.origin", "^(\\w+):///", "$1:/").alias("path"), "image.width", "image.height")


def labelled(images: DataFrame, labels: DataFrame) -> DataFrame:
    """Each image with its boxes, one row a box; an image without a label file, or with an empty one, has one row of nulls."""
    return images.join(labels.withColumnRenamed("path", "label"), "label", "left")


def pixel_truth(labels: DataFrame, sizes: DataFrame) -> DataFrame:
    """``image, gt_idx, cls, x1, y1, x2, y2`` in pixels, from ``labelled`` rows (path, line_no, cls, box) and image sizes."""
    own = labels.where("cls IS NOT NULL").join(sizes, "path")
    half = {"x": F.col("w") / 2, "y": F.col("h") / 2}
    side = {"x": F.col("width"), "y": F.col("height")}
    corners = [((F.col(f"c{c}") + sign * half[c]) * side[c]).alias(f"{c}{n}") for n, sign in ((1, -1), (2, 1)) for c in ("x", "y")]
    return own.select(F.col("path").alias("image"), F.col("line_no").alias("gt_idx"), "cls", *corners)


def read_paths(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).where("trim(value) <> ''").select(F.trim("value").alias("path"))


def read_clip_labels(spark: SparkSession, path: str, root: str = "") -> DataFrame:
    """Clip labels; paths that are not absolute are taken below ``root``."""
    clips = spark.read.schema(CLIP_LABELS).option("header", True).csv(path)
    if not root:
        return clips
    whole = F.col("video_path").rlike(r"^(/|[A-Za-z][A-Za-z0-9+.-]*:)")
    return clips.withColumn("video_path", F.when(whole, F.col("video_path")).otherwise(F.concat(F.lit(root.rstrip("/") + "/"), "video_path")))


def encoded_maps(df: DataFrame) -> DataFrame:
    """Map columns as JSON text, for formats that have no maps."""
    return df.withColumns({f.name: F.to_json(f.name) for f in df.schema.fields if f.dataType.typeName() == "map"})


def write_table(df: DataFrame, path: str, form: str = "parquet", by: list[str] | None = None) -> None:
    """The sink of every step's table: manifests, pair samples, negatives, mined lists, track summaries, tracks.
    ``form`` parquet keeps all types; csv has a header and maps as JSON."""
    writer = (encoded_maps(df) if form == "csv" else df).write.mode("overwrite")
    writer = writer.partitionBy(*by) if by else writer
    writer.option("header", True).csv(path) if form == "csv" else writer.parquet(path)


def read_table(spark: SparkSession, path: str, schema: str | StructType, form: str = "parquet") -> DataFrame:
    """What ``write_table`` wrote; JSON text in a map column is decoded."""
    kind = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if form == "parquet":
        return spark.read.schema(kind).parquet(path)
    flat = StructType([StructField(f.name, StringType() if f.dataType.typeName() == "map" else f.dataType) for f in kind])
    read = spark.read.schema(flat).option("header", True).csv(path)
    return read.select(*(F.from_json(f.name, f.dataType.simpleString()).alias(f.name) if f.dataType.typeName() == "map" else F.col(f.name) for f in kind))


def read_manifest(spark: SparkSession, path: str, form: str = "parquet") -> DataFrame:
    return read_table(spark, path, MANIFEST, form)


def write_tracks(rows: DataFrame, path: str) -> None:
    """Sequences (label, clip, track, step, features), one folder a label."""
    write_table(rows.sortWithinPartitions("clip", "track", "step"), path, by=["label"])


def read_tracks(spark: SparkSession, path: str) -> DataFrame:
    """The sequences of ``write_tracks``; their order is the columns clip, track and step, not that of files."""
    return spark.read.parquet(path)


def decoded_frames(spark: SparkSession, folder: str, decode: Callable[[str, bytes], Iterator[dict]], schema: str, types: tuple[str, ...] = ("mp4", "avi", "mov", "mkv")) -> DataFrame:
    """Frames of the clips under a folder by the caller's decoder (path, content) -> rows of ``schema``; a clip is
    one task's work, and ``FRAMES`` of its frames are held at a time. Without a decoder, pipelines start from a table of observations."""
    clips = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).where(F.lower(F.substring_index("path", ".", -1)).isin(*types))

    def run(batches):
        import pandas as pd

        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                frames = iter(decode(path, content))
                while rows := list(islice(frames, FRAMES)):
                    yield pd.DataFrame(rows)

    return clips.select("path", "content").mapInPandas(run, schema)


def label_lines(boxes: DataFrame) -> DataFrame:
    """One text for each image: a line for each box with six decimals."""
    line = F.format_string("%d %.6f %.6f %.6f %.6f", "cls", "cx", "cy", "w", "h")
    ordered = F.array_sort(F.collect_list(F.struct("box_idx", line.alias("line"))))
    return boxes.groupBy("image").agg(F.array_join(F.transform(ordered, lambda x: x["line"]), "\n").alias("value"))


def file_system(path: str):
    """The file system of a path or URI, and the path within it; for use in tasks."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub("^file:/+", "/", path))


def write_labels(images: DataFrame, boxes: DataFrame) -> int:
    """One file for each image at its label path, a line for each box, empty for images without boxes; how many were written.
    ``images`` holds image, a whole path or URI, ``boxes`` image, box_idx, cls and the box. Tasks write their files themselves; a
    task that runs again writes the same ones. ``read_labels`` and ``labelled`` read them back."""
    texts = images.select("image").distinct().join(label_lines(boxes), "image", "left")
    named = texts.select(label_path(F.col("image")).alias("label"), F.coalesce(F.concat("value", F.lit("\n")), F.lit("")).alias("value"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: set[str] = set()
        for batch in batches:
            for label, value in zip(batch.column("label").to_pylist(), batch.column("value").to_pylist(), strict=True):
                system, path = file_system(label)
                folder = path.rpartition("/")[0]
                if folder not in made:
                    system.create_dir(folder, recursive=True)
                    made.add(folder)
                with system.open_output_stream(path) as out:
                    out.write(value.encode())
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["n"])

    return named.mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def write_splits(split: DataFrame, folder: str, splits: tuple[str, ...] = ("train", "val", "test")) -> None:
    """``folder/<split>.txt``, one path a line, in order, for each of ``splits``, which ``dataset_config`` names; without rows, an empty file.
    Each split is written by one task, row by row, as its readers want one file."""
    spark = split.sparkSession
    parts = f"{folder}/.parts-{uuid.uuid4().hex}"
    own = split.where(F.col("split").isin(*splits)).select("split", F.col("path").alias("value"))
    own.repartition("split").sortWithinPartitions("split", "value").write.partitionBy("split").text(parts)
    jvm = spark.sparkContext._jvm
    path = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    system = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for name in splits:
        target = path(f"{folder}/{name}.txt")
        system.delete(target, False)
        found = [f.getPath() for f in system.globStatus(path(f"{parts}/split={name}/part-*")) or ()]
        if found:
            system.rename(found[0], target)
        else:
            system.create(target).close()
    system.delete(path(parts), True)


def write_report(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").json(path)


def dataset_config(classes: list[str], folder: str) -> str:
    """The dataset description that trainers read, as YAML."""
    rows = [f"path: {json.dumps(folder)}", *(f"{s}: splits/{s}.txt" for s in ("train", "val", "test")), "names:", *(f"  {i}: {json.dumps(c)}" for i, c in enumerate(classes))]
    return "\n".join(rows) + "\n"


def format_report(report: dict) -> str:
    """Text of a report: ``map50``, ``ap50`` and ``n_gt`` by class, ``image_level`` counts and rates, ``recall_by_size`` and
    ``n_by_size``. Numbers have three decimals, missing ones read nan."""
    f = lambda v: "nan" if v is None else f"{v:.3f}"
    level = report["image_level"]
    head = [f"mAP@0.5: {f(report['map50'])}", "", f"{'class':<12} AP@0.5   boxes"]
    rows = [f"{c:<12} {f(v):>6}   {report['n_gt'].get(c, 0)}" for c, v in report["ap50"].items()]
    rates = f"image level @conf {level['conf_thr']}: precision {f(level['precision'])}  recall {f(level['recall'])}  false-positive rate {f(level['fpr'])}"
    counts = " ".join(f"{k} {level[k]}" for k in ("tp", "fp", "fn", "tn"))
    sizes = "  ".join(f"{k} {f(v)} (n={report['n_by_size'].get(k, 0)})" for k, v in report["recall_by_size"].items())
    return "\n".join([*head, *rows, "", f"{rates}  ({counts})", f"recall by object size: {sizes}"])


def audit_text(source: dict, images: dict, classes: list[dict]) -> str:
    """Markdown of one source's audit: ``source`` (name, role, version, license), ``images`` (n_images, n_empty),
    ``classes`` (src_id, name, n_boxes, n_images, target; target "" is dropped, None unmapped)."""
    head = f"## {source['name']}  (role: {source['role']}, version {source['version']}, license: {source['license']})"
    rows = [f"| {c['src_id']} | {c['name']} | {c['n_boxes']} | {c['n_images']} | {'**UNMAPPED**' if c['target'] is None else c['target'] or 'drop'} |" for c in classes]
    return "\n".join([head, "", f"{images['n_images']} images, {images['n_empty']} with no boxes.", "", "| id | class name | boxes | images | maps to |", "| --- | --- | --- | --- | --- |", *rows, ""])
