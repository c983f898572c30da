"""The curation run from end to end: unify sources, find copies, decide what to keep, split."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklake.functions.names import photo_stem
from tracklake.operators import annotations as A
from tracklake.operators import dedupe as D
from tracklake.sources import files
from tracklake.storage import materialize


@dataclass
class Curation:
    """The tables of a run."""

    manifest: DataFrame
    coverage: DataFrame
    summary: DataFrame
    grouped: DataFrame
    pairs_sample: DataFrame
    split: DataFrame


def unify(images: DataFrame, boxes: DataFrame, names: DataFrame, sources: DataFrame, mapping: DataFrame, taxonomy: DataFrame, only: list[str] | None = None, keep_emptied: bool = False, allow_unmapped: bool = False) -> tuple[DataFrame, DataFrame]:
    """All images of the chosen sources under the taxonomy, with what became of each, and their boxes.

    ``images`` holds idx, source, name; ``boxes`` source, image (an idx), name; ``names`` the class names of each
    source. Everything is validated before anything is made: a target outside the taxonomy raises, and so does
    a name without an entry unless ``allow_unmapped``, which drops its boxes.
    """
    chosen = A.chosen_sources(sources, only)
    used = mapping.join(chosen.select("source"), "source", "left_semi")
    A.refuse_unknown_targets(used, taxonomy)
    own_names = names.join(chosen.select("source"), "source", "left_semi")
    if not allow_unmapped:
        A.refuse_unmapped(own_names, used)
    mapped = materialize(A.remap(boxes.join(chosen.select("source"), "source", "left_semi"), used, taxonomy).select("image", "class_id", "target"), "mapped")
    per = mapped.groupBy("image").agg(F.count("*").alias("n_old"), F.count("class_id").alias("n_boxes"))
    counts = mapped.where("class_id IS NOT NULL").groupBy("image", "target").agg(F.count("*").alias("n"))
    counts = counts.groupBy("image").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("target", "n")))).alias("boxes_per_class"))
    rows = images.join(chosen.select("source", "role", "priority"), "source").join(per, images["idx"] == per["image"], "left").drop("image")
    rows = rows.join(counts, rows["idx"] == counts["image"], "left").drop("image")
    n_old, n_new = F.coalesce("n_old", F.lit(0)), F.coalesce("n_boxes", F.lit(0))
    rows = rows.select(
        "idx", "source", "role", "priority", "name", photo_stem(F.col("name")).alias("orig_stem"), n_new.alias("n_boxes"),
        F.coalesce("boxes_per_class", F.create_map().cast("map<string,bigint>")).alias("boxes_per_class"), (n_old == 0).alias("orig_empty"), ((n_old > 0) & (n_new == 0)).alias("emptied"),
    )
    rows = materialize(rows.withColumn("kept", F.lit(keep_emptied) | ~F.col("emptied")), "unified")
    return rows, mapped


def curate(images: DataFrame, boxes: DataFrame, names: DataFrame, sources: DataFrame, mapping: DataFrame, taxonomy: DataFrame, hashes: DataFrame, negatives: DataFrame, threshold: int = 6, val_frac: float = 0.1, seed: int = 0, **options) -> Curation:
    """One call for merging, deduplication and splitting. Copies are images whose hashes are near, and images of
    one photo by their names, together; ``hashes`` holds idx, h and mirror."""
    rows, mapped = unify(images, boxes, names, sources, mapping, taxonomy, **options)
    kept = rows.where("kept").drop("kept")
    named = A.unique_names(kept).withColumn("out_name", F.concat("source", F.lit("__"), "out_name"))
    manifest = materialize(named.withColumnRenamed("name", "orig_name"), "manifest")
    own = hashes.join(manifest.select("idx"), "idx", "left_semi")
    edges = D.hamming_edges(own, threshold).unionByName(A.stem_edges(kept.select("idx", "source", "name")))
    grouped = materialize(D.keep_policy(D.groups(manifest, edges)), "grouped")
    coverage = mapped.where("class_id IS NOT NULL").join(rows.select("idx", "source"), F.col("image") == F.col("idx")).groupBy("source", F.col("target").alias("class")).agg(F.count("*").alias("n"))
    sample = D.cross_source(D.hamming_pairs(own, threshold), manifest)
    split = D.assemble_splits(grouped.where("keep"), A.usable(negatives), val_frac=val_frac, seed=seed)
    return Curation(manifest, coverage, A.run_summary(rows), grouped, sample, split)


def write_curation(run: Curation, folder: str, form: str = "parquet") -> None:
    """The run's sinks: manifests before and after the decision, a sample of pairs, and the splits."""
    files.write_table(run.manifest, f"{folder}/manifest", form)
    files.write_table(run.grouped, f"{folder}/manifest_dedup", form)
    files.write_table(run.pairs_sample, f"{folder}/duplicates_sample", form)
    files.write_table(run.coverage, f"{folder}/coverage", form)
    files.write_table(run.split, f"{folder}/splits", form)
