"""Taxonomy remapping, audit and coverage of annotation tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracklake.functions.names import name_key, photo_stem, seeded


def remap(boxes: DataFrame, mapping: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """``boxes`` (source, name, ...) with ``target``, ``class_id`` and ``status``: mapped, dropped (the
    mapping's target is null) or unmapped (no entry). ``mapping`` holds source, name, target; names
    meet in lower case with white space collapsed.
    """
    m = mapping.select("source", name_key(F.col("name")).alias("_key"), "target", F.lit(True).alias("_found"))
    t = taxonomy.select(F.col("class").alias("target"), "class_id")
    out = boxes.withColumn("_key", name_key(F.col("name"))).join(m, ["source", "_key"], "left").join(t, "target", "left")
    status = F.when(F.col("_found").isNull(), "unmapped").when(F.col("target").isNull(), "dropped").when(F.col("class_id").isNull(), "unknown target").otherwise("mapped")
    return out.withColumn("status", status).drop("_key", "_found")


def unmapped(names: DataFrame, mapping: DataFrame) -> DataFrame:
    """Names of a source that its mapping does not mention."""
    m = mapping.select("source", name_key(F.col("name")).alias("_key"))
    return names.withColumn("_key", name_key(F.col("name"))).join(m, ["source", "_key"], "left_anti").select("source", "name").distinct()


def refuse_unmapped(names: DataFrame, mapping: DataFrame) -> None:
    """Raise if any name is unmapped, before anything is written."""
    found = unmapped(names, mapping).limit(20).collect()
    if found:
        raise ValueError("no mapping for " + ", ".join(f"{r.source}: {r.name}" for r in found))


def refuse_unknown_targets(mapping: DataFrame, taxonomy: DataFrame) -> None:
    """Raise if a mapping names a class that the taxonomy lacks."""
    known = taxonomy.select(F.col("class").alias("target"))
    found = mapping.where("target IS NOT NULL").join(known, "target", "left_anti").limit(20).collect()
    if found:
        raise ValueError("not in the taxonomy: " + ", ".join(f"{r.source}: {r.name} -> {r.target}" for r in found))


def chosen_sources(sources: DataFrame, only: list[str] | None = None) -> DataFrame:
    """The sources that are not to be skipped and, with ``only``, are named there."""
    used = sources.where("role <> 'skip'")
    return used.where(F.col("source").isin(*only)) if only else used


def usable(rows: DataFrame) -> DataFrame:
    """Rows to use, where a column says so; all of them where there is none."""
    return rows.where("use") if "use" in rows.columns else rows


def class_subset(boxes: DataFrame, classes: list[int]) -> DataFrame:
    return boxes.where(F.col("cls").isin(*classes))


def taxonomy_detections(pred: DataFrame, model_names: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """``pred`` with the model's class numbers replaced by the taxonomy's; classes whose name it lacks are left out.
    ``model_names`` holds cls and name, a row for each class of the model."""
    known = taxonomy.select(name_key(F.col("class")).alias("_key"), "class_id")
    own = model_names.select("cls", name_key(F.col("name")).alias("_key")).join(known, "_key").select("cls", "class_id")
    return pred.join(F.broadcast(own), "cls").withColumn("cls", F.col("class_id")).drop("class_id")


def split_class_boxes(split: DataFrame, per_image: DataFrame, classes: DataFrame) -> DataFrame:
    """``split, class, n`` for every split and class, 0 where there are none; ``split`` holds idx, split and
    negative, ``per_image`` idx and boxes_per_class. Negatives have no boxes to count."""
    counted = split.where("NOT negative").join(per_image, "idx").select("split", F.explode("boxes_per_class").alias("class", "n"))
    every = split.select("split").distinct().join(F.broadcast(classes.select("class")))
    sums = counted.groupBy("split", "class").agg(F.sum("n").alias("n"))
    return every.join(sums, ["split", "class"], "left").withColumn("n", F.coalesce("n", F.lit(0)).cast("bigint"))


def all_dropped(mapping: DataFrame) -> DataFrame:
    """Sources of which every class maps to null."""
    return mapping.groupBy("source").agg(F.every(F.col("target").isNull()).alias("_all")).where("_all").select("source")


def prompts(taxonomy: DataFrame, background: bool = False) -> DataFrame:
    """One row for each prompt, in class order; a class without prompts is its own. ``background`` adds an empty
    prompt of no class, for detectors that need one to leave things alone."""
    own = F.when(F.coalesce(F.size("prompts"), F.lit(0)) > 0, F.col("prompts")).otherwise(F.array("class"))
    rows = taxonomy.select("class_id", F.posexplode(own).alias("place", "prompt"))
    if not background:
        return rows
    return rows.unionByName(taxonomy.sparkSession.sql("SELECT CAST(NULL AS INT) AS class_id, 0 AS place, '' AS prompt"))


def audit(boxes: DataFrame) -> DataFrame:
    """Boxes and images of each class in each source."""
    return boxes.groupBy("source", "cls").agg(F.count("*").alias("n_boxes"), F.countDistinct("image").alias("n_images"))


def image_audit(images: DataFrame, boxes: DataFrame) -> DataFrame:
    """Images of each source, and how many hold no box."""
    n = boxes.groupBy("source", "image").agg(F.count("*").alias("n"))
    return images.join(n, ["source", "image"], "left").groupBy("source").agg(F.count("*").alias("n_images"), F.count_if(F.col("n").isNull()).alias("n_empty"))


def keep_images(boxes: DataFrame, keep_emptied: bool = False) -> DataFrame:
    """``source, image, n_old, n_new, kept``: an image all of whose boxes vanish goes, one that had none stays."""
    per = boxes.groupBy("source", "image").agg(F.count("old_cls").alias("n_old"), F.count("class_id").alias("n_new"))
    return per.withColumn("kept", (F.col("n_old") == 0) | (F.col("n_new") > 0) | F.lit(keep_emptied))


def run_summary(images: DataFrame) -> DataFrame:
    return images.groupBy("source").agg(F.count("*").alias("n_in"), F.count_if("kept").alias("n_kept"), F.count_if(~F.col("kept")).alias("n_dropped"))


def class_counts(boxes: DataFrame) -> DataFrame:
    """Each image's map from class to its boxes."""
    n = boxes.groupBy("image", "cls").agg(F.count("*").alias("n"))
    return n.groupBy("image").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("cls", "n")))).alias("boxes_per_class"), F.sum("n").alias("n_boxes"))


def coverage(boxes: DataFrame, classes: list[int]) -> DataFrame:
    """Boxes by source and class, zero where there are none; the classes are given, so no pass collects them."""
    return boxes.groupBy("source").agg(*(F.count_if(F.col("cls") == c).alias(f"c{c}") for c in classes))


def partial_classes(boxes: DataFrame, sources: DataFrame, classes: DataFrame) -> DataFrame:
    """Classes that some but not all of the train sources label (of all sources, if none is a train source)."""
    any_train = sources.agg(F.coalesce(F.max(F.col("role") == "train"), F.lit(False)).alias("some"))
    judged = sources.join(F.broadcast(any_train)).where(~F.col("some") | (F.col("role") == "train")).select("source")
    have = boxes.join(judged, "source", "left_semi").groupBy("cls").agg(F.countDistinct("source").alias("n_sources"))
    return have.join(F.broadcast(judged.agg(F.count("*").alias("n_all")))).join(classes, "cls").where("n_sources > 0 AND n_sources < n_all")


def sample_per_class(boxes: DataFrame, k: int, seed: int = 0) -> DataFrame:
    """k rows of each source and class by a seeded order; only k rows a group pass the exchange."""
    order = Window.partitionBy("source", "cls").orderBy(seeded(F.col("box_id"), seed), "box_id")
    return boxes.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def stem_edges(images: DataFrame) -> DataFrame:
    """Star edges from the first image of each (source, photo stem) to the others."""
    firsts = images.withColumn("stem", photo_stem(F.col("name")))
    low = firsts.groupBy("source", "stem").agg(F.min("idx").alias("src"), F.count("*").alias("n")).where("n > 1").drop("n")
    return firsts.join(low, ["source", "stem"]).where("idx > src").select("src", F.col("idx").alias("dst"))


def unique_names(images: DataFrame) -> DataFrame:
    """``out_name``, unique within a source: of a repeated name the first image keeps it, the others get the
    first of ``_1``, ``_2``, ... before the suffix that no image of the source has.

    Images come in the order of idx. Names already taken are taken for good, so the free numbers of a
    stem are those that no given name holds.
    """
    suffix = F.regexp_extract("name", r"(?<=.)(\.[^.]*)$", 1)
    rows = images.withColumn("_suffix", suffix).withColumn("_stem", F.expr("left(name, length(name) - length(_suffix))"))
    rows = rows.withColumn("_turn", F.row_number().over(Window.partitionBy("source", "name").orderBy("idx")) - 1)
    # numbers that given names already hold: of the stem "a", "a_3.jpg" holds 3
    base, number = F.regexp_extract("_stem", r"^(.*)_([1-9][0-9]{0,8})$", 1), F.regexp_extract("_stem", r"^(.*)_([1-9][0-9]{0,8})$", 2)
    held = rows.select("source", base.alias("_base"), "_suffix", number.try_cast("int").alias("_number")).where("_number IS NOT NULL")
    taken = held.groupBy("source", "_base", "_suffix").agg(F.sort_array(F.collect_set("_number")).alias("_taken")).withColumnRenamed("_base", "_stem")
    joined = rows.join(taken, ["source", "_stem", "_suffix"], "left")
    # the k-th free number: k plus the taken numbers up to it
    free = F.aggregate(F.coalesce("_taken", F.array().cast("array<int>")), F.col("_turn"), lambda k, t: k + (t <= k).cast("int"))
    name = F.when(F.col("_turn") == 0, F.col("name")).otherwise(F.concat("_stem", F.lit("_"), free.cast("string"), "_suffix"))
    return joined.withColumn("out_name", name).drop("_suffix", "_stem", "_turn", "_taken")


def candidates(images: DataFrame, confusers: list[str], person: str = "person") -> DataFrame:
    """Images whose labels hold a person and at least one confuser; ``reasons`` lists these."""
    found = F.array_sort(F.array_intersect("labels", F.array(*map(F.lit, confusers))))
    return images.where(F.array_contains("labels", person)).withColumn("reasons", found).where(F.size("reasons") > 0)


def candidate_pool(images: DataFrame, confusers: list[str], extra: DataFrame | None = None, most: int = 3000, seed: int = 0, drawn: float = 2.5, screened: float = 1.3) -> DataFrame:
    """``image, origin``: candidates for negatives. Of the images with a confuser, ``drawn`` times ``most`` are
    drawn by a seeded order, and of those that show a person as well, ``screened`` times ``most`` go on;
    ``extra`` (image) follows with the origin ``extra``. Limits are the sampling itself."""
    confused = images.where(F.size(F.array_intersect("labels", F.array(*map(F.lit, confusers)))) > 0).withColumn("_key", seeded(F.col("image"), seed))
    chosen = candidates(confused.orderBy("_key", "image").limit(int(drawn * most)), confusers).orderBy("_key", "image").limit(int(screened * most))
    out = chosen.select("image", F.concat(F.lit("coco:"), F.array_join("reasons", "|")).alias("origin"))
    return out if extra is None else out.unionByName(extra.select("image", F.lit("extra").alias("origin")))


def kept_negatives(judged: DataFrame, most: int = 3000, seed: int = 0) -> DataFrame:
    """Of judged candidates (image, origin, use) all extra ones, and of the others, in the seeded order, those
    up to the one with which ``most`` usable ones are reached. Counted by leading hash digits, so no task sorts all."""
    key = seeded(F.col("image"), seed)
    others = judged.where("origin <> 'extra'").withColumn("_key", key).withColumn("_head", F.substring("_key", 1, 3))
    heads = others.groupBy("_head").agg(F.count_if("use").alias("n"))
    before = Window.orderBy("_head").rowsBetween(Window.unboundedPreceding, -1)
    starts = heads.withColumn("_start", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    run = Window.partitionBy("_head").orderBy("_key", "image").rowsBetween(Window.unboundedPreceding, -1)
    counted = others.join(F.broadcast(starts), "_head").withColumn("_upto", F.col("_start") + F.coalesce(F.sum(F.col("use").cast("int")).over(run), F.lit(0)))
    return judged.where("origin = 'extra'").unionByName(counted.where(F.col("_upto") < most).drop("_key", "_head", "_start", "_upto"))


def latest_version(versions: DataFrame, path: Column) -> DataFrame:
    """The entry with the largest number after the last slash, for each source."""
    number = F.expr("try_cast(_last AS INT)")
    numbered = versions.withColumn("_path", path).withColumn("_last", F.substring_index("_path", "/", -1)).withColumn("number", number)
    return numbered.groupBy("source").agg(F.max("number").alias("version"))
