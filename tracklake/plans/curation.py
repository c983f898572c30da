"""Queries on taxonomy, audit, duplicates and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracklake.functions.names import clip_name, hash_hex, label_path, name_key, photo_stem, safe_name
from tracklake.operators import annotations as A
from tracklake.operators import dedupe as D
from tracklake.plans import views as V
from tracklake.plans.run import curate, unify
from tracklake.plans.views import with_views
from tracklake.storage import materialize

PART = "SELECT DISTINCT p_type AS name FROM part"
MAP_SQL = "class_map(name, target, class_id) AS (VALUES ('standard', 'cigarette', 0), ('economy', 'vape', 1), ('medium', 'cigar', 2), ('promo', 'pipe', 3), ('small', NULL, NULL))"
FILES = "files AS (SELECT page_id AS idx, 'src' || (page_id % 3) AS source, 'IMG_' || (page_id % 40) || CASE WHEN page_id % 2 = 0 THEN '.rf.' || page_id || '.jpg' ELSE '.png' END AS name FROM pages)"
SIM = """words AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(string_split(regexp_replace(lower(trim(text)), '\\s+', ' ', 'g'), ' ')) AS w FROM documents),
bits AS MATERIALIZED (SELECT doc_id, ('0x' || substr(md5(w), 1, 16))::UBIGINT AS x FROM words),
sums AS MATERIALIZED (SELECT doc_id, i, sum(CASE WHEN (x >> i) & 1 = 1 THEN 1 ELSE -1 END) AS s FROM bits, range(64) r(i) GROUP BY ALL),
hashes AS MATERIALIZED (SELECT doc_id AS idx, sum(CASE WHEN s > 0 THEN (1::HUGEINT << i) ELSE 0 END)::UBIGINT AS h FROM sums GROUP BY ALL),
pairs AS (SELECT a.idx AS i, b.idx AS j, bit_count(xor(a.h, b.h))::INT AS d FROM hashes a JOIN hashes b ON a.idx < b.idx AND bit_count(xor(a.h, b.h)) <= 6)"""
COMPONENTS = """ends AS (SELECT i AS a, j AS b FROM pairs UNION ALL SELECT j, i FROM pairs),
reach(a, b) AS (SELECT a, a FROM ends UNION SELECT r.a, e.b FROM reach r JOIN ends e ON r.b = e.a),
comps AS (SELECT a AS node, min(b) AS component FROM reach GROUP BY a)"""
POLICY = """grouped AS (SELECT m.*, coalesce(c.component, m.idx) AS group_id FROM manifest m LEFT JOIN comps c ON m.idx = c.node),
per AS (SELECT group_id, count(DISTINCT source) > 1 AS mixed, count(DISTINCT role) > 1 AS both_roles FROM grouped GROUP BY 1),
leaky AS (SELECT g.*, mixed, mixed AND both_roles AND role = 'train' AS leak FROM grouped g JOIN per USING (group_id)),
alive AS (SELECT group_id, count(DISTINCT source) > 1 AS still, min(priority) AS least FROM leaky WHERE mixed AND NOT leak GROUP BY 1),
policy AS (SELECT l.idx, l.source, l.role, l.priority, l.group_id, CASE WHEN leak THEN 'test_leak' WHEN mixed AND still AND priority > least THEN 'cross_source_dup' ELSE '' END AS drop_reason
FROM leaky l LEFT JOIN alive a USING (group_id))"""
SPLIT = """kept AS (SELECT * FROM policy WHERE drop_reason = ''),
sizes AS (SELECT source, group_id, count(*) AS n, md5(group_id::VARCHAR || '|0') AS key FROM kept WHERE role = 'train' GROUP BY ALL),
runs AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY source ORDER BY key, group_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(n) OVER (PARTITION BY source) AS total FROM sizes),
train AS (SELECT k.idx, CASE WHEN before < 0.1 * total THEN 'val' ELSE 'train' END AS split FROM kept k JOIN runs r ON k.source = r.source AND k.group_id = r.group_id WHERE k.role = 'train')"""


def _names(spark, sf):
    return V.table(spark, sf, "part").select(F.lit("part").alias("source"), F.col("p_type").alias("name"))


def norm_names(spark, sf):
    return V.table(spark, sf, "part").groupBy(name_key(F.concat(F.lit("  "), "p_type", F.lit("  X "))).alias("name_key")).agg(F.count("*").alias("n"))


def remap_classes(spark, sf):
    out = A.remap(_names(spark, sf), V.part_map(spark), V.taxonomy(spark))
    return out.groupBy("name", "status", "class_id").agg(F.count("*").alias("n"))


def unmapped_classes(spark, sf):
    return A.unmapped(_names(spark, sf), V.part_map(spark)).select("name")


def _files(spark, sf):
    suffix = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit(".rf."), F.col("page_id").cast("string"), F.lit(".jpg"))).otherwise(".png")
    name = F.concat(F.lit("IMG_"), (F.col("page_id") % 40).cast("string"), suffix)
    return V.table(spark, sf, "pages").select(F.col("page_id").alias("idx"), F.concat(F.lit("src"), (F.col("page_id") % 3).cast("string")).alias("source"), name.alias("name"))


def photo_stems(spark, sf):
    return _files(spark, sf).select("idx", photo_stem(F.col("name")).alias("stem"))


def stem_edges(spark, sf):
    return A.stem_edges(_files(spark, sf))


def unique_names(spark, sf):
    return A.unique_names(_files(spark, sf).withColumn("name", F.regexp_replace("name", r"\.rf\.\d+", ""))).select("idx", "out_name")


def label_paths(spark, sf):
    return V.table(spark, sf, "pages").select("page_id", label_path(F.concat(F.lit("/data/images/a/images/p"), F.col("page_id").cast("string"), F.lit(".jpg"))).alias("label"))


def safe_names(spark, sf):
    return V.table(spark, sf, "pages").select("page_id", safe_name(F.col("url")).alias("name"), clip_name(F.col("url")).alias("clip"))


def _boxes(spark, sf):
    return V.boxes(spark, sf).withColumn("box_id", F.col("image") * 1000 + F.col("idx"))


def source_audit(spark, sf):
    return A.audit(_boxes(spark, sf))


def coverage(spark, sf):
    return A.coverage(_boxes(spark, sf), [0, 1, 2, 3, 4])


def partial_classes(spark, sf):
    b = _boxes(spark, sf).where("NOT (source = 'R' AND cls = 2)")
    sources = b.select("source").distinct().withColumn("role", F.when(F.col("source") == "N", "test").otherwise("train"))
    return A.partial_classes(b, sources, spark.createDataFrame([(i,) for i in range(5)], "cls int")).select("cls", "n_sources", "n_all")


def class_counts(spark, sf):
    return A.class_counts(_boxes(spark, sf)).select("image", "n_boxes", F.array_join(F.transform(F.array_sort(F.map_entries("boxes_per_class")), lambda e: F.concat_ws(":", e["key"], e["value"])), ",").alias("per_class"))


def run_summary(spark, sf):
    b = _boxes(spark, sf).select("source", "image", F.col("cls").alias("old_cls"), F.when(F.col("cls") < 3, F.col("cls")).alias("class_id"))
    return A.run_summary(A.keep_images(b))


def class_sample(spark, sf):
    return A.sample_per_class(_boxes(spark, sf), 24).select("source", "cls", "box_id", "place")


def empty_images(spark, sf):
    every = V.images(spark, sf).withColumn("source", F.lit("orders"))
    return A.image_audit(every, _boxes(spark, sf).withColumn("source", F.lit("orders")))


def _simhash(spark, sf):
    return D.text_simhash(V.table(spark, sf, "documents")).select(F.col("doc_id").alias("idx"), "h", F.lit(None).cast("bigint").alias("mirror"))


def text_hashes(spark, sf):
    return _simhash(spark, sf).select("idx", hash_hex(F.col("h")).alias("phash"))


def hamming_pairs(spark, sf):
    return D.hamming_pairs(materialize(_simhash(spark, sf), "simhash"), 6)


def duplicate_groups(spark, sf):
    return D.groups(V.manifest(spark, sf), D.hamming_edges(materialize(_simhash(spark, sf), "simhash")))


def components(spark, sf):
    return duplicate_groups(spark, sf).select("idx", "group_id")


def keep_policy(spark, sf):
    return D.keep_policy(duplicate_groups(spark, sf)).select("idx", "group_id", "drop_reason", "keep")


def dropped_by_reason(spark, sf):
    return D.keep_policy(duplicate_groups(spark, sf)).where("NOT keep").groupBy("drop_reason", "source").agg(F.count("*").alias("n"))


def cross_source_pairs(spark, sf):
    return D.cross_source(hamming_pairs(spark, sf), V.manifest(spark, sf)).select("i", "j", "source_i", "source_j")


def _kept(spark, sf):
    return materialize(D.keep_policy(duplicate_groups(spark, sf)).where("keep"), "kept")


def group_split(spark, sf):
    return D.group_split(_kept(spark, sf).where("role = 'train'"), 0.1).select("idx", "split")


def split_sizes(spark, sf):
    negatives = V.table(spark, sf, "pages").select(F.col("page_id").alias("idx"))
    return D.assemble_splits(_kept(spark, sf), negatives).groupBy("split", "negative").agg(F.count("*").alias("n"))


SHIP_MAP = [("air", "cigarette"), ("reg air", "cigarette"), ("rail", "vape"), ("ship", "cigar"), ("truck", "pipe"), ("fob", "smoke"), ("mail", None)]


KINDS = ("AIR", "REG AIR", "RAIL", "SHIP", "TRUCK", "FOB", "MAIL")


def _kind():
    return F.element_at(F.array(*map(F.lit, KINDS)), (F.col("l_partkey") % 7 + 1).cast("int"))


def _run_inputs(spark, sf):
    """Documents as images of many sources, their orders' line items as boxes, pages as negatives."""
    number = F.regexp_extract("source", r"(\d+)$", 1).cast("int")
    docs = V.table(spark, sf, "documents").select("doc_id", "source")
    plain = F.concat(F.lit("IMG_"), (F.col("doc_id") % 50).cast("string"))
    name = F.when(F.col("doc_id") % 5 == 0, F.concat(plain, F.lit(".jpg"))).when(F.col("doc_id") % 5 == 1, F.concat(plain, F.lit("_1.jpg")))
    name = F.coalesce(name, F.concat(F.lit("IMG_"), F.floor(F.col("doc_id") / 3).cast("string"), F.lit(".rf."), F.col("doc_id").cast("string"), F.lit(".jpg")))
    images = docs.select(F.col("doc_id").alias("idx"), "source", name.alias("name"))
    boxes = V.table(spark, sf, "lineitem").join(docs, F.col("l_orderkey") == F.col("doc_id")).select("source", F.col("doc_id").alias("image"), _kind().alias("name"))
    role = F.when(number >= 15, "test").when(number % 7 == 6, "skip").otherwise("train")
    sources = docs.select("source", role.alias("role"), (number % 4).alias("priority")).distinct()
    mapping = sources.select("source").join(F.broadcast(spark.createDataFrame(SHIP_MAP, "name string, target string")))
    hashes = materialize(_simhash(spark, sf), "simhash")
    negatives = V.table(spark, sf, "pages").select(F.col("page_id").alias("idx"), (F.col("page_id") % 4 != 0).alias("use"))
    return images, boxes, boxes.select("source", "name").distinct(), sources, mapping, V.taxonomy(spark), hashes, negatives


def _run(spark, sf):
    return curate(*_run_inputs(spark, sf))


def _per_class(column):
    return F.array_join(F.transform(F.array_sort(F.map_entries(column)), lambda e: F.concat_ws(":", e["key"], e["value"])), ",")


def curation_manifest(spark, sf):
    images, boxes, names, sources, mapping, taxonomy, _, _ = _run_inputs(spark, sf)
    rows, _ = unify(images, boxes, names, sources, mapping, taxonomy)
    return rows.select("idx", "source", "role", "priority", "orig_stem", "n_boxes", _per_class("boxes_per_class").alias("per_class"), "orig_empty", "emptied", "kept")


def curation_names(spark, sf):
    return _run(spark, sf).manifest.select("idx", "out_name")


def curation_run(spark, sf):
    run = _run(spark, sf)
    split = run.split.where("NOT negative").select("idx", "split")
    return run.grouped.join(split, "idx", "left").select("idx", "group_id", "drop_reason", "keep", "split")


def group_counts(spark, sf):
    return D.group_counts(_run(spark, sf).grouped)


def split_boxes(spark, sf):
    run = _run(spark, sf)
    return A.split_class_boxes(run.split, run.grouped.select("idx", "boxes_per_class"), V.taxonomy(spark))


def mirror_pairs(spark, sf):
    """Pairs of documents and of mirrored ones, whose code is that of a document with its halves swapped."""
    h = materialize(_simhash(spark, sf), "simhash")
    swapped = F.shiftleft("h", 32).bitwiseOR(F.shiftrightunsigned("h", 32))
    both = h.select("idx", "h", swapped.alias("mirror")).unionAll(h.where("idx % 5 = 0").select(F.col("idx") + 10_000_000, swapped, "h"))
    return D.hamming_pairs(both, 6)


def taxonomy_detections(spark, sf):
    model = spark.createDataFrame([(0, "Vape"), (1, "person"), (2, " cigar "), (3, "smoke"), (4, "lighter")], "cls int, name string")
    return A.taxonomy_detections(V.predictions(spark, sf), model, V.taxonomy(spark)).select("image", "det_idx", "cls", "conf")


def _labelled_images(spark, sf):
    kinds = F.array_sort(F.collect_set(F.lower(_kind())))
    return V.table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("image")).agg(kinds.alias("labels"))


def candidate_pool(spark, sf):
    extra = V.table(spark, sf, "pages").where("page_id % 9 = 0").select(F.col("page_id").alias("image"))
    pool = A.candidate_pool(_labelled_images(spark, sf).withColumn("labels", F.transform("labels", lambda x: F.when(x == "mail", "person").otherwise(x))), ["fob", "rail"], extra, most=200)
    return pool


def kept_negatives(spark, sf):
    judged = candidate_pool(spark, sf).withColumn("use", F.col("image") % 3 != 0)
    return A.kept_negatives(judged, 100)


QUERIES = {f.__name__: f for f in (norm_names, remap_classes, unmapped_classes, photo_stems, stem_edges, unique_names, label_paths, safe_names, source_audit, coverage, partial_classes, class_counts, run_summary, class_sample, empty_images, text_hashes, hamming_pairs, components, keep_policy, dropped_by_reason, cross_source_pairs, group_split, split_sizes, curation_manifest, curation_names, curation_run, group_counts, split_boxes, mirror_pairs, taxonomy_detections, candidate_pool, kept_negatives)}
KIND = "(['AIR', 'REG AIR', 'RAIL', 'SHIP', 'TRUCK', 'FOB', 'MAIL'])[l_partkey % 7 + 1]"
RUN = """src AS (SELECT DISTINCT source, CASE WHEN n >= 15 THEN 'test' WHEN n % 7 = 6 THEN 'skip' ELSE 'train' END AS role, n % 4 AS priority FROM (SELECT source, regexp_extract(source, '(\\d+)$', 1)::INT AS n FROM documents)),
files AS (SELECT doc_id AS idx, source, CASE doc_id % 5 WHEN 0 THEN 'IMG_' || (doc_id % 50) || '.jpg' WHEN 1 THEN 'IMG_' || (doc_id % 50) || '_1.jpg' ELSE 'IMG_' || (doc_id // 3) || '.rf.' || doc_id || '.jpg' END AS name FROM documents),
ship(name, target) AS (VALUES ('air', 'cigarette'), ('reg air', 'cigarette'), ('rail', 'vape'), ('ship', 'cigar'), ('truck', 'pipe'), ('fob', 'smoke'), ('mail', NULL)),
mapped AS (SELECT l_orderkey AS image, target FROM lineitem JOIN documents ON l_orderkey = doc_id LEFT JOIN ship ON lower({KIND}) = name),
counted AS (SELECT image, string_agg(target || ':' || n, ',' ORDER BY target) AS per_class FROM (SELECT image, target, count(*) AS n FROM mapped WHERE target IS NOT NULL GROUP BY ALL) GROUP BY 1),
per AS (SELECT image, count(*) AS n_old, count(target) AS n_new FROM mapped GROUP BY 1),
unified AS (SELECT idx, f.source, role, priority, name, CASE WHEN instr(name, '.rf.') > 0 THEN split_part(name, '.rf.', 1) ELSE regexp_replace(name, '\\.[^.]*$', '') END AS orig_stem, coalesce(n_new, 0) AS n_boxes, coalesce(per_class, '') AS per_class, coalesce(n_old, 0) = 0 AS orig_empty, coalesce(n_old, 0) > 0 AND n_new = 0 AS emptied FROM files f JOIN src USING (source) LEFT JOIN per ON idx = per.image LEFT JOIN counted ON idx = counted.image WHERE role <> 'skip'),
manifest AS (SELECT idx, source, role, priority, name, orig_stem, per_class FROM unified WHERE NOT emptied)""".replace("{KIND}", KIND)
RUN_LINKS = """both_ends AS (SELECT i, j FROM pairs SEMI JOIN manifest ON i = manifest.idx SEMI JOIN (SELECT idx FROM manifest) n ON j = n.idx UNION ALL SELECT low, idx FROM (SELECT idx, min(idx) OVER (PARTITION BY source, orig_stem) AS low FROM manifest) WHERE idx > low),
ends AS (SELECT i AS a, j AS b FROM both_ends UNION ALL SELECT j, i FROM both_ends),
reach(a, b) AS (SELECT a, a FROM ends UNION SELECT r.a, e.b FROM reach r JOIN ends e ON r.b = e.a),
comps AS (SELECT a AS node, min(b) AS component FROM reach GROUP BY a)"""
POOL = """shown AS (SELECT l_orderkey AS image, list_sort(list_distinct(list(CASE lower({KIND}) WHEN 'mail' THEN 'person' ELSE lower({KIND}) END))) AS labels FROM lineitem GROUP BY 1),
drawn AS (SELECT * FROM shown WHERE list_has_any(labels, ['fob', 'rail']) ORDER BY md5(image || '|0'), image LIMIT 500),
pool AS (SELECT image, 'coco:' || array_to_string(list_filter(labels, lambda x: x IN ('fob', 'rail')), '|') AS origin FROM (SELECT * FROM drawn WHERE list_contains(labels, 'person') ORDER BY md5(image || '|0'), image LIMIT 260) UNION ALL SELECT page_id, 'extra' FROM pages WHERE page_id % 9 = 0)""".replace("{KIND}", KIND)
STEM = "CASE WHEN instr(name, '.rf.') > 0 THEN split_part(name, '.rf.', 1) ELSE regexp_replace(name, '\\.[^.]*$', '') END"
ORACLE_SQL = {
    "norm_names": "SELECT regexp_replace(lower(trim('  ' || p_type || '  X ')), '\\s+', ' ', 'g') AS name_key, count(*) AS n FROM part GROUP BY 1",
    "remap_classes": f"WITH {MAP_SQL} SELECT p_type AS name, CASE WHEN m.name IS NULL THEN 'unmapped' WHEN m.target IS NULL THEN 'dropped' ELSE 'mapped' END AS status, m.class_id::INT AS class_id, count(*) AS n FROM part p LEFT JOIN class_map m ON lower(p.p_type) = m.name GROUP BY ALL",
    "unmapped_classes": f"WITH {MAP_SQL} SELECT DISTINCT p_type AS name FROM part WHERE lower(p_type) NOT IN (SELECT name FROM class_map)",
    "photo_stems": f"WITH {FILES} SELECT idx, {STEM} AS stem FROM files",
    "stem_edges": f"WITH {FILES}, s AS (SELECT *, min(idx) OVER (PARTITION BY source, {STEM}) AS src FROM files) SELECT src, idx AS dst FROM s WHERE idx > src",
    "unique_names": f"WITH {FILES}, plain AS (SELECT idx, source, regexp_replace(name, '\\.rf\\.\\d+', '') AS name FROM files), t AS (SELECT *, row_number() OVER (PARTITION BY source, name ORDER BY idx) - 1 AS k FROM plain) SELECT idx, CASE WHEN k = 0 THEN name ELSE regexp_replace(name, '\\.[^.]*$', '') || '_' || k || regexp_extract(name, '\\.[^.]*$') END AS out_name FROM t",
    "label_paths": "SELECT page_id, '/data/images/a/labels/p' || page_id || '.txt' AS label FROM pages",
    "safe_names": "SELECT page_id, left(regexp_replace(url, '[^A-Za-z0-9]+', '_', 'g'), 40) AS name, regexp_replace(regexp_replace(regexp_extract(url, '[^/]*$'), '(.)\\.[^.]*$', '\\1'), '[^A-Za-z0-9_-]+', '_', 'g') AS clip FROM pages",
    "source_audit": with_views("SELECT source, cls, count(*) AS n_boxes, count(DISTINCT image) AS n_images FROM boxes GROUP BY ALL", "boxes"),
    "coverage": with_views("SELECT source, " + ", ".join(f"count(*) FILTER (cls = {c}) AS c{c}" for c in range(5)) + " FROM boxes GROUP BY 1", "boxes"),
    "partial_classes": with_views("SELECT cls, count(DISTINCT source) AS n_sources, (SELECT count(DISTINCT source) FROM boxes WHERE source <> 'N') AS n_all FROM boxes WHERE source <> 'N' AND NOT (source = 'R' AND cls = 2) GROUP BY 1 HAVING n_sources < n_all", "boxes"),
    "class_counts": with_views("SELECT image, sum(n)::BIGINT AS n_boxes, string_agg(cls || ':' || n, ',' ORDER BY cls) AS per_class FROM (SELECT image, cls, count(*) AS n FROM boxes GROUP BY ALL) GROUP BY 1", "boxes"),
    "run_summary": with_views("SELECT source, count(*) AS n_in, count(*) FILTER (n_new > 0) AS n_kept, count(*) FILTER (n_new = 0) AS n_dropped FROM (SELECT source, image, count(*) FILTER (cls < 3) AS n_new FROM boxes GROUP BY ALL) GROUP BY 1", "boxes"),
    "class_sample": with_views("SELECT source, cls, image * 1000 + idx AS box_id, row_number() OVER (PARTITION BY source, cls ORDER BY md5((image * 1000 + idx) || '|0'), image * 1000 + idx)::INT AS place FROM boxes QUALIFY place <= 24", "boxes"),
    "empty_images": "SELECT 'orders' AS source, count(*) AS n_images, count(*) FILTER (o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)) AS n_empty FROM orders",
    "text_hashes": f"WITH {SIM} SELECT idx, printf('%016x', h) AS phash FROM hashes",
    "hamming_pairs": f"WITH {SIM} SELECT i, j, d FROM pairs",
    "components": f"WITH RECURSIVE {SIM}, {COMPONENTS} SELECT doc_id AS idx, coalesce(component, doc_id) AS group_id FROM documents LEFT JOIN comps ON doc_id = node",
    "keep_policy": f"WITH RECURSIVE {SIM}, {COMPONENTS}, manifest AS ({V.SQL['manifest']}), {POLICY} SELECT idx, group_id, drop_reason, drop_reason = '' AS keep FROM policy",
    "dropped_by_reason": f"WITH RECURSIVE {SIM}, {COMPONENTS}, manifest AS ({V.SQL['manifest']}), {POLICY} SELECT drop_reason, source, count(*) AS n FROM policy WHERE drop_reason <> '' GROUP BY ALL",
    "cross_source_pairs": f"WITH {SIM} SELECT i, j, a.source AS source_i, b.source AS source_j FROM pairs JOIN documents a ON i = a.doc_id JOIN documents b ON j = b.doc_id WHERE a.source <> b.source ORDER BY i, j LIMIT 300",
    "group_split": f"WITH RECURSIVE {SIM}, {COMPONENTS}, manifest AS ({V.SQL['manifest']}), {POLICY}, {SPLIT} SELECT idx, split FROM train",
    "split_sizes": f"""WITH RECURSIVE {SIM}, {COMPONENTS}, manifest AS ({V.SQL['manifest']}), {POLICY}, {SPLIT}, base AS (SELECT idx, split FROM train UNION ALL SELECT idx, 'test' FROM kept WHERE role = 'test'),
        placed AS (SELECT page_id, row_number() OVER (ORDER BY md5(page_id || '|0'), page_id) AS place, round_even(0.2 * count(*) OVER (), 0) AS n_test, floor(0.1 * (SELECT count(*) FROM base WHERE split = 'train')) AS n_train FROM pages)
        SELECT split, false AS negative, count(*) AS n FROM base GROUP BY ALL UNION ALL SELECT CASE WHEN place <= n_test THEN 'test' ELSE 'train' END AS split, true, count(*) FROM placed WHERE place <= n_test + n_train GROUP BY ALL""",
    "curation_manifest": f"WITH {RUN} SELECT idx, source, role, priority, orig_stem, n_boxes, per_class, orig_empty, emptied, NOT emptied AS kept FROM unified",
    "curation_names": f"""WITH {RUN}, parted AS (SELECT *, regexp_replace(name, '\\.[^.]*$', '') AS stem, row_number() OVER (PARTITION BY source, name ORDER BY idx) - 1 AS turn FROM manifest),
        taken AS (SELECT source, regexp_extract(stem, '^(.*)_([1-9][0-9]*)$', 1) AS stem, list(DISTINCT regexp_extract(stem, '^(.*)_([1-9][0-9]*)$', 2)::INT) AS held FROM parted WHERE regexp_matches(stem, '^(.*)_([1-9][0-9]*)$') GROUP BY ALL)
        SELECT idx, source || '__' || CASE WHEN turn = 0 THEN name ELSE stem || '_' || (list_filter(range(1, turn + len(coalesce(held, [])) + 1), lambda x: NOT list_contains(coalesce(held, []), x::INT))[turn]) || '.jpg' END AS out_name FROM parted LEFT JOIN taken USING (source, stem)""",
    "curation_run": f"""WITH RECURSIVE {SIM}, {RUN}, {RUN_LINKS}, {POLICY.replace("per AS", "per_group AS").replace("JOIN per USING", "JOIN per_group USING")}, {SPLIT}, base AS (SELECT idx, split FROM train UNION ALL SELECT idx, 'test' FROM kept WHERE role = 'test')
        SELECT idx, group_id, drop_reason, drop_reason = '' AS keep, split FROM policy LEFT JOIN base USING (idx)""",
    "group_counts": f"""WITH RECURSIVE {SIM}, {RUN}, {RUN_LINKS}, {POLICY.replace("per AS", "per_group AS").replace("JOIN per USING", "JOIN per_group USING")} SELECT count(*) AS n_images, count(DISTINCT group_id) AS n_groups, count(*) FILTER (drop_reason = '') AS n_kept FROM policy""",
    "split_boxes": f"""WITH RECURSIVE {SIM}, {RUN}, {RUN_LINKS}, {POLICY.replace("per AS", "per_group AS").replace("JOIN per USING", "JOIN per_group USING")}, {SPLIT}, base AS (SELECT idx, split FROM train UNION ALL SELECT idx, 'test' FROM kept WHERE role = 'test')
        SELECT s.split, c.class, count(m.image)::BIGINT AS n FROM (SELECT DISTINCT split FROM base) s CROSS JOIN (VALUES ('cigarette'), ('vape'), ('cigar'), ('pipe'), ('smoke')) c(class) LEFT JOIN (SELECT split, image, target FROM base JOIN mapped ON idx = image) m ON m.split = s.split AND m.target = c.class GROUP BY ALL""",
    "mirror_pairs": f"""WITH {SIM}, swapped AS (SELECT idx, h, ((h::HUGEINT << 32) & 18446744069414584320::HUGEINT)::UBIGINT | (h >> 32) AS m FROM hashes),
        coded AS (SELECT idx, h, m FROM swapped UNION ALL SELECT idx + 10000000, m, h FROM swapped WHERE idx % 5 = 0)
        SELECT a.idx AS i, b.idx AS j, least(bit_count(xor(a.h, b.h)), bit_count(xor(a.m, b.h)))::INT AS d FROM coded a JOIN coded b ON a.idx < b.idx AND least(bit_count(xor(a.h, b.h)), bit_count(xor(a.m, b.h))) <= 6""",
    "taxonomy_detections": with_views("SELECT image, det_idx, CASE cls WHEN 0 THEN 1 WHEN 2 THEN 2 ELSE 4 END::INT AS cls, conf FROM pred WHERE cls IN (0, 2, 3)", "pred"),
    "candidate_pool": f"WITH {POOL} SELECT * FROM pool",
    "kept_negatives": f"WITH {POOL}, judged AS (SELECT *, image % 3 <> 0 AS use FROM pool) SELECT image, origin, use FROM (SELECT *, coalesce(sum(use::INT) OVER (ORDER BY md5(image || '|0'), image ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS upto FROM judged WHERE origin <> 'extra') WHERE upto < 100 UNION ALL SELECT * FROM judged WHERE origin = 'extra'",
}
