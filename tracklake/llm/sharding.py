"""K-d tree partitioning of documents by weighted medians of their metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracklake.llm._lookup import lookup
from tracklake.storage import discard, materialize

CODE_BITS, HASH_BITS, STEP = 20, 40, 10
KEY_BITS = CODE_BITS + HASH_BITS


def default_dimensions() -> dict[str, Column]:
    """Source, language, and size in steps of 1/64 octave."""
    return {"source": F.col("source").cast("string"), "lang": F.col("lang").cast("string"), "size": F.floor(F.log2(F.col("size").cast("double")) * 64).cast("bigint")}


def kd_shards(docs: DataFrame, shards: int | None = 16, target_bytes: int | None = None, dimensions: dict[str, Column] | None = None) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for every row of ``docs`` (doc_id, text and the dimensions' columns).

    A dimension's values, in their order, become coordinates by their share of the bytes: a value's
    coordinate is the middle of its stretch of the running sum of bytes, so a dimension on which a
    node holds one value has no width there, whatever its type. The tree splits every node that
    stands for more than one shard at the median of its bytes (or, for an odd number of shards, at
    the fitting share) along the dimension that is widest in the node. Rows with equal coordinates
    are ordered by a hash of doc_id and text, and repeats of one row by a hash of their number as well, so
    that a value that a third of the rows share is split too, be it a row. All nodes of a level are split together: a histogram of at most 1,024 cells a node finds
    the cell of the median, and only that cell is refined, until it holds one document. Sizes of
    shards so differ by a few documents at most. Give ``shards``, or ``target_bytes`` with
    ``shards=None``. Distinct values of a dimension are ranked in one task: bin finer ones, as size is.

    Null texts have size 1 and checksum 0; null metadata is a value of its own, the first. Rows may share a
    doc_id or have none. An empty table gives no rows. Other columns are ignored.
    """
    dimensions = dimensions or default_dimensions()
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.withColumn("size", (F.octet_length(text) + 1).cast("bigint"))
    own = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("bigint").cast("string"), F.lit("")), text).cast("binary"))
    values = [c.alias(f"value_{i}") for i, c in enumerate(dimensions.values())]
    rows = materialize(rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), "size", F.crc32(text).alias("text_crc32"), own.alias("own"), *values), "valued-rows")
    numbered, spent = _told_apart(rows)
    spread = F.conv(F.substring(F.when(F.col("number") == 1, F.col("own")).otherwise(F.md5(F.concat_ws(":", "own", "number"))), 1, 10), 16, 10).cast("bigint")
    coded, codes = numbered.withColumn("spread", spread).drop("own", "number"), []
    for i in range(len(values)):
        codes.append(materialize(_coordinates(rows, f"value_{i}", f"code_{i}"), "coordinates"))
        coded = coded.join(codes[i].withColumnRenamed(f"value_{i}", f"own_{i}"), F.col(f"value_{i}").eqNullSafe(F.col(f"own_{i}"))).drop(f"value_{i}", f"own_{i}")
    coded = materialize(coded.withColumn("node", F.lit(0).cast("bigint")), "rows")
    discard(rows, *spent, *codes)
    rows = coded
    if target_bytes:
        total = rows.agg(F.sum("size")).first()[0] or 0
        shards = max(1, -(-total // target_bytes))
    leaves = {0: shards}
    while any(n > 1 for n in leaves.values()):
        rows, leaves = _split(rows, leaves, len(codes))
    return _slots(rows)


def _told_apart(rows: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Adds ``number``, which counts the rows that have one ``own``, from 1, and the tables that are read for it.
    Repeats are counted within the parts of a written table first, so that no task holds all repeats of a row."""
    repeated = materialize(rows.groupBy("own").agg(F.count("*").alias("n")).where("n > 1").select("own", F.lit(True).alias("again")), "repeated")
    if repeated.isEmpty():
        return rows.withColumn("number", F.lit(1).cast("bigint")), [repeated]
    found, hot = lookup(rows, repeated, ["own"])
    marked = materialize(found.withColumn("part", F.spark_partition_id()), "marked")
    again = marked.where("again")
    upto = Window.partitionBy("own").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialize(again.groupBy("own", "part").agg(F.count("*").alias("n")).select("own", "part", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("start")), "starts")
    place = F.row_number().over(Window.partitionBy("own", "part").orderBy("size"))
    many = again.withColumn("place", place).join(starts, ["own", "part"]).withColumn("number", F.col("place") + F.col("start"))
    return marked.where("again IS NULL").withColumn("number", F.lit(1).cast("bigint")).select(*rows.columns, "number").unionAll(many.select(*rows.columns, "number")), [repeated, hot, marked, starts]


def _coordinates(rows: DataFrame, value: str, code: str) -> DataFrame:
    """``value`` with its ``code``, from 0 to 2**20 - 1."""
    upto = Window.orderBy(F.col(value).asc_nulls_first())
    totals = rows.groupBy(value).agg(F.sum("size").alias("own"))
    summed = totals.withColumn("upto", F.sum("own").over(upto)).withColumn("whole", F.sum("own").over(Window.partitionBy()))
    middle = (2 * F.col("upto") - F.col("own")).cast("double") / (2 * F.col("whole"))
    return summed.select(value, F.least(F.lit((1 << CODE_BITS) - 1), F.floor(middle * (1 << CODE_BITS))).cast("bigint").alias(code))


def _table(spark: SparkSession, values: list[tuple[int, ...]], names: str) -> DataFrame:
    """A table of whole numbers as a literal of the plan: no Python worker, no task."""
    rows = ", ".join("(" + ", ".join(f"{int(x)}L" for x in v) + ")" for v in values) or "(" + ", ".join(["0L"] * len(names.split(","))) + ")"
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t({names})" + ("" if values else " WHERE false"))


def _split(rows: DataFrame, leaves: dict[int, int], n_codes: int):
    """One level of the tree. Nodes are named by the first shard under them; all that the driver holds is bounded by the number of shards times 1,024."""
    spark = rows.sparkSession
    spans = [f(f"code_{i}").alias(f"{name}{i}") for i in range(n_codes) for name, f in (("lo", F.min), ("hi", F.max))]
    found = {r.node: r for r in rows.groupBy("node").agg(F.sum("size").alias("size"), *spans).collect()}
    axis, need = {}, {}
    for node, n in leaves.items():
        if n > 1 and node in found:
            r = found[node]
            axis[node] = max(range(n_codes), key=lambda i: (r[f"hi{i}"] - r[f"lo{i}"], -i))
            need[node] = r.size * (n // 2) / n
    prefix = dict.fromkeys(axis, 0)
    cut: dict[int, int] = {}
    chosen = F.col("code_0")
    for i in range(1, n_codes):
        chosen = F.when(F.col("axis") == i, F.col(f"code_{i}")).otherwise(chosen)
    key = chosen * (1 << HASH_BITS) + F.col("spread")
    plan = _table(spark, list(axis.items()), "node, axis")
    keyed = materialize(rows.join(F.broadcast(plan), "node").select("node", "size", key.alias("key")), "keyed") if axis else None
    for shift in range(KEY_BITS - STEP, -1, -STEP):
        if not prefix:
            break
        at = _table(spark, list(prefix.items()), "node, prefix")
        inside = keyed.withColumn("prefix", F.shiftrightunsigned("key", shift + STEP)).join(F.broadcast(at), ["node", "prefix"])
        cells = inside.groupBy("node", F.shiftrightunsigned("key", shift).alias("cell")).agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
        by_node: dict[int, list] = {}
        for r in cells:
            by_node.setdefault(r.node, []).append((r.cell, r.size, r.n))
        for node, own in by_node.items():
            own.sort()
            for cell, size, n in own:
                if size > need[node] or cell == own[-1][0]:
                    break
                need[node] -= size
            prefix[node] = cell
            if n == 1 or shift == 0:
                cut[node] = (cell + (2 * need[node] >= size)) << shift
                del prefix[node]
    moves = [(node, axis[node], cut[node], node + leaves[node] // 2) for node in axis]
    plan = _table(spark, moves, "node, axis, cut, right")
    joined = rows.join(F.broadcast(plan), "node", "left")
    node = F.when(F.col("cut").isNotNull() & (key >= F.col("cut")), F.col("right")).otherwise(F.col("node"))
    moved = materialize(joined.withColumn("node", node).drop("axis", "cut", "right"), "rows")
    discard(rows, keyed)
    rows = moved
    deeper = {}
    for node, n in leaves.items():
        deeper[node] = n // 2 if n > 1 else n
        if n > 1:
            deeper[node + n // 2] = n - n // 2
    return rows, deeper


def _slots(rows: DataFrame, chunks_bits: int = 10) -> DataFrame:
    """Number the rows of each shard from 0 by counting chunks of the hash, so that no task sorts a whole shard."""
    rows = rows.withColumn("chunk", F.shiftrightunsigned("spread", HASH_BITS - chunks_bits))
    counts = rows.groupBy("node", "chunk").agg(F.count("*").alias("n"))
    before = Window.partitionBy("node").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialize(counts.select("node", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")), "starts")
    own = Window.partitionBy("node", "chunk").orderBy("spread", "doc_id", "size", "text_crc32")
    numbered = rows.withColumn("place", F.row_number().over(own) - 1).join(starts, ["node", "chunk"])
    return numbered.select("doc_id", "size", "text_crc32", F.col("node").cast("int").alias("shard"), (F.col("start") + F.col("place")).cast("bigint").alias("slot"))
