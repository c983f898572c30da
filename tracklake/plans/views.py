"""Role views: the shared tables read as observations, manifests, hashes, boxes and images."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CLASSES = [("cigarette", True), ("vape", True), ("cigar", True), ("pipe", True), ("smoke", False)]
TYPES = ["click", "view", "signup", "purchase", "error"]
PART_MAP = [("STANDARD", "cigarette"), ("ECONOMY", "vape"), ("MEDIUM", "cigar"), ("PROMO", "pipe"), ("SMALL", None)]
OBJECTS = [0, 1, 2, 3]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def taxonomy(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, c, o) for i, (c, o) in enumerate(CLASSES)], "class_id int, class string, is_object boolean")


def part_map(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("part", n, t) for n, t in PART_MAP], "source string, name string, target string")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a (track, hour): the last event of the hour, with a distance, a class and a confidence."""
    e = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("track"), F.expr("timestampdiff(HOUR, TIMESTAMP_NTZ'2024-01-01 00:00:00', ts)").cast("bigint").alias("step"), "event_id", "event_type", "value"
    )
    last = e.groupBy("track", "step").agg(F.max(F.struct("event_id", "event_type", "value")).alias("x"))
    cls = F.array_position(F.array(*map(F.lit, TYPES)), F.col("x.event_type")) - 1
    conf = (F.col("x.event_id") * 37 % 100) / 100
    return last.select("track", "step", F.least(F.col("x.value") / 50, F.lit(3.0)).alias("d"), cls.cast("int").alias("cls"), conf.alias("conf"), F.when(cls < 4, conf).otherwise(0.0).alias("obj"))


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.regexp_extract("source", r"(\d+)$", 1).cast("int")
    role = F.when(number >= 15, "test").otherwise("train")
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("idx"), "source", role.alias("role"), (number % 4).alias("priority"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    q, k = F.col("l_quantity"), F.col("l_linenumber")
    x1, y1 = (F.col("l_partkey") * 13 % 400).cast("double"), (F.col("l_suppkey") * 29 % 300).cast("double")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("image"), (k % 5).alias("cls"), F.col("l_returnflag").alias("source"), "l_returnflag", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        x1.alias("x1"), y1.alias("y1"), (x1 + 8 + 4 * q).alias("x2"), (y1 + 8 + 17 * k).alias("y2"), F.round(F.col("l_tax") * 100).cast("int").alias("tax"), F.round(F.col("l_discount") * 100).cast("int").alias("disc"),
    )


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All boxes with their number within the image; equal rows are told apart by nothing and so count in any order."""
    from pyspark.sql import Window

    order = Window.partitionBy("image").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "tax", "disc")
    return _lines(spark, sf_dir).withColumn("idx", F.row_number().over(order))


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boxes(spark, sf_dir).where("l_returnflag <> 'R'").select("image", F.col("idx").alias("gt_idx"), "cls", "x1", "y1", "x2", "y2")


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    shift = (F.col("tax") * 2).cast("double")
    b = boxes(spark, sf_dir).where("tax < 7")
    return b.select("image", F.col("idx").alias("det_idx"), "cls", (F.col("disc") / 10).alias("conf"), (F.col("x1") + shift).alias("x1"), "y1", (F.col("x2") + shift).alias("x2"), "y2")


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("image"))


SQL = {
    "observations": """SELECT user_id AS track, date_sub('hour', TIMESTAMP '2024-01-01', ts)::BIGINT AS step, event_id, event_type, value FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id, date_sub('hour', TIMESTAMP '2024-01-01', ts) ORDER BY event_id DESC) = 1""",
    "obs": """SELECT track, step, least(value / 50, 3.0) AS d, (list_position(['click','view','signup','purchase','error'], event_type) - 1)::INT AS cls,
        (event_id * 37 % 100) / 100 AS conf, CASE WHEN event_type <> 'error' THEN (event_id * 37 % 100) / 100 ELSE 0.0 END AS obj FROM observations""",
    "manifest": """SELECT doc_id AS idx, source, CASE WHEN regexp_extract(source, '(\\d+)$', 1)::INT >= 15 THEN 'test' ELSE 'train' END AS role, regexp_extract(source, '(\\d+)$', 1)::INT % 4 AS priority FROM documents""",
    "boxes": """SELECT *, row_number() OVER (PARTITION BY image ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag, tax, disc)::INT AS idx FROM (
        SELECT l_orderkey AS image, l_linenumber % 5 AS cls, l_returnflag AS source, l_returnflag, l_partkey, l_suppkey, l_linenumber, l_quantity, (l_partkey * 13 % 400)::DOUBLE AS x1, (l_suppkey * 29 % 300)::DOUBLE AS y1,
        (l_partkey * 13 % 400)::DOUBLE + 8 + 4 * l_quantity AS x2, (l_suppkey * 29 % 300)::DOUBLE + 8 + 17 * l_linenumber AS y2, round(l_tax * 100)::INT AS tax, round(l_discount * 100)::INT AS disc FROM lineitem)""",
    "truth": "SELECT image, idx AS gt_idx, cls, x1, y1, x2, y2 FROM boxes WHERE l_returnflag <> 'R'",
    "pred": "SELECT image, idx AS det_idx, cls, disc / 10 AS conf, x1 + tax * 2 AS x1, y1, x2 + tax * 2 AS x2, y2 FROM boxes WHERE tax < 7",
    "images": "SELECT o_orderkey AS image FROM orders",
}
NEEDS = {"obs": ["observations"], "truth": ["boxes"], "pred": ["boxes"]}


def with_views(body: str, *names: str, recursive: bool = False, more: str = "") -> str:
    """``body`` under the named views; ``more`` holds further table expressions."""
    order: list[str] = []
    for n in names:
        order += [x for x in (*NEEDS.get(n, []), n) if x not in order]
    ctes = [f"{n} AS ({SQL[n]})" for n in order] + ([more] if more else [])
    return f"WITH {'RECURSIVE ' if recursive else ''}{', '.join(ctes)} {body}" if ctes else body
