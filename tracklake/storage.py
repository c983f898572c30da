"""Cutting lineage through the folder that the whole cluster shares."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``. Where it is unset, a local session, whose executors
    are this process, gets a folder of its own; on a cluster, where each machine would write to its
    own disk, that is an error."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = f"file://{tempfile.mkdtemp(prefix='tracklake-')}"
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


@contextmanager
def _batches_of(spark: SparkSession, rows: int | None) -> Iterator[None]:
    """While a job runs, at most ``rows`` rows in a batch that goes to Python: whole texts are large rows, and a
    batch of them stands in the executor and in the worker at once."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    if rows is not None and int(before) > rows:
        spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def materialize(df: DataFrame, tag: str, batch_rows: int | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back; ``batch_rows`` bounds batches that go to Python.
    Rows of each value of the columns ``by`` are in a folder of their own, so a filter on these reads no others.

    The files outlive any executor, so a lost executor costs a re-read and no recomputation,
    and readers see a plan with known sizes, which lets adaptive execution choose joins by
    measured bytes.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    with _batches_of(spark, batch_rows):
        df.write.parquet(path, partitionBy=list(by) or None)
    table = spark.read.schema(df.schema).parquet(path)
    table = table.select(df.columns) if by else table
    table.written_to = path
    return table


def materialize_by(df: DataFrame, column: str, parts: int, tag: str, batch_rows: int | None = None) -> DataFrame:
    """As ``materialize``, as a table of ``parts`` buckets of ``column``: what groups by that column later
    reads each bucket in one task, without moving it again."""
    spark = df.sparkSession
    name, path = f"{tag}_{uuid.uuid4().hex}".replace("-", "_"), f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    with _batches_of(spark, batch_rows):
        df.repartition(parts, column).write.bucketBy(parts, column).option("path", path).format("parquet").saveAsTable(name)
    table = spark.table(name)
    table.written_to, table.table_name = path, name
    return table


def discard(*tables: DataFrame | None) -> None:
    """Delete tables of ``materialize`` that nothing reads any more, and let the context cleaner drop
    the shuffle files of the jobs that wrote them. None and tables from elsewhere are passed over."""
    jvm = None
    for table in tables:
        if (path := getattr(table, "written_to", None)) is not None:
            context = table.sparkSession.sparkContext
            jvm = context._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(context._jsc.hadoopConfiguration()).delete(where, True)
            table.written_to = None
            if name := getattr(table, "table_name", None):
                table.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
    if jvm is not None:
        gc.collect()
        jvm.System.gc()
