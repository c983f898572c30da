"""A training-data pipeline over ``documents``: five stages, each on all that the stage before kept.

Every stage takes and all but the last return the columns of ``documents``; other columns are left
out. A row is judged by itself: rows without doc_id, and rows that repeat a doc_id, get a key of
their own within the stage. An empty table passes through as an empty table.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklake.llm._text import TEXT_ROWS
from tracklake.llm.line_dedup import dropped_lines, fuzzy_lines, without_lines
from tracklake.llm.mixing import mixed
from tracklake.llm.near_dedup import near_duplicates
from tracklake.llm.sentencepiece_bpe import encode_documents
from tracklake.llm.toxicity import fit, score_documents
from tracklake.storage import discard, materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
REJECT = 0.7
WORD = r"[^\x20\x09-\x0D]"


def _dense(docs: DataFrame) -> DataFrame:
    """``docs``, written, with dense numbers from 0 as ``doc_id``, in the order of the given ones, rows without one last."""
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
    rows = docs.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    placed = materialize(rows, "sorted")  # the upper bits of ``at`` are the part, the lower ones the place in it
    starts, upto = [], 0
    for r in sorted(placed.groupBy(F.shiftright("at", 33).alias("part")).agg(F.count("*").alias("n")).collect()):
        starts.append((r.part, upto))
        upto += r.n
    table = docs.sparkSession.createDataFrame(starts, "part long, start long")  # a row for each part
    key = F.col("start") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    keyed = placed.join(F.broadcast(table), F.shiftright("at", 33) == F.col("part")).withColumn("doc_id", key).drop("at", "part", "start")
    keyed.written_to = placed.written_to
    return keyed


def _by_row(stage: Callable) -> Callable:
    """The stage on rows whose ``doc_id`` is a key of the row, with the given doc_id in ``given``. If some rows have no doc_id
    or share one, all get dense keys in the order of their ids, rows without one last; else the ids are the keys. So each row
    follows its own verdict, and of copies the smallest doc_id stays."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        docs = docs.select(*COLUMNS).withColumn("given", F.col("doc_id")).withColumn("doc_id", F.col("doc_id").cast("bigint"))
        keyed = None
        if not docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 OR doc_id IS NULL").isEmpty():
            docs = keyed = _dense(docs)
        out = stage(spark, docs, sf_dir).withColumn("doc_id", F.col("given")).select(*COLUMNS)
        if keyed is not None:
            out = materialize(out, "unkeyed")
            discard(keyed)
        return out

    return run


@_by_row
def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of 0.7 or more go; the field is fitted on the labelled documents
    among ``docs``, on all their labels: a labelled document may thus be judged by a field that has learned from it. Null and empty texts score as texts without toxic words; with labels of one kind
    only, nothing goes."""
    field = fit(docs.withColumn("doc_id", F.col("given")), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    toxic = materialize(score_documents(docs, field).where(F.col("score") >= REJECT).select("doc_id"), "toxic", TEXT_ROWS)
    return docs.join(toxic, "doc_id", "left_anti")


@_by_row
def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of a line, fuzzy ones too, are cut, and ``n_chars`` counted again. A document of
    which no word is left goes; null, empty and blank texts stay as they are."""
    dropped = materialize(dropped_lines(fuzzy_lines(docs)), "dropped")
    cut = without_lines(docs.withColumn("had", F.coalesce(F.col("text").rlike(WORD), F.lit(False))), dropped)
    return cut.where(~F.col("had") | F.col("text").rlike(WORD)).withColumn("n_chars", F.length("text").cast("bigint"))


@_by_row
def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, repeated rows included, the one with the smallest key stays; texts without words stay."""
    lost = materialize(near_duplicates(docs).where("NOT kept").select("doc_id"), "near-copies")
    return docs.join(lost, "doc_id", "left_anti")


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows are taken as often as the mix of sources says, up to three times. A null source is one of its
    own; rows that are equal are taken alike."""
    return mixed(docs.select(*COLUMNS))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, the number of ids of each row, and digests of the ids and of the text decoded from them; null is empty."""
    coded = encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", reject_toxic),
    ("line dedup", drop_repeated_lines),
    ("near dedup", keep_one_of_near_duplicates),
    ("mixing", mix_to_weights),
    ("encoding", encode),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again by the next."""
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, name.replace(" ", "-"), TEXT_ROWS)
            discard(last)
            last = docs
    return docs
