"""The registered queries of this subpackage: thin uses of its operators over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklake.llm._vectors import usable
from tracklake.llm.brown import brown_scores
from tracklake.llm.collocations import collocations
from tracklake.llm.conversation_repair import repaired
from tracklake.llm.line_dedup import fuzzy_lines
from tracklake.llm.mixing import mix_sources
from tracklake.llm.near_dedup import near_duplicates
from tracklake.llm.oracles import ORACLE_SQL
from tracklake.llm.rp_forest import forest_neighbours
from tracklake.llm.sanitise import KINDS, find_private, listed
from tracklake.llm.sentencepiece_bpe import encode_documents
from tracklake.llm.sharding import kd_shards
from tracklake.llm.toxicity import fit, score_documents
from tracklake.llm.va_file import exact_top_k
from tracklake.llm.vp_tree import simhash_groups

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _remainder(n: int):
    return F.crc32(F.col("doc_id").cast("bigint").cast("string")) % n


def op1_brown(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = brown_scores(_table(spark, sf_dir, "documents"), _remainder(7) != 2)
    return scored.withColumn("held_out", _remainder(7) == 2).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")


def op2_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = kd_shards(_table(spark, sf_dir, "documents"), 16)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op3_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = fuzzy_lines(_table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "line", "group", "kept")


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op6_sanitise(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_private(_table(spark, sf_dir, "documents"))
    base = F.concat(*(listed(k, F.col(k)) for k in KINDS))
    counts = [F.size(k).cast("bigint").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(F.array_join(base, ",").cast("binary"), 256).alias("base_sha256"), F.array_join(F.concat(base, listed("term", F.col("term"))), ",").alias("spans"))


def op7_va_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = F.transform("embedding", lambda x: F.floor(64 * x.cast("double")).cast("double"))
    vectors = _table(spark, sf_dir, "embeddings").where(usable(F.col("embedding"))).select("vec_id", whole.alias("vector"))
    found = exact_top_k(vectors, vectors.where("vec_id % 20 = 0"))
    return found.select("query_id", "rank", "vec_id", F.col("score").cast("bigint").alias("score"))


def op8_rp_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = F.col("embedding").cast("array<double>")
    vectors = _table(spark, sf_dir, "embeddings").where(usable(F.col("embedding"), zero=False)).select("vec_id", wide.alias("vector"))
    return forest_neighbours(vectors, vectors.where("vec_id % 20 = 0"))


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    field = fit(docs, _table(spark, sf_dir, "labels").where(_remainder(3) != 1))
    scored = score_documents(docs, field)
    return scored.select("doc_id", (_remainder(3) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), F.size("spans").alias("n_offending"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_table(spark, sf_dir, "documents"))


def op12_simhash_vp_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_groups(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("mark")), 16, "0").alias("fingerprint"), "component_id")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired(_table(spark, sf_dir, "conversations"))


__all__ = ["ORACLE_SQL", "QUERIES"]

QUERIES: dict[str, Query] = {
    "op1_brown": op1_brown,
    "op2_kd_shards": op2_kd_shards,
    "op3_fuzzy_lines": op3_fuzzy_lines,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_sanitise": op6_sanitise,
    "op7_va_file": op7_va_file,
    "op8_rp_forest": op8_rp_forest,
    "op9_mix_sources": op9_mix_sources,
    "op10_toxicity": op10_toxicity,
    "op11_collocations": op11_collocations,
    "op12_simhash_vp_tree": op12_simhash_vp_tree,
    "op13_conversation_repair": op13_conversation_repair,
}
