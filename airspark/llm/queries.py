"""The registered queries of this package: each operator over its whole table, and its DuckDB SQL if any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (conversation_repair, hard_negatives, jaccard_join, line_dedup, oracle_sql, packing, piece_codec, quality_rank,
               quality_rules, shard_tree, token_counts, topk_search, toxicity, url_rules)
from .common import read_table


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"), "byte_bpe_50k.json")


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_ids, ids, and the text decoded from them."""
    return piece_codec.round_trip(read_table(spark, sf_dir, "documents"), "piece_bpe_32k.model")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(read_table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, text without repeated later runs, removed_lines, removed_words."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.clean(docs, report=True)


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rank.score(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (jaccard_join.group_documents(read_table(spark, sf_dir, "documents"), words=4, percent=85)
            .select("doc_id", "n_shingles", "component_id"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), "word_bpe_49k.json", capacity=2048)


def op9_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(read_table(spark, sf_dir, "embeddings"), lambda i: i % 50 == 0, k=5)


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(read_table(spark, sf_dir, "pages"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = conversation_repair.damage(read_table(spark, sf_dir, "conversations"))
    return conversation_repair.repair(damaged, copies=F.col("copies"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(read_table(spark, sf_dir, "embeddings"), lambda i: i % 50 == 0, label_col=label)


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_tree.assign(read_table(spark, sf_dir, "documents"), shard_tree.tree_of(24), shard_tree.tree_of(25))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_token_counts, op2_sentencepiece, op3_quality_rules, op4_toxicity,
                            op5_line_dedup, op6_quality_classifier, op7_jaccard_join, op8_packing, op9_topk_search, op10_url_filter,
                            op11_conversation_repair, op12_hard_negatives, op13_sharding)}
ORACLE: dict[str, str] = {"op7_jaccard_join": oracle_sql.JACCARD, "op9_topk_search": oracle_sql.TOPK, "op10_url_filter": oracle_sql.URLS,
                          "op11_conversation_repair": oracle_sql.CONVERSATIONS, "op12_hard_negatives": oracle_sql.NEGATIVES,
                          "op13_sharding": oracle_sql.sharding()}
