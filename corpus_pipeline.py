"""The corpus pipeline: quality rules, quality classifier, line dedup, n-gram Jaccard join, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
``documents``.  Between stages the rows are written as Parquet and reread, so a lost executor costs one
stage's tasks at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airspark.llm import jaccard_join, line_dedup, packing, quality_rank, quality_rules
from airspark.llm.common import checkpoint, read_table

TOKENIZER = "word_bpe_49k.json"


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the learned votes reject go."""
    return quality_rules.keep_good(docs)


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored under the threshold go.  Learned from the labelled rows of ``documents``, since
    the rules before have removed nearly all that are labelled bad."""
    model = quality_rank.learn(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return quality_rank.keep_good(docs, model)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated runs of lines are deleted from the texts; documents left without a word go."""
    return line_dedup.clean(docs).where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by n-gram Jaccard similarity, the one with the smallest id stays."""
    return jaccard_join.keep_one(docs, words=5, percent=80)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all kept documents with their places in token sequences."""
    return packing.pack_documents(docs, TOKENIZER)


STAGES = [
    ("quality rules", quality_rules_stage),
    ("quality classifier", quality_classifier_stage),
    ("line dedup", line_dedup_stage),
    ("n-gram Jaccard join", near_duplicates_stage),
    ("packing", packing_stage),
]

#: Expectation-maximisation, the learned scores and the tokenizer have no SQL form; tests hold the stages
#: against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = checkpoint(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
