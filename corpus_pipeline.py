"""From raw documents to a sharded mix: quality rules, near-dedup, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame: all but the last
with the columns of docs, further ones as they came. Null, empty and blank texts
fail the quality rules. Very long texts are worked on whole. Rows that repeat
doc_id and text count once from near-dedup on; of equal texts the one of the
least doc_id stays, null doc_ids last. The mix holds a document once or twice,
with the words taken. Empty tables give empty results; an empty or null
benchmark item removes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cellstrata.llm import decontam, mixing, neardup, quality, sharding
from cellstrata.llm.common import cut_lineage, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects."""
    return quality.judge(docs, out="__failed_rule").where("__failed_rule is null").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles of Jaccard similarity 0.8 or more."""
    return neardup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes, as documents; those taken twice are there twice."""
    return mixing.mix_documents(docs)


def shard_assignment(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix with the shard of each document."""
    return sharding.assign(docs, sharding.tree())


STAGES = [
    ("quality rules", quality_rules),
    ("near-dedup", near_dedup),
    ("decontamination", decontamination),
    ("source mixing", source_mixing),
    ("sharding", shard_assignment),
]

#: Near-dedup's similarities and the mix's permutations can't be told in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES):
            docs = cut_lineage(docs)
    return docs
