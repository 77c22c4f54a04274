"""A corpus pipeline out of the operators of ``ledgerlake.llm``.

Each stage is ``(name, function)``; a function takes ``(spark, docs, sf_dir)`` and returns a DataFrame. All but
the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.llm import packing, quality_rules, simhash, toxicity
from ledgerlake.llm.queries import vocabulary
from ledgerlake.llm.scratch import cut


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents that fail the base rules or lie beyond their group's fences go."""
    return quality_rules.keep(docs)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3, learned from the labels of the documents that are left: scores of 0.7 and more go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep(docs, toxicity.fit(docs, labels))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10 for texts of 80 % common five-word shingles: of each group the document with the smallest id stays, repeated rows once."""
    return simhash.keep_first(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9 with the vocabulary and row length of its own query."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.tiktoken"), added=packing.added_tokens(vocabulary("byte_bpe_50k.json")))


STAGES = [("quality rules", drop_low_quality), ("toxicity", drop_toxic), ("simhash near-dedup", drop_near_copies), ("packing", pack)]

#: SQL has no byte-pair merges, nearest examples or fingerprint links: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each one to the stored rows of the one before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(docs, name.replace(" ", "-"))
    return docs
