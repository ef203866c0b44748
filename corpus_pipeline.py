"""The corpus pipeline: stages that each take (spark, docs, sf_dir) and return what the next one reads.

All stages but the last return the columns of their documents, whatever their names, and rows as they came: documents with
null, empty, very long or ill-encoded texts are ordinary, their own representatives, clean, of size 0 if they have no words
(and so never dropped by the first three stages). Rows that repeat an id with the same text become one in the second
stage; rows without an id stay. An empty table passes every stage. Each stage's table is settled in the shared folder;
release() of touchline.llm.common deletes them once the last one's result is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from touchline.llm import decontaminate, jaccard, mixing, sharding, toxicity
from touchline.llm.common import settle, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score rejects go."""
    return toxicity.ordinary(docs, table(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return jaccard.representatives(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold any window of a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated, kept or dropped so that sources come near their target shares."""
    return mixing.mixture(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in compacted shards under a committed manifest; one row each, read back: doc_id, n_bytes, shard and what the manifest tells of it."""
    return sharding.report(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near copies", one_of_each),
    ("decontamination", drop_benchmark),
    ("mixing", mix),
    ("sharding", shard),
]

#: Trained scores and similarity groups are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = settle(docs, f"pipeline-{name.replace(' ', '-')}")
    return docs
