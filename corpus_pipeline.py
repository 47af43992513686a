"""The corpus pipeline: toxic documents out, near copies out, benchmark leaks out, sources mixed, documents sharded.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet to the shared scratch folder and
read again as the next stage's ``docs``. All but the last return the columns of ``documents``; the last adds ``shard`` and
``slot``. A stage works on all rows that its predecessor kept, and its decisions take effect. Null and empty texts, repeated rows
and empty tables are treated as the operators state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from demandgrid.llm import decontaminate, mixing, neardup, shards, toxicity
from demandgrid.llm.common import materialize, table

N_SHARDS = 24


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below 0.5. The model learns from all labelled documents of the stage's input."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    return toxicity.drop_toxic(docs, toxicity.learn(docs, labels))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    return neardup.drop_near(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources by weights 5, 2, 1 takes it."""
    return mixing.mix_rows(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with ``shard`` (0 to 23, near equal bytes) and ``slot``."""
    return shards.shard_rows(docs, N_SHARDS)


STAGES = [
    ("toxicity", reject_toxic),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: A conditional random field and hashed signatures can't be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
