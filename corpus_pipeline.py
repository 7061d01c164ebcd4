"""The corpus pipeline: what stays of ``documents``, mixed and sharded.

Each stage works on all rows its predecessor kept and is stored before the next one
reads it. All but the last return the columns of the documents; the last adds
``shard``. A document that the mix takes twice is there twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from listmill.llm.common import stored, table
from listmill.llm.decontamination import drop_contaminated
from listmill.llm.mixing import mix
from listmill.llm.sharding import shard
from listmill.llm.simhash import drop_near_duplicates
from listmill.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mix(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents and their shard."""
    return shard(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near copies", near_copies),
    ("benchmark decontamination", decontamination),
    ("mixing", mixture),
    ("sharding", sharding),
]

# Compression lengths, fingerprints and slots have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
