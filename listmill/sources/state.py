"""Stored log offsets: an append-only table, one small file per committed run.

A log partition's position only rises, until it is reset: that begins a new epoch, of
which the latest counts whatever its offset.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listmill.schemas import OFFSETS
from listmill.sources.paths import read_or_empty

_KEY = ["target", "topic", "partition"]
_STORED = f"{OFFSETS}, epoch long"


def _positions(spark: SparkSession, path: str) -> DataFrame:
    """One row per target and log partition: its epoch and the highest offset in it."""
    latest = F.max(F.struct("epoch", "next_offset")).alias("latest")
    return read_or_empty(spark, path, _STORED).groupBy(*_KEY).agg(latest).select(*_KEY, "latest.*")


def read_offsets(spark: SparkSession, path: str, target: str) -> DataFrame:
    """Committed offset per topic and partition of one target; empty before the first run."""
    return _positions(spark, path).where(F.col("target") == target).drop("epoch")


def commit_offsets(offsets: DataFrame, path: str) -> None:
    """Add a run's offsets. The highest value counts, so a repeated commit changes nothing."""
    stored = _positions(offsets.sparkSession, path).drop("next_offset")
    # one row per log partition on either side
    rows = offsets.join(F.broadcast(stored), _KEY, "left")
    rows = rows.select(*_KEY, "next_offset", F.coalesce("epoch", F.lit(0)).cast("long").alias("epoch"))
    rows.coalesce(1).write.mode("append").parquet(path)


def reset_offsets(
    spark: SparkSession, path: str, target: str, topic: str, partition: int, value: int
) -> None:
    """Set one log partition's position, back or forth; ``value`` is the next offset to read."""
    same = (F.col("target") == target) & (F.col("topic") == topic) & (F.col("partition") == partition)
    epoch = _positions(spark, path).where(same).agg(F.max("epoch")).first()[0]
    row = (target, topic, partition, value, 0 if epoch is None else epoch + 1)
    spark.createDataFrame([row], _STORED).coalesce(1).write.mode("append").parquet(path)
