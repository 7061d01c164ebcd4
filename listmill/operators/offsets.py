"""Read positions of a log: resume, latest, merge with earlier state, JSON form."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from listmill.operators.joins import drop_matching


def resume(log: DataFrame, offsets: DataFrame) -> DataFrame:
    """Log records not read yet; a partition without a stored offset starts at its earliest.

    ``offsets`` has one row per topic and partition, as ``merge_offsets`` gives for
    one target.
    """
    # one row per log partition
    start = F.broadcast(offsets.select("topic", "partition", "next_offset"))
    already_read = F.col("a.offset") < F.col("b.next_offset")
    keys = ["topic", "partition"]
    return drop_matching(log, start, keys, already_read, spread_by=keys)


def behind(log: DataFrame, offsets: DataFrame) -> DataFrame:
    """Log partitions that end before their stored offset: the log was emptied and refilled.

    A partition without any record may just have expired and is not among them.
    """
    ends = latest_offsets(log).alias("l")
    same = (F.col("l.topic") == F.col("o.topic")) & (F.col("l.partition") == F.col("o.partition"))
    return (
        ends.join(F.broadcast(offsets.alias("o")), same)
        .where("l.offset + 1 < o.next_offset")
        .select("l.topic", "l.partition", "l.offset", "o.next_offset")
    )


def latest_offsets(log: DataFrame) -> DataFrame:
    """Highest offset per topic and partition; combined before the shuffle."""
    return log.groupBy("topic", "partition").agg(F.max("offset").alias("offset"))


def latest_records(log: DataFrame) -> DataFrame:
    """The record at the highest offset of each topic and partition, as a ranking.

    For callers that need the record; for the offset alone use ``latest_offsets``.
    """
    newest = Window.partitionBy("topic", "partition").orderBy(F.desc("offset"))
    return log.withColumn("rn", F.row_number().over(newest)).where("rn = 1").drop("rn")


def next_offsets(log: DataFrame, target: str) -> DataFrame:
    """Offsets to store once these records are stored: one past the highest read."""
    return latest_offsets(log).select(
        F.lit(target).alias("target"),
        "topic",
        "partition",
        (F.col("offset") + 1).alias("next_offset"),
    )


def merge_offsets(*states: DataFrame) -> DataFrame:
    """Highest stored offset per log partition; one that was idle keeps its old value."""
    return (
        reduce(DataFrame.unionByName, states)
        .groupBy("target", "topic", "partition")
        .agg(F.max("next_offset").alias("next_offset"))
    )


def offsets_json(offsets: DataFrame) -> DataFrame:
    """``{"<partition>": next_offset, ...}`` per target and topic, by partition number.

    Expects one row per log partition, so a group is as long as its topic has
    partitions.
    """
    entries = F.array_sort(F.collect_list(F.struct("partition", "next_offset")))
    named = F.transform(entries, lambda e: F.struct(e["partition"].cast("string"), e["next_offset"]))
    return offsets.groupBy("target", "topic").agg(
        F.to_json(F.map_from_entries(named)).alias("offsets")
    )
