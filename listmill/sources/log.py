"""The page log: a broker topic where the connector is deployed, else a table of its records."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listmill.schemas import LOG_RECORD

EARLIEST = -2


def starting_offsets(
    topic: str, stored: Mapping[int, int], partitions: Iterable[int] | None = None
) -> str:
    """The connector's ``startingOffsets``: all from the earliest, or each partition's position.

    The connector wants every partition named. ``partitions`` names those that may
    have been added since the offsets were stored; they start at their earliest.
    """
    if not stored:
        return "earliest"
    known = {**{p: EARLIEST for p in partitions or ()}, **stored}
    return json.dumps({topic: {str(p): known[p] for p in sorted(known)}})


def kafka_options(
    brokers: str,
    topic: str,
    stored: Mapping[int, int],
    partitions: Iterable[int] | None = None,
    min_tasks: int | None = None,
    group: str | None = None,
) -> dict[str, str]:
    """Options of a batch read; ``min_tasks`` splits large partitions over several tasks."""
    options = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "startingOffsets": starting_offsets(topic, stored, partitions),
        "endingOffsets": "latest",
    }
    if group:
        options["kafka.group.id"] = group
    return options | ({"minPartitions": str(min_tasks)} if min_tasks else {})


def read_kafka(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """Unread records of a topic; needs Spark's Kafka connector on the class path."""
    return spark.read.format("kafka").options(**options).load()


def write_kafka(messages: DataFrame, brokers: str, topic: str) -> None:
    """Publish a ``value`` column; needs Spark's Kafka connector on the class path."""
    (
        messages.select("value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("topic", topic)
        .save()
    )


def read_replay(spark: SparkSession, path: str, topic: str) -> DataFrame:
    """A topic's records from a Parquet table with the columns of a log record."""
    return spark.read.schema(LOG_RECORD).parquet(path).where(F.col("topic") == topic)
