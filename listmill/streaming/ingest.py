"""Log stream -> bronze, with the stream's checkpoint in place of stored offsets."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from listmill.operators.bronze import to_bronze
from listmill.schemas import LOG_RECORD
from listmill.sources.paths import folder_names, path_exists
from listmill.sources.tables import STREAM_LOG


def kafka_stream(spark: SparkSession, brokers: str, topic: str) -> DataFrame:
    """A topic as a stream; new partitions are picked up. Needs Spark's Kafka connector."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .load()
    )


def replay_stream(spark: SparkSession, path: str) -> DataFrame:
    """Log records from the files of a directory, new files as they appear."""
    return spark.readStream.schema(LOG_RECORD).parquet(path)


def ingest_stream(
    log: DataFrame,
    sink: str,
    checkpoint: str,
    ingestion_date: dt.date | Column | None = None,
    table_format: str = "parquet",
) -> StreamingQuery:
    """Append what the log has gained since the last run, then stop; returns the ended query.

    Spark's file sink records the files of each micro-batch, so a batch that is
    repeated after a failure is stored once. Its readers see only recorded files:
    keep batch ingest and stream ingest to different bronze tables.
    """
    spark = log.sparkSession
    if table_format == "parquet" and folder_names(spark, sink):
        if not path_exists(spark, f"{sink}/{STREAM_LOG}"):
            raise ValueError(f"{sink} has rows of batch runs, which the stream's readers would not see")
    query = (
        to_bronze(log, ingestion_date)
        .writeStream.format(table_format)
        .partitionBy("ingestion_date")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(sink)
    )
    query.awaitTermination()
    return query
