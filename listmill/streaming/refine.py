"""Bronze stream -> silver: each micro-batch refined and upserted once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from listmill.operators.refine import RefineSpec, refine
from listmill.schemas import BRONZE
from listmill.sources.tables import upsert_silver

_COLUMNS = ("ingestion_date", "value", "topic", "partition", "offset")


def bronze_stream(spark: SparkSession, path: str) -> DataFrame:
    """A bronze table as a stream: its files, and new ones as they appear."""
    return spark.readStream.schema(BRONZE).parquet(path)


def refine_stream(
    spark: SparkSession,
    source: str,
    sink: str,
    checkpoint: str,
    spec: RefineSpec,
    only_newer: bool = False,
    stream: str | None = None,
) -> StreamingQuery:
    """Upsert what bronze has gained since the last run, then stop; returns the ended query.

    Spark repeats a micro-batch with the same rows and number if a run died before
    the checkpoint had it as done. The silver table stores that number in the same file
    that makes the batch's rows current, so a repeated batch changes nothing, even where others
    have written since. ``stream`` names the numbers' series, the checkpoint unless
    given; a new checkpoint, which counts from 0 again, needs another name.
    """
    name = stream or checkpoint

    def upsert(batch: DataFrame, number: int) -> None:
        refined = refine(batch.select(*_COLUMNS), spec)
        upsert_silver(
            batch.sparkSession, sink, refined, spec.merge_key, only_newer, batch_of=(name, number)
        )

    query = (
        bronze_stream(spark, source)
        .writeStream.foreachBatch(upsert)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
