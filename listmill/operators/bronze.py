"""Log records -> bronze rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def date_column(date: dt.date | Column | None) -> Column:
    if isinstance(date, Column):
        return date
    return F.current_date() if date is None else F.lit(date)


def to_bronze(log: DataFrame, ingestion_date: dt.date | Column | None = None) -> DataFrame:
    """Text key and value, stamped with the ingestion date (today unless given)."""
    return log.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "topic",
        "partition",
        "offset",
        "timestamp",
        "timestampType",
        date_column(ingestion_date).alias("ingestion_date"),
    )


def bronze_for_date(bronze: DataFrame, for_date: dt.date) -> DataFrame:
    """One date of bronze; a typed comparison, so only that partition is read."""
    return bronze.where(F.col("ingestion_date") == F.lit(for_date))
