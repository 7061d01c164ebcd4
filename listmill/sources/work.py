"""Work tables in the folder all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from listmill.operators.joins import key_bytes
from listmill.session import work_dir


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows as a table, read back: computed once, and safe from lost executors."""
    path = work_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_keys(keys: DataFrame, purpose: str) -> tuple[DataFrame, int]:
    """The keys as a table, and what they take when they are broadcast, measured by the write."""
    measured = Observation(purpose)
    table = stored(keys.observe(measured, key_bytes(*keys.columns).alias("bytes")), purpose)
    return table, measured.get["bytes"]


def append_counted(rows: DataFrame, path: str) -> int:
    """Append to the Parquet table at ``path``; the number of rows is counted by the write."""
    counted = Observation("rows")
    rows.observe(counted, F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(path)
    return counted.get["rows"]
