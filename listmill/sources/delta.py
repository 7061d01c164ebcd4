"""Silver tables in Delta format, where the ``delta`` package and its jars are deployed."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from listmill.operators.merge import DATE
from listmill.sources.paths import remove_path

try:
    from delta.tables import DeltaTable
except ImportError:
    DeltaTable = None


def delta_available() -> bool:
    return DeltaTable is not None


def upsert_delta(
    spark: SparkSession, path: str, batch: DataFrame, key: str, only_newer: bool = False
) -> int:
    """Create or MERGE; Delta itself rejects several batch rows for one table row."""
    if DeltaTable is None:
        raise RuntimeError("the delta package is not installed; use the Parquet tables")
    work = f"{path.rstrip('/')}/_work/{uuid.uuid4().hex}"
    try:
        # MERGE may run its source several times; the stored batch is counted once
        batch.write.parquet(work)
        return _merge(spark, path, spark.read.schema(batch.schema).parquet(work), key, only_newer)
    finally:
        remove_path(spark, work)


def _merge(spark: SparkSession, path: str, batch: DataFrame, key: str, only_newer: bool) -> int:
    if not DeltaTable.isDeltaTable(spark, path):
        batch.write.partitionBy(DATE).format("delta").mode("append").save(path)
    else:
        newer = f"s.{DATE} >= t.{DATE}" if only_newer else None
        table = DeltaTable.forPath(spark, path).alias("t")
        merging = table.merge(batch.alias("s"), f"t.{key} = s.{key}")
        merging.whenMatchedUpdateAll(newer).whenNotMatchedInsertAll().execute()
    return batch.count()
