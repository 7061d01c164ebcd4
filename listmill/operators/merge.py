"""Upsert of a batch into a table, as joins.

Matched table rows take all columns of the batch row (its date too, so a row can
move to another partition), other table rows stay, other batch rows are added.
Null keys match nothing. A batch row that matches several table rows replaces
each of them. Several batch rows for one table row are an error, which the caller
checks with ``conflicting_keys``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listmill.operators.joins import drop_matching, join_unique

DATE = "ingestion_date"


def batch_keys(batch: DataFrame, key: str) -> DataFrame:
    """Each key of the batch once: how many rows have it, and the newest date."""
    return (
        batch.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("copies"), F.max(DATE).alias("batch_date"))
    )


def _not_newer(only_newer: bool) -> Column | None:
    return F.col("b.batch_date") >= F.col(f"a.{DATE}") if only_newer else None


def matched_rows(table: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Key, date and the batch's key count of every table row that the batch matches."""
    return join_unique(table.select(key, DATE), keys, key, "inner")


def matched_keys(matched: DataFrame, key: str) -> DataFrame:
    """Each key that is in table and batch once, with the batch's newest date."""
    return matched.groupBy(key).agg(F.max("batch_date").alias("batch_date"))


def repeated_keys(matched: DataFrame, key: str) -> DataFrame:
    """Keys of more than one table row that the batch matches."""
    return matched.groupBy(key).agg(F.count(F.lit(1)).alias("hits")).where("hits > 1").select(key)


def conflicting_keys(matched: DataFrame, key: str) -> DataFrame:
    """Keys that are in the table and more than once in the batch."""
    return matched.where("copies > 1").groupBy(key).agg(F.max("copies").alias("copies"))


def kept_rows(table: DataFrame, keys: DataFrame, key: str, only_newer: bool = False) -> DataFrame:
    """Table rows the batch does not replace."""
    return drop_matching(table, keys, key, _not_newer(only_newer), spread_by=[key, DATE])


def updated_rows(
    matched: DataFrame, batch: DataFrame, key: str, only_newer: bool = False
) -> DataFrame:
    """The batch row, once per table row it replaces."""
    hits = matched.where(F.col("batch_date") >= F.col(DATE)) if only_newer else matched
    return join_unique(hits.select(key), batch, key, "inner").select(*batch.columns)


def added_rows(matched: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Batch rows that match no table row."""
    return drop_matching(batch, matched.select(key).distinct(), key)


def changed_rows(matched: DataFrame, batch: DataFrame, key: str, only_newer: bool = False) -> DataFrame:
    """Updated and added rows, where no key of ``matched`` is repeated.

    Each batch row then replaces one row or is added, so that all of them are the batch itself;
    one join leaves out those that replace none because they are older.
    """
    if not only_newer:
        return batch
    replaces = F.col("batch_date") >= F.col(DATE)
    hits = matched.select(key, F.coalesce(replaces, F.lit(False)).alias("_replaces"))
    joined = join_unique(batch, hits, key, "left")
    return joined.where(F.coalesce("_replaces", F.lit(True))).select(*batch.columns)
