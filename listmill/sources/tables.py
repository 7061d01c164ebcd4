"""Bronze and silver tables as Parquet directories partitioned by ingestion date.

Bronze is append-only. Silver is updated in place of MERGE by writing new
directories for the dates a batch touches:

    <table>/rows/version=<n>/ingestion_date=<d>/...   written once, never changed
    <table>/dates/...                                 (version, ingestion_date, held_in, stream, batch)
    <table>/columns/...                               names and types, written with the first rows
    <table>/work/...                                  of a running update, removed at its end

``dates`` says which version directory holds each date; the entry of the highest
version counts, and a null ``held_in`` means that the date has no rows any more.
Adding a run's entries, one file, is the last step of an update. Until then
readers see the old rows, and what a failed run wrote is never named. Dates that
a batch does not touch are neither read nor rewritten. The entries of a stream's micro-batch
also name the stream and the batch, so a batch is known to be stored as soon as its rows are
there, and is not stored again.

One writer per table at a time. A version directory that ``dates`` no longer
names may be deleted once no reader of that time is left.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from listmill.operators import merge
from listmill.operators.joins import broadcast_if_small, broadcast_limit, key_bytes, row_bytes
from listmill.operators.merge import DATE
from listmill.schemas import BRONZE
from listmill.sources.paths import file_paths, folder_names, path_exists, read_or_empty, remove_path

# Where Spark's file sink lists the files of a stream's table.
STREAM_LOG = "_spark_metadata"

_DATES = "version long, ingestion_date date, held_in long, stream string, batch long"


class ConflictingKeys(ValueError):
    """Several rows of a batch would replace the same table row."""


class SchemaMismatch(ValueError):
    """A batch has other columns than the table, or other types."""


def packed(table_format: str = "parquet") -> dict[str, str]:
    """Write options: pages say the same things over and over, and zstd halves what Snappy leaves."""
    return {"compression": "zstd"} if table_format == "parquet" else {}


def append_bronze(
    rows: DataFrame, path: str, backfill: bool = False, table_format: str = "parquet"
) -> int:
    """Append to the partitioned bronze table; returns the number of rows, counted by the write.

    A day's rows go to one partition and are written where they were read. With
    ``backfill`` they have many dates: those are brought together first, a large
    date on several tasks, so that each task does not add a file to every date.
    """
    if path_exists(rows.sparkSession, f"{path}/{STREAM_LOG}"):
        raise ValueError(f"{path} is written by a stream, whose readers would not see these rows")
    counted = Observation("bronze")
    rows = rows.observe(counted, F.count(F.lit(1)).alias("rows"))
    if backfill:
        rows = rows.hint("rebalance", DATE)
    rows.write.options(**packed(table_format)).partitionBy(DATE).format(table_format).mode(
        "append"
    ).save(path)
    return counted.get["rows"]


def read_bronze(spark: SparkSession, path: str, table_format: str = "parquet") -> DataFrame:
    if table_format == "parquet":
        return spark.read.schema(BRONZE).parquet(path)
    return spark.read.format(table_format).load(path)


def bronze_files(spark: SparkSession, path: str, date: dt.date) -> set[str]:
    """Paths of the Parquet files that hold a date of the bronze table."""
    return file_paths(spark, f"{path}/{DATE}={date}")


def read_bronze_files(spark: SparkSession, path: str, files: set[str]) -> DataFrame:
    """The rows of some of the table's Parquet files."""
    return spark.read.schema(BRONZE).option("basePath", path).parquet(*sorted(files))


def _entries(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, f"{path}/dates", _DATES)


def _held(spark: SparkSession, path: str) -> tuple[int, dict[dt.date, int]]:
    """Current version and, for each date, the version that holds it: one entry per date."""
    latest = _entries(spark, path).groupBy(DATE).agg(
        F.max("version").alias("version"), F.max_by("held_in", "version").alias("held_in")
    )
    rows = latest.collect()
    version = max((r["version"] for r in rows), default=0)
    return version, {r[DATE]: r["held_in"] for r in rows if r["held_in"] is not None}


def silver_exists(spark: SparkSession, path: str) -> bool:
    return _held(spark, path)[0] > 0


def _columns(schema: StructType) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in schema.fields}


def _stored_schema(spark: SparkSession, path: str) -> StructType:
    rows = spark.read.schema("columns string").parquet(f"{path}/columns").collect()
    return StructType.fromJson(json.loads(rows[0]["columns"]))


def _check_schema(spark: SparkSession, path: str, batch: StructType) -> None:
    table, given = _columns(_stored_schema(spark, path)), _columns(batch)
    odd = sorted(n for n in table.keys() | given.keys() if table.get(n) != given.get(n))
    if odd:
        raise SchemaMismatch(
            "; ".join(f"{n}: table {table.get(n)}, batch {given.get(n)}" for n in odd)
        )


def _read_dates(spark: SparkSession, path: str, held: dict[dt.date, int]) -> DataFrame:
    schema = _stored_schema(spark, path)
    folders = [f"{path}/rows/version={v}/{DATE}={d}" for d, v in sorted(held.items())]
    rows = spark.read.schema(schema).option("basePath", f"{path}/rows").parquet(*folders)
    return rows.select(*[F.col(f"`{n}`") for n in schema.fieldNames()])


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """The table's current rows."""
    version, held = _held(spark, path)
    if not held:
        raise FileNotFoundError(f"no table at {path}")
    return _read_dates(spark, path, held)


def _write(rows: DataFrame, path: str, version: int, mode: str) -> None:
    rows.write.options(**packed()).partitionBy(DATE).mode(mode).parquet(f"{path}/rows/version={version}")


def _is_stored(spark: SparkSession, path: str, stream: str, batch: int) -> bool:
    later = (F.col("stream") == stream) & (F.col("batch") >= batch)
    return not _entries(spark, path).where(later).isEmpty()


def _commit(
    spark: SparkSession,
    path: str,
    version: int,
    touched: set[dt.date],
    batch_of: tuple[str, int] | None,
) -> None:
    """Make the written version current for the dates in it and the dates it replaces."""
    written = _dates_in(spark, f"{path}/rows/version={version}")
    if not touched | written:
        return
    stream = batch_of or (None, None)
    entries = [
        (version, d, version if d in written else None, *stream) for d in sorted(touched | written)
    ]
    frame = spark.createDataFrame(entries, _DATES).coalesce(1)
    frame.write.mode("append").parquet(f"{path}/dates")


def _dates_in(spark: SparkSession, rows: str) -> set[dt.date]:
    """The dates a written folder has partitions of."""
    names = (name.partition("=") for name in folder_names(spark, rows))
    return {dt.date.fromisoformat(value) for column, _, value in names if column == DATE}


def upsert_silver(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    key: str,
    only_newer: bool = False,
    batch_of: tuple[str, int] | None = None,
) -> int:
    """Create the table from the batch, or merge the batch into it by ``key``.

    The first batch is stored as it is, without a check for repeated keys. Later
    ones follow ``operators.merge``; ``ConflictingKeys`` is raised before the table
    changes, and ``SchemaMismatch`` before anything is written. The batch is evaluated
    once; the result is the number of its rows. ``batch_of`` names a stream and the batch's
    number in it; a batch that is stored already is left out, with 0 as result.
    """
    if batch_of is not None and _is_stored(spark, path, *batch_of):
        return 0
    version, held = _held(spark, path)
    if version:
        _check_schema(spark, path, batch.schema)
    counted = Observation("silver")
    batch = batch.observe(
        counted, F.count(F.lit(1)).alias("rows"), key_bytes(key).alias("key_bytes")
    )
    new = version + 1
    if not version:
        _write(batch, path, new, "overwrite")
        rows = counted.get["rows"]
        if rows:
            columns = spark.createDataFrame([(batch.schema.json(),)], "columns string")
            columns.coalesce(1).write.mode("overwrite").parquet(f"{path}/columns")
            _commit(spark, path, new, set(), batch_of)
        return rows

    work = f"{path}/work/{uuid.uuid4().hex}"
    try:
        batch.write.options(**packed()).partitionBy(DATE).parquet(f"{work}/batch")
        sizes = counted.get
        touched = _merge(
            spark, path, held, new, work, batch.schema, key, only_newer, sizes["key_bytes"]
        )
        _commit(spark, path, new, touched, batch_of)
        return sizes["rows"]
    finally:
        remove_path(spark, work)


def _merge(
    spark: SparkSession,
    path: str,
    held: dict[dt.date, int],
    new: int,
    work: str,
    schema: StructType,
    key: str,
    only_newer: bool,
    keys_size: int,
) -> set[dt.date]:
    """Write the merged rows of all dates the stored batch touches; return those of the table.

    Reads the table twice: key and date of all rows, to find the matches, and then
    all columns of the touched dates. Rows are kept by the keys that matched, which are
    measured on their own and mostly fewer than the batch's. Only what is measured is broadcast.
    """
    batch = spark.read.schema(schema).parquet(f"{work}/batch")
    keys = broadcast_if_small(merge.batch_keys(batch, key), keys_size)
    hit_dates: set[dt.date] = set()
    changed = batch
    if held:
        table = _read_dates(spark, path, held)
        found = Observation("matched")
        hits = merge.matched_rows(table, keys, key)
        hits.observe(found, key_bytes(key).alias("bytes")).write.options(**packed()).parquet(
            f"{work}/matched"
        )
        matched = spark.read.schema(hits.schema).parquet(f"{work}/matched")
        hits_size = found.get["bytes"]
        hit_keys = broadcast_if_small(merge.matched_keys(matched, key), hits_size)
        hit_dates = _checked_dates(matched, key)
        joined = broadcast_if_small(matched, hits_size)
        if merge.repeated_keys(matched, key).isEmpty():
            changed = merge.changed_rows(joined, batch, key, only_newer)
        else:  # maybe a hot key of the table, which only an inner join divides over tasks
            rows = batch
            if hits_size > broadcast_limit(spark):  # a small batch goes to where they are
                rows = broadcast_if_small(batch, batch.agg(row_bytes(schema)).first()[0])
            changed = merge.updated_rows(joined, rows, key, only_newer).unionByName(
                merge.added_rows(joined, batch, key)
            )
    touched = hit_dates | (_dates_in(spark, f"{work}/batch") & held.keys())
    if touched:
        old = _read_dates(spark, path, {d: held[d] for d in touched})
        changed = changed.unionByName(merge.kept_rows(old, hit_keys, key, only_newer))
    # Rows may come out of a join by key, each task with every date. Rebalancing brings
    # dates together, splitting a date that is too large for one task.
    changed = changed.hint("rebalance", DATE)
    _write(changed, path, new, "overwrite")
    return touched


def _checked_dates(matched: DataFrame, key: str) -> set[dt.date]:
    """The dates of the matched table rows, of which there is one result row each."""
    dates = matched.groupBy(DATE).agg(F.max("copies").alias("copies")).collect()
    if any(r["copies"] > 1 for r in dates):
        examples = merge.conflicting_keys(matched, key).limit(5).collect()
        raise ConflictingKeys(f"{key} more than once in the batch and in the table: {examples}")
    return {r[DATE] for r in dates}
