"""A stored visited set, plain or in buckets by id.

    <set>/...                  rows of a plain set
    <set>/_layouts/...         (layout, buckets), one row per layout
    <set>/_buckets-<layout>/   the rows in buckets from that layout on

A set that ``lay_out`` has put in buckets is looked up where it is: the ids of many
candidates are brought to its buckets, and single ids are read from theirs alone. Rows
appended later go to the buckets too, as further files; laying out anew writes one file
per bucket again, and may change their number. A layout counts once it is complete, so a
run that dies leaves the set as it was. One writer per set at a time. Folders of earlier layouts
may be deleted once no reader of that time is left.

Spark knows buckets by a catalog entry only; each layout is declared as an external
table of the session's catalog under a name made from its path.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from listmill.schemas import VISITED
from listmill.sources.paths import path_exists, read_or_empty
from listmill.sources.work import append_counted

# Some hundred MB of ids in each, at a billion ids.
BUCKETS = 256

# How many ids ``visited_among`` takes as literals.
MOST_IDS = 1000

_LAYOUTS = "layout long, buckets int"


def _layout(spark: SparkSession, path: str) -> tuple[int, int]:
    """Number and buckets of the newest complete layout; 0 of a plain set."""
    rows = read_or_empty(spark, f"{path}/_layouts", _LAYOUTS).collect()  # one per layout
    for row in sorted(rows, reverse=True):
        if path_exists(spark, f"{path}/_buckets-{row['layout']}/_SUCCESS"):
            return row["layout"], row["buckets"]
    return 0, 0


def _declared(spark: SparkSession, path: str, layout: int, buckets: int) -> str:
    """Name of the layout's table in the catalog."""
    folder = f"{path}/_buckets-{layout}"
    name = f"listmill_visited_{hashlib.md5(folder.encode()).hexdigest()}"
    location = folder.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"""CREATE TABLE IF NOT EXISTS {name} ({VISITED}) USING parquet
        CLUSTERED BY (id) SORTED BY (id) INTO {buckets} BUCKETS LOCATION '{location}'"""
    )
    return name


def _append(rows: DataFrame, table: str, buckets: int) -> int:
    """Each task writes the bucket it holds."""
    counted = Observation("visited")
    rows = rows.select("target", "id").observe(counted, F.count(F.lit(1)).alias("rows"))
    rows.repartition(buckets, "id").write.insertInto(table)
    return counted.get["rows"]


def read_visited(spark: SparkSession, path: str) -> DataFrame:
    """The set's (target, id), each once."""
    layout, buckets = _layout(spark, path)
    if not layout:
        return read_or_empty(spark, path, VISITED)
    name = _declared(spark, path, layout, buckets)
    spark.catalog.refreshTable(name)
    return spark.table(name)


def append_visited(rows: DataFrame, path: str) -> int:
    """Append rows that are not in the set; returns how many."""
    layout, buckets = _layout(rows.sparkSession, path)
    if not layout:
        return append_counted(rows.select("target", "id"), path)
    return _append(rows, _declared(rows.sparkSession, path, layout, buckets), buckets)


def lay_out(spark: SparkSession, path: str, buckets: int = BUCKETS) -> None:
    """Write the set in buckets; from then on it is read and appended there."""
    rows = read_visited(spark, path)
    used = read_or_empty(spark, f"{path}/_layouts", _LAYOUTS).agg(F.max("layout")).first()[0]
    layout = (used or 0) + 1
    entry = spark.createDataFrame([(layout, buckets)], _LAYOUTS).coalesce(1)
    entry.write.mode("append").parquet(f"{path}/_layouts")
    _append(rows, _declared(spark, path, layout, buckets), buckets)


def visited_among(spark: SparkSession, path: str, target: str, ids: list[str]) -> DataFrame:
    """Those of a few ids that the target has visited; only their buckets are read."""
    if len(ids) > MOST_IDS:
        raise ValueError(f"{len(ids)} ids: use frontier.unvisited beyond {MOST_IDS}")
    rows = read_visited(spark, path).where(F.col("target") == target)
    return rows.where(F.col("id").isin(ids)).select("id")
