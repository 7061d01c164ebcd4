"""The jobs: log -> bronze, bronze -> silver, and both for one date."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from listmill.functions.embedded import encode_message
from listmill.functions.links import related_link
from listmill.operators.bronze import bronze_for_date, to_bronze
from listmill.operators.frontier import (
    SAMPLE_SIZE,
    draw,
    fetched_ok,
    new_visited,
    sitemap_urls,
    unvisited,
)
from listmill.operators.offsets import behind, next_offsets, resume
from listmill.operators.refine import SPECS, RefineSpec, refine
from listmill.schemas import OFFSETS, TARGETS
from listmill.sources.delta import upsert_delta
from listmill.sources.log import kafka_options, read_kafka
from listmill.sources.pending import add_pending, read_pending, remove_pending
from listmill.sources.state import commit_offsets, read_offsets
from listmill.sources.tables import (
    append_bronze,
    bronze_files,
    read_bronze,
    read_bronze_files,
    upsert_silver,
)
from listmill.sources.visited import append_visited, read_visited
from listmill.sources.work import append_counted, stored


class LogBehind(ValueError):
    """The log has fewer records than were read: it was emptied and refilled."""


@dataclass(frozen=True)
class KafkaTopic:
    """A broker topic.

    ``partitions`` names those added since the last run; ``min_tasks`` makes that
    many tasks read it where it has fewer partitions, or one that holds most records.
    """

    topic: str
    brokers: str = "localhost:9092"
    partitions: Iterable[int] | None = None
    min_tasks: int | None = None
    group: str | None = None

    def unread(self, spark: SparkSession, target: str, offsets: DataFrame) -> DataFrame:
        stored = {r["partition"]: r["next_offset"] for r in offsets.collect()}
        options = kafka_options(
            self.brokers, self.topic, stored, self.partitions, self.min_tasks, self.group
        )
        return read_kafka(spark, options)


@dataclass(frozen=True)
class ReplayTopic:
    """A topic's records as a DataFrame with the columns of a log record.

    As the connector does on lost data, reading fails where a partition of the log
    ends before its stored offset. ``state.reset_offsets`` sets the offset back.
    """

    topic: str
    log: DataFrame

    def unread(self, spark: SparkSession, target: str, offsets: DataFrame) -> DataFrame:
        log = self.log.where(F.col("topic") == self.topic)
        rows = offsets.collect()  # one per log partition
        if not rows:
            return log
        stored = spark.createDataFrame(rows, OFFSETS)
        lost = behind(log, stored).collect()
        if lost:
            raise LogBehind(f"{self.topic} ends before the stored offset: {lost}")
        return resume(log, stored)


@dataclass(frozen=True)
class IngestReport:
    ingestion_date: dt.date
    rows: int


@dataclass(frozen=True)
class RefineReport:
    """Rows read and stored; rejected rows by reason where they were to be counted."""

    for_date: dt.date
    records: int
    stored: int
    rejected: dict[str, int] | None = None


def parse_date(text: str | dt.date | None) -> dt.date:
    """A date, or year-month-day text with or without leading zeros; else ``ValueError``."""
    if isinstance(text, dt.date):
        return text
    match = re.fullmatch(r"(\d{4})-(\d{1,2})-(\d{1,2})", text or "")
    if not match:
        raise ValueError(f"a date is required, as YYYY-MM-DD: {text!r}")
    return dt.date(*map(int, match.groups()))


def _require(**values: object) -> None:
    missing = [name for name, value in values.items() if not value]
    if missing:
        raise ValueError(f"required: {', '.join(missing)}")


def ingest(
    spark: SparkSession,
    source: KafkaTopic | ReplayTopic,
    sink: str,
    target: str,
    state: str,
    ingestion_date: str | dt.date | None = None,
    table_format: str = "parquet",
) -> IngestReport:
    """Append a topic's unread records to bronze, then store how far it was read.

    The offsets come from the rows that were stored, so they never run ahead of
    them; a run that dies in between leaves rows that the next one reads again,
    and refining keeps one of them. The log is read once, and of bronze only the files
    that this run has added (of a Delta table, the date).
    """
    _require(topic=source.topic, sink=sink, state=state)
    if target not in TARGETS:
        raise ValueError(f"target is one of {', '.join(TARGETS)}: {target!r}")
    if ingestion_date is None:
        ingestion_date = spark.sql("SELECT current_date() AS today").first()["today"]
    date = parse_date(ingestion_date)

    offsets = read_offsets(spark, state, target).where(F.col("topic") == source.topic)
    unread = to_bronze(source.unread(spark, target, offsets), date)
    by_file = table_format == "parquet"
    before = bronze_files(spark, sink, date) if by_file else set()
    rows = append_bronze(unread, sink, table_format=table_format)
    if rows:
        if by_file:
            added = read_bronze_files(spark, sink, bronze_files(spark, sink, date) - before)
        else:
            added = bronze_for_date(read_bronze(spark, sink, table_format), date)
        read = added.where(F.col("topic") == source.topic)
        commit_offsets(next_offsets(read, target), state)
    return IngestReport(date, rows)


def refine_date(
    spark: SparkSession,
    source: str,
    sink: str,
    for_date: str | dt.date,
    spec: RefineSpec,
    only_newer: bool = False,
    table_format: str = "parquet",
    count_rejected: bool = False,
) -> RefineReport:
    """Refine one date of bronze and upsert it into the silver table.

    All counts are taken by the run that stores the rows.
    """
    _require(source=source, sink=sink)
    date = parse_date(for_date)
    upsert = {"parquet": upsert_silver, "delta": upsert_delta}[table_format]
    read = Observation("bronze")
    columns = ("ingestion_date", "value", "topic", "partition", "offset")
    bronze = bronze_for_date(read_bronze(spark, source, table_format), date).select(*columns)
    bronze = bronze.observe(read, F.count(F.lit(1)).alias("records"))
    counted = Observation("rejected") if count_rejected else None
    stored = upsert(spark, sink, refine(bronze, spec, counted), spec.merge_key, only_newer)
    reasons = {r: n for r, n in counted.get.items() if n} if counted else None
    return RefineReport(date, read.get["records"], stored, reasons)


def run_daily(
    spark: SparkSession,
    source: KafkaTopic | ReplayTopic,
    bronze: str,
    silver: str,
    target: str,
    state: str,
    date: str | dt.date | None = None,
    table_format: str = "parquet",
) -> tuple[IngestReport, RefineReport]:
    """Both jobs for one date, which is fixed before the first so that midnight cannot part them."""
    ingested = ingest(spark, source, bronze, target, state, date, table_format)
    refined = refine_date(
        spark, bronze, silver, ingested.ingestion_date, SPECS[target], table_format=table_format
    )
    return ingested, refined


@dataclass(frozen=True)
class FetchReport:
    messages: int
    new_pending: int
    new_visited: int
    removed: int = 0


def record_fetches(
    spark: SparkSession,
    fetches: DataFrame,
    messages: str,
    pending: str,
    visited: str,
    target: str,
    rel: str = "prev",
    drawn_from: str | None = None,
) -> FetchReport:
    """Append what a round of fetches yields to three tables.

    ``fetches`` has url, status, source and timestamp. Of those that succeeded, the
    pages go to ``messages`` as log values, the URLs they name as related to ``pending``
    and their own ids to ``visited``; their URLs leave the pending set ``drawn_from``, which
    is ``pending`` itself unless given. The fetches are computed once and stored. The ids come
    after the pages: a run that dies before them is fetched again. One that dies
    before the URLs leave has them dropped by the next ``draw_round``.
    """
    _require(messages=messages, pending=pending, visited=visited, target=target)
    value = encode_message(F.col("url"), F.col("source"), F.col("timestamp"))
    related = related_link(F.col("source"), rel)
    ok = fetched_ok(fetches).select("url", value.alias("value"), related.alias("related"))
    ok = stored(ok, "fetched")
    written = append_counted(ok.select("value"), messages)
    added = add_pending(spark, pending, ok.select(F.col("related").alias("url")))
    seen = read_visited(spark, visited)
    marked = append_visited(new_visited(seen, ok, target), visited)
    removed = remove_pending(spark, drawn_from or pending, ok.select("url"))
    return FetchReport(written, added, marked, removed)


def draw_round(
    spark: SparkSession, pending: str, visited: str, target: str, n: int = SAMPLE_SIZE, seed: str = ""
) -> DataFrame:
    """URLs to fetch, from a sample of the stored pending set; those visited already leave it."""
    drawn = draw(read_pending(spark, pending), read_visited(spark, visited), target, n, seed)
    remove_pending(spark, pending, drawn.stale)
    return drawn.to_fetch


def sitemap_round(documents: DataFrame, visited: DataFrame, target: str) -> DataFrame:
    """The sitemaps' URLs that the target has not visited, with the documents' other columns."""
    return unvisited(sitemap_urls(documents), visited, target)
