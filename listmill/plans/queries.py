"""The registered queries: (spark, folder of the test tables) -> DataFrame.

Each runs an operator or a job over whole tables. Those that exercise a job write
its tables to a fresh work folder and read them back.
"""

from __future__ import annotations

import dataclasses
import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listmill.functions.embedded import (
    PROPERTY,
    SOLD_PROPERTY,
    embedded_json,
    encode_message,
    parse_message,
)
from listmill.functions.links import SOLD_LINK_PATTERN
from listmill.functions.urls import url_id, url_key, url_tail, url_type
from listmill.operators import frontier, merge
from listmill.operators.bronze import bronze_for_date as rows_of_date
from listmill.operators.bronze import to_bronze
from listmill.operators.offsets import (
    latest_offsets,
    latest_records,
    next_offsets,
    offsets_json,
    resume,
)
from listmill.operators.refine import (
    CANONICAL,
    FORSALE,
    SOLD,
    RefineSpec,
    latest_per_key,
    parse_messages,
    parse_objects,
    refine,
    rejected,
)
from listmill.plans import derived, jobs
from listmill.plans.derived import DAY_1, DAY_2, LISTING_TOPIC, SPLIT, flat, table
from listmill.plans.jobs import ReplayTopic, ingest, refine_date, run_daily
from listmill.schemas import OFFSETS
from listmill.session import work_dir
from listmill.sources.log import read_replay
from listmill.sources.paths import remove_path
from listmill.sources.pending import add_pending, read_pending
from listmill.sources.sitemaps import read_sitemap_files
from listmill.sources.state import commit_offsets, read_offsets, reset_offsets
from listmill.sources.tables import (
    append_bronze,
    read_bronze,
    read_silver,
    silver_exists,
    upsert_silver,
)
from listmill.sources.visited import append_visited, lay_out, read_visited
from listmill.streaming.ingest import ingest_stream
from listmill.streaming.refine import refine_stream

# Records up to here count as read in the offset queries.
READ_UNTIL = dt.date(2024, 1, 2)
EVENT_DATE = dt.date(2024, 1, 2)
EVENT_TOPIC = "events"

# Where a log partition that was read to its end is set back to.
RESET_TOPIC, RESET_PARTITION, RESET_TO = "view", 1, 100

BRONZE_COLUMNS = (
    "key",
    "value",
    "topic",
    "partition",
    "offset",
    "timestamp",
    "timestampType",
    "ingestion_date",
)


def _event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events in one topic."""
    return derived.topic_log(spark, sf_dir).withColumn("topic", F.lit(EVENT_TOPIC))


def _read_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offsets stored when the records of the first day had been read; none for sign-ups."""
    log = derived.topic_log(spark, sf_dir)
    first = log.where((F.to_date("timestamp") < F.lit(READ_UNTIL)) & (F.col("topic") != "signup"))
    return next_offsets(first, "forsale")


def _bronze(spark: SparkSession, sf_dir: str, spec: RefineSpec, by_ship_date: bool = True):
    date = derived.ship_date() if by_ship_date else derived.arrival_day()
    return to_bronze(derived.listing_log(spark, sf_dir, spec.target), date)


# --- log and bronze ---------------------------------------------------------------------


def log_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored log of two topics, of which one is read."""
    other = _event_log(spark, sf_dir).withColumn("topic", F.lit("it's another"))
    path = work_dir(spark, "log")
    _event_log(spark, sf_dir).unionByName(other).write.parquet(path)
    source = ReplayTopic(EVENT_TOPIC, read_replay(spark, path, EVENT_TOPIC))
    records = source.unread(spark, "forsale", spark.createDataFrame([], OFFSETS))
    text = [F.col(c).cast("string").alias(c) for c in ("key", "value")]
    return records.select(*text, "topic", "partition", "offset", "timestamp", "timestampType")


def offset_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = derived.topic_log(spark, sf_dir)
    unread = resume(log, _read_before(spark, sf_dir))
    return unread.select("topic", "partition", "offset", F.col("value").cast("string").alias("value"))


def offset_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_offsets(derived.topic_log(spark, sf_dir))


def offset_latest_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = latest_records(derived.topic_log(spark, sf_dir))
    return newest.select("topic", "partition", "offset", F.col("value").cast("string").alias("value"))


def offset_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = work_dir(spark, "offsets")
    log = derived.topic_log(spark, sf_dir)
    idle = log.groupBy("topic").agg(F.min("offset").alias("offset"))
    idle = idle.withColumn("partition", F.lit(11))
    commit_offsets(_read_before(spark, sf_dir), state)
    commit_offsets(next_offsets(idle, "forsale"), state)
    commit_offsets(next_offsets(log, "sold"), state)
    commit_offsets(next_offsets(resume(log, read_offsets(spark, state, "forsale")), "forsale"), state)
    stored = [read_offsets(spark, state, target) for target in ("forsale", "sold")]
    return offsets_json(stored[0].unionByName(stored[1]))


def offset_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is unread after all was read and one log partition was set back."""
    state = work_dir(spark, "offsets")
    log = derived.topic_log(spark, sf_dir)
    commit_offsets(next_offsets(log, "forsale"), state)
    reset_offsets(spark, state, "forsale", RESET_TOPIC, RESET_PARTITION, RESET_TO)
    unread = resume(log, read_offsets(spark, state, "forsale"))
    return unread.select("topic", "partition", "offset", F.col("value").cast("string").alias("value"))


def ingest_today(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records stamped without a date are of today."""
    rows = to_bronze(_event_log(spark, sf_dir))
    today = F.col("ingestion_date") == F.current_date()
    return rows.select("partition", "offset", today.alias("is_today"))


def bronze_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of the ingest job; the second finds what the first has not read."""
    folder = work_dir(spark, "bronze")
    log = _event_log(spark, sf_dir)
    early = log.where(F.to_date("timestamp") < F.lit(READ_UNTIL))
    for part, day in ((early, DAY_1), (log, DAY_2)):
        source = ReplayTopic(EVENT_TOPIC, part)
        ingest(spark, source, f"{folder}/rows", "forsale", f"{folder}/offsets", day)
    return read_bronze(spark, f"{folder}/rows").select(*BRONZE_COLUMNS)


def bronze_for_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "bronze")
    rows = to_bronze(_event_log(spark, sf_dir), F.to_date("timestamp"))
    append_bronze(rows, folder, backfill=True)
    return rows_of_date(read_bronze(spark, folder), EVENT_DATE).select(*BRONZE_COLUMNS)


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "stream")
    events = (
        spark.readStream.schema(table(spark, sf_dir, "events").schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf_dir)
    )
    log = derived.as_topic_log(events)
    for _ in range(2):  # the second run has nothing to add
        ingest_stream(log, f"{folder}/rows", f"{folder}/checkpoint", F.to_date("timestamp"))
    return read_bronze(spark, f"{folder}/rows").select(*BRONZE_COLUMNS)


# --- messages, URLs, embedded objects -----------------------------------------------------


def envelope_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    time = F.col("page_id").cast("double") + 0.25
    message = encode_message(F.col("url"), F.col("html"), time)
    return pages.select("page_id", parse_message(message).alias("page")).select("page_id", "page.*")


def envelope_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = parse_messages(_bronze(spark, sf_dir, FORSALE))
    return messages.withColumn("source_md5", F.md5("source")).drop("source", "topic")


def url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        url_tail(url).alias("tail"),
        url_key(url).alias("url_key"),
        url_type(url).alias("prop_type"),
    )


def url_id_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", url_id(F.col("url")).alias("id"))


def _embedded(spark: SparkSession, sf_dir: str, spec: RefineSpec, name: str) -> DataFrame:
    messages = parse_messages(_bronze(spark, sf_dir, spec))
    text = embedded_json(F.col("source"), name)
    found = messages.select("url_key", "offset", "partition", text.alias("text"))
    number = F.from_json("text", "id long")["id"]
    return found.select(
        "url_key", "offset", "partition", F.md5("text").alias("text_md5"), number.alias("id")
    )


def datalayer_property(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _embedded(spark, sf_dir, FORSALE, PROPERTY)


def datalayer_sold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _embedded(spark, sf_dir, SOLD, SOLD_PROPERTY)


def _props(spark: SparkSession, sf_dir: str, spec: RefineSpec) -> DataFrame:
    rows = parse_objects(parse_messages(_bronze(spark, sf_dir, spec)), spec)
    return flat(rows.select("offset", "partition", *spec.objects))


def props_forsale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _props(spark, sf_dir, FORSALE)


def props_sold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _props(spark, sf_dir, SOLD)


def props_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _props(spark, sf_dir, CANONICAL)


# --- silver -------------------------------------------------------------------------------


def latest_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = ("l_shipdate", "l_linenumber", "l_partkey", "l_suppkey")
    return latest_per_key(table(spark, sf_dir, "lineitem"), "l_orderkey", newest)


def refine_forsale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(refine(_bronze(spark, sf_dir, FORSALE), FORSALE))


def refine_sold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(refine(_bronze(spark, sf_dir, SOLD), SOLD))


def refine_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(refine(_bronze(spark, sf_dir, CANONICAL), CANONICAL))


def refine_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that yield no listing, and why."""
    rows = rejected(parse_messages(_bronze(spark, sf_dir, FORSALE)), FORSALE)
    return rows.select("offset", "partition", "url_key", "reason")


def _upserted(spark: SparkSession, sf_dir: str, spec: RefineSpec) -> DataFrame:
    """Silver table after the batches of both arrival days."""
    folder = work_dir(spark, "silver")
    bronze = _bronze(spark, sf_dir, spec, by_ship_date=False)
    for day in (DAY_1, DAY_2):
        batch = refine(rows_of_date(bronze, day), spec)
        upsert_silver(spark, folder, batch, spec.merge_key)
    return flat(read_silver(spark, folder))


def upsert_forsale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upserted(spark, sf_dir, FORSALE)


def upsert_sold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upserted(spark, sf_dir, SOLD)


def upsert_sold_by_sale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upserted(spark, sf_dir, dataclasses.replace(SOLD, merge_key="sold_id"))


def upsert_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upserted(spark, sf_dir, CANONICAL)


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table with repeated keys: one row per line item."""
    day = F.when(F.col("l_linestatus") == "F", F.lit(DAY_1)).otherwise(F.lit(DAY_2))
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("listing_id"),
        F.col("l_extendedprice").alias("price"),
        day.alias("ingestion_date"),
    )


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch with unique keys: all orders, pending ones under keys that no line has."""
    day = F.when(F.col("o_orderstatus") == "F", F.lit(DAY_1)).otherwise(F.lit(DAY_2))
    return table(spark, sf_dir, "orders").select(
        F.expr(derived.ORDER_KEY).alias("listing_id"),
        F.col("o_totalprice").alias("price"),
        day.alias("ingestion_date"),
    )


def upsert_first_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated keys are stored as they are where no table exists yet."""
    folder = work_dir(spark, "silver")
    before = silver_exists(spark, folder)
    upsert_silver(spark, folder, _lines(spark, sf_dir), "listing_id")
    return read_silver(spark, folder).select(
        "*", F.lit(before).alias("before"), F.lit(silver_exists(spark, folder)).alias("after")
    )


def upsert_each_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch row replaces every table row of its key."""
    folder = work_dir(spark, "silver")
    upsert_silver(spark, folder, _lines(spark, sf_dir), "listing_id")
    upsert_silver(spark, folder, _orders(spark, sf_dir), "listing_id")
    return read_silver(spark, folder)


def upsert_only_newer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table rows of a later date than the batch row stay."""
    folder = work_dir(spark, "silver")
    upsert_silver(spark, folder, _lines(spark, sf_dir), "listing_id")
    upsert_silver(spark, folder, _orders(spark, sf_dir), "listing_id", only_newer=True)
    return read_silver(spark, folder)


def upsert_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that a MERGE rejects: the batch repeats them and the table has them."""
    keys = merge.batch_keys(_lines(spark, sf_dir), "listing_id")
    matched = merge.matched_rows(_orders(spark, sf_dir), keys, "listing_id")
    return merge.conflicting_keys(matched, "listing_id")


def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts the jobs report, from the bronze and silver tables of both days."""
    folder = work_dir(spark, "metrics")
    append_bronze(_bronze(spark, sf_dir, FORSALE, by_ship_date=False), f"{folder}/bronze")
    reports = [
        refine_date(spark, f"{folder}/bronze", f"{folder}/silver", day, FORSALE)
        for day in (DAY_1, DAY_2)
    ]
    return spark.createDataFrame(
        [(r.for_date, r.records, r.stored) for r in reports],
        "for_date date, records long, stored long",
    )


def daily_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily(spark, sf_dir, "forsale")


def daily_run_sold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily(spark, sf_dir, "sold")


def _daily(spark: SparkSession, sf_dir: str, target: str) -> DataFrame:
    """Two daily runs of log -> bronze -> silver; the second day's log holds the first day's too."""
    folder = work_dir(spark, "daily")
    log = derived.listing_log(spark, sf_dir, target)
    arrived = log.where(F.to_date("timestamp") < F.lit(SPLIT))
    for part, day in ((arrived, DAY_1), (log, DAY_2)):
        run_daily(
            spark,
            ReplayTopic(LISTING_TOPIC, part),
            bronze=f"{folder}/bronze",
            silver=f"{folder}/silver",
            target=target,
            state=f"{folder}/offsets",
            date=day,
        )
    return flat(read_silver(spark, f"{folder}/silver"))


def stream_refine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver table of a stream over two days of bronze, whose last batch is run twice."""
    folder = work_dir(spark, "stream-refine")
    rows, silver, checkpoint = (f"{folder}/{n}" for n in ("bronze", "silver", "checkpoint"))
    log = derived.listing_log(spark, sf_dir, "forsale")
    for day in (DAY_1, DAY_2):
        part = to_bronze(log, derived.arrival_day()).where(F.col("ingestion_date") == day)
        append_bronze(part, rows)
        refine_stream(spark, rows, silver, checkpoint, FORSALE)
    remove_path(spark, f"{checkpoint}/commits/1")
    refine_stream(spark, rows, silver, checkpoint, FORSALE)
    return flat(read_silver(spark, silver))


# --- URL bookkeeping ----------------------------------------------------------------------


def _visited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished orders were visited as sold listings, open ones as listings for sale."""
    target = F.when(F.col("o_orderstatus") == "F", "sold").otherwise("forsale").alias("target")
    return table(spark, sf_dir, "orders").select(target, F.col("o_orderkey").cast("string").alias("id"))


def _done(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.order_urls(spark, sf_dir).where("o_orderstatus = 'F'").select("url")


def _labelled(*parts: tuple[str, DataFrame]) -> DataFrame:
    frames = [df.select(F.lit(label).alias("part"), df[df.columns[-1]].alias("item")) for label, df in parts]
    return frames[0].unionByName(frames[1])


def frontier_unvisited(spark: SparkSession, sf_dir: str) -> DataFrame:
    candidates = table(spark, sf_dir, "lineitem").select(
        derived.listing_url().alias("url"), "l_linenumber", "l_shipdate"
    )
    return frontier.unvisited(candidates, _visited(spark, sf_dir), "sold")


def visited_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates looked up in a set in buckets: laid out, appended to, laid out anew."""
    path = f"{work_dir(spark, 'visited')}/set"
    urls = derived.order_urls(spark, sf_dir)
    for part, buckets in (("o_orderstatus = 'F'", 16), ("o_orderstatus = 'P'", 4)):
        done = urls.where(part).select("url")
        append_visited(frontier.new_visited(read_visited(spark, path), done, "sold"), path)
        lay_out(spark, path, buckets)
    append_visited(frontier.new_visited(read_visited(spark, path), urls, "forsale"), path)
    candidates = table(spark, sf_dir, "lineitem").select(
        derived.listing_url().alias("url"), "l_linenumber", "l_shipdate"
    )
    return frontier.unvisited(candidates, read_visited(spark, path), "sold")


def frontier_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sets after finished orders were fetched for the other target too."""
    pending = derived.order_urls(spark, sf_dir).select("url")
    done = _done(spark, sf_dir)
    visited = _visited(spark, sf_dir)
    return _labelled(
        ("pending", frontier.pending_remove(pending, done)),
        ("visited", frontier.visited_add(visited, done, "forsale")),
    )


def pending_add(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(derived.listing_url().alias("url"))
    return frontier.pending_add(derived.order_urls(spark, sf_dir), lines)


def frontier_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frontier.sample(derived.order_urls(spark, sf_dir), seed="1:")


def frontier_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    pending = derived.order_urls(spark, sf_dir).select("url")
    visited = _visited(spark, sf_dir)
    to_fetch, rest = frontier.next_round(pending, visited, "sold", seed="2:")
    return _labelled(("fetch", to_fetch), ("pending", rest))


def link_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frontier.extract_links(table(spark, sf_dir, "pages").select("page_id", "html"))


def link_extract_scoped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of the list in one element, which gets a second list; others are all around.

    The second list has values without quotes, a bracket in quotes, an attribute whose value
    looks like another and references by number.
    """
    before = '''<a href="/before">b</a><ul><li><a href="/other">o</a></li></ul>
        <nav class="list" id=result><h2>Hits <a href="/heading">h</a></h2>'''
    after = F.concat(
        F.lit("<ul><li><img src='/i.png'><a class='x' href='/second-"),
        F.col("page_id"),
        F.lit(
            '''\'>s</a><ul><li><a href="/nested">n</a></li></ul></li>
            <li><a title="5 > 3" href="/bracket">b</a></li><li><a href=/plain>p</a></li>
            <li><a data-x=" href='/bad'" href="/good">g</a></li><li><a href="/r?a&#38;b&#x26;c">r</a></li>
            <li><p><a href="/deep">d</a></p></li></ul></nav><ul><li><a href="/after">a</a></li></ul>'''
        ),
    )
    html = F.replace(F.replace("html", F.lit("<nav>"), F.lit(before)), F.lit("</nav>"), after)
    pages = table(spark, sf_dir, "pages").select("page_id", html.alias("html"))
    return frontier.extract_list_links(pages)


def link_extract_sold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links to sold listings that are added to the pages, two of them on one line."""
    added = r"""concat(html, '\n<a href="https://www.example.org/salda/villa-', page_id,
        '">x</a>\n<a href="https://www.example.org/salda/a-1">y</a> <a class="b" href="https://www.example.org/salda/b-',
        page_id, '">z</a>\n<a href="https://www.example.org/salda/c">no id</a>')"""
    pages = table(spark, sf_dir, "pages").select("page_id", F.expr(added).alias("html"))
    return frontier.extract_links(pages, SOLD_LINK_PATTERN)


def related_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Related links that are added to the pages under https, in both attribute orders."""
    link = F.expr(
        """CASE WHEN url LIKE 'https://%.org/%' THEN
             concat('<link rel="next" href="/n"><link href="', replace(url, '&', '&amp;'), '" rel="prev">')
           WHEN url LIKE 'https://%' THEN
             concat("<link rel='prev'><link rel='prev' href='", replace(url, '&', '&amp;'), "'/><link rel='prev' href='/2'>")
           ELSE '' END"""
    )
    pages = table(spark, sf_dir, "pages")
    return frontier.related_links(pages.select(F.concat(link, "html").alias("html")))


def _sitemaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sitemap document per order, with the order's and, unless it is finished, the customer's URL."""
    xml = F.expr(
        f"""concat('<?xml version="1.0" encoding="UTF-8"?>\\n',
              '<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"><url>\\n<loc>{LISTING_ORDER}', o_orderkey,
              '</loc><lastmod>2024-01-01</lastmod></url>',
              CASE WHEN o_orderstatus = 'F' THEN '' ELSE
                concat('<url><priority>1</priority><loc> {LISTING_CUSTOMER}', o_custkey, '&amp;x=1 </loc></url>') END,
              '</urlset>')"""
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", xml.alias("xml"))


def sitemap_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URLs of the documents; some were cut off, and are returned as broken."""
    cut = F.when(F.expr(CUT_OFF), F.expr("substring(xml, 1, length(xml) - 12)")).otherwise(F.col("xml"))
    urls, broken = frontier.split_sitemaps(_sitemaps(spark, sf_dir).withColumn("xml", cut))
    return urls.withColumn("broken", F.lit(False)).unionByName(
        broken.select("o_orderkey", F.lit(None).cast("string").alias("url"), F.lit(True).alias("broken"))
    )


def sitemap_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The URLs of the same documents, joined to large ones, a compressed file each."""
    folder = work_dir(spark, "sitemaps")
    items = F.regexp_extract("xml", "(?s)<urlset[^>]*>(.*)</urlset>", 1)
    head = F.regexp_extract("xml", "(?s)^(.*<urlset[^>]*>)", 1)
    large = (
        _sitemaps(spark, sf_dir)
        .groupBy(F.expr("o_orderkey div 10000").alias("part"))
        .agg(F.first(head).alias("head"), F.array_join(F.collect_list(items), "\n").alias("items"))
    )
    text = large.select(F.concat("head", "items", F.lit("</urlset>")).alias("xml"))
    text.write.option("maxRecordsPerFile", 1).text(folder, compression="gzip")
    return read_sitemap_files(spark, folder).select("url")


def sitemap_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sitemaps' URLs that are not visited."""
    return jobs.sitemap_round(_sitemaps(spark, sf_dir), _visited(spark, sf_dir), "sold")


def fetch_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three tables after the pages were fetched; a part failed, some is known already.

    Half of the pages were pending; those that did not fail are no more.
    """
    folder = work_dir(spark, "fetches")
    pages = table(spark, sf_dir, "pages")
    link = F.concat(F.lit("<link rel='prev' href='"), F.expr(RELATED), F.lit("'>"), F.col("html"))
    fetches = pages.select(
        "url",
        F.expr(FETCH_STATUS).alias("status"),
        link.alias("source"),
        F.col("page_id").cast("double").alias("timestamp"),
    )
    known = pages.where("page_id % 3 = 0").select(F.expr(RELATED).alias("url"))
    known = known.unionByName(pages.where("page_id % 2 = 0").select("url"))
    add_pending(spark, f"{folder}/pending", known)
    seen = pages.where("page_id % 4 = 0").select(url_id(F.col("url")).alias("id")).distinct()
    seen.select(F.lit("sold").alias("target"), "id").write.parquet(f"{folder}/visited")
    names = ("messages", "pending", "visited")
    jobs.record_fetches(spark, fetches, *[f"{folder}/{n}" for n in names], "sold")
    messages, visited = (spark.read.parquet(f"{folder}/{n}") for n in ("messages", "visited"))
    pending = read_pending(spark, f"{folder}/pending")
    url = parse_message(F.col("value"))["url"]
    return (
        messages.select(F.lit("message").alias("part"), url.alias("item"))
        .unionByName(pending.select(F.lit("pending").alias("part"), F.col("url").alias("item")))
        .unionByName(visited.select(F.lit("visited").alias("part"), F.col("id").alias("item")))
    )


# Which sitemaps are cut off, which fetches fail, and what pages name as related.
CUT_OFF = "o_orderkey % 10 = 3"
FETCH_STATUS = "CASE WHEN page_id % 5 = 0 THEN 404 ELSE 200 END"
RELATED = "concat('https://www.example.org/canonical/c-', CAST(floor(page_id / 2) AS BIGINT))"


LISTING_ORDER = f"{derived.LISTING_URL}villa-"
LISTING_CUSTOMER = "https://www.example.org/agent?id="


def fetch_ok(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.expr(
        "CASE event_type WHEN 'error' THEN 500 WHEN 'signup' THEN 301 WHEN 'view' THEN 299 ELSE 200 END"
    )
    fetches = table(spark, sf_dir, "events").select("event_id", status.alias("status"))
    return frontier.fetched_ok(fetches)


_NAMED = {"url_key": url_parts, "latest_per_key": latest_line}

QUERIES = _NAMED | {
    query.__name__: query
    for query in (
        log_read,
        offset_resume,
        offset_latest,
        offset_latest_record,
        offset_commit,
        offset_reset,
        ingest_today,
        bronze_ingest,
        bronze_for_date,
        stream_ingest,
        envelope_encode,
        envelope_parse,
        url_id_whole,
        datalayer_property,
        datalayer_sold,
        props_forsale,
        props_sold,
        props_canonical,
        refine_forsale,
        refine_sold,
        refine_canonical,
        refine_rejects,
        upsert_first_run,
        upsert_forsale,
        upsert_sold,
        upsert_sold_by_sale,
        upsert_canonical,
        upsert_each_match,
        upsert_only_newer,
        upsert_conflicts,
        run_metrics,
        daily_run,
        daily_run_sold,
        stream_refine,
        frontier_unvisited,
        visited_buckets,
        frontier_commit,
        pending_add,
        frontier_sample,
        frontier_round,
        link_extract,
        link_extract_scoped,
        link_extract_sold,
        related_link,
        sitemap_urls,
        sitemap_files,
        sitemap_round,
        fetch_ok,
        fetch_round,
    )
}
