import datetime as dt
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from listmill.functions.embedded import parse_message
from listmill.operators.bronze import to_bronze
from listmill.operators.refine import FORSALE, SOLD, refine
from listmill.plans import jobs
from listmill.plans.jobs import (
    FetchReport,
    LogBehind,
    ReplayTopic,
    ingest,
    parse_date,
    record_fetches,
    refine_date,
    run_daily,
)
from listmill.schemas import BRONZE, LOG_RECORD
from listmill.session import work_dir
from listmill.sources.paths import remove_path
from listmill.sources.pending import add_pending, read_pending
from listmill.sources.state import reset_offsets
from listmill.sources.tables import append_bronze, read_bronze, read_silver, upsert_silver
from listmill.streaming.ingest import ingest_stream, replay_stream
from listmill.streaming.refine import refine_stream
from tests.test_refine import bronze, page

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def log(spark, *messages):
    """Log records from (url, source, timestamp, partition, offset)."""
    return bronze(spark, *messages).select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        *[c for c in BRONZE_REST],
    )


BRONZE_REST = ("topic", "partition", "offset", "timestamp", "timestampType")


def message(i, price, partition=0):
    return (f"http://h/villa-{i}", page({"id": i, "price": price}), float(price), partition, price)


def positions(spark, path):
    return sorted((r["partition"], r["offset"]) for r in read_bronze(spark, path).collect())


def test_dates():
    assert parse_date("2020-09-01") == parse_date("2020-9-1") == dt.date(2020, 9, 1)
    assert parse_date(D1) is D1
    for bad in ("bad", "", None, "2020-13-01", "2020-09-01T00:00"):
        with pytest.raises(ValueError):
            parse_date(bad)


def test_arguments_are_checked(spark, folder):
    source = ReplayTopic("t", log(spark, message(1, 1)))
    with pytest.raises(ValueError, match="target is one of"):
        ingest(spark, source, folder, "rented", folder)
    with pytest.raises(ValueError, match="required: sink"):
        ingest(spark, source, "", "sold", folder)
    with pytest.raises(ValueError, match="required: topic"):
        ingest(spark, ReplayTopic("", source.log), folder, "sold", folder)
    with pytest.raises(ValueError, match="required: source"):
        refine_date(spark, "", folder, D1, FORSALE)
    with pytest.raises(ValueError, match="a date is required"):
        refine_date(spark, folder, folder, "", FORSALE)


def test_ingest_resumes(spark, folder):
    rows, state = f"{folder}/rows", f"{folder}/state"
    first = log(spark, message(1, 1), message(2, 2), message(3, 1, partition=1))
    assert ingest(spark, ReplayTopic("t", first), rows, "forsale", state, D1).rows == 3
    assert ingest(spark, ReplayTopic("t", first), rows, "forsale", state, D2).rows == 0
    more = first.unionByName(log(spark, message(4, 3), message(5, 9, partition=2)))
    assert ingest(spark, ReplayTopic("t", more), rows, "forsale", state, D2).rows == 2
    assert positions(spark, rows) == [(0, 1), (0, 2), (0, 3), (1, 1), (2, 9)]
    # another target reads the same topic from its start
    assert ingest(spark, ReplayTopic("t", more), f"{folder}/sold", "sold", state).rows == 5


def test_offsets_come_from_the_files_of_the_run(spark, folder, monkeypatch):
    read, whole = [], jobs.next_offsets

    def noting(rows, target):
        read.append(set(rows.inputFiles()))
        return whole(rows, target)

    monkeypatch.setattr(jobs, "next_offsets", noting)
    messages = [message(i, i) for i in range(1, 5)]
    for n in (2, 4):
        ingest(spark, ReplayTopic("t", log(spark, *messages[:n])), f"{folder}/b", "sold", f"{folder}/o", D1)
    assert read[0] and read[1] and not read[0] & read[1]
    assert len(positions(spark, f"{folder}/b")) == 4


def test_a_lost_commit_reads_again(spark, folder, monkeypatch):
    rows, silver, state = f"{folder}/rows", f"{folder}/silver", f"{folder}/state"
    source = ReplayTopic("t", log(spark, message(1, 1), message(2, 2)))
    with monkeypatch.context() as patch:
        patch.setattr(jobs, "commit_offsets", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            ingest(spark, source, rows, "forsale", state, D1)
    ingest(spark, source, rows, "forsale", state, D1)
    assert len(positions(spark, rows)) == 4
    report = refine_date(spark, rows, silver, D1, FORSALE)
    assert (report.records, report.stored) == (4, 2)


def test_daily_runs(spark, folder):
    paths = dict(
        bronze=f"{folder}/bronze", silver=f"{folder}/silver", target="forsale", state=f"{folder}/state"
    )
    day1 = log(spark, message(1, 1), message(2, 2), message(1, 3))
    ingested, refined = run_daily(spark, ReplayTopic("t", day1), date=D1, **paths)
    assert (ingested.rows, refined.records, refined.stored) == (3, 3, 2)
    day2 = day1.unionByName(log(spark, message(2, 4), message(7, 5)))
    ingested, refined = run_daily(spark, ReplayTopic("t", day2), date="2024-1-2", **paths)
    assert (ingested.rows, refined.records, refined.stored) == (2, 2, 2)
    found = {(r["listing_id"], r["props"]["price"], r["ingestion_date"]) for r in read_silver(spark, paths["silver"]).collect()}
    assert found == {("1", 3, D1), ("2", 4, D2), ("7", 5, D2)}
    # nothing new: the run stores nothing and changes nothing
    ingested, refined = run_daily(spark, ReplayTopic("t", day2), date=dt.date(2024, 1, 3), **paths)
    assert (ingested.rows, refined.records, refined.stored) == (0, 0, 0)
    assert read_silver(spark, paths["silver"]).count() == 3


def test_a_recreated_log_is_not_skipped(spark, folder):
    rows, state = f"{folder}/rows", f"{folder}/state"
    old = log(spark, *[message(i, i) for i in range(20)])
    ingest(spark, ReplayTopic("t", old), rows, "forsale", state, D1)
    fresh = ReplayTopic("t", log(spark, *[message(i, i) for i in range(8)]))
    with pytest.raises(LogBehind):
        ingest(spark, fresh, rows, "forsale", state, D2)
    reset_offsets(spark, state, "forsale", "t", 0, 0)
    assert ingest(spark, fresh, rows, "forsale", state, D2).rows == 8
    assert ingest(spark, fresh, rows, "forsale", state, D2).rows == 0


def test_fetches_are_recorded(spark, folder):
    paths = [f"{folder}/{n}" for n in ("messages", "pending", "visited")]
    fetches = [
        ("http://h/a-1", 200, "<link rel='prev' href='http://h/c-9'>", 1.0),
        ("http://h/b-2", 404, "<link rel='prev' href='http://h/c-8'>", 2.0),
        ("http://h/a-1", 200, "", 3.0),
    ]
    frame = spark.createDataFrame(fetches, "url string, status int, source string, timestamp double")
    assert record_fetches(spark, frame, *paths, "sold") == FetchReport(2, 1, 1)
    assert record_fetches(spark, frame, *paths, "sold") == FetchReport(2, 0, 0)
    assert [tuple(r) for r in spark.read.parquet(paths[1]).collect()] == [("http://h/c-9",)]
    assert [tuple(r) for r in spark.read.parquet(paths[2]).collect()] == [("sold", "1")]
    assert record_fetches(spark, frame, *paths, "forsale") == FetchReport(2, 0, 1)


def test_fetched_urls_leave_the_pending_set(spark, folder):
    paths = [f"{folder}/{n}" for n in ("messages", "pending", "visited")]
    todo = spark.createDataFrame([("http://h/a-1",), ("http://h/b-2",), ("http://h/c-3",)], "url string")
    add_pending(spark, paths[1], todo)
    fetches = [
        ("http://h/a-1", 200, "<link rel=prev href=http://h/c-9>", 1.0),
        ("http://h/b-2", 404, "", 2.0),
    ]
    frame = spark.createDataFrame(fetches, "url string, status int, source string, timestamp double")
    assert record_fetches(spark, frame, *paths, "sold") == FetchReport(1, 1, 1, 1)
    left = sorted(r["url"] for r in read_pending(spark, paths[1]).collect())
    assert left == ["http://h/b-2", "http://h/c-3", "http://h/c-9"]
    assert record_fetches(spark, frame, *paths, "sold") == FetchReport(1, 0, 0, 0)
    # related URLs go to one set, fetched ones leave another
    other = f"{folder}/other"
    add_pending(spark, other, todo)
    assert record_fetches(spark, frame, *paths, "forsale", drawn_from=other) == FetchReport(1, 0, 1, 1)
    assert read_pending(spark, other).count() == 2 and read_pending(spark, paths[1]).count() == 3


def test_fetches_are_computed_once(spark, folder):
    """A source that gives other rows each time still fills all three tables alike."""
    paths = [f"{folder}/{n}" for n in ("messages", "pending", "visited")]
    url = F.concat(F.lit("http://h/a-"), F.expr("uuid()"))
    page = F.concat(F.lit("<link rel='prev' href='"), "url", F.lit("-p'>"))
    fetches = spark.range(3).select(url.alias("url"), F.lit(200).alias("status"), F.lit(1.0).alias("timestamp"))
    record_fetches(spark, fetches.withColumn("source", page), *paths, "sold")
    messages = spark.read.parquet(paths[0]).select(parse_message(F.col("value"))["url"].alias("url"))
    known = {r["url"].split("-")[-1] for r in messages.collect()}
    assert {r["id"] for r in spark.read.parquet(paths[2]).collect()} == known
    assert {r["url"].split("-")[-2] for r in read_pending(spark, paths[1]).collect()} == known


def test_a_first_day_without_records(spark, folder):
    source = ReplayTopic("other", log(spark, message(1, 1)))
    reports = run_daily(spark, source, f"{folder}/b", f"{folder}/s", "sold", f"{folder}/o", D1)
    assert (reports[0].rows, reports[1].stored) == (0, 0)


def test_refining_a_date_again_changes_nothing(spark, folder):
    source = ReplayTopic("t", log(spark, message(1, 1), message(2, 2)))
    ingest(spark, source, f"{folder}/b", "forsale", f"{folder}/o", D1)
    for _ in range(2):
        refine_date(spark, f"{folder}/b", f"{folder}/s", D1, FORSALE)
    assert read_silver(spark, f"{folder}/s").count() == 2


def test_rejected_rows_are_counted(spark, folder):
    pages = [
        page({"id": 1, "price": 5}),
        page({"id": "x", "price": 5}),
        page({"price": 5}),
        "<script>dataLayer = [{}];</script>",
        "<p>none</p>",
        None,
    ]
    messages = [(f"http://h/villa-{i}", source, 1.0, 0, i) for i, source in enumerate(pages)]
    append_bronze(to_bronze(log(spark, *messages), D1), f"{folder}/bronze")
    report = refine_date(spark, f"{folder}/bronze", f"{folder}/silver", D1, FORSALE, count_rejected=True)
    reasons = dict.fromkeys(("id of another type", "no id", "no object", "no data layer", "no page"), 1)
    assert (report.records, report.stored, report.rejected) == (6, 1, reasons)
    plain = refine_date(spark, f"{folder}/bronze", f"{folder}/other", D1, FORSALE)
    assert (plain.stored, plain.rejected) == (1, None)


def test_two_sales_of_one_home(spark, folder):
    def sale(home, sale_id, offset):
        return (f"http://h/villa-{sale_id}", page({"id": home}, {"id": sale_id}), 1.0, 0, offset)

    source = ReplayTopic("t", log(spark, sale(5, 1, 0)))
    run_daily(spark, source, f"{folder}/b", f"{folder}/s", "sold", f"{folder}/o", D1)
    source = ReplayTopic("t", log(spark, sale(5, 2, 1), sale(5, 3, 2)))
    ingest(spark, source, f"{folder}/b", "sold", f"{folder}/o", D2)
    with pytest.raises(ValueError, match="listing_id more than once"):
        refine_date(spark, f"{folder}/b", f"{folder}/s", D2, SOLD)


def test_stream_equals_batch_and_resumes(spark, folder):
    logs, sink, checkpoint = (f"{folder}/{n}" for n in ("log", "rows", "checkpoint"))
    first = log(spark, message(1, 1), message(2, 2))
    first.write.parquet(logs)
    stream = replay_stream(spark, logs)

    def run(date):
        progress = ingest_stream(stream, sink, checkpoint, date).recentProgress
        return sum(p["numInputRows"] for p in progress)

    assert run(D1) == 2
    assert run(D1) == 0
    log(spark, message(3, 3)).write.mode("append").parquet(logs)
    assert run(D2) == 1
    batch = f"{folder}/batch"
    for part, day in ((first, D1), (spark.read.schema(LOG_RECORD).parquet(logs), D2)):
        ingest(spark, ReplayTopic("t", part), batch, "sold", f"{folder}/o", day)
    columns = [c.split()[0] for c in BRONZE.split(", ")]
    streamed, batched = (
        sorted(map(str, read_bronze(spark, path).select(columns).collect())) for path in (sink, batch)
    )
    assert streamed == batched
    # neither may add to the other's table, where its rows would not show
    with pytest.raises(ValueError, match="written by a stream"):
        ingest(spark, ReplayTopic("t", first), sink, "sold", f"{folder}/o2", D1)
    with pytest.raises(ValueError, match="rows of batch runs"):
        ingest_stream(stream, batch, f"{folder}/checkpoint2", D1)


@pytest.mark.parametrize("master", ["local[4]", "spark://h:7077"])
def test_work_folder_is_the_shared_one(folder, master):
    def session(**options):
        options = {k.replace("_", "."): v for k, v in options.items()}
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, default=None: options.get(k, default)))

    shared = session(spark_master=master, spark_checkpoint_dir=f"{folder}/")
    assert work_dir(shared, "x").startswith(f"{folder}/listmill/x-")
    assert work_dir(shared, "x") != work_dir(shared, "x")
    unset = session(spark_master=master)
    if master.startswith("local"):
        assert "/listmill/x-" in work_dir(unset, "x")
    else:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            work_dir(unset, "x")


def test_refining_a_stream_equals_daily_runs(spark, folder):
    """Each micro-batch is upserted once, also one that is run again after a failure."""
    rows, silver, checkpoint = f"{folder}/bronze", f"{folder}/silver", f"{folder}/checkpoint"
    daily = f"{folder}/daily"
    for day, messages in ((D1, [message(1, 5), message(2, 6)]), (D2, [message(1, 7), message(3, 8)])):
        append_bronze(to_bronze(log(spark, *messages), day), rows)
        refine_stream(spark, rows, silver, checkpoint, FORSALE)
        refine_date(spark, rows, daily, day, FORSALE)
    assert prices(spark, silver) == prices(spark, daily) == [(1, 7), (2, 6), (3, 8)]
    # the batch was stored, but the stream died before it said so; the table has changed since
    remove_path(spark, f"{checkpoint}/commits/1")
    newer = to_bronze(log(spark, message(1, 9)), D2)
    assert upsert_silver(spark, silver, refine(newer, FORSALE), "listing_id") == 1
    refine_stream(spark, rows, silver, checkpoint, FORSALE)
    assert prices(spark, silver) == [(1, 9), (2, 6), (3, 8)]
    # nothing new; then a batch in which no row is a listing
    refine_stream(spark, rows, silver, checkpoint, FORSALE)
    empty = to_bronze(log(spark, ("http://h/villa-4", "<p>none</p>", 1.0, 0, 99)), D2)
    append_bronze(empty, rows)
    refine_stream(spark, rows, silver, checkpoint, FORSALE)
    assert prices(spark, silver) == [(1, 9), (2, 6), (3, 8)]


def test_batches_of_different_streams_do_not_hide_each_other(spark, folder):
    batches = [refine(to_bronze(log(spark, message(i, i)), D1), FORSALE) for i in (1, 2)]
    silver = f"{folder}/silver"
    assert upsert_silver(spark, silver, batches[0], "listing_id", batch_of=("a", 0)) == 1
    assert upsert_silver(spark, silver, batches[1], "listing_id", batch_of=("b", 0)) == 1
    assert upsert_silver(spark, silver, batches[1], "listing_id", batch_of=("b", 0)) == 0
    assert upsert_silver(spark, silver, batches[0], "listing_id", batch_of=("b", 1)) == 1
    assert prices(spark, silver) == [(1, 1), (2, 2)]


def prices(spark, silver):
    rows = read_silver(spark, silver).select("listing_id", "collected_on").collect()
    return sorted((int(r["listing_id"]), int(r["collected_on"])) for r in rows)
