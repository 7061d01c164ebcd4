import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from listmill.operators.refine import CANONICAL, FORSALE, SOLD, latest_per_key, refine
from listmill.operators.bronze import bronze_for_date, to_bronze
from listmill.schemas import BRONZE
from listmill.sources.tables import append_bronze, read_bronze
from tests.conftest import final_plan

DAY = dt.date(2024, 1, 2)


def page(prop=None, sold=None):
    objects = {"page": "x"}
    if prop is not None:
        objects["property"] = prop
    if sold is not None:
        objects["sold_property"] = sold
    return f"<script>dataLayer = [{json.dumps(objects, separators=(',', ':'))}];</script>"


def bronze(spark, *messages, date=DAY):
    """Rows from (url, source, timestamp, partition, offset)."""
    rows = [
        (
            None,
            json.dumps({"url": url, "source": source, "timestamp": t}),
            "t",
            p,
            o,
            dt.datetime(2024, 1, 1),
            0,
            date,
        )
        for url, source, t, p, o in messages
    ]
    return spark.createDataFrame(rows, BRONZE)


def test_forsale_columns_and_types(spark):
    df = refine(bronze(spark, ("http://h/villa-3rum-5", page({"id": 5, "rooms": 2}), 1.5, 0, 0)), FORSALE)
    assert df.columns == ["ingestion_date", "url", "collected_on", "listing_id", "prop_type", "props"]
    assert dict(df.dtypes)["listing_id"] == "string" and len(df.schema["props"].dataType) == 26
    [row] = df.collect()
    assert (row["listing_id"], row["prop_type"], row["collected_on"]) == ("5", "villa", 1.5)
    assert (row["props"]["id"], row["props"]["rooms"]) == (5, 2.0)


def test_canonical_has_its_own_fields(spark):
    source = page({"id": 5, "borattavgift": 7, "amenities": ["a", None]})
    df = refine(bronze(spark, ("http://h/villa-5", source, 1.5, 0, 0)), CANONICAL)
    assert len(df.schema["props"].dataType) == 14
    props = df.first()["props"]
    assert (props["borattavgift"], props["amenities"]) == (7, ["a", None])


def test_sold_takes_both_ids_from_json(spark):
    df = refine(
        bronze(
            spark,
            ("http://h/villa-1", page({"id": 5}, {"id": 3000000000, "rooms": 2.5}), 1.0, 0, 0),
            ("http://h/villa-2", page(None, {"id": 8}), 1.0, 0, 1),
            ("http://h/villa-3", page({"id": 5}), 1.0, 0, 2),
        ),
        SOLD,
    )
    assert dict(df.dtypes)["sold_id"] == "bigint" and dict(df.dtypes)["listing_id"] == "int"
    rows = {r["sold_id"]: r for r in df.collect()}
    assert rows.keys() == {3000000000, 8}
    assert (rows[3000000000]["listing_id"], rows[8]["listing_id"]) == (5, None)
    assert rows[3000000000]["sold_props"]["rooms"] == "2.5"


def test_rows_without_an_id_do_not_count_as_latest(spark):
    df = refine(
        bronze(
            spark,
            ("http://h/villa-5", page({"id": 5, "price": 1}), 1.0, 0, 0),
            ("http://h/villa-5", page({"id": "5", "price": 2}), 2.0, 0, 1),
            ("http://h/villa-5", "no data", 3.0, 0, 2),
            ("http://h/villa-6", "no data", 3.0, 0, 3),
        ),
        FORSALE,
    )
    assert [(r["listing_id"], r["props"]["price"]) for r in df.collect()] == [("5", 1)]


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_latest_does_not_depend_on_partitioning(spark, parts):
    messages = [
        (f"http://h/villa-{i % 3}", page({"id": i}), float(i % 2), i % 4, i // 4) for i in range(60)
    ]
    rows = refine(bronze(spark, *messages).repartition(parts), FORSALE).collect()
    best = {}
    for i in range(60):
        best[str(i % 3)] = max(best.get(str(i % 3), ((-1.0,), 0)), ((float(i % 2), i // 4, i % 4), i))
    assert {r["listing_id"]: r["props"]["id"] for r in rows} == {k: v[1] for k, v in best.items()}


def test_page_is_parsed_once_and_ranked_before_the_shuffle(spark, conf):
    conf(spark__sql__debug__maxToStringFields="500")
    df = refine(bronze(spark, ("http://h/villa-5", page({"id": 5}), 1.0, 0, 0)), FORSALE)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_extract(") == 1
    partial, shuffle = plan.index("row_number(), 1, Partial"), plan.index("Exchange hashpartitioning")
    assert shuffle < partial  # printed from the result down to the scan
    assert plan.count("Exchange") == 1


def test_hot_key_shrinks_before_the_shuffle(spark):
    rows = spark.range(0, 30000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), "id"
    )
    latest = latest_per_key(rows, "k", ("id",))
    assert "WindowGroupLimit" in final_plan(latest)
    assert latest.where("k = -1").first()["id"] == 29997 and latest.count() == 20001


def test_bronze_partitions_are_pruned(spark, folder):
    for day in (DAY, dt.date(2024, 1, 3)):
        rows = bronze(spark, ("u-1", "s", 1.0, 0, 0), date=day)
        assert append_bronze(rows, f"{folder}/bronze") == 1
    one = bronze_for_date(read_bronze(spark, f"{folder}/bronze"), DAY)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingestion_date" in plan and one.count() == 1
    parsed = refine(one, FORSALE)._jdf.queryExecution().executedPlan().toString()
    read = parsed[parsed.index("ReadSchema") :]
    assert "key" not in read and "timestampType" not in read


def test_backfill_writes_few_files_per_date(spark, folder):
    days = F.expr("date_add(DATE'2024-01-01', CAST(id % 5 AS INT))").alias("ingestion_date")
    rows = spark.range(0, 2000, 1, 8).select(days, "id")
    for name, backfill, files in (("many", False, 40), ("few", True, 5)):
        assert append_bronze(rows, f"{folder}/{name}", backfill) == 2000
        assert len(list(Path(folder, name).glob("*/part-*"))) == files


def test_to_bronze_takes_a_date_a_column_or_today(spark):
    log = spark.createDataFrame(
        [(b"k", "å".encode(), "t", 0, 0, dt.datetime(2020, 5, 6, 7), 0)],
        "key binary, value binary, topic string, partition int, offset long, timestamp timestamp, timestampType int",
    )
    assert to_bronze(log, DAY).first()["ingestion_date"] == DAY
    assert to_bronze(log, F.to_date("timestamp")).first()["ingestion_date"] == dt.date(2020, 5, 6)
    today = spark.sql("SELECT current_date() AS d").first()["d"]
    row = to_bronze(log).first()
    assert row["ingestion_date"] == today and (row["key"], row["value"]) == ("k", "å")
