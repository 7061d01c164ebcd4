"""Input building: tasks that grow with the table, pages that only their readers pay for."""

import datetime as dt
import json
import re

import pytest
from pyspark.sql import functions as F

from listmill.operators.bronze import to_bronze
from listmill.plans import derived
from listmill.sources.paths import file_paths
from listmill.sources.tables import append_bronze

LINES = (
    "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
    "l_linestatus string, l_shipdate timestamp"
)


@pytest.fixture
def lines(spark, folder):
    day = dt.datetime(1998, 1, 1)
    rows = [(i, i, i % 9, i % 7 + 1, 2.0, 3.5, 0.1, 0.0, "N", "O", day) for i in range(100)]
    spark.createDataFrame(rows, LINES).write.parquet(f"{folder}/lineitem.parquet")
    return folder


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_page_tasks_grow_with_the_lines(spark, lines, monkeypatch):
    def tasks():
        found = re.search(r"RepartitionByExpression \[.*\], (\d+)", plan(derived.listing_log(spark, lines, "sold")))
        return int(found[1])

    assert tasks() == derived.PAGE_TASKS
    monkeypatch.setattr(derived, "PAGE_LINES", 2)
    assert tasks() == 50


def test_offsets_are_read_without_building_pages(spark, lines):
    log = derived.listing_log(spark, lines, "forsale")
    assert "StructsToJson" in plan(log)
    assert "StructsToJson" not in plan(log.groupBy("topic", "partition").agg(F.max("offset")))


def test_bronze_is_packed(spark, lines, folder):
    rows = to_bronze(derived.listing_log(spark, lines, "forsale"), dt.date(2024, 1, 1))
    assert append_bronze(rows, f"{folder}/bronze") == 100
    files = file_paths(spark, f"{folder}/bronze/ingestion_date=2024-01-01")
    assert files and all(f.endswith(".zstd.parquet") for f in files)


def test_page_objects_are_joined_without_counting_their_characters(spark, lines):
    source = derived.page_source("forsale").alias("source")
    pages = spark.read.parquet(f"{lines}/lineitem.parquet").select("l_orderkey", source)
    assert "substring(" not in plan(pages)
    text = pages.where("l_orderkey = 8").first()["source"]
    [found] = re.findall(r'"property":(\{.*\})\}\];', text.replace(',"user":{"login":false}', ""))
    prop = json.loads(found)
    assert (prop["id"], prop["water_distance"], prop["broker_firm"]) == (8, 8, "firm-8")
    assert prop["locations"]["city"] == "city\\N" and prop["amenities"] == ["balcony", "lift-2"]


def test_plain_lines_have_their_messages_joined_as_json_writes_them(spark):
    day = dt.datetime(1998, 1, 1)
    plain = [
        (i, i + 3, i % 9, i % 7 + 1, q, 1234567.5 * i, i % 3 / 20, i % 5 / 50, "NAR"[i % 3], "OF"[i % 2], day)
        for i, q in enumerate([1.0, 2.0, 26.0, 50.0] * 21)
    ]
    rows = plain + [(2**40, -1, 0, 0, -0.0, 1e-9, 1e20 / 1e11, 0.0, "", "~ x", day)]
    odd = [
        (*rows[0][:i], value, *rows[0][i + 1 :])
        for i, values in {
            **{i: [None] for i in range(10)},
            7: [float("nan"), float("-inf"), None],
            8: ['"', "\\", "a\nb", "\u0001", " ", None],
            9: ["Å", "{", "\x7f", None],
        }.items()
        for value in values
    ]
    lines = spark.createDataFrame(rows + odd, LINES).repartition(2)
    for target in ("forsale", "sold", "canonical"):
        texts = lines.select(
            derived.is_plain(lines.schema).alias("plain"),
            derived.plain_message(target, lines).alias("joined"),
            derived.message(target).alias("written"),
        ).collect()
        said = [t for t in texts if t["plain"]]
        assert len(said) == len(rows) + 1  # the brace needs no escape
        assert all(t["joined"] == t["written"] for t in said)


@pytest.mark.parametrize("target", ["forsale", "sold", "canonical"])
def test_pages_are_built_by_methods_that_the_jvm_compiles(spark, lines, conf, target):
    conf(spark__sql__adaptive__enabled="false")
    rows = to_bronze(derived.listing_log(spark, lines, target), derived.arrival_day())
    parts = rows._jdf.queryExecution().debug().codegenToSeq()
    assert parts.size() and all(
        parts.apply(i)._3().maxMethodCodeSize() < 8000 for i in range(parts.size())
    )
