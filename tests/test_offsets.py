import datetime as dt
import json
import random

from pyspark.sql import functions as F

from listmill.operators import offsets
from listmill.schemas import LOG_RECORD, OFFSETS
from listmill.sources.log import kafka_options, read_replay, starting_offsets
from listmill.sources.state import commit_offsets, read_offsets, reset_offsets
from tests.conftest import final_plan


def log(spark, records):
    rows = [
        (None, f"v{o}".encode(), topic, p, o, dt.datetime(2024, 1, 1), 0) for topic, p, o in records
    ]
    return spark.createDataFrame(rows, LOG_RECORD)


def state(df):
    return {(r["topic"], r["partition"]): r["next_offset"] for r in df.collect()}


def test_starting_offsets():
    assert starting_offsets("t", {}) == "earliest"
    assert json.loads(starting_offsets("t", {1: 34, 0: 26})) == {"t": {"0": 26, "1": 34}}
    assert json.loads(starting_offsets("t", {0: 26}, range(3))) == {"t": {"0": 26, "1": -2, "2": -2}}
    options = kafka_options("h:9092", "t", {})
    assert "minPartitions" not in options and "kafka.group.id" not in options
    assert kafka_options("h:9092", "t", {}, min_tasks=40)["minPartitions"] == "40"
    assert kafka_options("h:9092", "t", {}, group="g")["kafka.group.id"] == "g"
    assert options["subscribe"] == "t"


def test_resume_starts_unseen_partitions_at_the_earliest(spark):
    records = log(spark, [("t", 0, 0), ("t", 0, 1), ("t", 1, 7), ("u", 0, 0)])
    stored = spark.createDataFrame([("x", "t", 0, 1)], OFFSETS)
    unread = offsets.resume(records, stored)
    assert unread.columns == records.columns
    assert {(r["topic"], r["partition"], r["offset"]) for r in unread.collect()} == {
        ("t", 0, 1),
        ("t", 1, 7),
        ("u", 0, 0),
    }


def test_latest_by_aggregate_and_by_ranking(spark):
    rng = random.Random(5)
    picks = sorted({(f"t{rng.randrange(3)}", rng.randrange(4), rng.randrange(500)) for _ in range(400)})
    records = log(spark, picks).repartition(7)
    expected = {}
    for topic, p, o in picks:
        expected[topic, p] = max(o, expected.get((topic, p), -1))
    for latest in (offsets.latest_offsets(records), offsets.latest_records(records)):
        assert {(r["topic"], r["partition"]): r["offset"] for r in latest.collect()} == expected


def test_state_never_goes_back_and_keeps_idle_partitions(spark, folder):
    path = f"{folder}/state"
    assert state(read_offsets(spark, path, "sold")) == {}
    for target, records in (
        ("sold", [("t", 0, 9), ("t", 10, 4)]),
        ("sold", [("t", 0, 3), ("t", 2, 1)]),
        ("forsale", [("t", 0, 50)]),
    ):
        commit_offsets(offsets.next_offsets(log(spark, records), target), path)
    stored = read_offsets(spark, path, "sold")
    assert state(stored) == {("t", 0): 10, ("t", 10): 5, ("t", 2): 2}
    [row] = offsets.offsets_json(stored).collect()
    assert row["offsets"] == '{"0":10,"2":2,"10":5}'


def test_replay_table(spark, folder):
    log(spark, [("t", 0, 0), ("it's", 0, 1)]).write.parquet(f"{folder}/log")
    assert [r["offset"] for r in read_replay(spark, f"{folder}/log", "it's").collect()] == [1]


def test_latest_offsets_combines_before_the_shuffle(spark):
    plan = offsets.latest_offsets(log(spark, [("t", 0, 0)]))._jdf.queryExecution().executedPlan()
    assert "partial_max" in plan.toString()


def test_resume_reads_only_what_is_used_and_shuffles_nothing(spark, conf, folder):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    log(spark, [("t", 0, o) for o in range(100)]).write.parquet(folder + "/log")
    records = spark.read.schema(LOG_RECORD).parquet(folder + "/log")
    stored = spark.createDataFrame([("x", "t", 0, 40)], OFFSETS)
    unread = offsets.resume(records, stored).select("offset")
    plan = final_plan(unread)
    assert "ReadSchema: struct<topic:string,partition:int,offset:bigint>" in plan
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    assert unread.agg(F.min("offset")).first()[0] == 40


def test_reset_offsets(spark, folder):
    path = f"{folder}/state"
    commit_offsets(offsets.next_offsets(log(spark, [("t", 0, 9), ("t", 1, 9)]), "sold"), path)
    reset_offsets(spark, path, "sold", "t", 0, 3)
    assert state(read_offsets(spark, path, "sold")) == {("t", 0): 3, ("t", 1): 10}
    commit_offsets(offsets.next_offsets(log(spark, [("t", 0, 5), ("t", 1, 2)]), "sold"), path)
    assert state(read_offsets(spark, path, "sold")) == {("t", 0): 6, ("t", 1): 10}
    reset_offsets(spark, path, "forsale", "u", 2, 7)
    reset_offsets(spark, path, "sold", "t", 1, 99)
    assert state(read_offsets(spark, path, "sold")) == {("t", 0): 6, ("t", 1): 99}
    assert state(read_offsets(spark, path, "forsale")) == {("u", 2): 7}


def test_a_log_behind_its_offsets_is_found(spark):
    records = log(spark, [("t", 0, 49), ("t", 1, 9), ("t", 2, 3)])
    stored = spark.createDataFrame([("x", "t", p, n) for p, n in ((0, 100), (1, 10), (3, 5))], OFFSETS)
    assert [tuple(r) for r in offsets.behind(records, stored).collect()] == [("t", 0, 49, 100)]
