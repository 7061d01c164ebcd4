"""The upsert contract, as one plan and on the stored table."""

import datetime as dt
import os
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from listmill.operators import merge
from listmill.sources import tables
from listmill.sources.delta import delta_available, upsert_delta
from listmill.sources.tables import (
    ConflictingKeys,
    SchemaMismatch,
    read_silver,
    silver_exists,
    upsert_silver,
)
from tests.conftest import final_plan

SCHEMA = "k string, v int, ingestion_date date"
D1, D2, D3 = (dt.date(2024, 1, d) for d in (1, 2, 3))


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def rows(df):
    return Counter(tuple(r) for r in df.select("k", "v", "ingestion_date").collect())


def brute_force(table, batch, only_newer=False):
    """The same, row by row."""
    result, used = [], set()
    for k, v, d in table:
        hits = [i for i, s in enumerate(batch) if k is not None and s[0] == k]
        used.update(hits)
        hits = [i for i in hits if not only_newer or batch[i][2] >= d]
        result.append(batch[hits[0]] if hits else (k, v, d))
    return Counter(result + [s for i, s in enumerate(batch) if i not in used])


def test_matched_unmatched_and_null_keys(spark, folder):
    table = [("a", 1, D1), ("b", 1, D1), (None, 1, D1)]
    batch = [("b", 2, D2), ("c", 2, D2), (None, 9, D2)]
    expected = Counter(
        [("a", 1, D1), ("b", 2, D2), ("c", 2, D2), (None, 1, D1), (None, 9, D2)]
    )
    assert not silver_exists(spark, folder)
    assert upsert_silver(spark, folder, frame(spark, *table), "k") == 3
    assert silver_exists(spark, folder)
    assert upsert_silver(spark, folder, frame(spark, *batch), "k") == 3
    assert rows(read_silver(spark, folder)) == expected
    # null keys are added once more by each run, others are not
    upsert_silver(spark, folder, frame(spark, *batch), "k")
    assert rows(read_silver(spark, folder)) == expected + Counter([(None, 9, D2)])


def test_first_run_stores_repeated_keys(spark, folder):
    upsert_silver(spark, folder, frame(spark, ("a", 1, D1), ("a", 2, D1)), "k")
    assert rows(read_silver(spark, folder)) == Counter([("a", 1, D1), ("a", 2, D1)])
    # one batch row then replaces both
    upsert_silver(spark, folder, frame(spark, ("a", 3, D2)), "k")
    assert rows(read_silver(spark, folder)) == Counter({("a", 3, D2): 2})


def test_repeated_key_in_batch_and_table_is_an_error(spark, folder):
    before = Counter([("a", 1, D1)])
    upsert_silver(spark, folder, frame(spark, ("a", 1, D1)), "k")
    with pytest.raises(ConflictingKeys, match="k more than once"):
        upsert_silver(spark, folder, frame(spark, ("a", 2, D2), ("a", 3, D2), ("b", 1, D2)), "k")
    assert rows(read_silver(spark, folder)) == before
    # not in the table: all are added
    upsert_silver(spark, folder, frame(spark, ("b", 2, D2), ("b", 3, D2)), "k")
    assert rows(read_silver(spark, folder)) == before + Counter([("b", 2, D2), ("b", 3, D2)])


def test_moved_rows_leave_their_date(spark, folder):
    upsert_silver(spark, folder, frame(spark, ("a", 1, D1), ("b", 1, D2)), "k")
    upsert_silver(spark, folder, frame(spark, ("a", 2, D3)), "k")
    assert rows(read_silver(spark, folder)) == Counter([("b", 1, D2), ("a", 2, D3)])
    # the emptied date can come back
    upsert_silver(spark, folder, frame(spark, ("c", 1, D1)), "k")
    assert rows(read_silver(spark, folder)) == Counter(
        [("b", 1, D2), ("a", 2, D3), ("c", 1, D1)]
    )


def test_only_touched_dates_are_rewritten(spark, folder):
    upsert_silver(spark, folder, frame(spark, ("a", 1, D1), ("b", 1, D2)), "k")
    upsert_silver(spark, folder, frame(spark, ("b", 2, D3)), "k")
    version, held = tables._held(spark, folder)
    assert (version, held) == (2, {D1: 1, D3: 2})


def test_an_older_date_replaces_a_newer_one_unless_told_not_to(spark, folder):
    upsert_silver(spark, folder, frame(spark, ("a", 2, D2), ("b", 2, D2)), "k")
    old = frame(spark, ("a", 1, D1), ("c", 1, D1))
    upsert_silver(spark, folder, old, "k", only_newer=True)
    kept = Counter([("a", 2, D2), ("b", 2, D2), ("c", 1, D1)])
    assert rows(read_silver(spark, folder)) == kept
    upsert_silver(spark, folder, old, "k")
    assert rows(read_silver(spark, folder)) == Counter([("a", 1, D1), ("b", 2, D2), ("c", 1, D1)])


def test_leftovers_of_a_failed_run_do_not_show(spark, folder, monkeypatch):
    upsert_silver(spark, folder, frame(spark, ("a", 1, D1)), "k")
    with monkeypatch.context() as patch:
        patch.setattr(tables, "_commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            upsert_silver(spark, folder, frame(spark, ("a", 2, D2), ("z", 2, D3)), "k")
    assert rows(read_silver(spark, folder)) == Counter([("a", 1, D1)])
    upsert_silver(spark, folder, frame(spark, ("a", 3, D2)), "k")
    assert rows(read_silver(spark, folder)) == Counter([("a", 3, D2)])


def test_empty_batches(spark, folder):
    empty = frame(spark).limit(0)
    assert upsert_silver(spark, folder, empty, "k") == 0
    assert not silver_exists(spark, folder)
    upsert_silver(spark, folder, frame(spark, ("a", 1, D1)), "k")
    assert upsert_silver(spark, folder, empty, "k") == 0
    assert rows(read_silver(spark, folder)) == Counter([("a", 1, D1)])


def test_keys_too_large_to_broadcast(spark, folder, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", listmill__broadcastBytes="0")
    table = [(str(i), 1, D1 if i % 2 else D2) for i in range(50)] + [(None, 1, D1)] * 3
    batch = [(str(i), 2, D3) for i in range(40, 60)] + [(None, 2, D3)]
    upsert_silver(spark, folder, frame(spark, *table), "k")
    upsert_silver(spark, folder, frame(spark, *batch), "k")
    assert rows(read_silver(spark, folder)) == brute_force(table, batch)


keys = st.one_of(st.none(), st.sampled_from("abcdef"))
days = st.sampled_from([D1, D2, D3])
some_rows = st.lists(st.tuples(keys, st.integers(0, 3), days), max_size=8)
batches = st.lists(
    st.tuples(keys, st.integers(4, 7), days),
    max_size=6,
    unique_by=lambda r: object() if r[0] is None else r[0],
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(some_rows, batches, st.booleans())
def test_upsert_is_row_by_row_merge(spark, tmp_path_factory, table, batch, only_newer):
    folder = str(tmp_path_factory.mktemp("silver"))
    upsert_silver(spark, folder, frame(spark, ("other", 0, D1), *table), "k")
    upsert_silver(spark, folder, frame(spark, *batch), "k", only_newer)
    want = brute_force([("other", 0, D1), *table], batch, only_newer)
    assert rows(read_silver(spark, folder)) == want


@pytest.mark.parametrize(
    "other", ["k string, w int, ingestion_date date", "k string, v long, ingestion_date date",
              "k string, v int, w int, ingestion_date date", "k string, ingestion_date date"]
)
def test_other_columns_are_refused(spark, folder, other):
    upsert_silver(spark, folder, frame(spark, ("a", 1, D1)), "k")
    values = {"k": "b", "v": 2, "w": 3, "ingestion_date": D3}
    names = [c.split()[0] for c in other.split(", ")]
    batch = spark.createDataFrame([tuple(values[n] for n in names)], other)
    before = set(os.listdir(f"{folder}/rows"))
    with pytest.raises(SchemaMismatch):
        upsert_silver(spark, folder, batch, "k")
    assert set(os.listdir(f"{folder}/rows")) == before
    assert rows(read_silver(spark, folder)) == Counter([("a", 1, D1)])
    # another order of the same columns is fine
    upsert_silver(spark, folder, frame(spark, ("b", 2, D3)).select("ingestion_date", "v", "k"), "k")
    assert rows(read_silver(spark, folder)) == Counter([("a", 1, D1), ("b", 2, D3)])


def test_few_matches_of_a_large_batch_keep_rows_without_a_shuffle(spark, folder, conf, monkeypatch):
    """Beyond the limit the batch's keys are joined by sorting, those that matched are broadcast."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1", listmill__broadcastBytes="2000")
    upsert_silver(spark, folder, frame(spark, *[(f"t{i}", 1, D1) for i in range(200)]), "k")
    plans, kept = [], merge.kept_rows

    def noted(*args):
        result = kept(*args)
        plans.append(result._jdf.queryExecution().executedPlan().toString())
        return result

    monkeypatch.setattr(merge, "kept_rows", noted)
    batch = [(f"b{i}", 2, D2) for i in range(100)] + [("t1", 2, D2), ("t2", 2, D2)]
    upsert_silver(spark, folder, frame(spark, *batch), "k")
    assert "BroadcastHashJoin" in plans[0] and "SortMergeJoin" not in plans[0]
    assert read_silver(spark, folder).count() == 300
    assert not os.path.exists(f"{folder}/work") or not os.listdir(f"{folder}/work")


@pytest.mark.skipif(delta_available(), reason="the package is installed")
def test_delta_needs_its_package(spark, folder):
    with pytest.raises(RuntimeError, match="not installed"):
        upsert_delta(spark, folder, frame(spark, ("a", 1, D1)), "k")


@pytest.mark.parametrize("only_newer", [False, True])
def test_changed_rows_take_one_join(spark, only_newer):
    table = frame(spark, ("a", 1, D1), ("b", 1, D3), ("c", 1, D1), (None, 1, D1))
    batch = frame(spark, ("a", 2, D2), ("b", 2, D2), ("d", 2, D2), ("d", 3, D2), (None, 2, D2))
    matched = merge.matched_rows(table, merge.batch_keys(batch, "k"), "k")
    assert merge.repeated_keys(matched, "k").isEmpty()
    changed = merge.changed_rows(matched, batch, "k", only_newer)
    apart = merge.updated_rows(matched, batch, "k", only_newer).unionByName(
        merge.added_rows(matched, batch, "k")
    )
    assert rows(changed) == rows(apart)
    assert (("b", 2, D2) in rows(changed)) is not only_newer
    joins = [df._jdf.queryExecution().optimizedPlan().toString().count("Join ") for df in (changed, apart)]
    assert joins[0] < joins[1]


def test_a_batch_is_joined_once_unless_the_table_repeats_its_keys(spark, folder, monkeypatch):
    joined = []
    for name in ("changed_rows", "updated_rows", "added_rows"):
        real = getattr(merge, name)
        monkeypatch.setattr(merge, name, lambda *a, n=name, f=real: joined.append(n) or f(*a))
    upsert_silver(spark, f"{folder}/once", frame(spark, ("a", 1, D1), ("b", 1, D1)), "k")
    upsert_silver(spark, f"{folder}/once", frame(spark, ("a", 2, D2), ("c", 2, D2)), "k")
    assert joined == ["changed_rows"]
    upsert_silver(spark, f"{folder}/twice", frame(spark, ("a", 1, D1), ("a", 2, D1)), "k")
    upsert_silver(spark, f"{folder}/twice", frame(spark, ("a", 3, D2), ("c", 3, D2)), "k")
    assert joined[1:] == ["updated_rows", "added_rows"]
    assert rows(read_silver(spark, f"{folder}/twice")) == Counter({("a", 3, D2): 2, ("c", 3, D2): 1})


JOINS = ("matched_rows", "changed_rows", "updated_rows", "added_rows", "kept_rows")


@pytest.fixture
def join_plans(monkeypatch):
    """The plans, after adaptive execution, of the joins that an upsert takes, by name."""
    plans = {}

    def noted(name, real):
        def call(*args):
            result = real(*args)
            plans[name] = final_plan(result)
            return result

        return call

    for name in JOINS:
        monkeypatch.setattr(merge, name, noted(name, getattr(merge, name)))
    return plans


@pytest.mark.parametrize("repeated, only_newer", [(False, False), (False, True), (True, False)])
def test_keys_beyond_the_limit_do_not_go_through_the_driver(
    spark, folder, conf, join_plans, repeated, only_newer
):
    """Spark would broadcast them: their files are small."""
    conf(spark__sql__autoBroadcastJoinThreshold="10m", listmill__broadcastBytes="2000")
    table = [(f"k{i}", 1, D1 if i % 2 else D2) for i in range(300)] + [(None, 1, D1)]
    table += [("k7", 0, D1)] * 3 if repeated else []
    batch = [(f"k{i}", 2, D2) for i in range(200, 400)] + [("k7", 2, D2), (None, 2, D2)]
    upsert_silver(spark, folder, frame(spark, *table), "k")
    upsert_silver(spark, folder, frame(spark, *batch), "k", only_newer)
    changed = {"updated_rows", "added_rows"} if repeated else {"changed_rows"}
    assert join_plans.keys() == {"matched_rows", "kept_rows", *changed}
    if not repeated and not only_newer:  # all of the batch, and no join
        assert "Join" not in join_plans.pop("changed_rows")
    for name, plan in join_plans.items():
        assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan, name
    assert rows(read_silver(spark, folder)) == brute_force(table, batch, only_newer)


def test_a_hot_key_of_the_table_meets_a_small_batch_where_it_is(spark, folder, conf, join_plans):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", listmill__broadcastBytes="2000")
    table = [("hot", i, D1) for i in range(100)] + [("b", 1, D1)]
    batch = [("hot", 2, D2), ("c", 2, D2), (None, 2, D2)]
    upsert_silver(spark, folder, frame(spark, *table), "k")
    upsert_silver(spark, folder, frame(spark, *batch), "k")
    assert "BroadcastHashJoin" in join_plans["updated_rows"] and "BuildRight" in join_plans["updated_rows"]
    assert "BroadcastExchange" not in join_plans["kept_rows"]
    assert rows(read_silver(spark, folder)) == brute_force(table, batch)
