"""Hot and null keys in the joins, by the plans that Spark ends up with."""

import pytest
from pyspark.sql import functions as F

from listmill.operators.joins import drop_matching, join_unique, row_bytes
from tests.conftest import final_plan

SMALL = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "50k",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "50k",
    "spark__sql__shuffle__partitions": "8",
}


def table(spark, hot):
    """A third of the rows have the key ``hot``."""
    key = F.when(F.col("id") % 3 == 0, F.lit(hot)).otherwise(F.col("id")).cast("long")
    return spark.range(0, 90000, 1, 8).select(key.alias("k"), F.md5(F.col("id").cast("string")).alias("v"))


@pytest.fixture
def keys(spark):
    odd = spark.range(0, 30000, 1, 2).select((F.col("id") * 2 + 1).alias("k"))
    return odd.groupBy("k").agg(F.count(F.lit(1)).alias("n"))


@pytest.mark.parametrize("hot", [7, 8])
def test_hot_key_is_split(spark, conf, keys, hot):
    conf(**SMALL)
    rows = table(spark, hot)
    kept = drop_matching(rows, keys, "k")
    assert "SortMergeJoin(skew=true)" in final_plan(kept)
    assert kept.count() == rows.where("k % 2 = 0 OR k >= 60000").count()
    both = join_unique(rows, keys, "k", "inner")
    assert "SortMergeJoin(skew=true)" in final_plan(both)
    assert both.columns == ["k", "v", "n"]
    assert both.count() == rows.where("k % 2 = 1 AND k < 60000").count()


def test_null_keys_stay_and_are_spread(spark, conf, keys):
    conf(**SMALL)
    rows = table(spark, None)
    kept = drop_matching(rows, keys, "k")
    assert "skew=true" not in final_plan(kept)
    sizes = [r["n"] for r in kept.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert max(sizes) < 2 * min(sizes) or len(sizes) == 1
    assert kept.where("k IS NULL").count() == 30000


def test_several_keys_and_a_condition(spark):
    left = spark.createDataFrame(
        [("a", 1, 5), ("a", 1, 3), ("a", 2, 1), (None, 1, 1), ("b", None, 0)], "t string, p int, o int"
    )
    right = spark.createDataFrame([("a", 1, 5), ("b", None, 9)], "t string, p int, n int")
    kept = drop_matching(left, right, ["t", "p"], F.col("a.o") < F.col("b.n"))
    assert sorted(kept.collect(), key=str) == sorted(
        left.where("o <> 3").collect(), key=str
    )


def test_bytes_of_whole_rows(spark):
    schema = "k string, n int, s struct<a: string, b: array<string>, c: struct<d: double>>"
    row = ("k" * 1000, 1, ("a" * 2000, ["b" * 3000, None, ""], (1.5,)))
    size = spark.createDataFrame([row], schema)
    measured = size.agg(row_bytes(size.schema)).first()[0]
    assert 6000 < measured < 7000
    nulls = spark.createDataFrame([(None, None, None), (None, None, (None, None, None))], schema)
    assert 0 < nulls.agg(row_bytes(nulls.schema)).first()[0] < 1000
    assert nulls.limit(0).agg(row_bytes(nulls.schema)).first()[0] == 0
