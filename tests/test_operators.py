from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cartorio.operators.keys import dense_row_number, page
from cartorio.operators.shares import share_of_total
from cartorio.operators.skew import hot_keys, salted_join


@pytest.fixture
def many(spark):
    # one key holds a third of the rows, some keys are null, some unknown
    return spark.range(0, 9_000, numPartitions=5).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 700).alias("k"),
        F.col("id").alias("row"))


@pytest.fixture
def one(spark):
    return spark.range(0, 500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))


@pytest.mark.parametrize("how", ["inner", "left", "left_anti", "left_semi"])
def test_salted_join_equals_plain_join(many, one, how, rows):
    got, want = salted_join(many, one, "k", "row", how, rows_per_task=100), many.join(one, "k", how)
    assert got.columns == want.columns
    assert rows(got) == rows(want)


def test_hot_keys_are_few_and_found(many):
    assert [(r.k, r._salts) for r in hot_keys(many, "k", 1_000).collect()] == [(7, 4)]
    assert hot_keys(many, "k").count() == 0


def test_buckets_of_a_hot_key_hold_a_task_each(many, one):
    hot = hot_keys(many, "k", 200)
    buckets = many.join(hot, "k").groupBy("k", F.pmod(F.xxhash64("row"), "_salts")).count()
    sizes = [r["count"] for r in buckets.collect()]
    assert sum(sizes) == many.where("k = 7").count() and max(sizes) < 2 * 200


def test_dense_row_number_has_no_gaps(spark):
    df = spark.range(0, 5_000, numPartitions=7).select((F.col("id") * 37 % 5_000).alias("x"))
    got = dense_row_number(df, ["x"], "n").collect()
    assert sorted((r.x, r.n) for r in got) == [(i, i + 1) for i in range(5_000)]


def test_near_and_deep_pages_agree(spark):
    df = spark.range(0, 3_000, numPartitions=4).select((F.col("id") * 7 % 3_000).alias("x"))
    near = [r.x for r in page(df, [F.desc("x")], 50, 1_000).collect()]
    deep = [r.x for r in page(df, [F.desc("x")], 50, 1_000, deep=10).collect()]
    assert near == deep == list(range(1_999, 1_949, -1))


def test_share_of_total(spark, rows):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "g string")
    assert rows(share_of_total(df, ["g"])) == [("a", 2, 50.0), ("b", 1, 25.0), (None, 1, 25.0)]
    assert share_of_total(df.where("false"), ["g"]).count() == 0
