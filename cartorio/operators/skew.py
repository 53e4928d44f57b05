"""Equi-joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows that one task is to hold of a key, and the most keys that are ever split.
ROWS_PER_TASK, MOST_HOT = 1_000_000, 10_000


def hot_keys(df: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``(key, _salts)`` of the keys with more rows than one task is to hold; NULL is a key like any other.

    A key gets as many salts as tasks it fills. Keys below a ten-thousandth of all rows are left whole,
    so there are at most ``MOST_HOT`` hot keys at any table size. One pass over ``df``.
    """
    counts = df.groupBy(key).agg(F.count("*").alias("_n"))
    most = counts.agg(F.greatest(F.lit(rows_per_task), F.ceil(F.sum("_n") / MOST_HOT)).alias("_most"))
    return (
        counts.crossJoin(F.broadcast(most))  # one row
        .where(F.col("_n") > F.col("_most"))
        .select(key, F.ceil(F.col("_n") / F.col("_most")).cast("int").alias("_salts"))
    )


def salted_join(
    many: DataFrame, one: DataFrame, key: str, salt_by: str, how: str = "inner", rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Join ``many`` to ``one`` on ``key``, with each hot key of ``many`` spread over buckets of a task's size.

    Rows of a hot key get a bucket from ``salt_by`` (a column that varies within the key), and
    the matching row of ``one`` is repeated once per bucket; all other keys use bucket 0. The
    list of hot keys is broadcast: ``hot_keys`` bounds its rows. A NULL key matches nothing.
    """
    if how not in ("inner", "left", "left_anti", "left_semi"):
        raise ValueError(f"unsupported join type {how}")
    hot = F.broadcast(hot_keys(many, key, rows_per_task).withColumnRenamed(key, "_key"))
    salts = F.coalesce("_salts", F.lit(1))
    left = many.join(hot, many[key].eqNullSafe(F.col("_key")), "left").withColumn(
        "_salt", F.pmod(F.xxhash64(salt_by), salts).cast("int")).drop("_key", "_salts")
    right = one.join(hot, one[key] == F.col("_key"), "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_key", "_salts")
    return left.join(right, [key, "_salt"], how).drop("_salt")
