"""Consecutive row numbers and stable pages over tables of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartorio.session import shared_dir

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the partition above this bit


def dense_row_number(df: DataFrame, order_by: list[str | Column], name: str) -> DataFrame:
    """Row number 1..n in ``order_by`` order without sorting the table in one task.

    A range sort gives each partition a contiguous slice; a row's number is its place in its
    slice plus the sizes of the slices before it. The slices are checkpointed, since a second
    range sort could cut them elsewhere. Only one count per slice meets in one task, and the
    broadcast holds that many rows.
    """
    shared_dir(df.sparkSession)
    slices = (
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_slice", F.shiftright("_at", _LOCAL_BITS))
        .checkpoint()
    )
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        slices.groupBy("_slice").agg(F.count("*").alias("_n"))
        .select("_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    local = F.col("_at").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    return (
        slices.join(F.broadcast(offsets), "_slice")
        .withColumn(name, (F.col("_offset") + local + 1).cast("bigint"))
        .select(*df.columns, name)
    )


def page(df: DataFrame, order_by: list[Column], limit: int, offset: int, deep: int = 10_000) -> DataFrame:
    """Rows ``offset .. offset+limit`` of the ordered table.

    Near pages use a top-k, which holds offset+limit rows in one task; pages past ``deep`` rows
    are cut by row number instead, so that a far page gathers nothing but itself.
    """
    if offset + limit <= deep:
        return df.orderBy(*order_by).offset(offset).limit(limit)
    numbered = dense_row_number(df, order_by, "_row")
    return numbered.where(F.col("_row").between(offset + 1, offset + limit)).orderBy("_row").drop("_row")
