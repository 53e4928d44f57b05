"""Group counts, shares of the total and top-k reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartorio.functions.cells import percent


def share_of_total(
    df: DataFrame, by: list[str], count: str = "total", share: str = "percentual", weight: str | None = None,
) -> DataFrame:
    """Rows per group (or the sum of ``weight``) and the group's share of all rows in percent.

    The total is summed from the counted groups, whose shuffle Spark reuses, so the table is read
    once; an empty window would pull every group into one task instead.
    """
    counts = df.groupBy(*by).agg((F.sum(weight) if weight else F.count("*")).alias(count))
    total = counts.agg(F.sum(count).alias("_total"))
    return (
        counts.crossJoin(F.broadcast(total))
        .withColumn(share, percent(F.col(count), F.col("_total")))
        .drop("_total")
    )


def top_k(df: DataFrame, order_by: list[Column], k: int) -> DataFrame:
    return df.orderBy(*order_by).limit(k)
