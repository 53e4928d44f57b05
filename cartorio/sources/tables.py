"""Parquet layers and the catalog of curated tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartorio.sources.paths import if_there


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def table_at(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at ``path``, None where there is none."""
    return if_there(lambda: spark.read.parquet(path))


def register_views(tables: dict[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def table_names(spark: SparkSession) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables())


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, n_rows) of each table; the counts read no columns."""
    counts = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def list_tables(spark: SparkSession, names: list[str] | None = None) -> DataFrame:
    """Registered tables with their row counts."""
    return table_counts({n: spark.table(n) for n in (names or table_names(spark))})
