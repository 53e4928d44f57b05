"""Distributed writes of curated tables."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartorio.functions.fixed import EXPORT_TABLES


def side_by_side(work: Callable[[str], Any], names: list[str], most: int = 8) -> dict[str, Any]:
    """``work`` of each name, several at a time, so that the jobs of small tables share the cluster."""
    with ThreadPoolExecutor(most) as pool:
        return dict(zip(names, pool.map(work, names)))


def write_parquet_zstd(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> str:
    writer = df.write.mode(mode).option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return path


def export_csv(df: DataFrame, path: str) -> str:
    """Header and RFC-4180 quoting; blanks in cells are kept."""
    (df.write.mode("overwrite").option("header", True).option("escape", '"')
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return path


def export_jsonl(df: DataFrame, path: str) -> str:
    """One object per row, ISO dates, missing values written as null."""
    df.write.mode("overwrite").option("ignoreNullFields", False).option("dateFormat", "yyyy-MM-dd").json(path)
    return path


_FORMATS = {"csv": export_csv, "jsonl": export_jsonl, "parquet": write_parquet_zstd}


def export_dataset(spark: SparkSession, dataset: str, fmt: str, path: str) -> str:
    """Write one of the exportable datasets, taken from the registered curated tables."""
    table = EXPORT_TABLES.get(dataset.lower())
    if table is None:
        raise ValueError(f"invalid dataset {dataset!r}, choose from {sorted(EXPORT_TABLES)}")
    if fmt not in _FORMATS:
        raise ValueError(f"invalid format {fmt!r}, choose from {sorted(_FORMATS)}")
    if not spark.catalog.tableExists(table):
        raise LookupError(f"dataset {table} is not in the catalog")
    return _FORMATS[fmt](spark.table(table), path)


def write_table_format(df: DataFrame, path: str, fmt: str) -> str:
    """Delta or Iceberg through its connector, which must be on the session's classpath."""
    if fmt not in ("delta", "iceberg"):
        raise ValueError(f"invalid table format {fmt!r}")
    df.write.format(fmt).mode("overwrite").save(path)
    return path


def file_statistics(df: DataFrame) -> DataFrame:
    """Per data file of a file-based table: name, bytes, modification time and rows."""
    meta = F.col("_metadata")
    return (
        df.select(
            meta.getField("file_path").alias("path"),
            meta.getField("file_size").alias("size"),
            meta.getField("file_modification_time").alias("modification_time"),
        )
        .groupBy("path", "size", "modification_time")
        .agg(F.count("*").alias("num_records"))
    )
