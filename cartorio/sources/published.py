"""Curated tables that stay readable while a run writes the next state of them.

Every run writes into folders of its own, ``<root>/<table>/run=<run>``. A small pointer file, put in place last by a
rename, names the folders that make up each table; readers start from the newest pointer. So a run that fails
changes nothing, a reader sees all tables of one state, and a run that only adds rows neither reads nor rewrites
what is there. One run publishes at a time.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, types as T

from cartorio.sources.sinks import side_by_side, write_parquet_zstd
from cartorio.sources.tables import register_views

#: Pointer files below a root; readers of Parquet pass over names that begin so.
_POINTERS = "_pointers"


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, at = _fs(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(at)) if fs.exists(at) else []


def _pointers(spark: SparkSession, root: str) -> list[str]:
    return [n for n in _names(spark, f"{root}/{_POINTERS}") if n.endswith(".json")]


def _read(spark: SparkSession, path: str) -> dict:
    fs, at = _fs(spark, path)
    stream = fs.open(at)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def state(spark: SparkSession, root: str) -> dict:
    """``tables`` (folders and schema of each) and ``marks`` of the newest pointer; empty before the first."""
    root = root.rstrip("/")
    found = _pointers(spark, root)
    return _read(spark, f"{root}/{_POINTERS}/{found[-1]}") if found else {"tables": {}, "marks": {}}


def _point(spark: SparkSession, root: str, made: dict) -> None:
    found = _pointers(spark, root)
    number = int(found[-1][:-5]) + 1 if found else 1
    fs, final = _fs(spark, f"{root}/{_POINTERS}/{number:012d}.json")
    _, draft = _fs(spark, f"{root}/{_POINTERS}/.{uuid.uuid4().hex}")
    out = fs.create(draft)
    out.write(bytearray(json.dumps(made).encode()))
    out.close()
    if fs.exists(final) or not fs.rename(draft, final):
        raise RuntimeError(f"another run published {final} meanwhile")


def published(spark: SparkSession, root: str, name: str, now: dict | None = None) -> DataFrame | None:
    """The table as the newest pointer, or that of ``now``, has it; None where it has none."""
    root = root.rstrip("/")
    entry = (now or state(spark, root))["tables"].get(name)
    if entry is None:
        return None
    schema = T.StructType.fromJson(json.loads(entry["schema"]))
    return spark.read.schema(schema).option("basePath", f"{root}/{name}").parquet(
        *[f"{root}/{name}/{f}" for f in entry["folders"]]).select(*schema.fieldNames())


def publish(
    spark: SparkSession, root: str, tables: dict[str, DataFrame], partitions: dict[str, list[str]] | None = None,
    append: bool = False, marks: dict[str, int] | None = None,
) -> dict[str, DataFrame]:
    """Write ``tables`` and point to them; all tables below ``root`` as they are then.

    With ``append`` their rows come to what the tables hold, columns by name; else they take its place. Tables not
    given stay. Where ``partitions`` names columns, rows are brought together by them first: few files for each
    value, and a value of very many rows is split. ``marks`` are numbers kept with the state.
    """
    root, run = root.rstrip("/"), f"run=r{uuid.uuid4().hex}"
    now = state(spark, root)

    def write(name: str) -> None:
        by = (partitions or {}).get(name)
        df = tables[name]
        write_parquet_zstd(df.hint("rebalance", *by) if by else df, f"{root}/{name}/{run}", by)

    side_by_side(write, list(tables))
    entries = dict(now["tables"])
    for name, df in tables.items():
        old = entries.get(name) if append else None
        fields, folders = list(df.schema.fields), [run]
        if old:
            had = T.StructType.fromJson(json.loads(old["schema"])).fields
            fields = had + [f for f in fields if f.name not in {h.name for h in had}]
            fresh = [n for n in _names(spark, f"{root}/{name}/{run}") if not n.startswith(("_", "."))]
            folders = old["folders"] + ([run] if fresh else [])
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields])
        entries[name] = {"folders": folders, "schema": schema.json()}
    _point(spark, root, {"tables": entries, "marks": {**now["marks"], **(marks or {})}})
    return register_published(spark, root)


def register_published(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Every published table registered as a view of its name, all of one state."""
    now = state(spark, root)
    tables = {name: published(spark, root, name, now) for name in now["tables"]}
    register_views(tables)
    return tables


def expire(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Remove pointers but the newest ``keep`` and the folders that none of these names; the folders removed.

    What failed runs left goes too, so no run may be writing. Only folders are listed, one listing a table.
    """
    root = root.rstrip("/")
    found = _pointers(spark, root)
    kept, gone = found[-keep:], []
    held = {(n, f) for p in kept for n, e in _read(spark, f"{root}/{_POINTERS}/{p}")["tables"].items() for f in e["folders"]}
    for name in [n for n in _names(spark, root) if n != _POINTERS]:
        gone += [f"{name}/{f}" for f in _names(spark, f"{root}/{name}") if f.startswith("run=") and (name, f) not in held]
    for path in [f"{root}/{_POINTERS}/{p}" for p in found[:-keep]] + [f"{root}/{g}" for g in gone]:
        fs, at = _fs(spark, path)
        fs.delete(at, True)
    return gone
