"""Helpers shared by the operators: tables cut from their lineage, connected components, query registry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartorio.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query ``(spark, sf_dir) -> DataFrame``, with its SQL where there is one."""
    def add(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Tables written to the shared folder; ``drop`` removes one that nothing reads any more."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.n = spark, scratch_path(spark, name), 0

    def store(self, df: DataFrame, tidy: bool = False) -> DataFrame:
        """``df`` written once and read back: what follows does not depend on executors that may be lost.

        ``tidy``: files of its exchanges go once it is written, not with the driver's garbage.
        """
        self.n += 1
        path, conf = f"{self.root}/{self.n}", self.spark.conf
        before = conf.get(_TIDY, None)
        if tidy:
            conf.set(_TIDY, "true")
        try:
            df.write.parquet(path)
        finally:
            if tidy:
                conf.set(_TIDY, before) if before is not None else conf.unset(_TIDY)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch = path
        return out

    def drop(self, df: DataFrame) -> None:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(df._scratch)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def components(edges: DataFrame, scratch: Scratch, rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)`` (longs); the root is the smallest node reachable.

    Alternating large-star and small-star: each round links a node's larger neighbours to its smallest one, by
    a minimum per node and a join, so no neighbour list is ever gathered. The number of rounds grows with the
    logarithm of the longest chain. NULL ends and self-links are ignored.
    """
    e = scratch.store(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("a is not null and b is not null and a <> b").distinct())
    before = None
    for _ in range(rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = scratch.store(large)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        out = scratch.store(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        now = out.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        scratch.drop(e)
        scratch.drop(large)
        e = out
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    out = e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
    out._scratch = e._scratch
    return out
