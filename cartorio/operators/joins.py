"""Joins between facts and dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartorio.operators.skew import salted_join


def join_fact_dim_date(fact: DataFrame, calendar: DataFrame, key: str) -> DataFrame:
    """Inner join to the calendar. Spark broadcasts it by its size: one row per day."""
    days = calendar.select(F.col("date_key").alias(key), "year")
    return fact.join(days, key)


def join_fact_origin(fact: DataFrame, origin: DataFrame) -> DataFrame:
    """Inner join on the state; cases without a state drop out. Broadcast by size, not by hint."""
    return fact.join(origin.select("uf_origem", "regiao"), "uf_origem")


def join_decision_process(decisions: DataFrame, processes: DataFrame, how: str = "inner", salt_by: str = "decision_id") -> DataFrame:
    """Row-level join of decisions to their cases; a case with very many decisions is salted."""
    return salted_join(decisions, processes, "process_id", salt_by, how)


def decisions_per_case(decisions: DataFrame, *by: str) -> DataFrame:
    """Decisions counted by case and ``by`` columns, as ``n``.

    Aggregating joins start from this: the count merges on the map side, so a case with a third
    of all decisions meets the join as a few rows instead of one overfull task.
    """
    return decisions.groupBy("process_id", *by).agg(F.count("*").alias("n"))


def orphan_decisions(decisions: DataFrame, processes: DataFrame, salt_by: str = "decision_id") -> DataFrame:
    """Decisions whose case is unknown or not given."""
    return salted_join(decisions, processes.select("process_id"), "process_id", salt_by, "left_anti")


def first_decision_per_process(decisions: DataFrame) -> DataFrame:
    """Earliest decision date of each case."""
    return (
        decisions.where(F.col("process_id").isNotNull())
        .groupBy("process_id").agg(F.min("data_decisao").alias("primeira_decisao"))
    )


def with_event_date(processes: DataFrame, decisions: DataFrame) -> DataFrame:
    """Each case with the date of its first decision, or its start date where there is none."""
    first = first_decision_per_process(decisions)
    joined = processes.join(first, "process_id", "left")
    return joined.withColumn(
        "data_evento", F.coalesce("primeira_decisao", "data_distribuicao")).drop("primeira_decisao")


def cross_join_total(df: DataFrame, counted: DataFrame, name: str) -> DataFrame:
    """Every row of ``df`` beside the row count of ``counted`` (one row, so it is broadcast)."""
    return df.crossJoin(F.broadcast(counted.agg(F.count("*").alias(name))))


def left_join_stats(left: DataFrame, right: DataFrame, key: str, fill: dict[str, float]) -> DataFrame:
    """Left join of two per-key summaries; missing figures of the right side become ``fill``."""
    return left.join(right, key, "left").fillna(fill)
