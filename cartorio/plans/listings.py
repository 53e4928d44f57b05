"""Filtered, paged listings and read-only ad-hoc SQL."""

from __future__ import annotations

import time
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartorio.functions.cells import contains_text
from cartorio.operators.keys import page

_PROCESS_COLUMNS = [
    "process_id", "numero_processo", "classe_sigla", "classe_descricao", "assunto", "relator",
    "data_autuacao", "data_distribuicao", "uf_origem", "orgao_julgador", "situacao", "ano_distribuicao",
]
_DECISION_COLUMNS = [
    "decision_id", "process_id", "numero_processo", "classe_sigla", "data_decisao", "tipo_decisao",
    "categoria_decisao", "resultado", "relator", "orgao_colegiado", "ano_decisao",
]


def _equal(column: str, value: Any) -> list[Column]:
    """No filter for an empty or zero value; text is compared in upper case."""
    if not value:
        return []
    return [F.col(column) == (value.upper() if isinstance(value, str) else value)]


def _contains(column: str, value: str | None) -> list[Column]:
    return [contains_text(F.col(column), value)] if value else []


def _where(df: DataFrame, conditions: list[Column]) -> DataFrame:
    return df.where(reduce(lambda a, b: a & b, conditions)) if conditions else df


def _check_page(limit: int, offset: int) -> None:
    if not 1 <= limit <= 500:
        raise ValueError("limit must be between 1 and 500")
    if offset < 0:
        raise ValueError("offset must not be negative")


def _iso(columns: list[str]) -> list[Column]:
    return [F.date_format(c, "yyyy-MM-dd").alias(c) if c.startswith("data_") else F.col(c) for c in columns]


def filter_processes(
    processes: DataFrame, year: int | None = None, classe: str | None = None, relator: str | None = None,
    uf: str | None = None, situacao: str | None = None,
) -> DataFrame:
    return _where(processes, [
        *_equal("ano_distribuicao", year), *_equal("classe_sigla", classe), *_contains("relator", relator),
        *_equal("uf_origem", uf), *_equal("situacao", situacao),
    ])


def filter_decisions(
    decisions: DataFrame, year: int | None = None, categoria: str | None = None,
    resultado: str | None = None, relator: str | None = None,
) -> DataFrame:
    return _where(decisions, [
        *_equal("ano_decisao", year), *_equal("categoria_decisao", categoria),
        *_contains("resultado", resultado), *_contains("relator", relator),
    ])


def list_processes(processes: DataFrame, limit: int = 50, offset: int = 0, **filters: Any) -> DataFrame:
    """One page of matching cases, newest first, ties by case id."""
    _check_page(limit, offset)
    rows = filter_processes(processes, **filters).select(*_PROCESS_COLUMNS)
    found = page(rows, [F.desc("data_distribuicao"), F.asc("process_id")], limit, offset)
    return found.select(*_iso(_PROCESS_COLUMNS))


def list_decisions(
    decisions: DataFrame, limit: int = 50, offset: int = 0, ties: list[str] | None = None, **filters: Any,
) -> DataFrame:
    """One page of matching decisions, newest first, ties by ``ties`` (default: the decision id)."""
    _check_page(limit, offset)
    ties = ties or ["decision_id"]
    extra = [c for c in ties if c not in _DECISION_COLUMNS]
    rows = filter_decisions(decisions, **filters).select(*_DECISION_COLUMNS, *extra)
    found = page(rows, [F.desc("data_decisao"), *[F.asc(c) for c in ties]], limit, offset)
    return found.select(*_iso(_DECISION_COLUMNS))


def total_count(filtered: DataFrame) -> DataFrame:
    """Rows under the filters of a listing."""
    return filtered.agg(F.count("*").alias("total"))


READ_ONLY = ("SELECT", "WITH", "SHOW", "DESCRIBE", "EXPLAIN")


@dataclass
class SqlResult:
    """Rows of an ad-hoc query, or why it was refused; counting runs the query."""

    rows: DataFrame | None = None
    error: str | None = None
    execution_time_ms: float = 0.0

    @property
    def columns(self) -> list[str]:
        return self.rows.columns if self.rows is not None else []

    def row_count(self) -> int:
        return self.rows.count() if self.rows is not None else 0


def ad_hoc_sql(spark: SparkSession, text: str, args: dict[str, Any] | list[Any] | None = None) -> SqlResult:
    """Run one read-only statement over the registered tables.

    A SELECT or WITH text must also stand as a subquery, which no inserting or altering statement
    can; the first word alone would let ``WITH ... INSERT`` pass.
    """
    start = time.perf_counter()
    statement = text.strip().rstrip(";").rstrip()
    if not statement:
        return SqlResult(error="Empty SQL statement.")
    word = statement.split()[0].upper()
    if word not in READ_ONLY:
        return SqlResult(error=f"Only read-only statements ({', '.join(READ_ONLY)}) are permitted.")
    try:
        if word in ("SELECT", "WITH"):
            spark.sql(f"EXPLAIN SELECT * FROM (\n{statement}\n)", args=args)
        rows = spark.sql(statement, args=args)
        return SqlResult(rows=rows, execution_time_ms=round((time.perf_counter() - start) * 1000, 2))
    except PySparkException as err:
        return SqlResult(error=str(err), execution_time_ms=round((time.perf_counter() - start) * 1000, 2))
