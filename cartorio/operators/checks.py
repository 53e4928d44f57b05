"""Building blocks of quality checks: measured figures in, check rows out.

Every check row is (check_name, target_layer, dataset, status, message, details).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from string import Formatter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartorio.functions import fixed

PASS, FAIL = "PASS", "FAIL"
COLUMNS = ["check_name", "target_layer", "dataset", "status", "message", "details"]


@dataclass
class Check:
    """One rule over the measured figures of a table.

    ``failed`` is the condition under which it fails; ``bad`` and ``good`` are the messages.
    """

    name: str
    dataset: str
    failed: Column
    bad: Column
    good: Column
    details: dict[str, Column] = field(default_factory=dict)
    layer: str = "silver"
    #: details are left empty where this does not hold
    given: Column | None = None

    def row(self) -> Column:
        entries = [x for k, v in self.details.items() for x in (F.lit(k), v.cast("string"))]
        details = F.create_map(*entries) if entries else F.expr("cast(map() as map<string,string>)")
        if self.given is not None:
            details = F.when(self.given, details).otherwise(F.expr("cast(map() as map<string,string>)"))
        failed = F.coalesce(self.failed, F.lit(False))
        return F.struct(
            F.lit(self.name).alias("check_name"), F.lit(self.layer).alias("target_layer"),
            F.lit(self.dataset).alias("dataset"), F.when(failed, FAIL).otherwise(PASS).alias("status"),
            F.when(failed, self.bad).otherwise(self.good).alias("message"), details.alias("details"),
        )


def check_rows(figures: DataFrame, checks: list[Check]) -> DataFrame:
    """One row per check from the single row of figures."""
    return figures.select(F.inline(F.array(*[c.row() for c in checks])))


def message(template: str, **literals: object) -> Column:
    """Message from a template: ``{name}`` is a given literal, or else a figure's column."""
    parts = []
    for before, name, _, _ in Formatter().parse(template):
        if before:
            parts.append(F.lit(before))
        if name is not None:
            value = F.lit(str(literals[name])) if name in literals else F.col(name).cast("string")
            parts.append(F.coalesce(value, F.lit("None")))
    return F.concat(*parts) if parts else F.lit("")


def messages(kind: str, **literals: object) -> tuple[Column, Column]:
    """The failed and the passed message of a kind of check."""
    bad, good = fixed.CHECK_MESSAGES[kind]
    return message(bad, **literals), message(good, **literals)


def keyed_figures(
    df: DataFrame, key: str, counts: dict[str, Column], spans: dict[str, Column] | None = None,
) -> DataFrame:
    """One row: ``duplicates`` and ``null_ids`` of the key, rows under each of the conditions, least and
    largest value of each span as ``min_`` and ``max_`` columns.

    ``duplicates`` are rows beyond the first of each key, NULL being one key value. All figures add up over
    keys, so one pass gives them: two aggregates, both merging on the map side. The most frequent key costs
    one row per input partition.
    """
    spans = spans or {}
    per_key = df.groupBy(key).agg(
        F.count("*").alias("_n"), *[F.count_if(c).alias(n) for n, c in counts.items()],
        *[f(c).alias(f"{p}_{n}") for n, c in spans.items() for f, p in ((F.min, "min"), (F.max, "max"))])
    zero = F.lit(0).cast("bigint")
    return per_key.agg(
        F.coalesce(F.sum(F.col("_n") - 1), zero).alias("duplicates"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("_n"))), zero).alias("null_ids"),
        *[F.coalesce(F.sum(n), zero).alias(n) for n in counts],
        *[f(f"{p}_{n}").alias(f"{p}_{n}") for n in spans for f, p in ((F.min, "min"), (F.max, "max"))])


def side_by_side(*one_row: DataFrame) -> DataFrame:
    """The columns of several one-row frames in one row."""
    out = one_row[0]
    for other in one_row[1:]:
        out = out.crossJoin(F.broadcast(other))
    return out
