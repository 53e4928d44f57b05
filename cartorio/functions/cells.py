"""Column expressions that turn raw text cells into typed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartorio.functions import fixed

# a cast that fails inside costs an exception, some 100 times what a match does: numbers of 20 digits and more never fit,
# and days that a month of any year lacks are no dates
_WHOLE = r"^[+-]?0*[0-9]{1,19}$"
_DATE = (r"^[0-9]{4}-(?:(?:0[13578]|1[02])-(?:0[1-9]|[12][0-9]|3[01])|(?:0[469]|11)-(?:0[1-9]|[12][0-9]|30)"
         r"|02-(?:0[1-9]|[12][0-9]))$")
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def null_tokens(cell: Column) -> Column:
    """NULL for a raw cell that is one of the null tokens; matched before any trimming.

    One native lookup instead of a comparison per token: over many columns the latter makes the
    generated code too long for the JVM to compile. A cell with a comma is never in the set.
    """
    return F.when(F.find_in_set(cell, F.lit(",".join(fixed.NULL_TOKENS))) == 0, cell)


def trim_text(cell: Column) -> Column:
    """Without leading and trailing whitespace of any kind (plain ``trim`` only takes spaces)."""
    return F.btrim(cell, F.lit(fixed.WHITESPACE))


def upper_code(cell: Column) -> Column:
    return F.upper(trim_text(cell))


def safe_int(cell: Column) -> Column:
    """Whole number or NULL; text with blanks or a decimal point is not a whole number."""
    return F.when(cell.rlike(_WHOLE), cell.try_cast("bigint"))


def safe_money(cell: Column) -> Column:
    """Finite double, 0.0 for missing, unreadable or overlarge amounts."""
    amount = F.when(cell.rlike(_NUMBER), cell.try_cast("double"))
    return F.coalesce(F.when(F.abs(amount) < float("inf"), amount), F.lit(0.0))


def safe_date(cell: Column) -> Column:
    """ISO date, NULL for anything else; the cast needs no pattern once the shape is right."""
    return F.when(cell.rlike(_DATE), cell.try_cast("date"))


def date_key(day: Column) -> Column:
    """yyyyMMdd as a whole number, by arithmetic so that it stays inside generated code."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("bigint")


def decision_category(kind: Column) -> Column:
    """Category of a decision kind; an unknown or missing kind counts as collegiate."""
    return (
        F.when(kind.contains(fixed.MONOCRATIC_WORD), fixed.MONOCRATIC)
        .when(kind.contains(fixed.PRESIDENCY_WORD), fixed.PRESIDENCY)
        .otherwise(fixed.COLLEGIATE)
    )


def gross_compensation(*parts: Column) -> Column:
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    return F.round(total, 2)


def execution_rate(settled: Column, updated: Column) -> Column:
    """Row-level budget execution in percent, 0.0 where nothing was granted."""
    return F.when(updated > 0, F.round(settled / updated * 100.0, 2)).otherwise(F.lit(0.0))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """``100 * part / whole`` as a double (a decimal literal would change the type)."""
    return F.round(part * F.lit(100.0).cast("double") / whole, digits)


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def contains_text(column: Column, needle: str) -> Column:
    r"""Case-insensitive containment; ``%`` and ``_`` in ``needle`` stay wildcards, ``\`` is literal."""
    return column.ilike("%" + needle.replace("\\", "\\\\") + "%")
