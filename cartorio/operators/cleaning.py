"""Table-level cleaning steps shared by all Silver jobs."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, types as T
from pyspark.sql import functions as F

from cartorio.functions import cells

SEQ = "_seq"

# how each declared kind of cell is read once null tokens are gone
_READERS: dict[str, Callable[[Column], Column]] = {
    "text": cells.trim_text,
    "code": cells.upper_code,
    "int": cells.safe_int,
    "money": cells.safe_money,
    "date": cells.safe_date,
}
_SHAPED = ("int", "money", "date")


def canonical_name(name: str) -> str:
    return name.strip().lower().replace(" ", "_")


def canonical_column_names(df: DataFrame) -> DataFrame:
    """Strip, lower-case and underscore all column names."""
    return df.toDF(*[canonical_name(c) for c in df.columns])


def typed_columns(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Read the declared columns from raw text; a missing one raises, extra ones pass through."""
    missing = [c for c in kinds if c not in df.columns]
    if missing:
        raise ValueError(f"raw table lacks columns {missing}")
    # tokens first, in a step of their own: the readers below use a cell more than once; numbers
    # and dates need none, as no token has their shape
    known = df.select(*[
        F.col(c) if c == SEQ or kinds.get(c) in _SHAPED else cells.null_tokens(F.col(c)).alias(c)
        for c in [*kinds, *(c for c in df.columns if c not in kinds)]
    ])
    return known.select(*[
        _READERS[kinds[c]](F.col(c)).alias(c) if c in kinds else F.col(c) for c in known.columns])


def dedup_keep_first(df: DataFrame, key: str | Sequence[str], seq: str | Sequence[str] = SEQ) -> DataFrame:
    """The first row of each key in ``seq`` order; NULL keys form one group.

    The minimum merges on the map side, so a key that fills a third of the table reaches the
    shuffle as one row per input partition. A row travels once, its ``seq`` in front. ``seq`` must be total within a key.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = [seq] if isinstance(seq, str) else list(seq)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    lead = [c for c in rest if c in order]
    if len(lead) == len(order) and all(_ordered(df.schema[c].dataType) for c in rest):
        lead = order
        row = F.min(F.struct(*lead, *(c for c in rest if c not in lead)))
    else:
        row = F.min_by(F.struct(*rest), F.struct(*order))
    first = df.groupBy(*keys).agg(row.alias("_first"))
    return first.select(*keys, "_first.*").select(*df.columns)


def _ordered(kind: T.DataType) -> bool:
    """Whether values of this type can be compared."""
    return not re.search(r"\b(map<|variant|interval$)", kind.simpleString())


def require_not_null(df: DataFrame, *columns: str) -> DataFrame:
    return df.dropna(subset=list(columns)) if columns else df
