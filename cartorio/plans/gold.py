"""Gold: star schema of facts and dimensions."""

from __future__ import annotations

from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartorio.functions import fixed
from cartorio.functions.cells import date_key, trim_text
from cartorio.operators.keys import dense_row_number
from cartorio.plans.silver import REQUIRED
from cartorio.sources.published import publish, published, state


def _calendar(days: DataFrame) -> DataFrame:
    """Calendar attributes of the ``full_date`` column."""
    d = F.col("full_date")
    months = F.array(*[F.lit(m) for m in fixed.MONTH_NAMES])
    weekdays = F.array(*[F.lit(w) for w in fixed.DAY_NAMES])
    return days.select(
        date_key(d).alias("date_key"),
        d,
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.get(months, F.month(d) - 1).alias("month_name"),
        F.quarter(d).alias("quarter"),
        F.dayofmonth(d).alias("day"),
        F.get(weekdays, F.weekday(d)).alias("day_of_week"),
        (F.weekday(d) >= 5).alias("is_weekend"),
    )


def dim_date(spark: SparkSession, start_year: int = 2000, end_year: int = 2030) -> DataFrame:
    """One row per day of the years given."""
    bounds = spark.range(1).select(
        F.explode(F.sequence(F.make_date(F.lit(start_year), F.lit(1), F.lit(1)),
                             F.make_date(F.lit(end_year), F.lit(12), F.lit(31)))).alias("full_date"))
    return _calendar(bounds)


def dim_date_spanning(days: DataFrame) -> DataFrame:
    """Calendar of the whole years that the one date column of ``days`` touches."""
    (column,) = days.columns
    span = days.agg(F.year(F.min(column)).alias("lo"), F.year(F.max(column)).alias("hi"))
    one, dec, last = F.lit(1), F.lit(12), F.lit(31)
    full = F.sequence(F.make_date(F.col("lo"), one, one), F.make_date(F.col("hi"), dec, last))
    return _calendar(span.where("lo is not null").select(F.explode(full).alias("full_date")))


def region_of_state(state: Column) -> Column:
    """Macro-region by lookup in a literal map of the 27 states."""
    pairs = [(s, r) for r, states in fixed.STATES_BY_REGION.items() for s in states]
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(pairs)])
    return F.coalesce(F.try_element_at(table, state), F.lit(fixed.UNKNOWN_REGION))


def process_types(processes: DataFrame) -> DataFrame:
    return processes.select("classe_sigla", "classe_descricao").distinct()


def dim_process_type(processes: DataFrame) -> DataFrame:
    return dense_row_number(process_types(processes), ["classe_sigla", "classe_descricao"], "process_type_key")


def rapporteurs(*facts: DataFrame) -> DataFrame:
    # distinct on each side first: the sides then meet as a few names
    return reduce(DataFrame.unionAll, [f.select("relator").distinct() for f in facts]).dropna().distinct()


def dim_rapporteur(processes: DataFrame, decisions: DataFrame) -> DataFrame:
    return dense_row_number(rapporteurs(processes, decisions), ["relator"], "rapporteur_key").withColumn(
        "ativo", F.lit(True))


def origins(processes: DataFrame, region: DataFrame | None = None) -> DataFrame:
    """Distinct states with their region, from the fixed map or a (uf_origem, regiao) table."""
    states = processes.select("uf_origem").dropna().distinct()
    if region is None:
        return states.withColumn("regiao", region_of_state(F.col("uf_origem")))
    return states.join(region, "uf_origem", "left").withColumn(
        "regiao", F.coalesce("regiao", F.lit(fixed.UNKNOWN_REGION)))


def dim_origin(processes: DataFrame, region: DataFrame | None = None) -> DataFrame:
    return dense_row_number(origins(processes, region), ["uf_origem"], "origin_key")


def subjects(processes: DataFrame) -> DataFrame:
    """Distinct subjects; the branch of law is the part before the first bar."""
    branch = trim_text(F.get(F.split("assunto", "[|]"), F.lit(0)))
    return processes.select("assunto").dropna().distinct().withColumn("ramo_direito", branch)


def dim_subject(processes: DataFrame) -> DataFrame:
    return dense_row_number(subjects(processes), ["assunto"], "subject_key")


def with_date_keys(df: DataFrame, **keys: str) -> DataFrame:
    """Add ``key=date column`` whole-number date keys."""
    return df.withColumns({name: date_key(F.col(column)) for name, column in keys.items()})


def fact_processes(processes: DataFrame) -> DataFrame:
    return with_date_keys(
        processes, date_distribuicao_key="data_distribuicao", date_autuacao_key="data_autuacao")


def fact_decisions(decisions: DataFrame) -> DataFrame:
    return with_date_keys(decisions, date_decisao_key="data_decisao")


def fact_appeals(appeals: DataFrame) -> DataFrame:
    return with_date_keys(
        appeals, date_interposicao_key="data_interposicao", date_julgamento_key="data_julgamento")


def dim_personnel(personnel: DataFrame) -> DataFrame:
    keyed = dense_row_number(personnel, ["matricula_hash"], "personnel_key")
    return with_date_keys(keyed, date_admissao_key="data_admissao")


def fact_remuneration(remuneration: DataFrame) -> DataFrame:
    return remuneration


def fact_budget(budget: DataFrame) -> DataFrame:
    return budget


def star_schema(spark: SparkSession, silver: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All curated tables that the given Silver tables allow; cases and decisions are required."""
    processes, decisions = silver["processos"], silver["decisoes"]
    tables = {
        "dim_date": dim_date(spark),
        "dim_process_type": dim_process_type(processes),
        "dim_rapporteur": dim_rapporteur(processes, decisions),
        "dim_origin": dim_origin(processes),
        "dim_subject": dim_subject(processes),
        "fact_processes": fact_processes(processes),
        "fact_decisions": fact_decisions(decisions),
    }
    optional = {
        "fact_appeals": ("recursos", fact_appeals),
        "dim_personnel": ("pessoal", dim_personnel),
        "fact_remuneration": ("remuneracao", fact_remuneration),
        "fact_budget": ("orcamento", fact_budget),
    }
    for name, (source, build) in optional.items():
        if source in silver:
            tables[name] = build(silver[source])
    return tables


YEAR_PARTITIONS = {"fact_processes": ["ano_distribuicao"], "fact_decisions": ["ano_decisao"]}


def write_star_schema(
    spark: SparkSession, silver: dict[str, DataFrame], curated: str, by_year: bool = True,
    marks: dict[str, int] | None = None,
) -> dict[str, DataFrame]:
    """Write all curated tables, publish them together and register each under its name.

    ``by_year`` partitions the two large facts by year, so that year filters skip files.
    """
    return publish(spark, curated, star_schema(spark, silver), YEAR_PARTITIONS if by_year else None, marks=marks)


#: Natural and surrogate key of each dimension, and how its members come from Silver rows.
DIMENSIONS = {
    "dim_process_type": (["classe_sigla", "classe_descricao"], "process_type_key",
                         lambda rows: process_types(rows["processos"]) if "processos" in rows else None),
    "dim_rapporteur": (["relator"], "rapporteur_key", lambda rows: rapporteurs(
        *[rows[n] for n in ("processos", "decisoes") if n in rows]).withColumn("ativo", F.lit(True))
        if {"processos", "decisoes"} & rows.keys() else None),
    "dim_origin": (["uf_origem"], "origin_key",
                   lambda rows: origins(rows["processos"]) if "processos" in rows else None),
    "dim_subject": (["assunto"], "subject_key",
                    lambda rows: subjects(rows["processos"]) if "processos" in rows else None),
    "dim_personnel": (["matricula_hash"], "personnel_key",
                      lambda rows: with_date_keys(rows["pessoal"], date_admissao_key="data_admissao")
                      if "pessoal" in rows else None),
}

FACTS = {"fact_processes": ("processos", fact_processes), "fact_decisions": ("decisoes", fact_decisions),
         "fact_appeals": ("recursos", fact_appeals), "fact_remuneration": ("remuneracao", fact_remuneration),
         "fact_budget": ("orcamento", fact_budget)}


def new_members(members: DataFrame, dimension: DataFrame | None, natural: list[str], key: str) -> DataFrame:
    """Members that the dimension lacks, numbered in natural order after its largest key; NULL is a member like any."""
    if dimension is None:
        return dense_row_number(members, natural, key)
    known = dimension.select(*[F.col(c).alias(f"_{c}") for c in natural])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in natural])
    start = dimension.agg(F.coalesce(F.max(key), F.lit(0))).first()[0]
    fresh = dense_row_number(members.join(known, same, "left_anti"), natural, key)
    return fresh.withColumn(key, F.col(key) + F.lit(start))


def grow_star_schema(
    spark: SparkSession, rows: dict[str, DataFrame], curated: str, marks: dict[str, int] | None = None,
) -> dict[str, DataFrame]:
    """Add the Silver ``rows`` that no earlier run brought; all tables as they are then.

    Facts get new files in the years of these rows, and no file of theirs is read or written again. Dimensions
    get their new members; keys given before stay. Rows must be new, as those of incremental batches are: keys that
    came before were dropped there. The first run writes the whole star schema and needs cases and decisions;
    until both are there nothing is published.
    """
    now = state(spark, curated)
    if not now["tables"]:
        if not all(name in rows for name in REQUIRED):
            return {}
        return write_star_schema(spark, rows, curated, marks=marks)
    tables = {name: build(rows[source]) for name, (source, build) in FACTS.items() if source in rows}
    for name, (natural, key, members_of) in DIMENSIONS.items():
        members = members_of(rows)
        if members is not None:
            tables[name] = new_members(members, published(spark, curated, name, now), natural, key)
    return publish(spark, curated, tables, YEAR_PARTITIONS, append=True, marks=marks)
