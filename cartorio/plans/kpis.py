"""Caseload, decision, geography, lead-time, payroll and budget reports over the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartorio.functions import fixed
from cartorio.functions.cells import count_where, percent
from cartorio.operators.joins import (
    decisions_per_case, join_fact_dim_date, join_fact_origin, left_join_stats,
)
from cartorio.operators.shares import share_of_total, top_k


def _status(value: str) -> Column:
    return F.col("situacao") == value


def _disposed() -> Column:
    return F.col("situacao").isin(fixed.ARCHIVED, fixed.JUDGED)


# ---------------------------------------------------------------- overview


def kpi_overview(processes: DataFrame, decisions: DataFrame, appeals: DataFrame | None = None) -> DataFrame:
    """One row of headline figures; one pass over each fact."""
    cases = processes.agg(
        F.count("*").alias("total_processes"),
        count_where(_status(fixed.ACTIVE)).alias("active_processes"),
        count_where(_status(fixed.ARCHIVED)).alias("archived_processes"),
        F.count_distinct("relator").alias("total_judges"),
        F.min("ano_distribuicao").alias("lo"),
        F.max("ano_distribuicao").alias("hi"),
    )
    ruled = decisions.agg(F.count("*").alias("total_decisions"))
    default = f"{fixed.FIRST_YEAR} - {fixed.LAST_YEAR}"
    row = cases.crossJoin(F.broadcast(ruled))
    if appeals is None:
        row = row.withColumn("total_appeals", F.lit(0).cast("bigint"))
    else:
        row = row.crossJoin(F.broadcast(appeals.agg(F.count("*").alias("total_appeals"))))
    return row.select(
        "total_processes", "total_decisions", "active_processes", "archived_processes",
        "total_appeals", "total_judges",
        F.when(F.col("lo") != 0, F.concat_ws(" - ", "lo", "hi")).otherwise(default).alias("temporal_range"),
    )


def executive_summary_rates(overview: DataFrame) -> DataFrame:
    total = F.greatest(F.lit(1), F.col("total_processes"))
    return overview.select(
        "total_processes",
        percent(F.col("active_processes"), total, 1).alias("active_pct"),
        percent(F.col("archived_processes"), total, 1).alias("archived_pct"),
    )


# ---------------------------------------------------------------- cases


def yearly_trends(processes: DataFrame, calendar: DataFrame, ascending: bool = True) -> DataFrame:
    """Cases per year of distribution by status; cases are counted per day before the calendar join."""
    per_day = processes.groupBy("date_distribuicao_key").agg(
        F.count("*").alias("total"),
        count_where(_status(fixed.ACTIVE)).alias("em_tramitacao"),
        count_where(_status(fixed.ARCHIVED)).alias("baixados"),
        count_where(_status(fixed.JUDGED)).alias("julgados"),
    )
    out = join_fact_dim_date(per_day, calendar, "date_distribuicao_key").groupBy(F.col("year").alias("ano")).agg(
        *[F.sum(c).alias(c) for c in ("total", "em_tramitacao", "baixados", "julgados")])
    return out.orderBy(F.asc("ano") if ascending else F.desc("ano"))


def class_distribution(processes: DataFrame) -> DataFrame:
    out = share_of_total(processes, ["classe_sigla", "classe_descricao"], "total_acoes")
    return out.orderBy(F.desc("total_acoes"), "classe_sigla", "classe_descricao")


def top_classes(processes: DataFrame, k: int = 10) -> DataFrame:
    counts = processes.groupBy("classe_sigla", "classe_descricao").agg(F.count("*").alias("total_acoes"))
    return top_k(counts, [F.desc("total_acoes"), F.asc("classe_sigla"), F.asc("classe_descricao")], k)


def top_classes_share(processes: DataFrame, k: int = 10) -> DataFrame:
    """The largest classes with their share of all cases."""
    out = share_of_total(processes, ["classe_sigla", "classe_descricao"], "total_acoes")
    return top_k(out, [F.desc("total_acoes"), F.asc("classe_sigla"), F.asc("classe_descricao")], k)


def status_distribution(processes: DataFrame) -> DataFrame:
    return share_of_total(processes, ["situacao"], "total_processos").orderBy(
        F.desc("total_processos"), "situacao")


def _cases_per_state(processes: DataFrame, origin: DataFrame) -> DataFrame:
    """Cases counted per state before the join, so that no state's rows meet in one task."""
    per_state = processes.where("uf_origem is not null").groupBy("uf_origem").agg(F.count("*").alias("n"))
    return join_fact_origin(per_state, origin)


def cases_by_region_state(processes: DataFrame, origin: DataFrame, by_region: bool = True) -> DataFrame:
    out = _cases_per_state(processes, origin).groupBy("regiao", "uf_origem").agg(F.sum("n").alias("total_processos"))
    order = [F.desc("total_processos"), F.asc("uf_origem")]
    return out.orderBy(*([F.asc("regiao")] + order if by_region else order))


def cases_by_region(processes: DataFrame, origin: DataFrame) -> DataFrame:
    per_state = _cases_per_state(processes, origin)
    return share_of_total(per_state, ["regiao"], "total_processos", weight="n").orderBy(
        F.desc("total_processos"), "regiao")


def disposed_vs_active_by_year(processes: DataFrame) -> DataFrame:
    return processes.groupBy("ano_distribuicao").agg(
        F.count("*").alias("total"),
        count_where(_disposed()).alias("disposed_cases"),
        count_where(_status(fixed.ACTIVE)).alias("active_cases"),
    ).orderBy("ano_distribuicao")


def caseload_by_judge(processes: DataFrame) -> DataFrame:
    return processes.groupBy("relator").agg(
        count_where(_status(fixed.ACTIVE)).alias("active_cases"),
        count_where(_disposed()).alias("disposed_cases"),
    ).orderBy("relator")


# ---------------------------------------------------------------- decisions


def decisions_by_category(decisions: DataFrame) -> DataFrame:
    return share_of_total(decisions, ["categoria_decisao"]).orderBy(F.desc("total"), "categoria_decisao")


def decisions_by_category_year(decisions: DataFrame, calendar: DataFrame) -> DataFrame:
    per_day = decisions.groupBy("date_decisao_key", "categoria_decisao").agg(F.count("*").alias("n"))
    joined = join_fact_dim_date(per_day, calendar, "date_decisao_key")
    return joined.groupBy(F.col("year").alias("ano_decisao"), "categoria_decisao").agg(
        F.sum("n").alias("total_decisoes")
    ).orderBy(F.desc("ano_decisao"), F.desc("total_decisoes"), "categoria_decisao")


def outcome_distribution(decisions: DataFrame) -> DataFrame:
    return share_of_total(decisions, ["resultado"], "quantidade").orderBy(F.desc("quantidade"), "resultado")


def decisions_by_judge(decisions: DataFrame) -> DataFrame:
    category = F.col("categoria_decisao")
    return decisions.groupBy("relator").agg(
        F.count("*").alias("total_decisoes"),
        count_where(category == fixed.MONOCRATIC).alias("monocraticas"),
        count_where(category == fixed.COLLEGIATE).alias("colegiadas"),
    ).orderBy(F.desc("total_decisoes"), "relator")


def monocratic_ratio(decisions: DataFrame) -> DataFrame:
    mono = count_where(F.col("categoria_decisao") == fixed.MONOCRATIC)
    return decisions.agg(mono.alias("mono"), F.count("*").alias("n")).select(
        percent(F.col("mono"), F.nullif(F.col("n"), F.lit(0))).alias("monocratic_ratio"))


# ---------------------------------------------------------------- lead time


def lead_time_days(decisions: DataFrame, processes: DataFrame, by: str = "classe_sigla") -> DataFrame:
    """How many decisions came ``days`` after the case began, per ``by`` and day count.

    The histogram has one row per group and distinct day count, so exact medians over it need no
    large buffer.
    """
    per_case = decisions_per_case(decisions.where("process_id is not null"), "data_decisao")
    joined = per_case.join(processes.select("process_id", by, "data_distribuicao"), "process_id")
    return joined.groupBy(by, F.datediff("data_decisao", "data_distribuicao").alias("days")).agg(
        F.sum("n").alias("n"))


def lead_time_by_class(decisions: DataFrame, processes: DataFrame, k: int | None = None) -> DataFrame:
    """Mean, median, least and most days from start to decision."""
    days = lead_time_days(decisions, processes)
    out = days.groupBy("classe_sigla").agg(
        F.round(
            F.try_divide(F.sum(F.col("n") * F.col("days")), F.sum(F.when(F.col("days").isNotNull(), F.col("n")))), 1,
        ).alias("media_dias_ate_decisao"),
        F.percentile("days", 0.5, F.col("n")).alias("mediana_dias_ate_decisao"),
        F.min("days").alias("min_dias"),
        F.max("days").alias("max_dias"),
    )
    order = [F.desc("media_dias_ate_decisao"), F.asc("classe_sigla")]
    return out.orderBy(*order) if k is None else top_k(out, order, k)


def lead_time_boxplot(decisions: DataFrame, processes: DataFrame) -> DataFrame:
    """Five-number summary of the days to decision."""
    days = lead_time_days(decisions, processes).where("days is not null")
    points = F.percentile("days", F.array(*[F.lit(p) for p in (0.0, 0.25, 0.5, 0.75, 1.0)]), F.col("n"))
    return days.groupBy("classe_sigla").agg(points.alias("p")).select(
        "classe_sigla",
        *[F.col("p")[i].alias(name) for i, name in enumerate(("min_dias", "q1", "mediana", "q3", "max_dias"))],
    ).orderBy("classe_sigla")


# ---------------------------------------------------------------- judges


def judge_case_stats(processes: DataFrame) -> DataFrame:
    """Cases per judge; ``named`` is the judge again, NULL for the row of cases without one."""
    return processes.groupBy("relator").agg(
        F.max("relator").alias("named"),
        F.count("*").alias("total_cases"),
        count_where(_status(fixed.ACTIVE)).alias("active_cases"),
        count_where(_status(fixed.ARCHIVED)).alias("archived_cases"),
        count_where(_status(fixed.JUDGED)).alias("judged_cases"),
    )


def judge_decision_stats(decisions: DataFrame, processes: DataFrame) -> DataFrame:
    """Decisions per judge and mean days to decision; decisions without a known case still count.

    The mean needs only the sum of days, so decisions shrink to (case, judge) sums before the
    join and a case with very many decisions cannot overfill a task.
    """
    day = F.unix_date("data_decisao")
    per_case = decisions.where("relator is not null").groupBy("process_id", "relator").agg(
        F.count("*").alias("n"),
        count_where(F.col("categoria_decisao") == fixed.MONOCRATIC).alias("mono"),
        count_where(F.col("categoria_decisao") == fixed.COLLEGIATE).alias("coll"),
        F.count("data_decisao").alias("dated"),
        F.sum(day.cast("bigint")).alias("day_sum"),
    )
    start = processes.select("process_id", F.unix_date("data_distribuicao").alias("start"))
    joined = per_case.join(start, "process_id", "left")
    known = F.col("start").isNotNull()
    return joined.groupBy("relator").agg(
        F.sum("n").alias("total_decisions"),
        F.sum("mono").alias("monocratic_decisions"),
        F.sum("coll").alias("collegial_decisions"),
        F.sum(F.when(known, F.col("day_sum") - F.col("dated") * F.col("start"))).alias("days"),
        F.sum(F.when(known, F.col("dated"))).alias("pairs"),
    ).select(
        "relator", "total_decisions", "monocratic_decisions", "collegial_decisions",
        F.round(F.try_divide("days", "pairs"), 1).alias("avg_lead_time_days"),
    )


def judges_caseload(processes: DataFrame, decisions: DataFrame) -> DataFrame:
    """Workload per judge; judges without cases do not appear, the share counts all cases."""
    ruled = judge_decision_stats(decisions, processes)
    fill = {c: 0 for c in ruled.columns if c != "relator"}
    cases = judge_case_stats(processes)
    # an aggregate, unlike the key, is not filtered before the count: one pass serves rows and total
    total = cases.agg(F.sum("total_cases").alias("court_total"))
    stats = left_join_stats(cases.where("named is not null"), ruled, "relator", fill)
    return stats.crossJoin(F.broadcast(total)).select(
        "relator", "total_cases", "active_cases", "archived_cases", "judged_cases",
        "total_decisions", "monocratic_decisions", "collegial_decisions",
        percent(F.col("total_cases"), F.col("court_total")).alias("pct_caseload"),
        "avg_lead_time_days",
    ).orderBy(F.desc("total_cases"), "relator")


# ---------------------------------------------------------------- administration


def _millions(column: str) -> Column:
    return F.round(F.sum(column) / 1e6, 2)


def budget_summary(budget: DataFrame) -> DataFrame:
    money = ("dotacao_inicial", "dotacao_atualizada", "empenhado", "liquidado", "pago")
    rate = F.sum("liquidado") / F.nullif(F.sum("dotacao_atualizada"), F.lit(0.0)) * 100
    return budget.groupBy("ano_exercicio").agg(
        *[_millions(c).alias(f"{c}_milhoes") for c in money],
        F.round(rate, 1).alias("taxa_execucao_pct"),
    ).orderBy("ano_exercicio")


def budget_totals_by_year(budget: DataFrame) -> DataFrame:
    return budget.groupBy("ano_exercicio").agg(
        F.round(F.sum("dotacao_atualizada"), 2).alias("total_dotacao"),
        F.round(F.sum("liquidado"), 2).alias("total_liquidado"),
    ).orderBy("ano_exercicio")


def remuneration_summary(remuneration: DataFrame) -> DataFrame:
    return remuneration.agg(
        F.count("*").alias("total_registros_folha"),
        F.round(F.avg("remuneracao_liquida"), 2).alias("media_remuneracao_liquida"),
        F.round(F.max("remuneracao_liquida"), 2).alias("max_remuneracao_liquida"),
        F.round(F.sum("abate_teto"), 2).alias("total_abate_teto_retido"),
        _millions("remuneracao_liquida").alias("total_folha_paga_milhoes"),
    )


def personnel_by_category(personnel: DataFrame) -> DataFrame:
    """Staff and distinct departments per category.

    Counting by (category, department) first lets a category of any size merge on the map side.
    """
    pairs = personnel.groupBy("cargo_tipo", "lotacao").agg(F.count("*").alias("n"))
    return pairs.groupBy("cargo_tipo").agg(
        F.sum("n").alias("total_colaboradores"),
        F.count("lotacao").alias("total_lotacoes"),
    ).orderBy(F.desc("total_colaboradores"), "cargo_tipo")


def top_departments(personnel: DataFrame, k: int = 10) -> DataFrame:
    counts = personnel.groupBy("lotacao").agg(F.count("*").alias("total_colaboradores"))
    return top_k(counts, [F.desc("total_colaboradores"), F.asc("lotacao")], k)
