"""Quality checks over the bound tables; the years and states are set so that rules pass and fail."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartorio.bindings import frames as b
from cartorio.bindings.frames import with_views
from cartorio.bindings.registry import register
from cartorio.plans import quality as q

FIRST, LAST, THIS_YEAR = 1996, 2000, 1999
STATES = [f"NATION_{i}" for i in range(23)]
_STATES_SQL = ", ".join(f"'{s}'" for s in STATES)
COLUMNS = ["check_name", "target_layer", "dataset", "status", "message"]


def _processes(spark, d):
    return q.check_processes(b.processes(spark, d, origin=True), FIRST, LAST, THIS_YEAR, STATES)


def _decisions(spark, d):
    return q.check_decisions(b.decisions(spark, d), 1990, 2010)


def _referential(spark, d):
    return q.check_referential(b.decisions(spark, d), b.processes(spark, d))


def _orphans(spark, d):
    return q.check_referential(b.decisions(spark, d), b.processes(spark, d), orphans=True)


def _remuneration(spark, d):
    return q.check_remuneration(b.remuneration(spark, d))


def _budget(spark, d):
    return q.check_budget(b.budget(spark, d), FIRST, LAST)


def _row(name: str, dataset: str, count: str, source: str, bad: str, good: str, failed: str = "n > 0") -> str:
    """SQL of one check row: ``n`` is the counted figure."""
    return f"""SELECT '{name}' AS check_name, 'silver' AS target_layer, '{dataset}' AS dataset,
        CASE WHEN {failed} THEN 'FAIL' ELSE 'PASS' END AS status,
        CASE WHEN {failed} THEN {bad} ELSE {good} END AS message FROM (SELECT {count} FROM {source})"""


def _dup(name: str, dataset: str, key: str, source: str) -> str:
    return _row(name, dataset, f"COUNT(*) - COUNT(DISTINCT {key}) - MAX(CASE WHEN {key} IS NULL THEN 1 ELSE 0 END) AS n",
                source, f"'Found ' || n || ' duplicate {key} entries.'", f"'All {key} values are unique.'")


def _none(name: str, dataset: str, condition: str, source: str, bad: str, good: str) -> str:
    return _row(name, dataset, f"COUNT(*) FILTER (WHERE {condition}) AS n", source, f"n || '{bad}'", f"'{good}'")


def _scope(dataset: str, column: str, source: str, first: int, last: int) -> str:
    figures = (f"COUNT({column}) AS dated, MIN(year({column})) AS lo, MAX(year({column})) AS hi, "
               f"COUNT(*) FILTER (WHERE year({column}) NOT BETWEEN {first} AND {last}) AS n")
    return _row(f"temporal_scope_{first}_{last}", dataset, figures, source,
                f"""CASE WHEN dated = 0 THEN 'No valid date records found in column {column} for {dataset}.'
                ELSE 'Violação de escopo temporal em {dataset}: ' || n || ' registros fora de [{first}, {last}].' END""",
                f"""'Validado escopo temporal {first}-{last} em {dataset} (' || dated || ' registros, anos ' || lo || ' a '
                || hi || ', 0 fora do escopo).'""", "dated = 0 OR n > 0")


_P, _D, _R, _B = "fact_processes", "fact_decisions", "fact_remuneration", "fact_budget"
_NULLS = "'Null check: ' || ids || ' null IDs, ' || dates || ' null distribution dates.'"
_ODD = "n || ' processes have unreasonable distribution dates.'"

# key, inventory row of the check, its table's checks, name, SQL, views of the SQL
_CHECKS = [
    ("dq_pk_processes", _processes, "primary_key_uniqueness",
     _dup("primary_key_uniqueness", "processos", "process_id", _P), [_P]),
    ("dq_not_null_processes", _processes, "not_null_critical_fields",
     _row("not_null_critical_fields", "processos",
          "COUNT(*) - COUNT(process_id) AS ids, COUNT(*) - COUNT(data_distribuicao) AS dates", _P,
          _NULLS, _NULLS, "ids > 0 OR dates > 0"), [_P]),
    ("dq_reasonable_dates", _processes, "reasonable_dates",
     _row("reasonable_dates", "processos",
          f"COUNT(*) FILTER (WHERE year(data_distribuicao) < 1980 OR year(data_distribuicao) > {THIS_YEAR + 1}) AS n",
          _P, _ODD, _ODD), [_P]),
    ("dq_temporal_scope", _processes, f"temporal_scope_{FIRST}_{LAST}",
     _scope("processos", "data_distribuicao", _P, FIRST, LAST), [_P]),
    ("dq_valid_states", _processes, "valid_uf_domains",
     _row("valid_uf_domains", "processos",
          f"COUNT(DISTINCT uf_origem) FILTER (WHERE uf_origem NOT IN ({_STATES_SQL})) AS n",
          _P, "'Invalid UFs detected: ' || n || ' different codes.'", "'All UFs belong to valid Brazilian state codes.'"), [_P]),
    ("dq_pk_decisions", _decisions, "primary_key_uniqueness",
     _dup("primary_key_uniqueness", "decisoes", "decision_id", _D), [_D]),
    ("dq_not_null_decision_date", _decisions, "not_null_decision_date",
     _none("not_null_decision_date", "decisoes", "data_decisao IS NULL", _D, " null decision dates found.",
           "All decision dates are populated."), [_D]),
    ("dq_temporal_scope_decisions", _decisions, "temporal_scope_1990_2010",
     _scope("decisoes", "data_decisao", _D, 1990, 2010), [_D]),
    ("dq_temporal_consistency", _referential, "referential_temporal_consistency",
     _none("referential_temporal_consistency", "cross_process_decision", "f.data_decisao < p.data_distribuicao",
           f"{_D} f JOIN {_P} p ON f.process_id = p.process_id", " decisions precede their process distribution date.",
           "All joined decisions occur on or after their process distribution date."), [_P, _D]),
    ("dq_orphan_decisions", _orphans, "referential_orphans",
     _none("referential_orphans", "cross_process_decision", "p.process_id IS NULL",
           f"{_D} f LEFT JOIN {_P} p ON f.process_id = p.process_id", " decisions have no known process.",
           "All decisions belong to a known process."), [_P, _D]),
    ("dq_pk_remuneration", _remuneration, "remuneration_pk_uniqueness",
     _dup("remuneration_pk_uniqueness", "remuneracao", "remuneracao_id", _R), [_R]),
    ("dq_non_negative_net", _remuneration, "non_negative_net_salary",
     _none("non_negative_net_salary", "remuneracao", "remuneracao_liquida < 0", _R, " records have negative net salary.",
           "All net salaries are non-negative."), [_R]),
    ("dq_ceiling_integrity", _remuneration, "constitutional_ceiling_integrity",
     _none("constitutional_ceiling_integrity", "remuneracao", "abate_teto < 0", _R, " records have invalid abate_teto.",
           "Constitutional ceiling abate_teto verified."), [_R]),
    ("dq_pk_budget", _budget, "budget_pk_uniqueness",
     _dup("budget_pk_uniqueness", "orcamento", "orcamento_id", _B), [_B]),
    ("dq_non_negative_budget", _budget, "non_negative_budget_values",
     _none("non_negative_budget_values", "orcamento",
           "dotacao_atualizada < 0 OR empenhado < 0 OR liquidado < 0 OR pago < 0", _B,
           " budget entries have negative values.", "All budget monetary amounts are non-negative."), [_B]),
    ("dq_budget_year", _budget, "budget_year_range",
     _none("budget_year_range", "orcamento", f"ano_exercicio < {FIRST}", _B, f" budget records prior to {FIRST}.",
           f"All budget entries comply with {FIRST}-{LAST} fiscal cycle."), [_B]),
]


def _only(checks, name: str):
    return lambda spark, d: checks(spark, d).where(F.col("check_name") == name).select(*COLUMNS)


for _key, _checks, _name, _text, _views in _CHECKS:
    register(_key, with_views(_text, *_views))(_only(_checks, _name))


@register("dq_invalid_states", with_views(
    f"""SELECT uf_origem, COUNT(*) AS total_processos FROM fact_processes
        WHERE uf_origem NOT IN ({_STATES_SQL}) GROUP BY 1""", _P))
def _(spark, d):
    return q.invalid_states(b.processes(spark, d, origin=True), STATES)


def all_rows(spark, d):
    return _processes(spark, d).unionByName(_decisions(spark, d)).unionByName(_referential(spark, d)).unionByName(
        _remuneration(spark, d)).unionByName(_budget(spark, d))


# the check of orphans is not part of the contract
_ALL_SQL = " UNION ALL ".join(f"({text})" for key, _, _, text, _ in _CHECKS if key != "dq_orphan_decisions")
_TOTALS = f"""SELECT COUNT(*) AS total_checks, COUNT(*) FILTER (WHERE status = 'PASS') AS passed_checks,
    COUNT(*) FILTER (WHERE status = 'FAIL') AS failed_checks,
    CASE WHEN COUNT(*) FILTER (WHERE status = 'FAIL') = 0 THEN 'PASS' ELSE 'FAIL' END AS overall_status FROM ({_ALL_SQL})"""


@register("dq_checks", with_views(_ALL_SQL, _P, _D, _R, _B))
def _(spark, d):
    return all_rows(spark, d).select(*COLUMNS)


@register("dq_report", with_views(_TOTALS, _P, _D, _R, _B))
def _(spark, d):
    return q.quality_report(all_rows(spark, d)).drop("results", "timestamp")


@register("dq_gate", with_views(f"SELECT overall_status = 'PASS' AS go_on FROM ({_TOTALS})", _P, _D, _R, _B))
def _(spark, d):
    go_on = q.gate_passes(q.report_totals(all_rows(spark, d)))
    return b.table(spark, d, "region").limit(1).select(F.lit(go_on).alias("go_on"))


@register("dq_summary", with_views(
    f"""SELECT overall_status AS status, total_checks, passed_checks, failed_checks,
        '{FIRST} - {LAST}' AS temporal_window, total_checks AS n_details FROM ({_TOTALS})""", _P, _D, _R, _B))
def _(spark, d):
    summary = q.report_summary(spark, q.quality_report(all_rows(spark, d)), FIRST, LAST)
    return summary.withColumn("n_details", F.size("details").cast("bigint")).drop("details", "timestamp")
