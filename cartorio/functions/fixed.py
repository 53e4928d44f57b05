"""Fixed values of the data contract: every entry must equal the published one for right results."""

from __future__ import annotations

# Raw cells that mean NULL.
NULL_TOKENS = ["", "NA", "N/A", "NULL", "null", "NaN"]

# The characters with the Unicode White_Space property.
WHITESPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Case status.
ACTIVE = "EM TRAMITAÇÃO"
ARCHIVED = "BAIXADO"
JUDGED = "JULGADO"

# Decision categories and the words that select them.
MONOCRATIC = "MONOCRATICA"
PRESIDENCY = "PRESIDENCIA"
COLLEGIATE = "COLEGIADA"
MONOCRATIC_WORD = "Monocrática"
PRESIDENCY_WORD = "Presidência"

# Macro-region of each state.
STATES_BY_REGION = {
    "Centro-Oeste": ["DF", "GO", "MS", "MT"],
    "Nordeste": ["AL", "BA", "CE", "MA", "PB", "PE", "PI", "RN", "SE"],
    "Norte": ["AC", "AM", "AP", "PA", "RO", "RR", "TO"],
    "Sudeste": ["ES", "MG", "RJ", "SP"],
    "Sul": ["PR", "RS", "SC"],
}
UNKNOWN_REGION = "Indeterminado"

# Calendar names, January and Monday first.
MONTH_NAMES = [
    "Janeiro", "Fevereiro", "Março", "Abril", "Maio", "Junho",
    "Julho", "Agosto", "Setembro", "Outubro", "Novembro", "Dezembro",
]
DAY_NAMES = [
    "Segunda-feira", "Terça-feira", "Quarta-feira", "Quinta-feira",
    "Sexta-feira", "Sábado", "Domingo",
]

# Analytic window, censoring date, survival milestones, first watermark.
FIRST_YEAR = 2018
LAST_YEAR = 2026
CENSOR_DATE = "2026-12-31"
MILESTONE_DAYS = [30, 90, 180, 365, 730, 1825]
FIRST_WATERMARK = "2018-01-01"

# Datasets a user may export, and the table behind each.
EXPORT_TABLES = {
    "processes": "fact_processes",
    "decisions": "fact_decisions",
    "appeals": "fact_appeals",
    "budget": "fact_budget",
    "remuneration": "fact_remuneration",
    "personnel": "dim_personnel",
}

# The dataset each entity is traced to.
ENTITY_DATASETS = {
    "dim_origin": "processos",
    "dim_process_type": "processos",
    "dim_rapporteur": "processos",
    "dim_subject": "processos",
    "dim_personnel": "pessoal",
    "pessoal": "pessoal",
    "fact_remuneration": "remuneracao",
    "remuneracao": "remuneracao",
    "fact_budget": "orcamento",
    "orcamento": "orcamento",
    "fact_processes": "processos",
    "processos": "processos",
    "fact_decisions": "decisoes",
    "decisoes": "decisoes",
    "fact_appeals": "recursos",
    "recursos": "recursos",
    "repercussao_geral": "repercussao_geral",
}

# Messages of the quality checks, failed and passed; braces name measured figures. The message
# of invalid states is our own, as their number has no bound.
CHECK_MESSAGES = {
    "unique_key": ("Found {duplicates} duplicate {key} entries.", "All {key} values are unique."),
    "not_null_critical_fields": (
        "Null check: {null_ids} null IDs, {null_dates} null distribution dates.",
        "Null check: {null_ids} null IDs, {null_dates} null distribution dates."),
    "reasonable_dates": (
        "{odd_years} processes have unreasonable distribution dates.",
        "{odd_years} processes have unreasonable distribution dates."),
    "temporal_scope": (
        "Violação de escopo temporal em {dataset}: {out_of_scope} registros fora de [{first}, {last}].",
        "Validado escopo temporal {first}-{last} em {dataset} ({dated} registros, anos {min_year} a {max_year}, 0 fora do escopo)."),
    "temporal_scope_undated": (
        "No valid date records found in column {column} for {dataset}.", ""),
    "valid_uf_domains": (
        "Invalid UFs detected: {invalid_states} different codes.", "All UFs belong to valid Brazilian state codes."),
    "not_null_decision_date": ("{null_dates} null decision dates found.", "All decision dates are populated."),
    "referential_temporal_consistency": (
        "{early} decisions precede their process distribution date.",
        "All joined decisions occur on or after their process distribution date."),
    "non_negative_net_salary": (
        "{negative_net} records have negative net salary.", "All net salaries are non-negative."),
    "constitutional_ceiling_integrity": (
        "{negative_cut} records have invalid abate_teto.", "Constitutional ceiling abate_teto verified."),
    "non_negative_budget_values": (
        "{negative} budget entries have negative values.", "All budget monetary amounts are non-negative."),
    "budget_year_range": (
        "{early_years} budget records prior to {first}.",
        "All budget entries comply with {first}-{last} fiscal cycle."),
    "raw_file_presence": ("Raw file missing: {file_path}", ""),
    "checksum_integrity": ("Checksum mismatch! File has been altered.", "File SHA-256 matches latest manifest."),
}
