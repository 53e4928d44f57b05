"""Silver: typed, de-duplicated tables from raw text cells."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartorio.functions import cells
from cartorio.operators.cleaning import SEQ, dedup_keep_first, require_not_null, typed_columns
from cartorio.sources.sinks import write_parquet_zstd

# Declared columns of each raw table and how each cell is read.
PROCESSES = {
    "process_id": "text", "numero_processo": "int", "classe_sigla": "code",
    "classe_descricao": "text", "assunto": "text", "relator": "text",
    "data_autuacao": "date", "data_distribuicao": "date", "uf_origem": "code",
    "orgao_julgador": "text", "situacao": "code",
}
DECISIONS = {
    "decision_id": "text", "process_id": "text", "numero_processo": "int",
    "classe_sigla": "code", "data_decisao": "date", "tipo_decisao": "text",
    "resultado": "text", "relator": "text", "orgao_colegiado": "text", "texto_resumo": "text",
}
APPEALS = {
    "recurso_id": "text", "process_id": "text", "tipo_recurso": "text",
    "data_interposicao": "date", "data_julgamento": "date",
    "resultado_recurso": "text", "relator": "text",
}
TOPICS = {
    "tema_numero": "int", "titulo": "text", "data_reconhecimento": "date",
    "status": "text", "relator": "text", "tese_fixada": "text",
}
PERSONNEL = {
    "matricula_hash": "text", "nome_anonimizado": "text", "cargo": "text",
    "cargo_tipo": "text", "lotacao": "text", "situacao_funcional": "text",
    "data_admissao": "date",
}
REMUNERATION = {
    "remuneracao_id": "text", "matricula_hash": "text", "competencia_ano": "int",
    "competencia_mes": "int", "cargo": "text", "cargo_tipo": "text",
    "remuneracao_paradigma": "money", "vantagens_pessoais": "money", "subsidio": "money",
    "indenizacoes": "money", "previdencia_e_ir": "money", "abate_teto": "money",
    "remuneracao_liquida": "money",
}
BUDGET = {
    "orcamento_id": "text", "ano_exercicio": "int", "programa_trabalho": "text",
    "acao_orcamentaria": "text", "elemento_despesa": "text", "dotacao_inicial": "money",
    "dotacao_atualizada": "money", "empenhado": "money", "liquidado": "money", "pago": "money",
}


def _clean(raw: DataFrame, kinds: dict[str, str], key: str, required: tuple[str, ...]) -> DataFrame:
    """Read cells, keep the first row per key, then drop rows without the required values.

    The order matters: a first duplicate with a bad date hides a later good one. Rows without a required key are
    one group that would be dropped whole, so they go first.
    """
    rows = typed_columns(raw, kinds)
    first = dedup_keep_first(require_not_null(rows, key) if key in required else rows, key)
    return require_not_null(first, *required).drop(SEQ)


def _finish(df: DataFrame, out: str | None) -> DataFrame:
    if out is None:
        return df
    write_parquet_zstd(df, out)
    return df.sparkSession.read.parquet(out)


def derive_processes(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "ano_distribuicao": F.year("data_distribuicao"),
        "mes_distribuicao": F.month("data_distribuicao"),
    })


def derive_decisions(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "categoria_decisao": cells.decision_category(F.col("tipo_decisao")),
        "ano_decisao": F.year("data_decisao"),
        "mes_decisao": F.month("data_decisao"),
    })


def clean_processes(raw: DataFrame, out: str | None = None) -> DataFrame:
    return _finish(derive_processes(_clean(raw, PROCESSES, "process_id", ("process_id", "data_distribuicao"))), out)


def clean_decisions(raw: DataFrame, out: str | None = None) -> DataFrame:
    return _finish(derive_decisions(_clean(raw, DECISIONS, "decision_id", ("decision_id", "data_decisao"))), out)


def clean_appeals(raw: DataFrame, out: str | None = None) -> DataFrame:
    return _finish(_clean(raw, APPEALS, "recurso_id", ("recurso_id",)), out)


def clean_topics(raw: DataFrame, out: str | None = None) -> DataFrame:
    """General-repercussion topics; one row without a number may stay."""
    return _finish(_clean(raw, TOPICS, "tema_numero", ()), out)


def clean_personnel(raw: DataFrame, out: str | None = None) -> DataFrame:
    return _finish(_clean(raw, PERSONNEL, "matricula_hash", ("matricula_hash",)), out)


def clean_remuneration(raw: DataFrame, out: str | None = None) -> DataFrame:
    df = _clean(raw, REMUNERATION, "remuneracao_id", ("remuneracao_id",))
    gross = cells.gross_compensation(
        F.col("remuneracao_paradigma"), F.col("vantagens_pessoais"), F.col("subsidio"), F.col("indenizacoes"))
    return _finish(df.withColumn("remuneracao_bruta", gross), out)


def clean_budget(raw: DataFrame, out: str | None = None) -> DataFrame:
    df = _clean(raw, BUDGET, "orcamento_id", ("orcamento_id",))
    rate = cells.execution_rate(F.col("liquidado"), F.col("dotacao_atualizada"))
    return _finish(df.withColumn("taxa_execucao_pct", rate), out)


# Silver table name -> (raw folder, job)
JOBS = {
    "processos": clean_processes,
    "decisoes": clean_decisions,
    "recursos": clean_appeals,
    "repercussao_geral": clean_topics,
    "pessoal": clean_personnel,
    "remuneracao": clean_remuneration,
    "orcamento": clean_budget,
}
REQUIRED = ("processos", "decisoes")
