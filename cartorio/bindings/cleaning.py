"""Silver jobs over raw text made of the test tables, with dirt put in by key arithmetic."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartorio.bindings import frames as b
from cartorio.bindings.registry import register
from cartorio.functions import cells, fixed
from cartorio.operators import cleaning
from cartorio.operators.cleaning import SEQ
from cartorio.plans import silver

# ---------------------------------------------------------------- dirt, the same on both sides


def _pick(k: Column, mod: int, values: dict[int, str]) -> Column:
    """Literal for ``k % mod``, NULL where there is none; a constant array keeps the code small."""
    return F.get(F.array(*[F.lit(values.get(i)) for i in range(mod)]).cast("array<string>"), (k % mod).cast("int"))


def _dirty(x: Column, k: Column, mod: int, instead: dict[int, str], before: dict[int, str], after: dict[int, str]) -> Column:
    around = F.concat(
        F.coalesce(_pick(k, mod, before), F.lit("")), x, F.coalesce(_pick(k, mod, after), F.lit(""))) if (
        before or after) else x
    return F.coalesce(_pick(k, mod, instead), around)


def dirty_text(x: Column, k: Column) -> Column:
    return _dirty(x, k, 11, {2: "NA", 3: " NA ", 4: "", 5: "null"}, {0: "  ", 1: "\t"}, {0: " ", 1: "\n"})


def dirty_key(x: Column, k: Column) -> Column:
    return _dirty(x, k, 23, {2: "NULL"}, {0: " "}, {1: "\t"})


def dirty_date(x: Column, k: Column) -> Column:
    return _dirty(x, k, 13, {0: "31/12/1999", 2: "2024-1-5", 3: "2023-02-30", 4: "NaN"}, {1: " "}, {})


def dirty_int(x: Column, k: Column) -> Column:
    return _dirty(x, k, 7, {0: "abc", 1: "12.5", 2: " 7", 3: "99999999999999999999", 4: "N/A"}, {}, {})


def dirty_money(x: Column, k: Column) -> Column:
    return _dirty(x, k, 9, {0: "abc", 1: "N/A", 2: "-12.50", 3: "1e3", 4: " 5.0", 5: "", 6: "1e999"}, {}, {})


def _sql_cases(k: str, mod: int, cases: dict[int, str], other: str) -> str:
    return f"CASE {k} % {mod} " + " ".join(f"WHEN {i} THEN {v}" for i, v in cases.items()) + f" ELSE {other} END"


_SQL_DIRT = {
    "text": lambda x, k: _sql_cases(k, 11, {0: f"'  ' || {x} || ' '", 1: f"chr(9) || {x} || chr(10)", 2: "'NA'",
                                            3: "' NA '", 4: "''", 5: "'null'"}, x),
    "key": lambda x, k: _sql_cases(k, 23, {0: f"' ' || {x}", 1: f"{x} || chr(9)", 2: "'NULL'"}, x),
    "date": lambda x, k: _sql_cases(k, 13, {0: "'31/12/1999'", 1: f"' ' || {x}", 2: "'2024-1-5'", 3: "'2023-02-30'",
                                            4: "'NaN'"}, x),
    "int": lambda x, k: _sql_cases(k, 7, {0: "'abc'", 1: "'12.5'", 2: "' 7'", 3: "'99999999999999999999'",
                                          4: "'N/A'"}, x),
    "money": lambda x, k: _sql_cases(k, 9, {0: "'abc'", 1: "'N/A'", 2: "'-12.50'", 3: "'1e3'", 4: "' 5.0'", 5: "''", 6: "'1e999'"}, x),
}
_SQL_DIRT["plain"] = lambda x, k: x
_DIRT = {"plain": lambda x, k: x, "text": dirty_text, "key": dirty_key, "date": dirty_date, "int": dirty_int, "money": dirty_money}

# ---------------------------------------------------------------- reading cells, in SQL

_TOKENS = ", ".join(f"'{t}'" for t in fixed.NULL_TOKENS)


def _sql_read(kind: str, x: str) -> str:
    cell = f"(CASE WHEN {x} NOT IN ({_TOKENS}) THEN {x} END)"
    trimmed = f"regexp_replace({cell}, '^\\s+|\\s+$', '', 'g')"
    return {
        "text": trimmed,
        "code": f"upper({trimmed})",
        "int": f"CASE WHEN regexp_full_match({cell}, '[+-]?[0-9]+') THEN TRY_CAST({cell} AS BIGINT) END",
        "money": f"CASE WHEN isfinite(TRY_CAST({cell} AS DOUBLE)) AND NOT contains({cell}, ' ') "
                 f"THEN TRY_CAST({cell} AS DOUBLE) ELSE 0.0 END",
        "date": f"CASE WHEN regexp_full_match({cell}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') "
                f"THEN TRY_CAST({cell} AS DATE) END",
    }[kind]


# ---------------------------------------------------------------- raw tables


class Raw:
    """A raw table: source, key expression for the dirt, file order, and its text columns.

    ``columns`` maps a name to (kind of dirt, Spark text, SQL text). ``copies`` repeats rows whose
    key is a multiple of 50, the repeats being later in the file.
    """

    def __init__(self, source: str, number: str, order: list[str], columns: dict[str, tuple[str, str]], copies: bool):
        self.source, self.number, self.order, self.columns, self.copies = source, number, order, columns, copies

    def rows(self, spark, sf_dir: str) -> DataFrame:
        """The rows of the source behind the raw rows, repeats among them."""
        df = b.table(spark, sf_dir, self.source)
        if self.copies:
            repeats = F.when(F.expr(self.number) % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
            df = df.withColumn("_copy", F.explode(repeats))
        return df

    def uses(self) -> set[str]:
        """Words of the expressions, the names of the source's columns among them."""
        return {"_copy", *self.order, *re.findall(r"\w+", " ".join([self.number, *(x for _, x in self.columns.values())]))}

    def frame(self, spark, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
        """Raw text of the source, or of those ``rows`` of it."""
        df = self.rows(spark, sf_dir) if rows is None else rows
        df = df.withColumn("_k", F.expr(self.number))
        if not self.copies:
            df = df.withColumn("_copy", F.lit(0))
        made = []
        for i, (name, (dirt, text)) in enumerate(self.columns.items()):
            # a key keeps its dirt in all copies; other cells differ between copies
            k = F.col("_k") if dirt == "key" else F.col("_k") + F.lit(i) + F.col("_copy")
            made.append(_DIRT[dirt](F.expr(text), k).alias(name))
        return df.select(*made, F.struct("_copy", *self.order).alias(SEQ))

    def sql(self) -> str:
        made = []
        for i, (name, (dirt, text)) in enumerate(self.columns.items()):
            k = "_k" if dirt == "key" else f"(_k + {i} + _copy)"
            made.append(f"{_SQL_DIRT[dirt](f'({text})', k)} AS {name}")
        extra = f"UNION ALL SELECT *, {self.number} AS _k, 1 AS _copy FROM {self.source} WHERE ({self.number}) % 50 = 0"
        return f"""SELECT {', '.join(made)}, _copy, {', '.join(self.order)} FROM (
            SELECT *, {self.number} AS _k, 0 AS _copy FROM {self.source} {extra if self.copies else ''})"""

    def clean_sql(self, kinds: dict[str, str], key: str, required: tuple[str, ...], more: str = "") -> str:
        read = ", ".join(f"{_sql_read(kind, c)} AS {c}" for c, kind in kinds.items())
        where = " AND ".join(f"{c} IS NOT NULL" for c in required) or "true"
        return f"""
            WITH raw AS ({self.sql()}),
            cells AS (SELECT {read}, _copy AS _c, {', '.join(f'{o} AS _o{i}' for i, o in enumerate(self.order))} FROM raw),
            firsts AS (SELECT * FROM cells QUALIFY row_number() OVER (
                PARTITION BY {key} ORDER BY _c, {', '.join(f'_o{i}' for i in range(len(self.order)))}) = 1)
            SELECT {', '.join(kinds)}{', ' + more if more else ''} FROM firsts WHERE {where}"""


def _text(expr: str) -> str:
    return f"CAST({expr} AS VARCHAR(64))"


def _day(expr: str) -> str:
    return f"CAST(CAST({expr} AS DATE) AS VARCHAR(10))"


_LINE_ORDER = ["l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]
_LINE_KEY = "concat_ws('-', l_orderkey, l_linenumber)"
_LINE_NO = "l_orderkey * 7 + l_linenumber"
_AMOUNT = "concat(CAST(l_partkey AS VARCHAR(20)), '.2{}')"

# few dirty columns per table: the code that makes the dirt must not swell the stage that reads it
_DIRTY_MONEY = ("remuneracao_paradigma", "subsidio", "dotacao_atualizada", "liquidado")

RAW = {
    "processes": Raw("orders", "o_orderkey", ["o_orderkey"], {
        "process_id": ("key", _text("o_orderkey")), "numero_processo": ("int", _text("o_custkey")),
        "classe_sigla": ("text", "lower(o_orderpriority)"), "classe_descricao": ("plain", "o_orderpriority"),
        "assunto": ("text", "concat(o_orderpriority, ' | ', o_orderstatus)"), "relator": ("text", _text("o_custkey % 11")),
        "data_autuacao": ("date", _day("o_orderdate")), "data_distribuicao": ("date", _day("o_orderdate")),
        "uf_origem": ("text", "'sp'"), "orgao_julgador": ("plain", "'Plenário'"), "situacao": ("text", "'em tramitação'"),
    }, True),
    "decisions": Raw("lineitem", _LINE_NO, _LINE_ORDER, {
        "decision_id": ("key", _LINE_KEY), "process_id": ("text", _text("l_orderkey")),
        "numero_processo": ("int", _text("l_partkey")), "classe_sigla": ("text", "lower(l_returnflag)"),
        "data_decisao": ("date", _day("l_shipdate")),
        "tipo_decisao": ("text", "CASE l_returnflag WHEN 'N' THEN 'Decisão Monocrática' "
                                 "WHEN 'R' THEN 'Decisão da Presidência' ELSE 'Acórdão' END"),
        "resultado": ("plain", "l_linestatus"), "relator": ("text", _text("l_suppkey % 11")),
        "orgao_colegiado": ("plain", "l_returnflag"), "texto_resumo": ("plain", _text("l_linenumber")),
    }, False),
    "appeals": Raw("events", "event_id", ["event_id"], {
        "recurso_id": ("key", _text("event_id")), "process_id": ("text", _text("user_id")),
        "tipo_recurso": ("text", "event_type"), "data_interposicao": ("date", _day("ts")),
        "data_julgamento": ("date", _day("ts")), "resultado_recurso": ("text", "props"),
        "relator": ("text", _text("user_id % 11")),
    }, True),
    "topics": Raw("part", "p_partkey", ["p_partkey"], {
        "tema_numero": ("int", _text("p_partkey")), "titulo": ("text", "p_name"), "data_reconhecimento": ("date", "'2019-05-06'"),
        "status": ("text", "p_brand"), "relator": ("text", "p_type"), "tese_fixada": ("text", _text("p_size")),
    }, True),
    "personnel": Raw("customer", "c_custkey", ["c_custkey"], {
        "matricula_hash": ("key", _text("c_custkey")), "nome_anonimizado": ("text", "c_name"),
        "cargo": ("text", "c_mktsegment"), "cargo_tipo": ("text", "c_mktsegment"), "lotacao": ("text", _text("c_nationkey")),
        "situacao_funcional": ("text", "'Ativo'"), "data_admissao": ("date", "'2011-12-13'"),
    }, True),
    "remuneration": Raw("lineitem", _LINE_NO, _LINE_ORDER, {
        "remuneracao_id": ("key", _LINE_KEY), "matricula_hash": ("plain", _text("l_suppkey")),
        "competencia_ano": ("int", "'1998'"), "competencia_mes": ("int", _text("l_linenumber")),
        "cargo": ("plain", "l_returnflag"), "cargo_tipo": ("plain", "l_linestatus"),
        **{c: ("money" if c in _DIRTY_MONEY else "plain", _AMOUNT.format(i)) for i, c in enumerate(
            ("remuneracao_paradigma", "vantagens_pessoais", "subsidio", "indenizacoes", "previdencia_e_ir",
             "abate_teto", "remuneracao_liquida"), 1)},
    }, False),
    "budget": Raw("lineitem", _LINE_NO, _LINE_ORDER, {
        "orcamento_id": ("key", _LINE_KEY), "ano_exercicio": ("int", "'1999'"), "programa_trabalho": ("text", "l_returnflag"),
        "acao_orcamentaria": ("plain", "l_linestatus"), "elemento_despesa": ("plain", _text("l_linenumber")),
        **{c: ("money" if c in _DIRTY_MONEY else "plain", _AMOUNT.format(i)) for i, c in enumerate(
            ("dotacao_inicial", "dotacao_atualizada", "empenhado", "liquidado", "pago"), 2)},
    }, False),
}

_YM = ("CAST(year({0}) AS INTEGER) AS ano_{1}, CAST(month({0}) AS INTEGER) AS mes_{1}")
_CATEGORY = (f"CASE WHEN contains(tipo_decisao, '{fixed.MONOCRATIC_WORD}') THEN '{fixed.MONOCRATIC}' "
             f"WHEN contains(tipo_decisao, '{fixed.PRESIDENCY_WORD}') THEN '{fixed.PRESIDENCY}' "
             f"ELSE '{fixed.COLLEGIATE}' END AS categoria_decisao")
_GROSS = "ROUND(remuneracao_paradigma + vantagens_pessoais + subsidio + indenizacoes, 2) AS remuneracao_bruta"
_RATE = "CASE WHEN dotacao_atualizada > 0 THEN ROUND(liquidado / dotacao_atualizada * 100, 2) ELSE 0 END AS taxa_execucao_pct"

_JOBS = {
    "clean_processes": ("processes", silver.clean_processes, silver.PROCESSES, "process_id",
                        ("process_id", "data_distribuicao"), _YM.format("data_distribuicao", "distribuicao")),
    "clean_decisions": ("decisions", silver.clean_decisions, silver.DECISIONS, "decision_id",
                        ("decision_id", "data_decisao"), _CATEGORY + ", " + _YM.format("data_decisao", "decisao")),
    "clean_appeals": ("appeals", silver.clean_appeals, silver.APPEALS, "recurso_id", ("recurso_id",), ""),
    "clean_topics": ("topics", silver.clean_topics, silver.TOPICS, "tema_numero", (), ""),
    "clean_personnel": ("personnel", silver.clean_personnel, silver.PERSONNEL, "matricula_hash", ("matricula_hash",), ""),
    "clean_remuneration": ("remuneration", silver.clean_remuneration, silver.REMUNERATION, "remuneracao_id",
                           ("remuneracao_id",), _GROSS),
    "clean_budget": ("budget", silver.clean_budget, silver.BUDGET, "orcamento_id", ("orcamento_id",), _RATE),
}


def _job(raw: str, run):
    return lambda spark, d: run(RAW[raw].frame(spark, d))


for _name, (_raw, _run, _kinds, _key, _required, _more) in _JOBS.items():
    register(_name, RAW[_raw].clean_sql(_kinds, _key, _required, _more))(_job(_raw, _run))


# ---------------------------------------------------------------- single steps


def _step(name: str, raw: str, column: str, kind: str, read, sql_kind: str | None = None) -> None:
    """One cell reader over a raw column: distinct raw cells, what they become, and how often."""
    value = _sql_read(sql_kind or kind, column) if (sql_kind or kind) != "token" else (
        f"CASE WHEN {column} NOT IN ({_TOKENS}) THEN {column} END")
    sql = f"WITH raw AS ({RAW[raw].sql()}) SELECT {column} AS raw_cell, {value} AS cell, COUNT(*) AS n FROM raw GROUP BY ALL"

    def run(spark, d):
        df = RAW[raw].frame(spark, d)
        return df.groupBy(F.col(column).alias("raw_cell")).agg(F.count("*").alias("n")).select(
            "raw_cell", read(F.col("raw_cell")).alias("cell"), "n")

    register(name, sql)(run)


_step("null_tokens", "appeals", "tipo_recurso", "token", cells.null_tokens)
_step("trim_text", "appeals", "tipo_recurso", "text", lambda c: cells.trim_text(cells.null_tokens(c)))
_step("upper_codes", "processes", "classe_sigla", "code", lambda c: cells.upper_code(cells.null_tokens(c)))
_step("safe_int_cast", "processes", "numero_processo", "int", lambda c: cells.safe_int(cells.null_tokens(c)))
_step("safe_money_cast", "budget", "liquidado", "money", lambda c: cells.safe_money(cells.null_tokens(c)))
_step("safe_date_parse", "decisions", "data_decisao", "date", lambda c: cells.safe_date(cells.null_tokens(c)))


@register("canonical_column_names", "SELECT o_orderkey AS order_key, o_orderstatus AS situacao, o_totalprice AS total_price FROM orders")
def _(spark, d):
    df = b.table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return cleaning.canonical_column_names(df.toDF(" Order Key ", "SITUACAO", "total Price"))


@register("dedup_keep_first", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem QUALIFY row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice) = 1""")
def _(spark, d):
    lines = b.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate", "l_extendedprice")
    first = cleaning.dedup_keep_first(
        lines, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"])
    return first.drop("l_shipdate", "l_extendedprice")


@register("require_not_null", b.with_views(
    "SELECT matricula_hash, lotacao, data_admissao FROM silver_personnel WHERE lotacao IS NOT NULL AND data_admissao IS NOT NULL",
    "silver_personnel"))
def _(spark, d):
    df = b.personnel(spark, d).select("matricula_hash", "lotacao", "data_admissao")
    return cleaning.require_not_null(df, "lotacao", "data_admissao")


@register("date_parts", """SELECT CAST(year(l_shipdate) AS INTEGER) AS ano, CAST(month(l_shipdate) AS INTEGER) AS mes,
    COUNT(*) AS n FROM lineitem GROUP BY 1, 2""")
def _(spark, d):
    return b.table(spark, d, "lineitem").groupBy(
        F.year("l_shipdate").alias("ano"), F.month("l_shipdate").alias("mes")).agg(F.count("*").alias("n"))


@register("decision_category", f"""
    WITH raw AS ({RAW['decisions'].sql()})
    SELECT tipo_decisao, {_CATEGORY}, COUNT(*) AS n
    FROM (SELECT {_sql_read('text', 'tipo_decisao')} AS tipo_decisao FROM raw) GROUP BY 1, 2""")
def _(spark, d):
    kinds = RAW["decisions"].frame(spark, d).select(
        cells.trim_text(cells.null_tokens(F.col("tipo_decisao"))).alias("tipo_decisao"))
    return kinds.groupBy("tipo_decisao").agg(F.count("*").alias("n")).select(
        "tipo_decisao", cells.decision_category(F.col("tipo_decisao")).alias("categoria_decisao"), "n")


@register("gross_compensation", """SELECT l_orderkey, l_linenumber, l_partkey,
    ROUND(l_extendedprice + l_quantity + 0.25 + l_linenumber, 2) AS bruta FROM lineitem""")
def _(spark, d):
    gross = cells.gross_compensation(F.col("l_extendedprice"), F.col("l_quantity"), F.lit(0.25), F.col("l_linenumber"))
    return b.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", gross.alias("bruta"))


@register("execution_rate", """SELECT l_orderkey, l_linenumber, l_partkey,
    CASE WHEN l_extendedprice - 20000 > 0 THEN ROUND(l_quantity / (l_extendedprice - 20000) * 100, 2) ELSE 0 END AS taxa
    FROM lineitem""")
def _(spark, d):
    rate = cells.execution_rate(F.col("l_quantity"), F.col("l_extendedprice") - 20000)
    return b.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", rate.alias("taxa"))
