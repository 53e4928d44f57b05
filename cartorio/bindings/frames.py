"""Court tables made of the general test tables, as DataFrames and as the same SQL views.

Cases are orders, decisions are line items, appeals are events, personnel are customers, payroll
and budget are line-item amounts. NULL keys, judges and states and unknown cases are put in by
key arithmetic, the same on both sides, since the test tables have none. A case's state is the
nation its customer number falls on, so that no join to a large table hides in the binding.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartorio.functions import fixed
from cartorio.functions.cells import decision_category
from cartorio.plans import gold


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _judge(number: Column, judges: int, none_every: int) -> Column:
    return F.when(number % none_every != 0, F.concat(F.lit("Min. "), (number % judges).cast("string")))


def origins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(uf_origem, regiao, nation number) of each state."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").cast("bigint").alias("state_no"), F.col("n_name").alias("uf_origem"),
        F.col("r_name").alias("regiao"))


def processes(spark: SparkSession, sf_dir: str, origin: bool = False) -> DataFrame:
    """Cases; ``origin`` adds state and subject."""
    orders = table(spark, sf_dir, "orders")
    key, customer, day = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate").cast("date")
    status = F.when(F.col("o_orderstatus") == "O", fixed.ACTIVE).when(
        F.col("o_orderstatus") == "F", fixed.ARCHIVED).otherwise(fixed.JUDGED)
    df = orders.select(
        key.alias("process_id"),
        (key + 100000).alias("numero_processo"),
        F.upper("o_orderpriority").alias("classe_sigla"),
        F.concat(F.lit("Classe "), F.col("o_orderpriority")).alias("classe_descricao"),
        _judge(customer, 11, 101).alias("relator"),
        F.date_sub(day, (key % 15 + 1).cast("int")).alias("data_autuacao"),
        day.alias("data_distribuicao"),
        F.when(customer % 3 == 0, "Plenário").otherwise(
            F.concat((customer % 3).cast("string"), F.lit("ª Turma"))).alias("orgao_julgador"),
        status.alias("situacao"),
        F.year(day).alias("ano_distribuicao"),
        F.month(day).alias("mes_distribuicao"),
        F.when(customer % 103 != 0, customer % 25).alias("state_no"),
    )
    if origin:
        states = origins(spark, sf_dir)
        df = df.join(states, "state_no", "left").withColumn(
            "assunto", F.concat_ws(" | ", "regiao", "uf_origem", "classe_sigla")).drop("regiao")
    return gold.fact_processes(df.drop("state_no"))


def decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    order, part, flag = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_returnflag")
    day = F.col("l_shipdate").cast("date")
    kind = F.when(flag == "N", "Decisão Monocrática").when(flag == "R", "Decisão da Presidência").otherwise(
        "Acórdão - 1ª Turma")
    return gold.fact_decisions(lines.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("decision_id"),
        F.when(part % 97 == 0, None).when(part % 89 == 0, -order - 1).otherwise(order).alias("process_id"),
        (order + 100000).alias("numero_processo"),
        F.concat(F.lit("C"), (order % 5).cast("string")).alias("classe_sigla"),
        day.alias("data_decisao"),
        kind.alias("tipo_decisao"),
        F.concat("l_linestatus", "l_returnflag").alias("resultado"),
        _judge(F.col("l_suppkey"), 13, 53).alias("relator"),
        F.when(flag == "A", "1ª Turma").alias("orgao_colegiado"),
        F.concat(F.lit("Resumo "), F.col("l_linenumber").cast("string")).alias("texto_resumo"),
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.unix_date(day)).alias("line_id"),
        decision_category(kind).alias("categoria_decisao"),
        F.year(day).alias("ano_decisao"),
        F.month(day).alias("mes_decisao"),
    ))


def appeals(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    number, day = F.col("event_id"), F.col("ts").cast("date")
    return gold.fact_appeals(events.select(
        number.alias("recurso_id"), F.col("user_id").alias("process_id"), F.col("event_type").alias("tipo_recurso"),
        day.alias("data_interposicao"),
        F.when(number % 7 != 0, F.date_add(day, (number % 40).cast("int"))).alias("data_julgamento"),
        F.when(F.col("value") > 20, "Provido").otherwise("Não provido").alias("resultado_recurso"),
        _judge(F.col("user_id"), 11, 29).alias("relator"),
    ))


def personnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    states = origins(spark, sf_dir).select(F.col("state_no").alias("c_state"), F.col("uf_origem").alias("lotacao"))
    hired = F.date_add(F.lit("2000-01-01").cast("date"), (F.col("c_custkey") % 7000).cast("int"))
    return customer.join(states, F.col("c_nationkey") == F.col("c_state"), "left").select(
        F.concat(F.lit("M"), F.col("c_custkey").cast("string")).alias("matricula_hash"),
        F.col("c_name").alias("nome_anonimizado"),
        F.concat(F.lit("Cargo "), F.col("c_mktsegment")).alias("cargo"),
        F.col("c_mktsegment").alias("cargo_tipo"),
        F.when(F.col("c_custkey") % 31 != 0, F.col("lotacao")).alias("lotacao"),
        F.when(F.col("c_acctbal") < 0, "Cedido").otherwise("Ativo").alias("situacao_funcional"),
        F.when(F.col("c_custkey") % 37 != 0, hired).alias("data_admissao"),
    )


def remuneration(spark: SparkSession, sf_dir: str) -> DataFrame:
    price, tax, cut = F.col("l_extendedprice"), F.col("l_tax"), F.col("l_discount")
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("remuneracao_id"),
        price.alias("remuneracao_paradigma"),
        F.col("l_quantity").alias("vantagens_pessoais"),
        F.lit(0.0).alias("subsidio"),
        (price * tax).alias("indenizacoes"),
        (price * cut - 100.0).alias("abate_teto"),
        (price * (1 - cut) - 20000.0 * tax).alias("remuneracao_liquida"),
    )


def budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    price, tax, cut = F.col("l_extendedprice"), F.col("l_tax"), F.col("l_discount")
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("orcamento_id"),
        F.year("l_shipdate").cast("bigint").alias("ano_exercicio"),
        F.col("l_returnflag").alias("programa_trabalho"),
        (price - 5000.0).alias("dotacao_inicial"),
        F.when(F.year("l_shipdate") == 1996, 0.0).otherwise(price * (1 + tax)).alias("dotacao_atualizada"),
        price.alias("empenhado"),
        (price * (1 - cut)).alias("liquidado"),
        (price * (1 - cut) - 1000.0).alias("pago"),
    )


def _sql_judge(number: str, judges: int, none_every: int) -> str:
    return f"CASE WHEN {number} % {none_every} <> 0 THEN 'Min. ' || ({number} % {judges}) END"


_STATUS = f"CASE o_orderstatus WHEN 'O' THEN '{fixed.ACTIVE}' WHEN 'F' THEN '{fixed.ARCHIVED}' ELSE '{fixed.JUDGED}' END"


def sql_date_key(day: str) -> str:
    return f"CAST(strftime({day}, '%Y%m%d') AS BIGINT)"


VIEWS = {
    "dim_origin": """
        SELECT n_nationkey AS state_no, n_name AS uf_origem, r_name AS regiao
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "fact_processes": f"""
        SELECT o_orderkey AS process_id, o_orderkey + 100000 AS numero_processo,
               upper(o_orderpriority) AS classe_sigla, 'Classe ' || o_orderpriority AS classe_descricao,
               CASE WHEN uf_origem IS NULL THEN upper(o_orderpriority)
                    ELSE regiao || ' | ' || uf_origem || ' | ' || upper(o_orderpriority) END AS assunto,
               {_sql_judge('o_custkey', 11, 101)} AS relator,
               CAST(o_orderdate AS DATE) - CAST(o_orderkey % 15 + 1 AS INTEGER) AS data_autuacao,
               CAST(o_orderdate AS DATE) AS data_distribuicao, uf_origem,
               CASE WHEN o_custkey % 3 = 0 THEN 'Plenário' ELSE (o_custkey % 3) || 'ª Turma' END AS orgao_julgador,
               {_STATUS} AS situacao,
               CAST(year(o_orderdate) AS INTEGER) AS ano_distribuicao,
               CAST(month(o_orderdate) AS INTEGER) AS mes_distribuicao,
               {sql_date_key('o_orderdate')} AS date_distribuicao_key,
               {sql_date_key('CAST(o_orderdate AS DATE) - CAST(o_orderkey % 15 + 1 AS INTEGER)')} AS date_autuacao_key
        FROM orders LEFT JOIN dim_origin ON CASE WHEN o_custkey % 103 <> 0 THEN o_custkey % 25 END = state_no""",
    "fact_decisions": f"""
        SELECT l_orderkey || '-' || l_linenumber AS decision_id,
               CASE WHEN l_partkey % 97 = 0 THEN NULL WHEN l_partkey % 89 = 0 THEN -l_orderkey - 1
                    ELSE l_orderkey END AS process_id,
               l_orderkey + 100000 AS numero_processo, 'C' || (l_orderkey % 5) AS classe_sigla,
               CAST(l_shipdate AS DATE) AS data_decisao,
               CASE l_returnflag WHEN 'N' THEN 'Decisão Monocrática' WHEN 'R' THEN 'Decisão da Presidência'
                    ELSE 'Acórdão - 1ª Turma' END AS tipo_decisao,
               l_linestatus || l_returnflag AS resultado,
               {_sql_judge('l_suppkey', 13, 53)} AS relator,
               CASE WHEN l_returnflag = 'A' THEN '1ª Turma' END AS orgao_colegiado,
               'Resumo ' || l_linenumber AS texto_resumo,
               concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                         CAST(l_shipdate AS DATE) - DATE '1970-01-01') AS line_id,
               CASE l_returnflag WHEN 'N' THEN '{fixed.MONOCRATIC}' WHEN 'R' THEN '{fixed.PRESIDENCY}'
                    ELSE '{fixed.COLLEGIATE}' END AS categoria_decisao,
               CAST(year(l_shipdate) AS INTEGER) AS ano_decisao,
               CAST(month(l_shipdate) AS INTEGER) AS mes_decisao,
               {sql_date_key('l_shipdate')} AS date_decisao_key
        FROM lineitem""",
    "fact_appeals": f"""
        SELECT event_id AS recurso_id, user_id AS process_id, event_type AS tipo_recurso,
               CAST(ts AS DATE) AS data_interposicao,
               CASE WHEN event_id % 7 <> 0 THEN CAST(ts AS DATE) + CAST(event_id % 40 AS INTEGER) END AS data_julgamento,
               CASE WHEN value > 20 THEN 'Provido' ELSE 'Não provido' END AS resultado_recurso,
               {_sql_judge('user_id', 11, 29)} AS relator,
               {sql_date_key('ts')} AS date_interposicao_key,
               CASE WHEN event_id % 7 <> 0
                    THEN {sql_date_key('CAST(ts AS DATE) + CAST(event_id % 40 AS INTEGER)')} END AS date_julgamento_key
        FROM events""",
    "silver_personnel": """
        SELECT 'M' || c_custkey AS matricula_hash, c_name AS nome_anonimizado, 'Cargo ' || c_mktsegment AS cargo,
               c_mktsegment AS cargo_tipo, CASE WHEN c_custkey % 31 <> 0 THEN n_name END AS lotacao,
               CASE WHEN c_acctbal < 0 THEN 'Cedido' ELSE 'Ativo' END AS situacao_funcional,
               CASE WHEN c_custkey % 37 <> 0
                    THEN DATE '2000-01-01' + CAST(c_custkey % 7000 AS INTEGER) END AS data_admissao
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "fact_remuneration": """
        SELECT l_orderkey || '-' || l_linenumber AS remuneracao_id, l_extendedprice AS remuneracao_paradigma,
               l_quantity AS vantagens_pessoais, CAST(0 AS DOUBLE) AS subsidio, l_extendedprice * l_tax AS indenizacoes,
               l_extendedprice * l_discount - 100 AS abate_teto,
               l_extendedprice * (1 - l_discount) - 20000 * l_tax AS remuneracao_liquida
        FROM lineitem""",
    "fact_budget": """
        SELECT l_orderkey || '-' || l_linenumber AS orcamento_id, CAST(year(l_shipdate) AS BIGINT) AS ano_exercicio,
               l_returnflag AS programa_trabalho, l_extendedprice - 5000 AS dotacao_inicial,
               CASE WHEN year(l_shipdate) = 1996 THEN 0 ELSE l_extendedprice * (1 + l_tax) END AS dotacao_atualizada,
               l_extendedprice AS empenhado, l_extendedprice * (1 - l_discount) AS liquidado,
               l_extendedprice * (1 - l_discount) - 1000 AS pago
        FROM lineitem""",
}
_NEEDS = {"fact_processes": ["dim_origin"]}


def with_views(body: str, *views: str, more: str = "") -> str:
    """``body`` after the named views; ``more`` holds further ``name AS (...)`` definitions."""
    needed: list[str] = []
    for v in views:
        needed += [n for n in [*_NEEDS.get(v, []), v] if n not in needed]
    ctes = [f"{v} AS ({VIEWS[v]})" for v in needed] + ([more] if more else [])
    return f"WITH {', '.join(ctes)} {body}" if ctes else body
