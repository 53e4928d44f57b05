"""Data-quality contract: all figures of a table in one pass, then one row per check."""

from __future__ import annotations

from datetime import date, datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartorio.functions import fixed
from cartorio.functions.cells import count_where
from cartorio.operators.checks import COLUMNS, FAIL, PASS, Check, check_rows, keyed_figures, message, messages, side_by_side
from cartorio.operators.joins import decisions_per_case
from cartorio.plans.provenance import latest_ingestion, path_key
from cartorio.sources.manifest import file_sha256

STATES = sorted(s for states in fixed.STATES_BY_REGION.values() for s in states)


def _scope_counts(column: str, first: int, last: int) -> dict[str, Column]:
    year = F.year(column)
    return {"dated": F.col(column).isNotNull(), "out_of_scope": (year < first) | (year > last)}


def _temporal_scope(dataset: str, column: str, first: int, last: int) -> Check:
    """Fails when any dated row lies outside the years, or when no row is dated at all."""
    out, dated, lo, hi = (F.col(c) for c in ("out_of_scope", "dated", "min_year", "max_year"))
    bad, good = messages("temporal_scope", dataset=dataset, first=first, last=last)
    undated, _ = messages("temporal_scope_undated", dataset=dataset, column=column)
    return Check(
        f"temporal_scope_{first}_{last}", dataset, (dated == 0) | (out > 0),
        F.when(dated == 0, undated).otherwise(bad), good,
        {"min_year": lo, "max_year": hi, "out_of_bounds_count": out, "total_records": dated},
        given=dated > 0,
    )


def _unique_key(name: str, dataset: str, key: str) -> Check:
    dups = F.col("duplicates")
    return Check(name, dataset, dups > 0, *messages("unique_key", key=key), {"duplicates_count": dups})


def _none_of(name: str, dataset: str, figure: str, detail: str, **literals: object) -> Check:
    """Fails when the figure is not zero."""
    n = F.col(figure)
    return Check(name, dataset, n > 0, *messages(name, **literals), {detail: n})


# ---------------------------------------------------------------- state domain


def invalid_states(processes: DataFrame, valid: list[str] = STATES) -> DataFrame:
    """Every state code outside the domain with its number of cases."""
    found = processes.where("uf_origem is not null").groupBy("uf_origem").agg(F.count("*").alias("total_processos"))
    domain = processes.sparkSession.createDataFrame([(s,) for s in valid], "uf_origem string")
    return found.join(F.broadcast(domain), "uf_origem", "left_anti")


# ---------------------------------------------------------------- checks per table


def check_processes(
    processes: DataFrame, first: int = fixed.FIRST_YEAR, last: int = fixed.LAST_YEAR,
    current_year: int | None = None, valid_states: list[str] = STATES,
) -> DataFrame:
    ceiling = (current_year or date.today().year) + 1
    year = F.year("data_distribuicao")
    figures = side_by_side(
        keyed_figures(processes, "process_id", {
            "null_dates": F.col("data_distribuicao").isNull(), "odd_years": (year < 1980) | (year > ceiling),
            **_scope_counts("data_distribuicao", first, last)}, {"year": year}),
        invalid_states(processes, valid_states).agg(F.count("*").alias("invalid_states")))
    ids, dates, bad = (F.col(c) for c in ("null_ids", "null_dates", "invalid_states"))
    return check_rows(figures, [
        _unique_key("primary_key_uniqueness", "processos", "process_id"),
        Check("not_null_critical_fields", "processos", (ids > 0) | (dates > 0),
              *messages("not_null_critical_fields"), {"null_ids": ids, "null_dates": dates}),
        _none_of("reasonable_dates", "processos", "odd_years", "invalid_date_count"),
        _temporal_scope("processos", "data_distribuicao", first, last),
        # the codes themselves may be any number: they are rows of ``invalid_states``
        Check("valid_uf_domains", "processos", bad > 0, *messages("valid_uf_domains"), {"invalid_uf_count": bad}),
    ])


def check_decisions(decisions: DataFrame, first: int = fixed.FIRST_YEAR, last: int = fixed.LAST_YEAR) -> DataFrame:
    figures = keyed_figures(decisions, "decision_id", {
        "null_dates": F.col("data_decisao").isNull(), **_scope_counts("data_decisao", first, last)},
        {"year": F.year("data_decisao")})
    return check_rows(figures, [
        _unique_key("primary_key_uniqueness", "decisoes", "decision_id"),
        _none_of("not_null_decision_date", "decisoes", "null_dates", "null_dates"),
        _temporal_scope("decisoes", "data_decisao", first, last),
    ])


def _reference_figures(decisions: DataFrame, processes: DataFrame) -> DataFrame:
    """Decisions before their case began, and decisions without a known case.

    Both figures come from one join of per-case counts, so one case with very many decisions
    costs a few rows.
    """
    per_case = decisions_per_case(decisions, "data_decisao")
    cases = processes.select("process_id", "data_distribuicao", F.lit(True).alias("known"))
    joined = per_case.join(cases, "process_id", "left")
    early = F.when(F.col("data_decisao") < F.col("data_distribuicao"), F.col("n"))
    return joined.agg(
        F.coalesce(F.sum(early), F.lit(0)).alias("early"),
        F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("n"))), F.lit(0)).alias("orphans"),
    )


def check_referential(decisions: DataFrame, processes: DataFrame, orphans: bool = False) -> DataFrame:
    """Order of dates between a decision and its case; with ``orphans`` also decisions without a case.

    The second check is not part of the contract, so it counts in totals and gate only where asked for.
    """
    checks = [
        _none_of("referential_temporal_consistency", "cross_process_decision", "early", "anomalous_dates")]
    if orphans:
        checks.append(Check(
            "referential_orphans", "cross_process_decision", F.col("orphans") > 0,
            message("{orphans} decisions have no known process."), message("All decisions belong to a known process."),
            {"orphan_decisions": F.col("orphans")}))
    return check_rows(_reference_figures(decisions, processes), checks)


def check_remuneration(remuneration: DataFrame) -> DataFrame:
    figures = keyed_figures(remuneration, "remuneracao_id", {
        "negative_net": F.col("remuneracao_liquida") < 0, "negative_cut": F.col("abate_teto") < 0})
    return check_rows(figures, [
        _unique_key("remuneration_pk_uniqueness", "remuneracao", "remuneracao_id"),
        _none_of("non_negative_net_salary", "remuneracao", "negative_net", "negative_count"),
        _none_of("constitutional_ceiling_integrity", "remuneracao", "negative_cut", "invalid_abate_teto"),
    ])


def check_budget(budget: DataFrame, first: int = fixed.FIRST_YEAR, last: int = fixed.LAST_YEAR) -> DataFrame:
    """Negative amounts (the initial grant is not tested) and years before the first."""
    spent = [F.col(c) < 0 for c in ("dotacao_atualizada", "empenhado", "liquidado", "pago")]
    figures = keyed_figures(budget, "orcamento_id", {
        "negative": reduce(lambda a, b: a | b, spent), "early_years": F.col("ano_exercicio") < first})
    return check_rows(figures, [
        _unique_key("budget_pk_uniqueness", "orcamento", "orcamento_id"),
        _none_of("non_negative_budget_values", "orcamento", "negative", "negative_count"),
        _none_of("budget_year_range", "orcamento", "early_years", "invalid_years", first=first, last=last),
    ])


# ---------------------------------------------------------------- files


def _single(spark: SparkSession, name: str, layer: str, dataset: str, status: str, message: str) -> DataFrame:
    return spark.range(1).select(
        F.lit(name).alias("check_name"), F.lit(layer).alias("target_layer"), F.lit(dataset).alias("dataset"),
        F.lit(status).alias("status"), F.lit(message).alias("message"),
        F.expr("cast(map() as map<string,string>)").alias("details"))


def missing_table(spark: SparkSession, dataset: str, path: str) -> DataFrame:
    """The failed check of a required Silver table that is not there."""
    return _single(spark, "file_exists", "silver", dataset, FAIL, f"Parquet file not found at {path}")


def file_states(manifest: DataFrame, hashes: DataFrame) -> DataFrame:
    """(dataset, file_path, state, recorded_hash, computed_hash) of every file of each last ingestion.

    ``state`` is ``same``, ``altered`` or ``missing``. As many rows as landing files.
    """
    latest = latest_ingestion(manifest).select("dataset_name", "file_path", "file_hash_sha256")
    now = hashes.select(path_key("file_path").alias("_path"), F.col("file_hash_sha256").alias("computed_hash"))
    joined = latest.withColumn("_path", path_key("file_path")).join(now, "_path", "left")
    return joined.select(
        F.col("dataset_name").alias("dataset"), "file_path",
        F.when(F.col("computed_hash").isNull(), "missing").when(
            F.col("computed_hash") == F.col("file_hash_sha256"), "same").otherwise("altered").alias("state"),
        F.col("file_hash_sha256").alias("recorded_hash"), "computed_hash")


def check_checksums(manifest: DataFrame, hashes: DataFrame) -> DataFrame:
    """One check row per dataset: the files of its last ingestion against their hashes now.

    A missing file outweighs an altered one; the message names the first of them. ``file_states`` has
    all files.
    """
    state = F.col("state")
    sums = file_states(manifest, hashes).groupBy("dataset").agg(
        F.count("*").alias("files"), count_where(state == "missing").alias("missing"),
        count_where(state == "altered").alias("altered"),
        F.min(F.when(state == "missing", F.col("file_path"))).alias("file_path"))
    missing, altered = F.col("missing") > 0, F.col("altered") > 0
    bad, good = messages("checksum_integrity")
    gone, _ = messages("raw_file_presence")
    return sums.select(
        F.when(missing, "raw_file_presence").otherwise("checksum_integrity").alias("check_name"),
        F.lit("bronze").alias("target_layer"), "dataset",
        F.when(missing | altered, FAIL).otherwise(PASS).alias("status"),
        F.when(missing, gone).when(altered, bad).otherwise(good).alias("message"),
        F.create_map(*[x for c in ("files", "missing", "altered") for x in (
            F.lit(f"{c}_count"), F.col(c).cast("string"))]).alias("details"))


def check_files(spark: SparkSession, manifest: DataFrame, raw: str) -> DataFrame:
    """Hash the landing files below ``raw`` and compare them with the manifest."""
    return check_checksums(manifest, file_sha256(spark, raw))


# ---------------------------------------------------------------- report


def all_checks(
    spark: SparkSession, silver: dict[str, DataFrame], silver_dir: str = "silver",
    first: int = fixed.FIRST_YEAR, last: int = fixed.LAST_YEAR,
    manifest: DataFrame | None = None, hashes: DataFrame | None = None, current_year: int | None = None,
    orphans: bool = False,
) -> DataFrame:
    """Check rows of all tables present; a missing required table is a failed check.

    ``hashes`` are those of the landing files now, see ``file_sha256``.
    """
    parts: list[DataFrame] = []
    if "processos" in silver:
        parts.append(check_processes(silver["processos"], first, last, current_year))
    else:
        parts.append(missing_table(spark, "processos", f"{silver_dir}/processos"))
    if "decisoes" in silver:
        parts.append(check_decisions(silver["decisoes"], first, last))
    else:
        parts.append(missing_table(spark, "decisoes", f"{silver_dir}/decisoes"))
    if "processos" in silver and "decisoes" in silver:
        parts.append(check_referential(silver["decisoes"], silver["processos"], orphans))
    if "remuneracao" in silver:
        parts.append(check_remuneration(silver["remuneracao"]))
    if "orcamento" in silver:
        parts.append(check_budget(silver["orcamento"], first, last))
    if manifest is not None and hashes is not None:
        parts.append(check_checksums(manifest, hashes))
    return reduce(DataFrame.unionByName, [p.select(*COLUMNS) for p in parts])


def report_totals(results: DataFrame) -> DataFrame:
    """One row: numbers of checks and the overall status, PASS only without any failure."""
    failed = count_where(F.col("status") == FAIL)
    return results.agg(
        F.count("*").alias("total_checks"),
        count_where(F.col("status") == PASS).alias("passed_checks"),
        failed.alias("failed_checks"),
        F.when(failed == 0, PASS).otherwise(FAIL).alias("overall_status"),
    )


def quality_report(results: DataFrame, timestamp: str | None = None) -> DataFrame:
    """Totals with the list of check rows; there are as many rows as rules, and one per dataset for its files."""
    when = timestamp or datetime.now(timezone.utc).isoformat()
    listed = results.agg(F.collect_list(F.struct(*COLUMNS)).alias("results"))
    return report_totals(results).crossJoin(listed).withColumn("timestamp", F.lit(when))


def write_report(report: DataFrame, path: str) -> DataFrame:
    report.write.mode("overwrite").option("ignoreNullFields", False).json(path)
    return report.sparkSession.read.schema(report.schema).json(path)


def gate_passes(report: DataFrame) -> bool:
    """Whether the pipeline may go on to Gold."""
    return report.where(F.col("overall_status") != PASS).isEmpty()


def report_summary(spark: SparkSession, report: DataFrame | None, first: int = fixed.FIRST_YEAR, last: int = fixed.LAST_YEAR) -> DataFrame:
    """Status, totals, analytic window and check rows; a missing report reads as an empty PASS."""
    window = F.lit(f"{first} - {last}").alias("temporal_window")
    if report is None:
        zero = F.lit(0).cast("bigint")
        return spark.range(1).select(
            F.lit(PASS).alias("status"), zero.alias("total_checks"), zero.alias("passed_checks"),
            zero.alias("failed_checks"), window, F.lit("").alias("timestamp"),
            F.expr("cast(array() as array<struct<check_name:string,target_layer:string,dataset:string,"
                   "status:string,message:string,details:map<string,string>>>)").alias("details"))
    return report.select(
        F.col("overall_status").alias("status"), "total_checks", "passed_checks", "failed_checks", window,
        "timestamp", F.col("results").alias("details"))
