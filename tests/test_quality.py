from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cartorio.plans import quality as q
from cartorio.plans.provenance import manifest_rows


def _cases(spark, data):
    return spark.createDataFrame(data, "process_id string, day string, uf_origem string").withColumn(
        "data_distribuicao", F.col("day").cast("date"))


def _rulings(spark, data):
    return spark.createDataFrame(data, "decision_id string, process_id string, day string").withColumn(
        "data_decisao", F.col("day").cast("date"))


def _by_name(df):
    return {r.check_name: r for r in df.collect()}


GOOD = [("a", "2019-05-01", "SP"), ("b", "2020-05-01", None)]


def test_good_cases_pass(spark):
    got = _by_name(q.check_processes(_cases(spark, GOOD)))
    assert len(got) == 5 and {r.status for r in got.values()} == {"PASS"}
    assert got["temporal_scope_2018_2026"].details == {
        "min_year": "2019", "max_year": "2020", "out_of_bounds_count": "0", "total_records": "2"}


@pytest.mark.parametrize("extra,check,message", [
    (("a", "2019-06-01", "SP"), "primary_key_uniqueness", "Found 1 duplicate process_id entries."),
    ((None, "2019-06-01", "SP"), "not_null_critical_fields", "Null check: 1 null IDs, 0 null distribution dates."),
    (("c", None, "SP"), "not_null_critical_fields", "Null check: 0 null IDs, 1 null distribution dates."),
    (("c", "1979-01-01", "SP"), "reasonable_dates", "1 processes have unreasonable distribution dates."),
    (("c", "2017-01-01", "SP"), "temporal_scope_2018_2026",
     "Violação de escopo temporal em processos: 1 registros fora de [2018, 2026]."),
    (("c", "2019-01-01", "XX"), "valid_uf_domains", "Invalid UFs detected: 1 different codes."),
])
def test_bad_cases_fail(spark, extra, check, message):
    row = _by_name(q.check_processes(_cases(spark, [*GOOD, extra]), current_year=2026))[check]
    assert (row.status, row.message) == ("FAIL", message)


def test_no_dated_row_fails(spark):
    row = _by_name(q.check_decisions(_rulings(spark, [("1", "a", None)])))["temporal_scope_2018_2026"]
    assert row.status == "FAIL" and row.message.startswith("No valid date records")


def test_many_invalid_states_are_counted(spark):
    cases = spark.range(1_500).select(
        F.col("id").cast("string").alias("process_id"), F.lit("2020-01-01").cast("date").alias("data_distribuicao"),
        F.concat(F.lit("U"), F.col("id").cast("string")).alias("uf_origem"))
    row = _by_name(q.check_processes(cases))["valid_uf_domains"]
    assert row.message == "Invalid UFs detected: 1500 different codes." and row.details["invalid_uf_count"] == "1500"
    assert q.invalid_states(cases).count() == 1_500


def test_decisions_and_references(spark):
    cases = _cases(spark, GOOD)
    rulings = _rulings(spark, [("1", "a", "2019-04-30"), ("1", "a", "2019-06-01"), ("2", "zz", None), ("3", None, "2020-01-01")])
    got = _by_name(q.check_decisions(rulings))
    assert got["primary_key_uniqueness"].details["duplicates_count"] == "1"
    assert got["not_null_decision_date"].message == "1 null decision dates found."
    assert "referential_orphans" not in _by_name(q.check_referential(rulings, cases))
    ref = _by_name(q.check_referential(rulings, cases, orphans=True))
    assert ref["referential_temporal_consistency"].message == "1 decisions precede their process distribution date."
    assert ref["referential_orphans"].details["orphan_decisions"] == "2"


def test_money_checks(spark):
    pay = spark.createDataFrame([("1", -1.0, 0.0), ("1", 1.0, -2.0)], "remuneracao_id string, remuneracao_liquida double, abate_teto double")
    assert {r.status for r in q.check_remuneration(pay).collect()} == {"FAIL"}
    bud = spark.createDataFrame([("1", 2017, -9.0, 1.0, 1.0, 1.0, 1.0), ("2", 2030, 1.0, 1.0, 1.0, -1.0, 1.0)],
                                "orcamento_id string, ano_exercicio bigint, dotacao_inicial double, dotacao_atualizada double, "
                                "empenhado double, liquidado double, pago double")
    got = _by_name(q.check_budget(bud))
    # the initial grant is not tested, nor is the upper year
    assert got["non_negative_budget_values"].details["negative_count"] == "1"
    assert got["budget_year_range"].details["invalid_years"] == "1"
    assert got["budget_pk_uniqueness"].status == "PASS"


def test_checksums(spark):
    hashes = spark.createDataFrame([("file:/r/a.csv", 3, "h1"), ("file:/r/b.csv", 3, "h2"), ("file:/r/c.csv", 3, "h3")],
                                   "file_path string, file_size_bytes bigint, file_hash_sha256 string")
    counts = spark.createDataFrame([("file:///r/a.csv", 2)], "file_path string, row_count bigint")
    log = manifest_rows(hashes, counts, F.regexp_extract("file_path", "([abc]).csv", 1), "u")
    assert {r.dataset_name: r.row_count for r in log.collect()} == {"a": 2, "b": 0, "c": 0}
    now = hashes.where("file_path not like '%c.csv'").withColumn(
        "file_hash_sha256", F.when(F.col("file_path").like("%b.csv"), "other").otherwise(F.col("file_hash_sha256")))
    got = {r.dataset: (r.check_name, r.status) for r in q.check_checksums(log, now).collect()}
    assert got == {"a": ("checksum_integrity", "PASS"), "b": ("checksum_integrity", "FAIL"), "c": ("raw_file_presence", "FAIL")}
    assert {r.dataset: r.state for r in q.file_states(log, now).collect()} == {"a": "same", "b": "altered", "c": "missing"}
    whole = q.check_checksums(log.withColumn("dataset_name", F.lit("all")), now).collect()
    assert [(r.status, r.message, r.details) for r in whole] == [
        ("FAIL", "Raw file missing: file:/r/c.csv", {"files_count": "3", "missing_count": "1", "altered_count": "1"})]


def test_report_gate_and_summary(spark, tmp_path):
    checks = q.all_checks(spark, {"processos": _cases(spark, GOOD)}, "/silver")
    report = q.write_report(q.quality_report(checks), str(tmp_path / "report"))
    row = report.first()
    assert (row.total_checks, row.failed_checks, row.overall_status) == (6, 1, "FAIL")
    assert [r.check_name for r in row.results if r.status == "FAIL"] == ["file_exists"]
    assert not q.gate_passes(report)
    assert q.gate_passes(q.report_totals(checks.where("status = 'PASS'")))
    summary = q.report_summary(spark, report).first()
    assert summary.temporal_window == "2018 - 2026" and len(summary.details) == 6
    missing = q.report_summary(spark, None).first()
    assert (missing.status, missing.total_checks, missing.details) == ("PASS", 0, [])
