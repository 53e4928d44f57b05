from __future__ import annotations

import csv
import hashlib
import json
import os
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from cartorio.plans import exports, gold, kpis, listings, medallion, provenance, silver
from cartorio.sources import bronze, manifest, published, sinks
from cartorio.streaming import dedup, ingest

CASE = {"numero_processo": "1", "classe_sigla": "hc", "classe_descricao": "Habeas Corpus", "assunto": "PENAL | X",
        "relator": "Min. A", "data_autuacao": "2020-01-01", "data_distribuicao": "2020-01-02", "uf_origem": "sp",
        "orgao_julgador": "Plenário", "situacao": "BAIXADO"}
RULING = {"numero_processo": "1", "classe_sigla": "hc", "data_decisao": "2020-03-02", "tipo_decisao": "Decisão Monocrática",
          "resultado": "Provido", "relator": "Min. B", "orgao_colegiado": "", "texto_resumo": "ok, visto"}
FEED = ingest.Feed("processos", silver.PROCESSES, "process_id", ("process_id", "data_distribuicao"), "data_distribuicao",
                   "try_cast(regexp_extract(process_id, '([0-9]+)$', 1) as bigint)")


def _write(path, rows, columns=None):
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", newline="", encoding="utf-8") as f:
        writer = csv.DictWriter(f, columns or list(rows[0]))
        writer.writeheader()
        writer.writerows(rows)


def _case(i, **kw):
    return {"process_id": f"P-{i}", **CASE, **kw}


@pytest.fixture
def lake(spark, tmp_path):
    raw = tmp_path / "raw"
    _write(raw / "processos" / "p.csv", [_case(i, data_distribuicao=f"202{i % 3}-01-02") for i in range(6)])
    _write(raw / "decisoes" / "d.csv", [{"decision_id": f"D-{i}", "process_id": f"P-{i % 4}", **RULING,
                                         "data_decisao": "2023-01-05"} for i in range(8)])
    return raw, tmp_path / "out"


def test_medallion_run(spark, lake):
    raw, out = lake
    done = medallion.medallion_run(spark, str(raw), str(out))
    assert done.completed and done.report.first().overall_status == "PASS"
    assert done.report.first().total_checks == 11
    tables = {n: df.count() for n, df in done.gold.items()}
    assert tables == {"dim_date": 11323, "dim_process_type": 1, "dim_rapporteur": 2, "dim_origin": 1, "dim_subject": 1,
                      "fact_processes": 6, "fact_decisions": 8}
    log = manifest.scan_manifest_jsonl(spark, str(out / "manifest"))
    assert {r.dataset_name: r.row_count for r in log.collect()} == {"processos": 6, "decisoes": 8}
    assert [r.ramo_direito for r in done.gold["dim_subject"].collect()] == ["PENAL"]
    assert done.gold["dim_origin"].first().regiao == "Sudeste"
    overview = kpis.kpi_overview(done.gold["fact_processes"], done.gold["fact_decisions"]).first()
    assert (overview.total_processes, overview.total_appeals, overview.temporal_range) == (6, 0, "2020 - 2022")


def test_gate_stops_gold(spark, lake):
    raw, out = lake
    _write(raw / "processos" / "q.csv", [_case(99, uf_origem="QQ")])
    stopped = medallion.medallion_run(spark, str(raw), str(out))
    assert not stopped.completed and not stopped.gold
    assert medallion.medallion_run(spark, str(raw), str(out), enforce_gate=False).completed


def test_missing_required_dataset(spark, tmp_path):
    _write(tmp_path / "raw" / "processos" / "p.csv", [_case(1)])
    done = medallion.medallion_run(spark, str(tmp_path / "raw"), str(tmp_path / "out"), enforce_gate=False)
    assert not done.completed
    assert [r.check_name for r in done.report.first().results if r.status == "FAIL"] == ["file_exists"]


def test_empty_overview_has_default_range(spark, lake):
    raw, out = lake
    done = medallion.medallion_run(spark, str(raw), str(out))
    none = done.gold["fact_processes"].where("false")
    row = kpis.kpi_overview(none, done.gold["fact_decisions"]).first()
    assert row.temporal_range == "2018 - 2026"
    assert kpis.executive_summary_rates(kpis.kpi_overview(none, done.gold["fact_decisions"])).first().active_pct == 0.0


def test_calendar(spark):
    days = {r.date_key: r for r in gold.dim_date(spark).where("date_key in (20240229, 20250104)").collect()}
    assert gold.dim_date(spark).count() == 11323
    assert (days[20240229].month_name, days[20240229].day_of_week, days[20240229].is_weekend) == ("Fevereiro", "Quinta-feira", False)
    assert (days[20250104].day_of_week, days[20250104].is_weekend, days[20250104].quarter) == ("Sábado", True, 1)


# ---------------------------------------------------------------- incremental


def test_two_runs_and_nothing_new(spark, tmp_path):
    landing, base = tmp_path / "landing", str(tmp_path / "lake")
    state = ingest.watermark_state(ingest.state_rows(spark, base, "processos"), "processos").first()
    assert (state.last_ingested_date, state.max_id, state.batches_count, state.last_run_utc) == ("2018-01-01", 0, 0, None)
    _write(landing / "1.csv", [_case(i, data_distribuicao="2022-06-15") for i in range(1, 21)])
    first = ingest.incremental_ingest(spark, str(landing), base, FEED).first()
    assert (first.status, first.rows_added, first.new_watermark_date, first.max_id) == ("SUCCESS", 20, "2022-06-15", 20)
    # older dates and a repeated id: the marks do not move back, the first row stays
    _write(landing / "2.csv", [_case(i, data_distribuicao="2021-01-01", relator="Min. Z") for i in range(20, 36)])
    second = ingest.incremental_ingest(spark, str(landing), base, FEED).first()
    assert (second.rows_added, second.new_watermark_date, second.max_id) == (16, "2022-06-15", 35)
    third = ingest.incremental_ingest(spark, str(landing), base, FEED).first()
    assert (third.status, third.rows_added) == ("NO_NEW_DATA", 0)
    table = ingest.silver_table(spark, base, "processos")
    assert table.count() == 35
    assert [r.relator for r in table.where("process_id = 'P-20'").collect()] == ["Min. A"]
    assert ingest.bronze_table(spark, base, "processos").count() == 36
    log = spark.read.schema(manifest.MANIFEST_SCHEMA).json(f"{base}/manifest/processos")
    assert sorted(r.row_count for r in log.collect()) == [16, 20]


def test_columns_are_matched_by_name_and_drift_is_set_aside(spark, tmp_path):
    landing, base = tmp_path / "landing", str(tmp_path / "lake")
    columns = list(reversed(["process_id", *CASE]))
    _write(landing / "a.csv", [_case(1)], columns)
    _write(landing / "b.csv", [_case(2, extra="e")], ["process_id", "extra", *CASE])
    _write(landing / "c.csv", [{"decisao_id": "DEC-1", "relator": "x"}])
    row = ingest.incremental_ingest(spark, str(landing), base, FEED).first()
    assert row.rows_added == 2
    got = {r.process_id: (r.classe_sigla, r.extra) for r in ingest.silver_table(spark, base, "processos").collect()}
    assert got == {"P-1": ("HC", None), "P-2": ("HC", "e")}
    aside = ingest.quarantined_files(spark, base, "processos").collect()
    assert [r.header_line for r in aside] == ["decisao_id,relator"]


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    landing, base = tmp_path / "landing", str(tmp_path / "lake")
    _write(landing / "1.csv", [_case(i) for i in range(5)])
    lines = spark.read.text(str(landing)).select(
        "value", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("block"))
    for _ in range(2):
        ingest._ingest_batch(spark, base, FEED, lines, 0, True)
    state = ingest.watermark_state(ingest.state_rows(spark, base, "processos"), "processos").first()
    assert (state.batches_count, ingest.silver_table(spark, base, "processos").count()) == (1, 5)


def test_a_batch_of_few_keys_reads_few_files_of_the_history(spark, tmp_path, monkeypatch):
    landing, base = tmp_path / "landing", str(tmp_path / "lake")
    _write(landing / "1.csv", [_case(i) for i in range(200)])
    ingest.incremental_ingest(spark, str(landing), base, FEED)
    folders = [p for p in (tmp_path / "lake" / "firsts" / "processos" / "batch_id=0").iterdir() if p.name.startswith("key_bucket=")]
    assert len(folders) == FEED.buckets
    read = []
    real = ingest.not_yet_seen
    monkeypatch.setattr(ingest, "not_yet_seen", lambda batch, seen, key: (read.append(
        [r[0] for r in seen.select(F.input_file_name()).distinct().collect()]), real(batch, seen, key))[1])
    _write(landing / "2.csv", [_case(7, relator="Min. Z"), _case(1000), _case(1001)])
    ingest.incremental_ingest(spark, str(landing), base, FEED)
    assert 1 <= len(read[0]) <= 3
    monkeypatch.undo()
    table = {r.process_id: r.relator for r in ingest.silver_table(spark, base, "processos").collect()}
    assert len(table) == 202 and table["P-7"] == "Min. A"
    _write(landing / "3.csv", [_case(7), _case(1000)])  # a batch without any new key
    ingest.incremental_ingest(spark, str(landing), base, FEED)
    _write(landing / "4.csv", [_case(1001), _case(2000), {**_case(0), "process_id": "NULL"}])
    ingest.incremental_ingest(spark, str(landing), base, FEED)
    assert ingest.silver_table(spark, base, "processos").count() == 203


def test_bad_first_row_hides_later_batches(spark, tmp_path):
    landing, base = tmp_path / "landing", str(tmp_path / "lake")
    _write(landing / "1.csv", [_case(1, data_distribuicao="bad"), _case(2)])
    ingest.incremental_ingest(spark, str(landing), base, FEED)
    _write(landing / "2.csv", [_case(1), _case(3)])
    ingest.incremental_ingest(spark, str(landing), base, FEED)
    assert sorted(r.process_id for r in ingest.silver_table(spark, base, "processos").collect()) == ["P-2", "P-3"]


RULINGS = ingest.Feed("decisoes", silver.DECISIONS, "decision_id", ("decision_id", "data_decisao"), "data_decisao",
                      "try_cast(process_id as bigint)", derive=silver.derive_decisions)
CASES = ingest.Feed(FEED.dataset, FEED.kinds, FEED.key, FEED.required, FEED.date_column, FEED.sequence,
                    derive=silver.derive_processes)


def _ruling(i, **kw):
    return {"decision_id": f"D-{i}", "process_id": f"P-{i}", **RULING, **kw}


def _files(root):
    return {str(p.relative_to(root)): (p.stat().st_mtime_ns, p.read_bytes()) for p in root.rglob("*.parquet")}


def test_gold_grows_and_keys_stay(spark, tmp_path):
    landing, base, gold_at = tmp_path / "landing", str(tmp_path / "lake"), tmp_path / "gold"
    feeds = [(str(landing / "p"), CASES), (str(landing / "d"), RULINGS)]
    _write(landing / "p" / "1.csv", [_case(i, data_distribuicao=f"202{i % 2}-01-02", relator="Min. M") for i in range(4)])
    ingest.ingest_all(spark, feeds[:1], base, str(gold_at))
    assert published.state(spark, str(gold_at)) == {"tables": {}, "marks": {}}  # no decisions yet
    _write(landing / "d" / "1.csv", [_ruling(i, relator="Min. P") for i in range(3)])
    ingest.ingest_all(spark, feeds, base, str(gold_at))
    before, keys = _files(gold_at), {r.relator: r.rapporteur_key for r in published.published(spark, str(gold_at), "dim_rapporteur").collect()}
    assert keys == {"Min. M": 1, "Min. P": 2}
    held = published.published(spark, str(gold_at), "fact_processes")
    _write(landing / "p" / "2.csv", [_case(i, data_distribuicao="2022-01-02", relator=r, assunto=None, extra="e")
                                     for i, r in ((1, "Min. Z"), (8, "Min. A"), (9, "Min. B"))],
           ["process_id", "extra", *CASE])
    ingest.ingest_all(spark, feeds, base, str(gold_at))
    after = _files(gold_at)
    assert before.items() <= after.items()  # no file of earlier years has changed
    fresh = [f for f in after if f not in before and f.startswith("fact_")]
    assert fresh and all("fact_processes" in f and "ano_distribuicao=2022" in f for f in fresh)
    grown = published.published(spark, str(gold_at), "dim_rapporteur").collect()
    assert {r.relator: r.rapporteur_key for r in grown} == {**keys, "Min. A": 3, "Min. B": 4}
    facts = published.published(spark, str(gold_at), "fact_processes")
    assert {r.process_id: r.extra for r in facts.collect()} == {"P-0": None, "P-1": None, "P-2": None, "P-3": None, "P-8": "e", "P-9": "e"}
    assert {r.ano_distribuicao: r["count"] for r in facts.groupBy("ano_distribuicao").count().collect()} == {2020: 2, 2021: 2, 2022: 2}
    assert "ano_distribuicao" in facts.where("ano_distribuicao = 2022")._jdf.queryExecution().toString().split("PartitionFilters")[1][:80]
    assert held.count() == 4  # a reader of the state before still has all of it
    ingest.ingest_all(spark, feeds, base, str(gold_at))
    assert _files(gold_at) == after  # nothing new, nothing written
    silver_now = {n: ingest.silver_table(spark, base, n) for n in ("processos", "decisoes")}
    whole = gold.star_schema(spark, silver_now)
    for name, key in (("dim_subject", "subject_key"), ("dim_process_type", "process_type_key"), ("fact_decisions", "date_decisao_key")):
        plain = lambda df: sorted(map(repr, df.drop(key).collect()))
        assert plain(published.published(spark, str(gold_at), name)) == plain(whole[name].select(
            *published.published(spark, str(gold_at), name).columns))


def test_a_broken_run_is_made_up_for(spark, tmp_path, monkeypatch):
    """Silver was written, Gold was not: the next run brings both batches."""
    landing, base, at = tmp_path / "landing", str(tmp_path / "lake"), str(tmp_path / "gold")
    feeds = [(str(landing / "p"), CASES), (str(landing / "d"), RULINGS)]
    _write(landing / "d" / "1.csv", [_ruling(1)])
    for i in (1, 2, 3):
        _write(landing / "p" / f"{i}.csv", [_case(i)])
        if i == 2:
            monkeypatch.setattr(published, "_point", lambda *a: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                ingest.ingest_all(spark, feeds, base, at)
            monkeypatch.undo()
            assert published.published(spark, at, "fact_processes").count() == 1
        else:
            ingest.ingest_all(spark, feeds, base, at)
    assert sorted(r.process_id for r in published.published(spark, at, "fact_processes").collect()) == ["P-1", "P-2", "P-3"]


def test_a_write_killed_halfway_leaves_the_old_tables(spark, tmp_path):
    root = str(tmp_path / "gold")
    published.publish(spark, root, {"a": spark.range(5), "b": spark.range(3).withColumnRenamed("id", "n")})
    bad = spark.range(0, 40, 1, 4).select(F.when(F.col("id") < 39, F.col("id")).otherwise(F.raise_error(F.lit("killed"))).alias("n"))
    with pytest.raises(Exception, match="killed"):
        published.publish(spark, root, {"a": spark.range(9), "b": bad})
    assert (spark.table("a").count(), spark.table("b").count()) == (5, 3)
    again = published.register_published(spark, root)
    assert (again["a"].count(), again["b"].count()) == (5, 3)
    assert len(published.expire(spark, root)) == 2  # what the killed run left
    published.publish(spark, root, {"b": spark.range(7).withColumnRenamed("id", "n")}, append=True)
    published.publish(spark, root, {"a": spark.range(0)})
    assert (spark.table("a").count(), spark.table("b").count()) == (0, 10)
    gone = published.expire(spark, root, keep=1)
    assert [g.split("/")[0] for g in gone] == ["a"]
    now = published.register_published(spark, root)
    assert (now["a"].count(), now["b"].count(), now["b"].columns) == (0, 10, ["n"])


def test_dedup_within_a_watermark_sets_late_rows_aside(spark, tmp_path):
    staged, base = str(tmp_path / "staged"), str(tmp_path / "out")
    schema = spark.createDataFrame([], "k string, ts timestamp, n int").schema
    runs = [
        [("a", "2024-01-10 00:00:00", 1), ("a", "2024-01-10 06:00:00", 2), ("b", "2024-01-09 12:00:00", 3), (None, "2024-01-10 00:00:00", 4)],
        [("b", "2024-01-10 01:00:00", 5), (None, "2024-01-10 02:00:00", 6), ("c", "2024-01-20 00:00:00", 7)],
        # older than the watermark: a copy of what was kept, a key never kept (twice), one without a time
        [("c", "2024-01-20 03:00:00", 8), ("a", "2024-01-10 12:00:00", 9), ("d", "2024-01-11 00:00:00", 10),
         ("d", "2024-01-11 01:00:00", 11), ("a", "2024-01-21 00:00:00", 12)],
        []]
    for rows in runs:
        if rows:
            spark.createDataFrame([(k, ts, n) for k, ts, n in rows], "k string, ts string, n int").select(
                "k", F.to_timestamp("ts").alias("ts"), "n").coalesce(1).write.mode("append").parquet(staged)
        dedup.dedup_within_watermark(spark, staged, base, schema, "k", "ts", "2 days")
    kept = [(r.k, r.ts.day) for r in spark.read.parquet(f"{base}/kept").collect()]
    assert sorted(kept, key=repr) == sorted([("a", 10), ("a", 21), ("b", 9), ("c", 20), (None, 10)], key=repr)
    assert sorted(r.n for r in dedup.late_rows(spark, base, schema).collect()) == [10, 11]
    assert dedup.late_rows(spark, str(tmp_path / "none"), schema).count() == 0


# ---------------------------------------------------------------- provenance


def test_file_hashes(spark, tmp_path):
    (tmp_path / "f").mkdir()
    bodies = {"a.bin": b"process_id,val\n1,2\n3,4\n", "b.bin": bytes(range(256)) * 5000}
    for name, body in bodies.items():
        (tmp_path / "f" / name).write_bytes(body)
    got = {r.file_path[-5:]: (r.file_hash_sha256, r.file_size_bytes)
           for r in manifest.file_sha256(spark, str(tmp_path / "f")).collect()}
    want = {n: (hashlib.sha256(b).hexdigest(), len(b)) for n, b in bodies.items()}
    assert got == want
    # files above the size of a cell are streamed: same hashes, and their content is in no cell
    streamed = manifest.file_sha256(spark, str(tmp_path / "f"), cell=100, block=1000)
    assert {r.file_path[-5:]: (r.file_hash_sha256, r.file_size_bytes) for r in streamed.collect()} == want
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "1000000")
    try:
        with pytest.raises(Exception, match="(?i)length|size"):
            manifest.file_sha256(spark, str(tmp_path / "f"), cell=2_000_000).collect()
        bounded = manifest.file_sha256(spark, str(tmp_path / "f"), cell=1_000_000).collect()
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    assert {r.file_path[-5:]: (r.file_hash_sha256, r.file_size_bytes) for r in bounded} == want


def test_small_files_need_no_tasks_for_large_ones(spark, tmp_path):
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "a.csv").write_text("a")
    plan = lambda df: df._jdf.queryExecution().toString()
    assert "MapInArrow" not in plan(manifest.file_sha256(spark, str(tmp_path / "f")))
    assert "MapInArrow" in plan(manifest.file_sha256(spark, str(tmp_path / "f"), cell=0))


def test_manifest_skips_bad_lines(spark, tmp_path):
    good = {"dataset_name": "processos", "file_path": "/x", "row_count": 3, "extra": {"mode": "sample"}}
    (tmp_path / "m.jsonl").write_text("\n".join([json.dumps(good), "", "{broken", json.dumps({**good, "dataset_name": "o"})]))
    assert [r.dataset_name for r in manifest.scan_manifest_jsonl(spark, str(tmp_path / "m.jsonl")).collect()] == ["processos", "o"]
    assert manifest.scan_manifest_jsonl(spark, str(tmp_path / "m.jsonl"), "o").first().extra == {"mode": "sample"}


def test_lineage_without_manifest_and_unknown_entity(spark):
    entities = provenance.entity_datasets(spark, spark.createDataFrame([("Fact_Processes".lower(),), ("nope",)], "entity string"))
    counts = spark.createDataFrame([("processos", 5)], "table_name string, n_rows bigint")
    curated = spark.createDataFrame([("fact_processes", 4)], "table_name string, n_rows bigint")
    empty = spark.createDataFrame([], manifest.MANIFEST_SCHEMA)
    got = provenance.lineage_trace(entities, empty, counts, curated, None).collect()
    assert [(r.entity, r.layer, r.row_count) for r in got] == [
        ("fact_processes", "SOURCE", None), ("fact_processes", "SILVER_CLEAN", 5), ("fact_processes", "GOLD_ANALYTICAL", 4),
        ("nope", "ERROR", None)]
    assert {r.validation_status for r in got} == {"UNKNOWN"}


# ---------------------------------------------------------------- exports and listings


@pytest.fixture
def small(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, "HC", 1.5, True), ("b", 2, "RE", None, False), ("c", 3, None, 2.0, True)],
                               "process_id string, numero_processo bigint, classe_sigla string, valor double, is_active boolean")
    return spark.read.parquet(sinks.write_parquet_zstd(df.coalesce(1), str(tmp_path / "t")))


def test_export_of_all_tables(spark, small, tmp_path):
    row = exports.append_summary(small).first()
    assert (row.operation, row.total_records, row.total_data_files) == ("append", 3, 1) and row.total_files_size > 0
    # without the connectors nothing is called by a format that it is not
    made = exports.export_all(spark, {"t": small}, str(tmp_path / "x"), "both").collect()
    assert [(r.format, r.total_records) for r in made] == [("parquet", 3)]
    with pytest.raises(ValueError):
        exports.export_all(spark, {"t": small}, str(tmp_path / "x"), "hudi")


def test_exports(spark, small, tmp_path):
    small.createOrReplaceTempView("fact_processes")
    path = sinks.export_dataset(spark, "Processes", "jsonl", str(tmp_path / "j"))
    assert '"valor":null' in "".join(r.value for r in spark.read.text(path).collect())
    path = sinks.export_dataset(spark, "processes", "csv", str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(path).columns == small.columns
    with pytest.raises(ValueError, match="invalid dataset"):
        sinks.export_dataset(spark, "judges", "csv", str(tmp_path / "n"))
    with pytest.raises(ValueError, match="invalid format"):
        sinks.export_dataset(spark, "processes", "xml", str(tmp_path / "n"))


def test_ad_hoc_sql(spark, small):
    small.createOrReplaceTempView("t_small")
    good = listings.ad_hoc_sql(spark, "WITH x AS (SELECT * FROM t_small) SELECT process_id FROM x WHERE valor > :v ORDER BY 1;", {"v": 1.6})
    assert good.error is None and good.columns == ["process_id"] and [r[0] for r in good.rows.collect()] == ["c"]
    assert listings.ad_hoc_sql(spark, "SHOW TABLES").error is None
    assert listings.ad_hoc_sql(spark, "  ").error
    for text in ("DROP VIEW t_small", "WITH x AS (SELECT 1) INSERT INTO t_small SELECT * FROM x", "SELECT nope FROM t_small",
                 "SELECT 1; DROP VIEW t_small"):
        assert listings.ad_hoc_sql(spark, text).error
    assert spark.catalog.tableExists("t_small")


def test_listing_filters(spark, lake):
    raw, out = lake
    done = medallion.medallion_run(spark, str(raw), str(out))
    cases = done.gold["fact_processes"]
    got = listings.list_processes(cases, limit=2, offset=1, relator="min. _", uf="sp").collect()
    assert [(r.process_id, r.data_distribuicao) for r in got] == [("P-5", "2022-01-02"), ("P-1", "2021-01-02")]
    assert listings.filter_processes(cases, year=0, classe="").count() == 6
    assert listings.filter_processes(cases, relator="a\\").count() == 0
    assert listings.list_decisions(done.gold["fact_decisions"], limit=500, categoria="monocratica").count() == 8
    with pytest.raises(ValueError):
        listings.list_processes(cases, limit=501)


@pytest.mark.parametrize("max_files", [1, 1000])
@pytest.mark.parametrize("first,second", [("a b.csv", "b%.csv"), ("b%.csv", "a b.csv")])
def test_batch_size_does_not_change_the_kept_row(spark, tmp_path, max_files, first, second):
    landing, base = tmp_path / "landing", str(tmp_path / "lake")
    _write(landing / first, [_case(1, relator="Min. A")])
    _write(landing / second, [_case(1, relator="Min. B"), _case(2, relator="Min. B", assunto="x\ny")])
    os.utime(landing / first, (1_000, 1_000))
    os.utime(landing / second, (2_000, 2_000))
    ingest.incremental_ingest(spark, str(landing), base, FEED, max_files=max_files)
    kept = {r.process_id: r.relator for r in ingest.silver_table(spark, base, "processos").collect()}
    assert kept == {"P-1": "Min. A", "P-2": "Min. B"}
    log = spark.read.schema(manifest.MANIFEST_SCHEMA).json(f"{base}/manifest/processos")
    assert {r.original_filename: r.row_count for r in log.collect()} == {first: 1, second: 2}


def test_only_an_absent_folder_reads_as_no_table(spark, tmp_path):
    assert ingest.silver_table(spark, str(tmp_path), "processos") is None
    for i, kind in enumerate(("struct<a:int>", "int")):
        spark.range(1).select(F.lit(None).cast(kind).alias("c")).write.parquet(f"{tmp_path}/silver/processos/batch_id={i}")
    with pytest.raises(Exception, match="(?i)merg|schema"):
        ingest.silver_table(spark, str(tmp_path), "processos")


def test_raw_tables_of_one_source_are_sorted_once_before_they_are_text(spark, tmp_path):
    from cartorio.bindings import cleaning as raw_tables
    from cartorio.bindings import files

    rng = random.Random(3)
    lines = [(rng.randint(1, 40), rng.randint(1, 3), rng.randint(1, 99), rng.randint(1, 9), rng.uniform(1, 2),
              date(2020, 1, rng.randint(1, 28)), "N", "O") for _ in range(300)]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double, "
                          "l_shipdate date, l_returnflag string, l_linestatus string").write.parquet(f"{tmp_path}/lineitem.parquet")
    names = ["decisions", "remuneration", "budget"]
    with files._sorted_rows(spark, str(tmp_path), names) as rows:
        assert rows["decisions"] is rows["remuneration"] is rows["budget"]
        for name in names:
            raw = raw_tables.RAW[name]
            path = files._write_csv(raw.frame(spark, str(tmp_path), rows[name]), f"{tmp_path}/raw/{name}")
            key = next(iter(raw.columns))
            want = [r[0] for r in raw.frame(spark, str(tmp_path)).orderBy("_seq").select(key).collect()]
            alone = files.land_raw(spark, str(tmp_path), name, f"{tmp_path}/alone/{name}")
            for at in (path, alone):
                assert [r[0] for r in bronze.scan_csv_bronze(spark, at).orderBy("_seq").select(key).collect()] == want
