from __future__ import annotations

import os
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from cartorio.functions import cells
from cartorio.operators.cleaning import canonical_column_names, dedup_keep_first
from cartorio.plans import silver
from cartorio.plans.provenance import record_counts
from cartorio.sources.bronze import profile_csv_files, scan_csv_bronze, scan_csv_files, scan_csv_split

HEADER = ",".join(silver.PROCESSES)


def _csv(tmp_path, *lines, header=HEADER, name="a.csv"):
    folder = tmp_path / "raw"
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([header, *lines]) + "\n", encoding="utf-8")
    return str(folder)


def _line(pid, day="2020-01-02", number="1", status=" baixado ", text="Tema"):
    return f'{pid},{number},rcl,Reclamação,"{text}",Min. A,2020-01-01,{day},sp,Plenário,{status}'


def test_cells(spark):
    df = spark.createDataFrame(
        [("",), ("NA",), (" NA ",), (" x\t",), ("12",), (" 7",), ("12.5",), ("1e3",), ("-2.5",),
         ("2024-02-29",), ("2024-2-9",), ("2023-02-29",), (None,)], "c string")
    got = {r.c: r for r in df.select(
        "c", cells.null_tokens(F.col("c")).alias("n"), cells.trim_text(F.col("c")).alias("t"),
        cells.safe_int(F.col("c")).alias("i"), cells.safe_money(F.col("c")).alias("m"),
        cells.safe_date(F.col("c")).alias("d")).collect()}
    assert got[""].n is None and got["NA"].n is None and got[" NA "].n == " NA "
    assert got[" NA "].t == "NA" and got[" x\t"].t == "x"
    assert got["12"].i == 12 and got[" 7"].i is None and got["12.5"].i is None
    assert got["1e3"].m == 1000.0 and got["-2.5"].m == -2.5 and got[" 7"].m == 0.0 and got[None].m == 0.0
    assert got["2024-02-29"].d == date(2024, 2, 29)
    assert got["2024-2-9"].d is None and got["2023-02-29"].d is None


def test_cells_at_their_limits(spark):
    """Numbers and dates that no cast could read are told by their shape; all others are read as before."""
    numbers = ["9223372036854775807", "9223372036854775808", "-9223372036854775808", "-9223372036854775809",
               "+" + "0" * 30 + "7", "0" * 40, "9" * 19, "9" * 20, "1" + "0" * 19, "-", "", None]
    days = [f"{y:04d}-{m:02d}-{d:02d}" for y in (1900, 2000, 2023, 2024) for m in range(14) for d in range(33)]
    c = F.col("c")
    got = {r.c: (r.i, r.d) for r in spark.createDataFrame([(x,) for x in numbers + days], "c string").select(
        "c", cells.safe_int(c).alias("i"), cells.safe_date(c).alias("d")).collect()}
    for x in numbers:
        n = int(x) if x and x != "-" else None
        assert got[x][0] == (n if n is not None and -2 ** 63 <= n < 2 ** 63 else None)
    for x in days:
        try:
            assert got[x][1] == date.fromisoformat(x)
        except ValueError:
            assert got[x][1] is None
    # shapes that never fit are not tried: a cast that fails costs an exception
    tried = spark.createDataFrame([("9" * 20,), ("2023-04-31",), ("2023-02-30",)], "c string").where(
        c.rlike(cells._WHOLE) | c.rlike(cells._DATE))
    assert tried.isEmpty()


def test_processes_from_dirty_csv(spark, tmp_path):
    path = _csv(
        tmp_path,
        _line("Rcl-1", day="31/12/2020"),      # first duplicate with a bad date hides the good one
        _line("Rcl-1"),
        _line(" HC-2 ", text="linha um\nlinha ""dois"" | x"),
        _line("NA"), _line(""),                 # null keys are one group, then dropped
        _line("AP-3", number="abc", status="julgado"),
        "AP-4,5",                               # short row: date missing
    )
    raw = scan_csv_bronze(spark, path)
    out = {r.process_id: r for r in silver.clean_processes(raw).collect()}
    assert set(out) == {"HC-2", "AP-3"}
    assert out["HC-2"].classe_sigla == "RCL" and out["HC-2"].situacao == "BAIXADO" and out["HC-2"].uf_origem == "SP"
    assert "linha um\nlinha" in out["HC-2"].assunto
    assert out["AP-3"].numero_processo is None
    assert (out["HC-2"].ano_distribuicao, out["HC-2"].mes_distribuicao) == (2020, 1)


def test_spanning_files_are_found(spark, tmp_path):
    path = _csv(tmp_path, _line("A-1", text="um\ndois"))
    _csv(tmp_path, _line("A-2"), name="b.csv")
    spans = {r.file_path[-5:]: r.spans_lines for r in profile_csv_files(spark, path).collect()}
    assert spans == {"a.csv": True, "b.csv": False}
    assert scan_csv_bronze(spark, path).count() == 2


@pytest.mark.parametrize("first,second", [("a.csv", "b.csv"), ("b.csv", "a.csv")])
def test_first_in_order_of_arrival_over_files(spark, tmp_path, first, second):
    path = _csv(tmp_path, _line("A-1", number="1"), name=first)
    _csv(tmp_path, _line("A-1", number="2"), name=second)
    os.utime(f"{path}/{first}", (1_000, 1_000))
    os.utime(f"{path}/{second}", (2_000, 2_000))
    assert [r.numero_processo for r in silver.clean_processes(scan_csv_bronze(spark, path)).collect()] == [1]


def test_path_breaks_ties_of_arrival(spark, tmp_path):
    path = _csv(tmp_path, _line("A-1", number="2"), name="b.csv")
    _csv(tmp_path, _line("A-1", number="1"), name="a.csv")
    for name in ("a.csv", "b.csv"):
        os.utime(f"{path}/{name}", (1_000, 1_000))
    assert [r.numero_processo for r in silver.clean_processes(scan_csv_bronze(spark, path)).collect()] == [1]


@pytest.mark.parametrize("name", ["a b.csv", "decisões.csv", "a%20b.csv", "a+b.csv"])
@pytest.mark.parametrize("text", ["um", "um\ndois"])
def test_odd_file_names(spark, tmp_path, name, text):
    path = _csv(tmp_path, _line("A-1", text=text), name=name)
    _csv(tmp_path, _line("A-2"), name="plain.csv")
    cells_read = scan_csv_bronze(spark, path)
    assert cells_read.count() == 2
    assert {r.file_path.split("/")[-1] for r in record_counts(cells_read).collect()} == {name, "plain.csv"}


def test_header_must_agree(spark, tmp_path):
    _csv(tmp_path, _line("A-1"), name="a.csv")
    path = _csv(tmp_path, "x,y", header="decisao_id,process_id", name="b.csv")
    with pytest.raises(Exception):
        scan_csv_bronze(spark, path).collect()
    with pytest.raises(ValueError, match="lacks columns"):
        silver.clean_decisions(scan_csv_bronze(spark, path.replace("raw", "raw/a.csv")))


def test_category_of_missing_kind(spark):
    df = spark.createDataFrame([("Decisão Monocrática",), ("Decisão da Presidência",), ("Acórdão",), (None,)], "k string")
    got = [r[0] for r in df.select(cells.decision_category(F.col("k"))).collect()]
    assert got == ["MONOCRATICA", "PRESIDENCIA", "COLEGIADA", "COLEGIADA"]


def test_topics_keep_one_row_without_number(spark):
    raw = spark.createDataFrame(
        [("x", "a", 1), ("y", "b", 2), ("7", "c", 3), ("7", "d", 4)], "tema_numero string, titulo string, _seq int")
    for c in ("data_reconhecimento", "status", "relator", "tese_fixada"):
        raw = raw.withColumn(c, F.lit("v"))
    assert sorted(((r.tema_numero, r.titulo) for r in silver.clean_topics(raw).collect()), key=repr) == [(7, "c"), (None, "a")]


def test_money_jobs(spark):
    pay = spark.createDataFrame([("r1", "100.10", "x", "5", "NA", 1)],
                                "remuneracao_id string, remuneracao_paradigma string, vantagens_pessoais string, "
                                "subsidio string, indenizacoes string, _seq int")
    for c in silver.REMUNERATION:
        if c not in pay.columns:
            pay = pay.withColumn(c, F.lit("1"))
    row = silver.clean_remuneration(pay).first()
    assert row.remuneracao_bruta == 105.1 and row.vantagens_pessoais == 0.0
    bud = spark.createDataFrame([("o1", "0", "5", 1), ("o2", "200", "50", 2)],
                                "orcamento_id string, dotacao_atualizada string, liquidado string, _seq int")
    for c in silver.BUDGET:
        if c not in bud.columns:
            bud = bud.withColumn(c, F.lit("1"))
    rates = {r.orcamento_id: r.taxa_execucao_pct for r in silver.clean_budget(bud).collect()}
    assert rates == {"o1": 0.0, "o2": 25.0}


def test_dedup_of_a_hot_key(spark):
    df = spark.range(0, 30_000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("_seq"), F.col("id").alias("v"))
    out = dedup_keep_first(df, "k")
    assert out.count() == 20_001
    assert out.where("k = -1").first().v == 0


def test_canonical_names(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int").toDF(" Process ID ", "SITUACAO")
    assert canonical_column_names(df).columns == ["process_id", "situacao"]


@pytest.mark.parametrize("ending,piece", [("\n", "400"), ("\r\n", "1500"), ("\r\n", "100000")])
def test_files_with_line_breaks_in_cells_are_split(spark, tmp_path, piece, ending):
    """Same cells, NULLs and order as the whole-file reader, whatever the size of a piece; a broken file is read whole."""
    rng = random.Random(len(ending))
    for f in range(2):
        with open(tmp_path / f"{f}.csv", "w", newline="", encoding="utf-8") as out:
            out.write("A b,c,d" + ending)
            for i in range(150):
                cell = rng.choice(["x", "", '""', '"q ""z"" é"', f'"one\ntwo,{i}\n\nthree"', '"' + f"line {i}\n" * rng.randint(1, 30) + '"', " s "])
                out.write(f"{f}-{i},{cell},{rng.choice(['NA', 'ü', ''])}{ending}" + (ending if i % 40 == 7 else ""))
    with open(tmp_path / "odd.csv", "w", newline="", encoding="utf-8") as out:
        out.write("A b,c,d" + ending + f'7,5" pipe,x{ending}' * 21 + f'8,"a\nb",y{ending}')
    paths, names = [str(tmp_path / n) for n in ("0.csv", "1.csv", "odd.csv")], ["A b", "c", "d"]
    want = scan_csv_files(spark, paths, names, True).orderBy("_seq").drop("_seq").collect()
    spark.conf.set("spark.sql.files.maxPartitionBytes", piece)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        made = scan_csv_split(spark, paths, names)
        got = made.orderBy("_seq").drop("_seq").collect()
        tasks = made.where("a_b like '0-%'").select("_seq.block").distinct().count()
        if piece == "1500":
            assert scan_csv_bronze(spark, str(tmp_path)).count() == len(want)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(want) == 322 and made.columns == ["a_b", "c", "d", "_seq"]
    assert [tuple(r) for r in got] == [tuple(r) for r in want]
    assert tasks > {"400": 5, "1500": 2, "100000": 0}[piece]
    with pytest.raises(ValueError):
        scan_csv_split(spark, paths, ["a b", "d", "c"])


def test_keep_first_moves_each_row_once(spark):
    """The order travels in front of the row, not beside a second copy of it; types without an order still work."""
    df = spark.createDataFrame(
        [("a", 2, 0, "late", {"x": 1}), ("a", 1, 9, "first", {"y": 2}), ("b", 5, 5, None, None), (None, 3, 1, "n", None),
         (None, 3, 0, "m", {})], "k string, s int, u int, v string, w map<string,int>")
    for columns in (["k", "s", "u", "v"], ["v", "u", "k", "s"], ["k", "s", "u", "v", "w"]):
        out = dedup_keep_first(df.select(columns), "k", ["s", "u"])
        assert out.columns == columns
        assert sorted((str(r.k), r.s, r.u, str(r.v)) for r in out.collect()) == [
            ("None", 3, 0, "m"), ("a", 1, 9, "first"), ("b", 5, 5, "None")]
    plan = dedup_keep_first(df.drop("w"), "k", ["s", "u"])._jdf.queryExecution().optimizedPlan().toString()
    assert "min_by" not in plan
    assert dedup_keep_first(df.select("k"), "k", "k").count() == 3


def test_rows_without_a_required_key_are_not_exchanged(spark):
    raw = spark.createDataFrame(
        [("NULL", "2020-01-01", 1), ("7", "bad", 2), ("7", "2020-01-02", 3), (" 8", "2020-01-03", 4)], "process_id string, data_distribuicao string, n int")
    for name in silver.PROCESSES:
        if name not in raw.columns:
            raw = raw.withColumn(name, F.lit("x"))
    raw = raw.withColumn("_seq", F.struct("n")).drop("n")
    out = silver.clean_processes(raw)
    assert [r.process_id for r in out.collect()] == ["8"]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" in plan[plan.index("Aggregate"):]
