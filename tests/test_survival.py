from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from cartorio.plans import survival as km


def _counts(spark, pairs, strata=None):
    data = [(t, e, (strata or ["x"] * len(pairs))[i]) for i, (t, e) in enumerate(pairs)]
    return km.life_counts(spark.createDataFrame(data, "duration int, event int, g string"), grp="g")


def _brute(pairs):
    """Kaplan-Meier by hand: points, median, probability at a day."""
    points, s, median = [(0, 1.0)], 1.0, None
    for t in sorted({t for t, _ in pairs}):
        d = sum(1 for x, e in pairs if x == t and e)
        if d:
            s *= 1 - d / sum(1 for x, _ in pairs if x >= t)
            points.append((t, round(s, 4)))
            median = t if median is None and s <= 0.5 else median
    if len(points) == 1 and pairs:
        points.append((max(t for t, _ in pairs), 1.0))
    return points, median


def test_golden(spark):
    counts = _counts(spark, [(10, 1), (20, 0), (30, 1)])
    glob = counts.where("stratum_kind = 'global'")
    assert [(r.t, r.survival) for r in km.km_curve(glob).orderBy("t").collect()] == [(0, 1.0), (10, 0.6667), (30, 0.0)]
    row = km.km_summary(glob).first()
    assert (row.total_cases, row.events_count, row.censored_count, row.median_days) == (3, 2, 1, 30)
    assert row.milestone_survival["30_days"] == 0.0 and row.milestone_survival["365_days"] == 0.0


def test_all_censored_and_empty(spark):
    counts = _counts(spark, [(50, 0), (100, 0), (150, 0)]).where("stratum_kind = 'global'")
    assert [(r.t, r.survival) for r in km.km_curve(counts).orderBy("t").collect()] == [(0, 1.0), (150, 1.0)]
    row = km.km_summary(counts).first()
    assert row.median_days is None and set(row.milestone_survival.values()) == {1.0}
    empty = _counts(spark, [])
    assert km.km_curve(empty).count() == 0 and km.km_summary(empty).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed):
    rnd = random.Random(seed)
    pairs = [(rnd.randint(1, 60), int(rnd.random() < 0.6)) for _ in range(400)]
    names = [rnd.choice(["a", "b", None]) for _ in pairs]
    counts = _counts(spark, pairs, names)
    curve, medians = km.km_curve(counts).collect(), km.km_median(counts).collect()
    for kind, name in [("global", ""), ("grp", "a"), ("grp", None)]:
        mine = pairs if kind == "global" else [p for p, n in zip(pairs, names) if n == name]
        points, median = _brute(mine)
        got = sorted((r.t, r.survival) for r in curve if (r.stratum_kind, r.stratum) == (kind, name))
        assert [t for t, _ in got] == [t for t, _ in points]
        assert all(abs(a - b) < 1.1e-4 for (_, a), (_, b) in zip(got, points))
        assert [r.median_days for r in medians if (r.stratum_kind, r.stratum) == (kind, name)] == [median]


@pytest.mark.parametrize("n,limit", [(5, 10), (41, 40), (100, 40), (101, 15)])
def test_subsample(spark, n, limit):
    curve = spark.range(n).select(F.lit("g").alias("stratum_kind"), F.lit("").alias("stratum"),
                                  F.col("id").cast("int").alias("t"), F.lit(0.5).alias("survival"))
    want = list(range(n))
    if n > limit:
        want = want[::n // limit]
        if n - 1 not in want:
            want.append(n - 1)
    assert sorted(r.t for r in km.km_subsample(curve, limit).collect()) == want


def test_dataset_rules(spark):
    cases = spark.createDataFrame(
        [("a", "BAIXADO", "2020-01-10"), ("b", "julgado", "2020-01-10"), ("c", "EM TRAMITAÇÃO", "2020-01-10"),
         ("d", None, "2020-01-10"), ("e", "BAIXADO", None)], "process_id string, situacao string, day string",
    ).withColumns({"data_distribuicao": F.col("day").cast("date"), "classe_sigla": F.lit("X"), "relator": F.lit("J")})
    rulings = spark.createDataFrame(
        [("a", "2020-03-10"), ("a", "2020-02-10"), ("c", "2020-01-11"), (None, "2020-01-01")],
        "process_id string, day string").withColumn("data_decisao", F.col("day").cast("date"))
    got = {r.process_id: (r.duration, r.event) for r in km.survival_dataset(cases, rulings, "2020-12-31").collect()}
    # no decision: ends at once, clamped to a day; open or unknown status: censored; no start: dropped
    assert got == {"a": (31, 1), "b": (1, 1), "c": (356, 0), "d": (356, 0)}


def test_judges_skip_blank_after_the_limit(spark):
    rows = [("Min. A", 5), ("", 4), ("Min. B", 3), ("Min. C", 2)]
    cases = spark.createDataFrame([(n, 10 + i, 1) for n, k in rows for i in range(k)], "relator string, duration int, event int")
    got = {r.judge: r.total_cases for r in km.km_by_judge(cases, 3).collect()}
    assert got == {"A": 5, "B": 3}
