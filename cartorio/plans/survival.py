"""Kaplan-Meier backlog survival: overall and by stratum, in one plan.

Case rows are only joined and counted; all windows run over life tables, which hold one row per
stratum and distinct duration, and they share one partitioning and one sort order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartorio.functions import fixed
from cartorio.operators.joins import with_event_date

GLOBAL, CLASS, JUDGE = "global", "class", "judge"
_STRATUM = ["stratum_kind", "stratum"]


def survival_dataset(processes: DataFrame, decisions: DataFrame, reference_date: str = fixed.CENSOR_DATE) -> DataFrame:
    """Per case: event flag and duration in days, at least 1; cases without a start date drop out.

    A resolved case ends at its first decision (or, lacking one, at once); any other case is
    censored at the reference date.
    """
    started = processes.where("data_distribuicao is not null").select(
        "process_id", "classe_sigla", "relator", "situacao", "data_distribuicao")
    cases = with_event_date(started, decisions)
    resolved = F.coalesce(F.upper("situacao").isin(fixed.ARCHIVED, fixed.JUDGED), F.lit(False))
    end = F.when(resolved, F.col("data_evento")).otherwise(F.lit(reference_date).cast("date"))
    return cases.select(
        "process_id", "classe_sigla", "relator", "situacao",
        F.greatest(F.lit(1), F.datediff(end, "data_distribuicao")).alias("duration"),
        resolved.cast("int").alias("event"),
    )


def life_counts(cases: DataFrame, **strata: str) -> DataFrame:
    """Events and censored cases per stratum and duration, for all stratum kinds at once.

    ``strata`` maps a stratum kind to its column; the overall stratum is always there. Cases are
    counted once by all stratum columns together, and only these counts fan out to the kinds.
    """
    columns = list(dict.fromkeys(strata.values()))
    counts = cases.groupBy(*columns, "duration").agg(
        F.sum("event").alias("d"), F.sum(1 - F.col("event")).alias("c"))
    kinds = [F.struct(F.lit(GLOBAL).alias("stratum_kind"), F.lit("").alias("stratum"))] + [
        F.struct(F.lit(kind).alias("stratum_kind"), F.col(column).cast("string").alias("stratum"))
        for kind, column in strata.items()
    ]
    return (
        counts.select(F.explode(F.array(*kinds)).alias("s"), "duration", "d", "c")
        .groupBy("s.stratum_kind", "s.stratum", "duration")
        .agg(F.sum("d").alias("d"), F.sum("c").alias("c"))
    )


def _rows(first: int, last: int) -> Window:
    return Window.partitionBy(*_STRATUM).orderBy("duration").rowsBetween(first, last)


_WHOLE = (Window.unboundedPreceding, Window.unboundedFollowing)


def life_table(counts: DataFrame) -> DataFrame:
    """Adds ``at_risk``, the cases whose duration is at least the row's: all less those before."""
    n = F.col("d") + F.col("c")
    before = F.sum(n).over(_rows(Window.unboundedPreceding, -1))
    return counts.withColumn("at_risk", F.sum(n).over(_rows(*_WHOLE)) - F.coalesce(before, F.lit(0)))


def survival_steps(table: DataFrame) -> DataFrame:
    """Adds the unrounded survival probability ``s`` after each duration.

    A duration without events has the factor 1, so it repeats the probability before it.
    """
    return table.withColumn("s", F.product(1 - F.col("d") / F.col("at_risk")).over(
        _rows(Window.unboundedPreceding, Window.currentRow)))


def _median() -> Column:
    """First event time at which the unrounded probability is at most one half."""
    return F.min(F.when((F.col("d") > 0) & (F.col("s") <= 0.5), F.col("duration")))


def _rounded() -> Column:
    # ties to even, as the published curves are rounded
    return F.bround("s", 4)


def km_points(counts: DataFrame, milestones: list[int] | None = None) -> DataFrame:
    """Curve points, each with its stratum's cases, events, censored cases, median and asked milestones ``m<days>``.

    The curve starts at (0, 1.0) and steps at each event time. A stratum without events has two
    points, the other being (longest duration, 1.0).
    """
    whole = _rows(*_WHOLE)
    steps = survival_steps(life_table(counts)).withColumns({
        "total_cases": F.sum(F.col("d") + F.col("c")).over(whole),
        "events_count": F.sum("d").over(whole),
        "censored_count": F.sum("c").over(whole),
        "median_days": _median().over(whole),
        **{f"m{m}": F.coalesce(_last_step(m).over(whole), F.lit(1.0)) for m in milestones or []},
        "_first": F.row_number().over(Window.partitionBy(*_STRATUM).orderBy("duration")) == 1,
        "_last": F.max("duration").over(whole) == F.col("duration"),
    })

    def point(t: Column, survival: Column) -> Column:
        return F.struct(t.alias("t"), survival.alias("survival"))

    points = F.array_compact(F.array(
        F.when(F.col("_first"), point(F.lit(0), F.lit(1.0))),
        F.when(F.col("d") > 0, point(F.col("duration"), _rounded())),
        F.when(F.col("_last") & (F.col("events_count") == 0), point(F.col("duration"), F.lit(1.0))),
    ))
    stats = ["total_cases", "events_count", "censored_count", "median_days", *[f"m{m}" for m in milestones or []]]
    return steps.select(*_STRATUM, *stats, F.inline(points)).select(*_STRATUM, "t", "survival", *stats)


def km_curve(counts: DataFrame) -> DataFrame:
    """Step curve of each stratum, probabilities to four places."""
    return km_points(counts).select(*_STRATUM, "t", "survival")


def _last_step(m: int) -> Column:
    """Rounded probability of the last event step up to ``m`` days, NULL before the first; the curve only falls."""
    return F.min(F.when((F.col("d") > 0) & (F.col("duration") <= m), _rounded()))


def _milestone(m: int) -> Column:
    return F.coalesce(_last_step(m), F.lit(1.0)).alias(f"m{m}")


def stratum_stats(counts: DataFrame, milestones: list[int] = fixed.MILESTONE_DAYS) -> DataFrame:
    """One row per stratum: counts, median and a column ``m<days>`` per milestone."""
    return survival_steps(life_table(counts)).groupBy(*_STRATUM).agg(
        F.sum(F.col("d") + F.col("c")).alias("total_cases"),
        F.sum("d").alias("events_count"),
        F.sum("c").alias("censored_count"),
        _median().alias("median_days"),
        *[_milestone(m) for m in milestones],
    )


def km_median(counts: DataFrame) -> DataFrame:
    """Median duration, NULL where the probability never falls to one half."""
    return stratum_stats(counts, []).select(*_STRATUM, "median_days")


def km_milestones(counts: DataFrame, milestones: list[int] = fixed.MILESTONE_DAYS) -> DataFrame:
    """Rounded probability at each milestone, one row each."""
    pairs = ", ".join(f"{m}, m{m}" for m in milestones)
    return stratum_stats(counts, milestones).select(
        *_STRATUM, F.expr(f"stack({len(milestones)}, {pairs}) as (milestone_days, survival)"))


def km_counts(counts: DataFrame) -> DataFrame:
    """Cases, events and censored cases per stratum."""
    return counts.groupBy(*_STRATUM).agg(
        F.sum(F.col("d") + F.col("c")).alias("total_cases"),
        F.sum("d").alias("events_count"),
        F.sum("c").alias("censored_count"),
    )


def km_subsample(curve: DataFrame, max_points: int | Column) -> DataFrame:
    """At most about ``max_points`` points per stratum: every n-th from the first, and the last."""
    limit = F.lit(max_points) if isinstance(max_points, int) else max_points
    ordered = Window.partitionBy(*_STRATUM).orderBy("t")
    numbered = curve.withColumns({
        "_i": F.row_number().over(ordered) - 1,
        "_n": F.count("*").over(ordered.rowsBetween(*_WHOLE)),
    })
    step = F.when(F.col("_n") > limit, F.floor(F.col("_n") / limit)).otherwise(F.lit(1))
    return numbered.where((F.col("_i") % step == 0) | (F.col("_i") == F.col("_n") - 1)).drop("_i", "_n")


def largest_strata(counts: DataFrame, sizes: dict[str, int], skip_blank: str | None = None) -> DataFrame:
    """Life counts of the largest strata: ``sizes`` gives how many of each kind.

    Blank names of the kind ``skip_blank`` go only after the limit. The list of kept strata has at
    most the sum of ``sizes`` rows, so it is broadcast.
    """
    totals = counts.groupBy(*_STRATUM).agg(F.sum(F.col("d") + F.col("c")).alias("_cases"))
    rank = F.row_number().over(Window.partitionBy("stratum_kind").orderBy(F.desc("_cases"), "stratum"))
    wanted = F.create_map(*[F.lit(x) for kv in sizes.items() for x in kv])
    top = totals.withColumn("_rank", rank).where(
        (F.col("_rank") <= max(sizes.values())) & (F.col("_rank") <= F.try_element_at(wanted, F.col("stratum_kind"))))
    if skip_blank is not None:
        top = top.where((F.col("stratum_kind") != skip_blank) | (F.coalesce("stratum", F.lit("")) != ""))
    top = F.broadcast(top.select(F.col("stratum_kind").alias("_kind"), F.col("stratum").alias("_name")))
    same = (F.col("stratum_kind") == F.col("_kind")) & F.col("stratum").eqNullSafe(F.col("_name"))
    return counts.join(top, same, "left_semi")


def km_summary(counts: DataFrame, milestones: list[int] = fixed.MILESTONE_DAYS) -> DataFrame:
    """One row per stratum: counts, median and a map of milestone probabilities."""
    pairs = [x for m in milestones for x in (F.lit(f"{m}_days"), F.col(f"m{m}"))]
    return stratum_stats(counts, milestones).withColumn("milestone_survival", F.create_map(*pairs)).drop(
        *[f"m{m}" for m in milestones])


def km_by_class(cases: DataFrame, k: int = 5) -> DataFrame:
    """Summary of the largest classes."""
    return km_summary(largest_strata(life_counts(cases, **{CLASS: "classe_sigla"}), {CLASS: k}))


def _short_name() -> Column:
    """Judges without their title; other strata as they are."""
    short = F.replace(F.col("stratum"), F.lit("Min. "), F.lit(""))
    return F.when(F.col("stratum_kind") == JUDGE, short).otherwise(F.col("stratum"))


def km_by_judge(cases: DataFrame, k: int = 11) -> DataFrame:
    """Median, cases and one-year retention of the largest caseloads, judges by short name."""
    top = largest_strata(life_counts(cases, **{JUDGE: "relator"}), {JUDGE: k}, skip_blank=JUDGE)
    return stratum_stats(top, [365]).select(
        _short_name().alias("judge"), "median_days", "total_cases",
        F.round(F.col("m365") * 100, 1).alias("one_year_retention_pct"))


def survival_overview(cases: DataFrame, classes: int = 5, judges: int = 11) -> DataFrame:
    """Curve points of the whole backlog, the largest classes and the largest caseloads.

    Each point carries its stratum's counts and median, the milestones of the whole and of the classes
    (``m<days>``) and the one-year retention of the judges in percent; curves are thinned to 40, 20 and 15
    points as the published overview does.
    """
    counts = life_counts(cases, **{CLASS: "classe_sigla", JUDGE: "relator"})
    kept = largest_strata(counts, {GLOBAL: 1, CLASS: classes, JUDGE: judges}, skip_blank=JUDGE)
    points = F.when(F.col("stratum_kind") == GLOBAL, 40).when(F.col("stratum_kind") == CLASS, 20).otherwise(15)
    of_judge = F.col("stratum_kind") == JUDGE
    retention = F.when(of_judge, F.round(F.col("m365") * 100, 1))
    return km_subsample(km_points(kept, fixed.MILESTONE_DAYS), points).withColumns({
        "stratum": _short_name(), "one_year_retention_pct": retention,
        **{f"m{m}": F.when(~of_judge, F.col(f"m{m}")) for m in fixed.MILESTONE_DAYS}})
