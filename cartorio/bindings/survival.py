"""Kaplan-Meier survival over the bound cases, and over sign-up to purchase times of users."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartorio.bindings import frames as b
from cartorio.bindings.frames import with_views
from cartorio.bindings.registry import register
from cartorio.functions import fixed
from cartorio.plans import survival as km

# the test tables end in 2001; a nearer censoring date mixes events and censored cases
REFERENCE = "2002-06-30"


def cases(spark, d, reference_date: str = REFERENCE) -> DataFrame:
    return km.survival_dataset(b.processes(spark, d), b.decisions(spark, d), reference_date)


def _cases_sql(reference_date: str) -> str:
    resolved = f"upper(situacao) IN ('{fixed.ARCHIVED}', '{fixed.JUDGED}')"
    return f"""SELECT process_id, classe_sigla, relator, situacao,
            CAST(greatest(1, date_diff('day', data_distribuicao,
                CASE WHEN {resolved} THEN data_evento ELSE DATE '{reference_date}' END)) AS INTEGER) AS duration,
            CAST({resolved} AS INTEGER) AS event
        FROM (SELECT p.*, COALESCE(day, data_distribuicao) AS data_evento FROM fact_processes p
              LEFT JOIN (SELECT process_id, MIN(data_decisao) AS day FROM fact_decisions GROUP BY process_id) USING (process_id)
              WHERE data_distribuicao IS NOT NULL)"""


FOLLOW_UP = 48  # hours after sign-up


def users(spark, d) -> DataFrame:
    """Hours from a user's first sign-up to the first later purchase, censored after FOLLOW_UP."""
    events = b.table(spark, d, "events").select("event_id", "user_id", "event_type", F.unix_timestamp("ts").alias("at"))
    start = events.where("event_type = 'signup'").groupBy("user_id").agg(F.min("at").alias("start"))
    # a user's purchases of one second are one row before they meet the sign-up
    purchases = events.where("event_type = 'purchase'").select("user_id", "at").distinct()
    bought = purchases.join(start, "user_id").where("at > start").groupBy("user_id").agg(F.min("at").alias("bought"))
    hours = F.floor((F.col("bought") - F.col("start")) / 3600)
    seen = F.coalesce(hours < FOLLOW_UP, F.lit(False))
    return start.join(bought, "user_id", "left").select(
        "user_id", (F.col("user_id") % 5).alias("cohort"),
        F.greatest(F.lit(1), F.when(seen, hours).otherwise(FOLLOW_UP)).cast("int").alias("duration"),
        seen.cast("int").alias("event"))


_USERS_SQL = f"""
    SELECT user_id, user_id % 5 AS cohort,
           CAST(greatest(1, CASE WHEN h < {FOLLOW_UP} THEN h ELSE {FOLLOW_UP} END) AS INTEGER) AS duration,
           CAST(COALESCE(h < {FOLLOW_UP}, false) AS INTEGER) AS event
    FROM (SELECT user_id, (MIN(CASE WHEN event_type = 'purchase' AND sec > start THEN sec END) - any_value(start)) // 3600 AS h
          FROM (SELECT *, MIN(CASE WHEN event_type = 'signup' THEN sec END) OVER (PARTITION BY user_id) AS start
                FROM (SELECT user_id, event_type, CAST(floor(epoch(ts)) AS BIGINT) AS sec FROM events))
          WHERE start IS NOT NULL GROUP BY user_id)"""


def _life_sql(source: str, *strata: tuple[str, str]) -> str:
    """Life table CTEs over ``cases``: counts, life (with at_risk), steps, totals, curve.

    Probabilities are rounded as decimals, ties to even: scaling the double itself would turn
    values just below a tie into ties.
    """
    parts = [("global", "''")] + list(strata)
    union = " UNION ALL ".join(
        f"SELECT '{kind}' AS stratum_kind, CAST({column} AS VARCHAR) AS stratum, duration, event FROM cases"
        for kind, column in parts)
    return f"""cases AS ({source}), fanned AS ({union}),
        counts AS (SELECT stratum_kind, stratum, duration, SUM(event)::BIGINT AS d, SUM(1 - event)::BIGINT AS c
                   FROM fanned GROUP BY 1, 2, 3),
        life AS (SELECT *, CAST(SUM(d + c) OVER (PARTITION BY stratum_kind, stratum ORDER BY duration DESC
                        ROWS UNBOUNDED PRECEDING) AS BIGINT) AS at_risk FROM counts),
        steps AS (SELECT *, list_product(list(1 - d / at_risk) OVER (PARTITION BY stratum_kind, stratum ORDER BY duration
                        ROWS UNBOUNDED PRECEDING)) AS s FROM life WHERE d > 0),
        totals AS (SELECT stratum_kind, stratum, SUM(d + c)::BIGINT AS total_cases, SUM(d)::BIGINT AS events_count,
                          SUM(c)::BIGINT AS censored_count, MAX(duration) AS last_duration FROM counts GROUP BY 1, 2),
        scaled AS (SELECT *, CAST(CAST(s AS VARCHAR) AS DECIMAL(24, 20)) * 10000 AS k FROM steps),
        curve AS (SELECT stratum_kind, stratum, duration AS t, CAST(floor(k) + CASE WHEN k - floor(k) > 0.5
                         OR (k - floor(k) = 0.5 AND CAST(floor(k) AS BIGINT) % 2 = 1) THEN 1 ELSE 0 END AS DOUBLE) / 10000
                         AS survival FROM scaled
                  UNION ALL SELECT stratum_kind, stratum, 0, 1.0 FROM totals
                  UNION ALL SELECT stratum_kind, stratum, last_duration, 1.0 FROM totals WHERE events_count = 0),
        medians AS (SELECT stratum_kind, stratum, MIN(duration) FILTER (WHERE s <= 0.5) AS median_days FROM steps GROUP BY 1, 2),
        milestones AS (SELECT stratum_kind, stratum, m AS milestone_days,
                              COALESCE(arg_max(survival, t) FILTER (WHERE t <= m), 1.0) AS survival
                       FROM curve CROSS JOIN (SELECT unnest({fixed.MILESTONE_DAYS}) AS m) GROUP BY 1, 2, 3)"""


_BOTH = [("class", "classe_sigla"), ("judge", "relator")]


def _sql(body: str, *strata: tuple[str, str], more: str = "") -> str:
    ctes = _life_sql(_cases_sql(REFERENCE), *strata) + (f", {more}" if more else "")
    return with_views(body, "fact_processes", "fact_decisions", more=ctes)


def _same(a: str, c: str) -> str:
    return f"{a}.stratum_kind = {c}.stratum_kind AND {a}.stratum IS NOT DISTINCT FROM {c}.stratum"


def _counts(spark, d) -> DataFrame:
    return km.life_counts(cases(spark, d), **{km.CLASS: "classe_sigla", km.JUDGE: "relator"})


@register("survival_dataset", with_views(
    "SELECT * FROM (" + _cases_sql(fixed.CENSOR_DATE) + ")", "fact_processes", "fact_decisions"))
def _(spark, d):
    return cases(spark, d, fixed.CENSOR_DATE)


@register("life_table", _sql("SELECT * FROM life", *_BOTH))
def _(spark, d):
    return km.life_table(_counts(spark, d))


@register("at_risk_running", """
    SELECT event_type, hour, n, CAST(SUM(n) OVER (PARTITION BY event_type ORDER BY hour DESC ROWS UNBOUNDED PRECEDING) AS BIGINT)
           AS at_risk
    FROM (SELECT event_type, CAST(hour(ts) AS INTEGER) AS hour, COUNT(*) AS n FROM events GROUP BY 1, 2)""")
def _(spark, d):
    hours = b.table(spark, d, "events").groupBy("event_type", F.hour("ts").alias("hour")).agg(F.count("*").alias("n"))
    counts = hours.select(F.lit("type").alias("stratum_kind"), F.col("event_type").alias("stratum"),
                          F.col("hour").alias("duration"), F.lit(0).alias("d"), F.col("n").alias("c"))
    return km.life_table(counts).select(
        F.col("stratum").alias("event_type"), F.col("duration").alias("hour"), F.col("c").alias("n"), "at_risk")


@register("km_running_product", _sql("SELECT stratum_kind, stratum, duration, ROUND(s, 6) AS s FROM steps", *_BOTH))
def _(spark, d):
    return km.survival_steps(km.life_table(_counts(spark, d))).where("d > 0").select(
        "stratum_kind", "stratum", "duration", F.round("s", 6).alias("s"))


@register("km_curve", _sql("SELECT * FROM curve WHERE stratum_kind = 'global'"))
def _(spark, d):
    return km.km_curve(km.life_counts(cases(spark, d)))


@register("km_median", _sql(f"SELECT t.stratum_kind, t.stratum, median_days FROM totals t LEFT JOIN medians d ON {_same('t', 'd')}", *_BOTH))
def _(spark, d):
    return km.km_median(_counts(spark, d))


@register("km_milestones", _sql("SELECT * FROM milestones", *_BOTH))
def _(spark, d):
    return km.km_milestones(_counts(spark, d))


@register("km_counts", _sql("SELECT stratum_kind, stratum, total_cases, events_count, censored_count FROM totals", *_BOTH))
def _(spark, d):
    return km.km_counts(_counts(spark, d))


def _thin(limit: str) -> str:
    return f"""thin AS (SELECT stratum_kind, stratum, t, survival FROM (
        SELECT *, row_number() OVER (PARTITION BY stratum_kind, stratum ORDER BY t) - 1 AS i,
               COUNT(*) OVER (PARTITION BY stratum_kind, stratum) AS n, {limit} AS lim FROM curve)
        WHERE i % (CASE WHEN n > lim THEN n // lim ELSE 1 END) = 0 OR i = n - 1)"""


@register("km_subsample", _sql("SELECT * FROM thin", *_BOTH, more=_thin("40")))
def _(spark, d):
    return km.km_subsample(km.km_curve(_counts(spark, d)), 40)


_TOP = """top AS (SELECT stratum_kind, stratum FROM (SELECT *, row_number() OVER (PARTITION BY stratum_kind
            ORDER BY total_cases DESC, stratum NULLS FIRST) AS rn FROM totals)
        WHERE (stratum_kind = 'global') OR (stratum_kind = 'class' AND rn <= 3)
           OR (stratum_kind = 'judge' AND rn <= 7 AND stratum IS NOT NULL AND stratum <> ''))"""
_IN_TOP = "EXISTS (SELECT 1 FROM top WHERE top.stratum_kind = {0}.stratum_kind AND top.stratum IS NOT DISTINCT FROM {0}.stratum)"



@register("km_by_class", _sql(f"""
    SELECT t.stratum AS classe_sigla, total_cases, events_count, censored_count, median_days,
           {', '.join(f'MAX(survival) FILTER (WHERE milestone_days = {m}) AS s_{m}' for m in fixed.MILESTONE_DAYS)}
    FROM totals t LEFT JOIN medians d ON {_same('t', 'd')} JOIN milestones m ON {_same('t', 'm')}
    WHERE t.stratum_kind = 'class' AND {_IN_TOP.format('t')} GROUP BY ALL""", *_BOTH, more=_TOP))
def _(spark, d):
    summary = km.km_by_class(cases(spark, d), 3)
    return summary.select(
        F.col("stratum").alias("classe_sigla"), "total_cases", "events_count", "censored_count", "median_days",
        *[F.col("milestone_survival")[f"{m}_days"].alias(f"s_{m}") for m in fixed.MILESTONE_DAYS])


@register("km_by_judge", _sql(f"""
    SELECT replace(t.stratum, 'Min. ', '') AS judge, median_days, total_cases, ROUND(m.survival * 100, 1) AS one_year_retention_pct
    FROM totals t LEFT JOIN medians d ON {_same('t', 'd')}
    JOIN milestones m ON {_same('t', 'm')} AND m.milestone_days = 365
    WHERE t.stratum_kind = 'judge' AND {_IN_TOP.format('t')}""", *_BOTH, more=_TOP))
def _(spark, d):
    return km.km_by_judge(cases(spark, d), 7)


_STATUS = [("status", "situacao")]


# active cases are all censored: two points at 1.0, no median
@register("km_edge_cases", _sql(f"""
    SELECT c.stratum, c.t, c.survival, d.median_days, t.events_count FROM curve c
    JOIN totals t ON {_same('c', 't')} LEFT JOIN medians d ON {_same('c', 'd')}
    WHERE c.stratum_kind = 'status'""", *_STATUS))
def _(spark, d):
    counts = km.life_counts(cases(spark, d), status="situacao").where("stratum_kind = 'status'")
    rows = km.km_points(counts)
    return rows.select("stratum", "t", "survival", "median_days", "events_count")


@register("km_edge_milestones", _sql("SELECT stratum, milestone_days, survival FROM milestones WHERE stratum_kind = 'status'", *_STATUS))
def _(spark, d):
    counts = km.life_counts(cases(spark, d), status="situacao").where("stratum_kind = 'status'")
    return km.km_milestones(counts).drop("stratum_kind")


_WIDE = f"""wide AS (SELECT stratum_kind, stratum,
    {', '.join(f'MAX(survival) FILTER (WHERE milestone_days = {m}) AS m{m}' for m in fixed.MILESTONE_DAYS)}
    FROM milestones GROUP BY 1, 2)"""


@register("survival_overview", _sql(f"""
    SELECT c.stratum_kind, CASE WHEN c.stratum_kind = 'judge' THEN replace(c.stratum, 'Min. ', '') ELSE c.stratum END AS stratum,
           c.t, c.survival, total_cases, events_count, censored_count, median_days,
           {', '.join(f"CASE WHEN c.stratum_kind <> 'judge' THEN w.m{m} END AS m{m}" for m in fixed.MILESTONE_DAYS)},
           CASE WHEN c.stratum_kind = 'judge' THEN ROUND(w.m365 * 100, 1) END AS one_year_retention_pct
    FROM thin c JOIN wide w ON {_same('c', 'w')} JOIN totals t ON {_same('c', 't')} LEFT JOIN medians d ON {_same('c', 'd')}
    WHERE {_IN_TOP.format('c')}""", *_BOTH, more=_TOP + ", " + _WIDE + ", " + _thin(
        "(CASE stratum_kind WHEN 'global' THEN 40 WHEN 'class' THEN 20 ELSE 15 END)")))
def _(spark, d):
    return km.survival_overview(cases(spark, d), 3, 7)


_USER_LIFE = _life_sql(_USERS_SQL, ("cohort", "cohort"))


@register("km_curve_events", f"WITH {_USER_LIFE} SELECT * FROM curve")
def _(spark, d):
    return km.km_curve(km.life_counts(users(spark, d), cohort="cohort"))


@register("km_summary_events", f"""WITH {_USER_LIFE} SELECT t.stratum_kind, t.stratum, total_cases, events_count, censored_count,
    median_days FROM totals t LEFT JOIN medians d ON {_same('t', 'd')}""")
def _(spark, d):
    return km.km_summary(km.life_counts(users(spark, d), cohort="cohort")).drop("milestone_survival")
