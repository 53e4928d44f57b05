"""Mixing sources to target weights by iterative proportional fitting; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartorio.llm.common import Scratch, query, table

DIMS = ("source", "lang", "topic")
#: Share of a level is its token count to this power: 1 keeps the mix, 0 makes all levels equal.
TEMPERATURES = {"source": 0.7, "lang": 0.7, "topic": 0.9}
#: Fitting ends when a round scales no level by more than this, and is an error after so many rounds.
TOLERANCE, MOST_ROUNDS = 1e-9, 200
_WORD = r"[^ \t\n\x0B\f\r]+"


def topic_of(text: Column) -> Column:
    """Topic from the form of a whole text: ``table``, ``capitals``, ``prose``; ``none`` without a letter A-Z."""
    return (F.when(F.contains(text, F.lit(" | ")), "table")
            .when(F.regexp_like(text, F.lit("[a-z]")), "prose")
            .when(F.regexp_like(text, F.lit("[A-Z]")), "capitals").otherwise("none"))


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def levels(docs: DataFrame) -> dict[str, Column]:
    """Level of every dimension; NULL and empty values are one level."""
    text = F.coalesce(docs["text"], F.lit(""))
    return {"source": F.coalesce(docs["source"].cast("string"), F.lit("")),
            "lang": F.coalesce(docs["lang"].cast("string"), F.lit("")), "topic": topic_of(text)}


def tempered(cells: DataFrame, temperatures: dict[str, float] = TEMPERATURES) -> dict[str, DataFrame]:
    """Target shares ``level, share`` of every dimension from ``cells`` with ``tokens``, adding up to 1."""
    out = {}
    for d in DIMS:
        t = cells.groupBy(F.col(d).alias("level")).agg(F.pow(F.sum("tokens"), F.lit(temperatures[d])).alias("p"))
        out[d] = t.crossJoin(F.broadcast(t.agg(F.sum("p").alias("all")))).select(  # one row
            "level", (F.col("p") / F.col("all")).alias("share"))
    return out


def rake(cells: DataFrame, targets: dict[str, DataFrame], scratch: Scratch, rounds: int | None = None) -> DataFrame:
    """``cells`` with ``weight``: tokens raked until every dimension has its target shares.

    ``cells`` has one row per combination of levels, with ``tokens`` above 0. A round scales the weights of each
    level of each dimension in turn, by a sum per level and a join. The table has a row per combination only; it is
    written after every round, the scales after every step. Levels without a target get none of the weight.
    Rounds end when one changes no level's weight by more than ``TOLERANCE`` of it. Targets that cannot all be met
    never come to that, which is an error after ``MOST_ROUNDS``; with ``rounds``, it ends after so many as it is.
    """
    held = {d: scratch.store(t.select(F.col("level").alias(d), "share")) for d, t in targets.items()}
    out = scratch.store(cells.withColumn("weight", F.col("tokens").cast("double")))
    for n in range(rounds or MOST_ROUNDS):
        before, scales = out, []
        for d in DIMS:
            scales.append(scratch.store(out.groupBy(d).agg(F.sum("weight").alias("now")).join(held[d], d, "left").select(
                d, F.when(F.col("now") > 0, F.coalesce("share", F.lit(0.0)) / F.col("now")).otherwise(
                    F.lit(0.0)).alias("scale"))))
            out = out.join(scales[-1], d).withColumn("weight", F.col("weight") * F.col("scale")).drop("scale")
        out = scratch.store(out)
        moved = 1.0 if not n else max(  # weights of the first round are token counts
            s.where("scale > 0").agg(F.max(F.abs(F.col("scale") - 1))).first()[0] or 0.0 for s in scales)
        for done in [before, *scales]:
            scratch.drop(done)
        if moved <= TOLERANCE:
            return out
    if rounds is None:
        raise ValueError(f"the targets are not met after {MOST_ROUNDS} rounds: a round still moves weights by {moved:g}")
    return out


def probabilities(cells: DataFrame) -> DataFrame:
    """``cells`` with ``probability``: weight per token, scaled so that the scarcest cell is taken whole."""
    rate = cells.withColumn("rate", F.col("weight") / F.col("tokens"))
    top = rate.agg(F.max("rate").alias("top"))  # one row
    return rate.crossJoin(F.broadcast(top)).select(
        *DIMS, "tokens", "weight", F.coalesce(F.col("rate") / F.col("top"), F.lit(0.0)).alias("probability"))


def draw(doc_id: str, seed: int) -> Column:
    """A number from 0 to 1 that depends on the id alone; a NULL id is the empty text."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / 4294967296.0


def calibrate(sized: DataFrame, scratch: Scratch, temperatures=None, targets=None, rounds=None) -> DataFrame:
    """Sampling probability per combination of levels, from rows with the levels and ``n_tokens``."""
    cells = scratch.store(sized.groupBy(*DIMS).agg(F.sum("n_tokens").alias("tokens")).where("tokens > 0"))
    made = targets or tempered(cells, temperatures or TEMPERATURES)
    return scratch.store(probabilities(rake(cells, made, scratch, rounds)))


def mix(docs: DataFrame, seed: int = 1, **how) -> DataFrame:
    """``doc_id, source, lang, topic, n_tokens, probability, sampled`` for every row of ``docs``.

    ``docs`` has ``doc_id, text, source, lang``; other columns are ignored. Token weights are raked to the target
    shares of sources, languages and topics (``targets``, or else shares tempered from the counts), and a row is
    sampled with the probability of its combination, by a hash of its id, so repeated ids are drawn alike. Texts
    without words weigh nothing; where a combination has no words at all, its rows have probability 0.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    sized = scratch.store(docs.select(
        "doc_id", *[c.alias(d) for d, c in levels(docs).items()], token_count(docs["text"]).alias("n_tokens")))
    cells = calibrate(sized, scratch, **how).select(*DIMS, "probability")
    joined = sized.join(cells, list(DIMS), "left").withColumn(
        "probability", F.coalesce("probability", F.lit(0.0)))
    return joined.select("doc_id", *DIMS, "n_tokens", "probability",
                         (draw("doc_id", seed) < F.col("probability")).alias("sampled"))


def sample(docs: DataFrame, seed: int = 1, **how) -> DataFrame:
    """The rows of ``docs`` that ``mix`` samples, with their topic and probability as ``mix_`` columns.

    Other columns stay as they are, whatever their names; ``mix_`` columns of an earlier run are replaced.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    made = levels(docs)
    sized = docs.select(*[c.alias(d) for d, c in made.items()], token_count(docs["text"]).alias("n_tokens"))
    cells = calibrate(sized, scratch, **how).select(
        *[F.col(d).alias(f"_{d}") for d in DIMS], F.col("probability").alias("mix_probability"))
    names = [c for c in docs.columns if c not in ("mix_topic", "mix_probability")]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"),
                       *[c.alias(f"_level_{d}") for d, c in made.items()], draw("doc_id", seed).alias("_draw"))
    same = [F.col(f"_level_{d}") == F.col(f"_{d}") for d in DIMS]
    return rows.join(cells, same).where("_draw < mix_probability").select(
        *[F.col(f"_row.`{c}`") for c in names], F.col("_topic").alias("mix_topic"), "mix_probability")


def oracle(rounds: int = 12, seed: int = 1) -> str:
    """The same as SQL: one subquery per step of the fitting, in as many rounds as any test table needs."""
    steps, at = [], "w0"
    for r in range(rounds):
        for d in DIMS:
            to = f"w{len(steps) + 1}"
            steps.append(f"{to} AS (SELECT w.* EXCLUDE (weight), weight * share / sum(weight) OVER (PARTITION BY w.{d})"
                         f" AS weight FROM {at} w JOIN t_{d} t ON w.{d} = t.level)")
            at = to
    shares = [f"t_{d} AS (SELECT level, p / sum(p) OVER () AS share FROM (SELECT {d} AS level, "
              f"pow(sum(tokens), {TEMPERATURES[d]}) AS p FROM cells GROUP BY {d}))" for d in DIMS]
    return f"""
WITH sized AS (
  SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
         CASE WHEN contains(coalesce(text, ''), ' | ') THEN 'table'
              WHEN regexp_matches(coalesce(text, ''), '[a-z]') THEN 'prose'
              WHEN regexp_matches(coalesce(text, ''), '[A-Z]') THEN 'capitals' ELSE 'none' END AS topic,
         CAST(coalesce(len(regexp_extract_all(text, '[^ \\t\\n\\x0B\\f\\r]+')), 0) AS BIGINT) AS n_tokens
  FROM documents),
cells AS (SELECT source, lang, topic, sum(n_tokens) AS tokens FROM sized GROUP BY ALL HAVING sum(n_tokens) > 0),
{', '.join(shares)},
w0 AS (SELECT *, CAST(tokens AS DOUBLE) AS weight FROM cells),
{', '.join(steps)},
p AS (SELECT source, lang, topic, (weight / tokens) / max(weight / tokens) OVER () AS probability FROM {at})
SELECT doc_id, source, lang, topic, n_tokens, round(coalesce(probability, 0), 6) AS probability,
       CAST(concat('0x', substr(md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8)) AS BIGINT)
         / 4294967296.0 < coalesce(probability, 0) AS sampled
FROM sized LEFT JOIN p USING (source, lang, topic)"""


@query("op4_source_mixing", oracle())
def op4(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents")).withColumn("probability", F.round("probability", 6))
