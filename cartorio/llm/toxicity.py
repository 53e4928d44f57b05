"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartorio.llm.common import Scratch, query, table

SIZES = (3, 4, 5)
BUCKETS = 1 << 18
THRESHOLD = 0.3
#: Bytes of a text worked on at once.
_BLOCK = 1 << 20


def grams(text: str | None):
    """Blocks of hashed character n-grams of a whole text (bytes, A-Z in lower case), as bucket numbers."""
    raw = np.frombuffer(b" " + (text or "").encode().lower() + b" ", np.uint8)
    for at in range(0, len(raw), _BLOCK):
        b = raw[at:at + _BLOCK + max(SIZES) - 1].astype(np.uint64)
        h = b
        for n in range(2, max(SIZES) + 1):
            if len(h) < 2:
                break
            h = h[:-1] * np.uint64(257) + b[n - 1:]
            if n in SIZES:
                yield ((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(46)).astype(np.int32)


def _features(text, keep) -> np.ndarray:
    """Distinct numbers of the kept features of a text; ``keep`` has the number of each bucket, or -1."""
    found = [f[f >= 0] for f in (keep[g] for g in grams(text))]
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int32)


def _count(batches):
    """How many texts of either class have each bucket: one row per task and class."""
    seen = np.zeros((2, BUCKETS), np.int32)
    n = [0, 0]
    for b in batches:
        for text, label in zip(*(c.to_pylist() for c in b.columns)):
            mark = np.zeros(BUCKETS, bool)
            for g in grams(text):
                mark[g] = True
            seen[label] += mark
            n[label] += 1
    yield pa.RecordBatch.from_arrays(
        [pa.array([0, 1]), pa.array(n), pa.array([seen[0].tobytes(), seen[1].tobytes()])], ["label", "n", "seen"])


def _picked(keep):
    def run(batches):
        for b in batches:
            rows = [(label, _features(text, keep).astype("<i4").tobytes())
                    for text, label in zip(*(c.to_pylist() for c in b.columns))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())],
                ["label", "features"])
    return run


def _logistic(lists: list[np.ndarray], scale: np.ndarray, y: np.ndarray, ridge: float, steps: int):
    """Weights and intercept of a ridge logistic regression on scaled binary features, by adaptive gradient steps.

    ``lists`` has the features of every text. They are worked on some hundred texts at a time, so what is
    held besides them stays small.
    """
    n, k = len(y), len(scale)
    parts = []
    for at in range(0, n, 500):
        own = lists[at:at + 500]
        parts.append((slice(at, at + len(own)), np.repeat(np.arange(len(own), dtype=np.int32), [len(x) for x in own]),
                      np.concatenate(own)))
    w, b = np.zeros(k), float(np.log((y.sum() + 1) / (n - y.sum() + 1)))
    m, v = np.zeros(k + 1), np.zeros(k + 1)
    for t in range(1, steps + 1):
        g, scaled = np.zeros(k + 1), scale * w
        for texts, rows, cols in parts:
            z = b + np.bincount(rows, scaled[cols], minlength=texts.stop - texts.start)
            gap = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y[texts]) / n
            g[:-1] += np.bincount(cols, gap[rows], minlength=k)
            g[-1] += gap.sum()
        g[:-1] = g[:-1] * scale + ridge * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = 0.05 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-9)
        w, b = w - step[:-1], b - step[-1]
    return w, b


def fit(docs: DataFrame, labels: DataFrame, sample: int = 12_000, features: int = 8_192, smooth: float = 1.0,
        ridge: float = 1e-4, steps: int = 120) -> tuple[np.ndarray, float]:
    """Weight of every bucket, and intercept, learnt from ``docs(doc_id, text)`` and ``labels(doc_id, toxic)``.

    The fit uses at most ``sample`` labelled rows, those with the smallest hash of their id, and the ``features``
    buckets with the strongest log-count ratios for their support. Labels other than 0 and 1 and labels without
    a document are left out, repeated rows count once. With one class only, the score of every text is that of the class share.
    """
    spark = docs.sparkSession
    chosen = (labels.select(F.col("doc_id").alias("_of"), F.col("toxic").cast("int").alias("_label"))
              .where("_label in (0, 1) and _of is not null")
              .orderBy(F.xxhash64(F.col("_of").cast("string")), "_label").limit(sample))
    # at most `sample` rows of two numbers; of rows with one id and label the smallest text is taken
    train = Scratch(spark, "toxicity").store(
        docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_of")).groupBy(
            "_of", "_label").agg(F.min("text").alias("text")).select("text", "_label"))
    parts = spark.sparkContext.defaultParallelism
    counted = train.coalesce(max(1, min(16, parts))).mapInArrow(_count, "label long, n long, seen binary").collect()
    seen, n = np.zeros((2, BUCKETS)), np.zeros(2)
    for r in counted:  # two rows of a megabyte for each of at most 16 tasks
        seen[r["label"]] += np.frombuffer(r["seen"], np.int32)
        n[r["label"]] += r["n"]
    if not n.all():
        rate = (n[1] + 0.5) / (n.sum() + 1)
        return np.zeros(BUCKETS), float(np.log(rate / (1 - rate)))
    ratio = np.log((seen[1] + smooth) / (n[1] + 2 * smooth)) - np.log((seen[0] + smooth) / (n[0] + 2 * smooth))
    support = seen.sum(0)
    strength = np.where(support >= 2, np.abs(ratio) * np.sqrt(support), 0)
    best = np.argsort(-strength, kind="stable")[:features]
    best = best[strength[best] > 0]
    keep = np.full(BUCKETS, -1, np.int32)
    keep[best] = np.arange(len(best))
    rows = train.mapInArrow(_picked(keep), "label long, features binary").collect()
    rows.sort(key=lambda r: (r["label"], bytes(r["features"])))  # sums come out alike in every run
    y = np.array([r["label"] for r in rows], float)
    w, b = _logistic([np.frombuffer(r["features"], "<i4") for r in rows], ratio[best], y, ridge, steps)
    out = np.zeros(BUCKETS)
    out[best] = w * ratio[best]
    return out, float(b)


def scorer(model: tuple[np.ndarray, float]):
    """Column function: the score of a text, from 0 to 1. NULL and empty texts get that of the intercept."""
    weights, b = model
    keep = np.where(weights != 0, np.arange(BUCKETS), -1).astype(np.int32)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        z = np.array([b + weights[_features(t, keep)].sum() for t in texts], float)
        return pd.Series(1 / (1 + np.exp(-np.clip(z, -500, 500))))
    return score


def held_out(doc_id: str = "doc_id"):
    """Rows that no fit sees: crc32 of the id as text, modulo 4, is 2; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 4 == 2


def reject_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **how) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, all columns as they are.

    NULL and empty texts score as the intercept alone, rows of one text alike, so repeated rows stay or go together.
    Where no label has a document, every text has the score of an even share. An empty table stays empty.
    """
    model = fit(docs, labels.where(~held_out()), **how)
    return docs.where(scorer(model)(F.col("text")) < threshold)


@query("op9_toxicity")
def op9(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels").where(~held_out()))
    scored = docs.select("doc_id", held_out().alias("held_out"), scorer(model)("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
