"""Language identification against a plain kernel machine, on odd rows, and by held-out accuracy."""

from __future__ import annotations

import os
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartorio.llm import languages as li

SCHEMA = "doc_id long, text string, lang string, source string, score string, _known int"
SF = "/root/testdata/sf0.01"


def corpus(seed=3, n=180):
    rng = np.random.default_rng(seed)
    parts = {"aa": ["ka", "lo", "mi", "tre"], "bb": ["zu", "lo", "ñé", "quer"], "cc": ["ßt", "öa", "mi", "zu"]}
    rows = []
    for i in range(n):
        lang = ["aa", "bb", "cc"][i % 3 if i % 5 else 0]
        words = ["".join(rng.choice(parts[lang], rng.integers(1, 5))) for _ in range(rng.integers(2, 40))]
        rows.append((i, " ".join(words).capitalize(), lang, "s", "clash", 1))
    return rows


def plain_grams(text):
    b = text.lower().encode()
    return {b[i:i + n] for n in li.SIZES for i in range(len(b) - n + 1)}


def test_against_plain_kernel_machine(spark):
    """Everything from sets of n-grams, dense kernels and the dual form of the ridge."""
    rows = corpus()
    model = li.fit(spark.createDataFrame(rows, SCHEMA).repartition(3), sample=90, landmarks=12, ridge=0.01)
    h = {r.doc_id: r.h for r in spark.createDataFrame(rows, SCHEMA).select(
        "doc_id", F.xxhash64(F.col("doc_id").cast("string")).alias("h")).collect()}
    chosen, marks = [], []
    for lang in ("aa", "bb", "cc"):
        own = sorted((h[r[0]], r) for r in rows if r[2] == lang)[:30]
        chosen += [r for _, r in own]
        marks += [r for _, r in own[:4]]
    sets = {r[0]: plain_grams(r[1]) for r in rows}
    k = lambda a, b: len(a & b) / np.sqrt(len(a) * len(b))
    own = np.array([[k(sets[a[0]], sets[b[0]]) for b in marks] for a in marks])
    inv = np.linalg.pinv(own, rcond=1e-6, hermitian=True)
    table = np.array([[k(sets[r[0]], sets[m[0]]) for m in marks] for r in rows])
    inner = table @ inv @ table.T  # of Nystrom features
    unit = inner / np.sqrt(np.outer(np.diag(inner), np.diag(inner)))
    at = [r[0] for r in chosen]
    share = np.array([1 / sum(c[2] == r[2] for c in chosen) for r in chosen])
    target = np.array([[1.0 if r[2] == x else -1.0 for x in ("aa", "bb", "cc")] for r in chosen])
    dual = np.linalg.solve(unit[np.ix_(at, at)] + np.diag(0.01 * 3 / share), target)
    want = unit[:, at] @ dual
    got = model.outputs([li.grams(r[1]) for r in rows])
    assert np.abs(got - want).max() < 0.02  # two n-grams in some thousands share a hash of 16 bits
    out = {r.doc_id: r for r in li.languages(spark.createDataFrame(rows, SCHEMA), model).collect()}
    e = np.exp(2 * want)
    assert all(out[r[0]].lang_pred == ("aa", "bb", "cc")[want[r[0]].argmax()] for r in rows)
    assert all(abs(out[r[0]].score - (e[r[0]] / e[r[0]].sum()).max()) < 0.02 for r in rows)
    assert sum(out[r[0]].lang_pred == r[2] for r in rows) > 0.95 * len(rows)


def test_odd_rows(spark):
    rows = corpus(n=60) + [
        (100, None, "aa", "", "", 0), (101, "", "bb", "", "", 0), (102, " 12 ½ _ Ⅷ\n", "cc", "", "", 0),
        (103, "é", None, None, None, None), (None, "kalo mi", "aa", "", "", 0), (None, "kalo mi", "aa", "", "", 0),
        (104, "漢字かな", None, "", "", 0), (105, "kalo tremi " * 200_000, None, "", "", 0), (106, "9" * 3_000_000 + "zuquer", None, "", "", 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    model = li.fit(df)
    out = li.languages(df, model)
    assert out.columns == ["doc_id", "text", "lang", "source", "_known", "lang_pred", "score"]
    got = {}
    for r in out.select("doc_id", "lang_pred", "score").collect():
        got.setdefault(r.doc_id, []).append((r.lang_pred, r.score))
    assert got[100] == got[101] == got[102] == [("und", 0.0)]
    assert len(got[None]) == 2 and got[None][0] == got[None][1] and got[None][0][0] == "aa"
    assert got[105][0][0] == "aa" and got[106][0][0] == "bb" and all(0 <= s <= 1 for v in got.values() for _, s in v)
    assert got[104][0][0] in ("aa", "bb", "cc") and got[103][0][0] in ("aa", "bb", "cc")
    assert out.count() == len(rows)


def test_without_model_rows_or_second_language(spark):
    df = spark.createDataFrame([(1, "kalo", None, "", "", 0), (2, "12", "aa", "", "", 0)], SCHEMA)
    assert li.fit(df) is None and li.fit(df.limit(0)) is None
    assert [tuple(r) for r in li.languages(df, None).select("lang_pred", "score").distinct().collect()] == [("und", 0.0)]
    one = li.fit(spark.createDataFrame([(1, "kalo", "aa", "", "", 0)] * 3, SCHEMA))
    assert [r.lang_pred for r in li.languages(df, one).orderBy("doc_id").collect()] == ["aa", "und"]
    assert li.languages(df.limit(0), one).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are absent")
def test_held_out_accuracy(spark):
    from cartorio.llm.queries import QUERIES
    out = QUERIES["op13_language_identification"](spark, SF)
    rows = out.join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score"] and len(rows) == 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) > 0.97 * len(held)
