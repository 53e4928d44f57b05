"""The pipeline's stages one after another, the registered SQL, and a library without this package."""

from __future__ import annotations

import glob
import os
import re
import shutil
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from check import rows_of
from cartorio.llm import decontaminate, mixing, pii, toxicity

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = "/root/testdata/sf0.001"


def first_of_groups(rows):
    """Smallest ids of the groups of five-word shingles at a Jaccard similarity of 0.8, all pairs one by one."""
    sets = []
    for r in rows:
        w = re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in r.text or ""))
        k = min(5, len(w))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9:
                root[find(i)] = find(j)
    low = {}
    for i, r in enumerate(rows):
        low[find(i)] = min(low.get(find(i), r.doc_id), r.doc_id)
    return sorted(low.values())


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are absent")
def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels, bench = spark.read.parquet(f"{SF}/labels.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    made = []
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, SF)
        now = spark.createDataFrame(now.collect(), now.schema)
        made.append(now)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert now.columns == docs.columns
    tox, dedup, clean, masked, mixed = made
    model = toxicity.fit(docs, labels.where(~toxicity.held_out()))
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    assert ids(tox) == ids(docs.where(toxicity.scorer(model)("text") < toxicity.THRESHOLD))
    assert ids(dedup) == first_of_groups(tox.collect())
    assert ids(clean) == ids(decontaminate.find(dedup, bench).where("size(items) = 0"))
    assert 0 < clean.count() <= dedup.count() <= tox.count() < docs.count()
    assert ids(masked) == ids(clean)
    assert pii.find(masked).where("exists(found, x -> x.k = 0)").count() == 0
    assert ids(mixed) == ids(mixing.mix(masked).where("sampled"))
    rows = lambda df: sorted(repr((r.doc_id, r.text, r.mix_topic, round(r.mix_probability, 9))) for r in df.collect())
    assert rows(corpus_pipeline.run(spark, SF)) == rows(mixed)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are absent")
@pytest.mark.parametrize("name", [n for n in entry.oracle_sql() if n.startswith(("op", "pipeline"))])
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM read_parquet('{f}')")
    df = entry.queries()[name](spark, SF)
    cur = con.execute(entry.oracle_sql()[name])
    assert rows_of(df.columns, df.collect()) == rows_of([c[0] for c in cur.description], cur.fetchall())


def test_operators_and_the_pipeline_are_registered():
    names = list(entry.queries())
    assert "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit()) == list(range(1, 14))


def test_the_rest_stands_alone(tmp_path):
    """Without this package and the pipeline the other queries are still there."""
    shutil.copytree(ROOT, tmp_path / "r", ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), any(n.startswith('op1_') or n == 'pipeline' for n in q))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "r", capture_output=True, text=True, timeout=120)
    left = [n for n in entry.queries() if not (n == "pipeline" or n.startswith("op") and n[2].isdigit())]
    assert out.stdout.split() == [str(len(left)), "False"], out.stderr
