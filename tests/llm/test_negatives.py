"""Hard negatives against brute force."""

from __future__ import annotations

import math

import numpy as np
import pytest

from cartorio.llm import negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label int, at string, akey int, score double"


def table(seed, dim=8):
    """Clusters, ties, copies, zero and opposite vectors, NULLs, other lengths, large values."""
    rng, rows = np.random.default_rng(seed), []
    mids = rng.normal(size=(6, dim))
    for i in range(420):
        v = mids[i % 6] + rng.normal(size=dim) * (0.2 if i % 4 else 1.5)
        rows.append((i * 5, (v if i % 9 else np.round(v)).tolist(), int(rng.integers(0, 4))))
    rows += [(3000 + i, rows[8][1], i % 3) for i in range(60)]  # copies: ties by id
    rows += [(100, rows[8][1], 1), (100, rows[8][1], 1), (200, rows[9][1], 2)]  # repeated ids
    rows += [(4000, [0.0] * dim, 0), (4001, [0.0] * dim, 1), (4100, (-mids[0]).tolist(), 9), (4101, mids[0].tolist(), 9)]
    rows += [(5000, [1.0, 2.0], 0), (5001, [2.0, 1.0], 0), (5002, [0.5, 0.5], 1), (6000, [], 3), (6001, [], 3), (6002, [], 2)]
    rows += [(7000, [1e5] * dim, 5), (7001, [1e5] * dim, 5), (7002, [6e4 + 1 / 256] + [6e4] * (dim - 1), 6), (7100, [1e300] * dim, 5)]
    rows += [(None, mids[0].tolist(), 0), (8000, None, 0), (8100, mids[0].tolist(), None), (8200, [None] * dim, 1),
             (8300, [float("nan")] * dim, 1), (8400, [float("inf")] * dim, 1), (9000, mids[1].tolist(), 77)]
    return rows


def plain(rows, positives=5, negatives=10, skip=2 ** 31):
    use = [(i, tuple(math.floor(256 * x) for x in v), lab) for i, v, lab in rows
           if i is not None and v is not None and lab is not None and all(x is not None and math.isfinite(x) for x in v)]
    use = [r for r in use if sum(x * x for x in r[1]) < skip ** 2]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for a in {r for r in use if r[0] % 100 == 0}:
        met = sorted(((-dot(a[1], r[1]), r[0], r[2]) for r in use if len(r[1]) == len(a[1])), key=lambda x: x[:2])
        for p in [m for m in met if m[2] == a[2] and m[1] != a[0]][:positives]:
            fit = [m for m in met if m[2] != a[2] and 30 * -p[0] <= 100 * -m[0] <= 90 * -p[0]]
            out += [(a[0], p[1], k + 1, m[1], -p[0], -m[0]) for k, m in enumerate(fit[:negatives])]
    return sorted(out)


@pytest.mark.parametrize("seed,how", [(1, {}), (2, {"block": 40, "strip": 4}), (3, {"block": 100, "strip": 1, "sample": 5}),
                                      (4, {"references": 1, "strip": 16})])
def test_against_brute_force(spark, seed, how):
    rows = table(seed)
    df = spark.createDataFrame([(*r, "clash", 1, 0.5) for r in rows], SCHEMA).repartition(3)
    out = hn.hard_negatives(df, **how)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    got = sorted(map(tuple, out.collect()))
    want = plain(rows)
    assert len(want) > 300 and got == want


def test_empty_and_lonely(spark):
    df = spark.createDataFrame([(0, [1.0], 1, "", 1, 0.0), (100, [1.0], 2, "", 1, 0.0)], SCHEMA)
    assert hn.hard_negatives(df).count() == 0 and hn.hard_negatives(df.limit(0)).count() == 0


def test_bounds_hold_and_filter():
    """No score passes its bounds, and in clustered vectors most strips stay unscored."""
    rng = np.random.default_rng(5)
    mids = rng.normal(size=(16, 32))
    x = np.floor(256 * (mids[rng.integers(0, 16, 2000)] + 0.1 * rng.normal(size=(2000, 32))))
    refs = hn.directions(x[:500].tolist(), 16)[32]
    norm = np.linalg.norm(x, axis=1)
    rows = [{"dim": 32, "vec_id": i, "label": i % 5, "q": hn._packed(v.astype(int)), "norm": n,
             "angles": np.arccos(np.clip(refs @ v / n, -1, 1)).astype("<f4").tobytes()}
            for i, (v, n) in enumerate(zip(x, norm))]
    block = hn.Block(rows, 32)
    angles = np.array([np.frombuffer(r["angles"], "<f4") for r in rows[:50]], float)
    up, down = hn.score_bounds(angles, norm[:50], block.low, block.high, block.least, block.most)
    score = x[:50] @ block.floats.T
    for s, part in enumerate(block.parts):
        assert (score[:, part].max(1) <= up[:, s]).all() and (score[:, part].min(1) >= down[:, s]).all()
    best = np.sort(score, 1)[:, -10]
    assert (up >= best[:, None]).mean() < 0.3
