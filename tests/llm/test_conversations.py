"""The prefix trie of conversations against a plain one."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest

from cartorio.llm import conversations as cv

SCHEMA = "conv_id long, turn long, role string, text string, key string, id int"


def plain(rows, rebuild=True):
    told = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            told.setdefault(conv, []).append(((turn is not None, turn or 0, tie), (role, text)))
    told = {c: [t for _, t in sorted(ts)] for c, ts in told.items()}
    made = {}
    for c, ts in told.items():
        h = zlib.crc32(str(c).encode()) % 4 if rebuild else 0
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        made[c] = tuple(told.get(base, [])[:h] + ts[h:])
    members = {}
    for c, ts in made.items():
        for d in range(len(ts) + 1):
            members.setdefault(ts[:d], []).append(c)
    kids = {}
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node, who in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in kids
            saved[node[:d]] += (len(who) - 1) * words
    return sorted((min(who), len(node), min(members[node[:-1]]) if node else None, len(who), len(kids.get(node, [])),
                   leaves[node], saved[node],
                   hashlib.sha256(",".join(str(c) for c in sorted(who) if len(made[c]) == len(node)).encode()).hexdigest())
                  for node, who in members.items())


def talk(seed, n=160):
    """Few distinct turns, so that many beginnings agree; copies, NULLs, ties, one turn that comes twice, long ones."""
    r, rows = random.Random(seed), []
    texts = ["a b", "a  b\tc", "", None, "é\x0bü ", "x " * 30, "user"]
    for c in range(-7, n):
        if r.random() < 0.15:
            continue
        long = 40 if c % 50 == 3 else r.choice([1, 1, 2, 3, 5, 8])
        for t in range(long):
            rows.append((c, r.choice([t, t, t, None]) if c % 3 == 0 else t, r.choice(["user", "", None]) if c % 2 else "user",
                         texts[t % 2] if c % 4 else r.choice(texts), "clash", 0))
    for c in range(n, n + 90):  # a third of all conversations are the same
        rows += [(c, t, "user", w, None, None) for t, w in enumerate(["hot", "hot", "a b"])]
    rows += [(5, 0, "user", "a b", None, 1)] * 2 + [(None, 0, "user", "lost", None, 1)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,block,rebuild", [(1, 200_000, True), (2, 7, True), (3, 1, False), (4, 60, False)])
def test_trie_against_plain(spark, seed, block, rebuild):
    rows = talk(seed)
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.adaptive.coalescePartitions.enabled",
                                                "spark.sql.execution.arrow.maxRecordsPerBatch")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # all slices stay apart
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        keyed = cv.keys(spark.createDataFrame(rows, SCHEMA).repartition(3))
        out = cv.prefix_trie(cv.with_shared_openings(keyed) if rebuild else keyed, block)
        got = sorted((tuple(r) for r in out.collect()))
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert out.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                           "ends_sha256"]
    want = plain(rows, rebuild)
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_turnless_and_empty(spark):
    df = spark.createDataFrame([(21, 0, "user", "a", "", 0), (41, 0, "user", "b", "", 0)], SCHEMA)
    got = sorted(tuple(r) for r in cv.prefix_trie(cv.with_shared_openings(cv.keys(df))).collect())
    assert sorted(got, key=repr) == sorted(plain([(21, 0, "user", "a"), (41, 0, "user", "b")]), key=repr)
    assert cv.prefix_trie(cv.with_shared_openings(cv.keys(df.limit(0)))).count() == 0


def test_very_long_turns_and_conversations(spark):
    rows = [(c, t, "user", f"w{t} " * (200_000 if t == 1 else 1), "", 0) for c in (1, 2) for t in range(3000)]
    got = cv.prefix_trie(cv.keys(spark.createDataFrame(rows, SCHEMA)))
    top = got.where("depth = 0").first()
    assert got.count() == 3001 and (top.n_convs, top.n_leaves, top.saved_tokens) == (2, 1, 202_999)
