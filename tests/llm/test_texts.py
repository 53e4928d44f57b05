"""The text operators against plain versions of their definitions, on small awkward tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartorio.llm.common import Scratch
from cartorio.llm import decontaminate, language_model, licenses, mixing, pii, resemblance, sentences, simhash, tokens, toxicity

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType()), T.StructField("fp", T.StringType()),
                     T.StructField("key", T.StringType())])
WORDS = "the of and to in a is that for it was on are as with his they at be this from".split()


def prose(rng, n):
    out = []
    while len(out) < n:
        k = rng.randint(4, 12)
        out += [rng.choice(WORDS) + rng.choice(["", "x", "ing", "ed"]) for _ in range(k)]
        out[-1] += "."
    return " ".join(out)


@pytest.fixture(scope="module")
def made():
    rng = random.Random(5)
    texts = [prose(rng, rng.randint(1, 120)) for _ in range(60)]
    texts += [texts[0], texts[0] + " extra", None, "", "   ", "Été À ÉTÉ x", "one", "one two", "é" * 30,
              "a" * 5000, "x y " * 4000, texts[1].upper(), "\n\n", "tab\tand\x0bmore\x0cspace", "🙂 ok 🙂"]
    ids = [*range(len(texts))]
    rows = [(i, t, "en", f"s{i % 3}", len(t) if t else None, "clash", "clash") for i, t in zip(ids, texts)]
    rows += [(None, texts[2], None, None, None, None, None), rows[5], rows[5], (7, "other text of id seven",) + rows[7][2:]]
    return rows


@pytest.fixture(scope="module")
def docs(spark, made):
    return spark.createDataFrame(made, DOCS).repartition(5)


def ascii_lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def words_plain(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(t or ""))


# --- near-duplicates -----------------------------------------------------------------------------------------------


def fingerprint_plain(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(t or ""))
    grams = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    hs = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs)) if hs else 0


def roots_plain(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if linked(a, b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {n: find(n) for n in nodes}


def test_simhash_equals_plain(docs, made):
    prints = [fingerprint_plain(r[1]) for r in made]
    root = roots_plain(sorted(set(prints)), lambda a, b: bin(a ^ b).count("1") <= 3)
    low = {}
    for r, p in zip(made, prints):
        if r[0] is not None:
            low[root[p]] = min(r[0], low.get(root[p], 10 ** 9))
    got = simhash.near_duplicates(docs).select("doc_id", simhash.hex_of("fp"), "component_id").collect()
    assert Counter(map(tuple, got)) == Counter((r[0], f"{p:016x}", low[root[p]]) for r, p in zip(made, prints))


def test_simhash_links_lose_no_pair(spark):
    rng = random.Random(3)
    fps = {0, (1 << 64) - 1}
    for _ in range(60):
        x = rng.getrandbits(64)
        fps.add(x)
        for _ in range(8):
            y = x
            for _ in range(rng.randint(1, 5)):
                y ^= 1 << rng.randrange(64)
            fps.add(y)
    signed = [simhash._signed(x) for x in fps]
    want = {(min(a, b), max(a, b)) for a in signed for b in signed if a != b and bin((a ^ b) & (1 << 64) - 1).count("1") <= 3}
    got = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long")).collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_simhash_keeps_one_of_each_group(docs, made):
    prints = {fingerprint_plain(r[1]) for r in made}
    root = roots_plain(sorted(prints), lambda a, b: bin(a ^ b).count("1") <= 3)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert Counter(root[fingerprint_plain(r.text)] for r in rows) == Counter(set(root.values()))
    for r in rows:
        same = [m[0] for m in made if root[fingerprint_plain(m[1])] == root[fingerprint_plain(r.text)]]
        assert r.doc_id == min((i for i in same if i is not None), default=None)


@pytest.mark.parametrize("crowd", [resemblance.CROWD, 0])  # 0: what two stars leave goes to the second prefix
def test_keep_one_by_shingles_loses_no_pair(spark, monkeypatch, crowd):
    monkeypatch.setattr(resemblance, "CROWD", crowd)
    rng = random.Random(11)
    line = prose(rng, 40)
    base = [" ".join(f"{rng.choice(WORDS)}{rng.randrange(60)}" for _ in range(rng.randint(3, 200))) for _ in range(25)]
    rows = []
    for t in base:
        rows.append(t + (" " + line if rng.random() < 0.5 else ""))
        for _ in range(rng.randint(0, 5)):
            w = rows[-1].split()
            for _ in range(rng.randint(1, max(1, len(w) // 30))):
                w[rng.randrange(len(w))] = f"new{rng.randrange(1000)}"
            rows.append(" ".join(w).upper() if rng.random() < 0.2 else " ".join(w))
    rows += [rows[0], None, "", " \n", "one two", "one  two", "one"]

    def grams(t):
        w = (t or "").lower().split()
        k = min(5, len(w))
        return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set()
    sets = [grams(t) for t in rows]
    like = lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9
    root = roots_plain(list(range(len(rows))), like)
    prints = [fingerprint_plain(t) for t in rows]
    far = sum(like(a, b) and bin(prints[a] ^ prints[b]).count("1") > 3 for a in range(len(rows)) for b in range(a))
    assert far > 10  # pairs that fingerprints within 3 bits pass over
    kept = simhash.keep_one(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string"), words=5)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(root.values()))


def test_second_prefix_parts_texts_that_share_a_passage(spark):
    rng = random.Random(3)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(150)) + " " + passage for _ in range(120)]
    texts += [texts[0] + " and more", texts[1].replace(" p59", " q59")]
    every = {i: resemblance.shingles(t, 5) for i, t in enumerate(texts)}
    rows = [(int(g), i, len(s), k, i) for i, s in every.items() for k, g in enumerate(
        s[:len(s) - int(resemblance.least(len(s), 0.8)) + 1].view(np.int64))]
    post = spark.createDataFrame(rows, "gram long, fp long, n int, pos int, root long")
    frame = spark.createDataFrame(list(enumerate(texts)), "fp long, text string")
    allowed = F.col("p.root") != F.col("q.root")
    got = resemblance._remaining(post, frame, 5, 0.8, allowed, Scratch(spark, "test"))[0].collect()
    assert resemblance._joined(post, allowed).count() > 50_000
    assert {(0, 120), (1, 121)} <= {(r.a, r.b) for r in got} and len(set(got)) < 500


def test_texts_that_share_late_shingles_only_are_not_paired(spark, monkeypatch):
    """Texts with 24 shingles of their own and 126 common ones have these in their prefixes, but too late for 0.8."""
    rng = random.Random(6)
    passage = " ".join(f"p{i}" for i in range(130))
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(20)) + " " + passage for _ in range(12)]
    texts.append(texts[0].replace(texts[0].split()[3], "other"))
    looked, possible = [], resemblance._possible
    monkeypatch.setattr(resemblance, "_possible", lambda pairs, *rest: looked.extend(
        (r.a, r.b) for r in pairs.collect()) or possible(pairs, *rest))
    frame = spark.createDataFrame(list(enumerate(texts)), "fp long, text string")
    found, _ = resemblance.links(frame, 5, 0.8, Scratch(spark, "test"))
    assert {(r.a, r.b) for r in found.collect()} == {(0, 12)} == set(looked)


def test_copies_edited_too_much_are_not_paired_one_by_one(spark, monkeypatch):
    """32 copies of each of 8 texts with one word of ten replaced in each, no two similar: few pairs for each of them."""
    rng = random.Random(9)
    texts = [" ".join(f"n{rng.randrange(10**6)}" if rng.random() < 0.1 else f"w{k}x{i}" for i in range(400))
             for k in range(8) for _ in range(32)]
    texts += [t + " and more" for t in texts[:3]]
    sets = [resemblance.shingles(t, 5) for t in texts]
    like = {(i, j) for j in range(len(texts)) for i in range(j) if (c := len(np.intersect1d(sets[i], sets[j]))) >= 0.8 * (
        len(sets[i]) + len(sets[j]) - c)}
    assert 3 <= len(like) < 100
    made, joined = [], resemblance._joined
    monkeypatch.setattr(resemblance, "_joined", lambda post, allowed: made.append(joined(post, allowed).count()) or joined(post, allowed))
    monkeypatch.setattr(resemblance, "FREQUENT", 0)  # as where a sample of many texts does not see them
    found, roots = resemblance.links(spark.createDataFrame(list(enumerate(texts)), "fp long, text string"), 5, 0.8, Scratch(spark, "test"))
    root = roots_plain(list(range(len(texts))), lambda a, b: (min(a, b), max(a, b)) in like)
    assert {(r.a, r.b) for r in found.collect()} <= like | {(b, a) for a, b in like}
    assert {r.node: r.root for r in roots.collect()} == {i: r for i, r in root.items() if list(root.values()).count(r) > 1}
    assert sum(made) < 8 * len(texts), made


@pytest.mark.parametrize("similarity", [0.4, 0.6, 0.8, 0.95])
def test_similar_texts_have_a_run_in_common_that_places_allow(similarity):
    """The first common hash of two similar sets is given by both, where the places leave enough, early in the smaller."""
    rng = np.random.default_rng(7)
    t, seen = similarity / (1 + similarity), 0
    while seen < 2000:
        n = int(rng.integers(1, 14)) if rng.random() < 0.5 else int(rng.integers(1, 400))
        x = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        kept = x[rng.random(len(x)) >= rng.random() * (1 - similarity)]
        if rng.random() < 0.5:  # what differs stands first, in turn with what is common: the worst order
            kept = np.r_[x[1:2 * (len(x) - len(kept)):2], x[2 * (len(x) - len(kept)):]]
        y = np.unique(np.r_[kept, rng.integers(0, 1 << 63, rng.integers(0, max(1, int(len(x) * (1 - similarity))) + 1), dtype=np.uint64)])
        c = len(np.intersect1d(x, y))
        if not len(y) or c < similarity * (len(x) + len(y) - c) - 1e-9:
            continue
        seen += 1
        (small, big) = (x, y) if len(x) <= len(y) else (y, x)
        p, q = ({int(h): int(i) for h, i in zip(*resemblance._runs(g, similarity))} for g in (small, big))
        n, m = len(small), len(big)
        assert any(
            min(n - p[h], m - q[h]) + min(p[h], q[h], (p[h] + q[h]) / 3) >= t * (n + m) - 1e-9 and p[h] <= n * (3 - 6 * t) + 1e-9
            for h in p.keys() & q.keys())


def test_sketches_never_pass_what_sets_differ_in():
    rng = np.random.default_rng(4)
    for _ in range(300):
        x = np.unique(rng.integers(0, 1 << 63, rng.integers(1, 4000), dtype=np.uint64))
        y = np.unique(np.r_[x[rng.random(len(x)) < rng.random()], rng.integers(0, 1 << 63, rng.integers(1, 900), dtype=np.uint64)])
        differ = len(np.setxor1d(x, y))
        assert resemblance.apart(resemblance.sketch(x), resemblance.sketch(y)) <= differ
    x = np.unique(rng.integers(0, 1 << 63, 3000, dtype=np.uint64))
    y = np.r_[x[:1800], np.unique(rng.integers(0, 1 << 63, 1200, dtype=np.uint64))]
    assert resemblance.apart(resemblance.sketch(x), resemblance.sketch(y)) > 6000 * 0.2 / 1.8


def test_keep_one_by_shingles_on_odd_rows(spark):
    """NULL ids, repeated rows, other columns that differ, texts of megabytes, columns named as the job's own."""
    long = " ".join(f"w{i % 977}x{i % 1013}" for i in range(150_000))
    rows = [(None, "same words here", 1, "b"), (None, "same words here", 1, "a"), (7, "same words here", 2, "b"),
            (7, "same words here", 2, "a"), (3, None, 0, ""), (4, "", 0, ""), (5, long, 0, ""), (6, long + " more", 0, ""),
            (None, "alone " * 7, 0, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp long, row string").repartition(3)
    kept = simhash.keep_one(df, words=5)
    assert kept.columns == df.columns
    assert sorted(((r.doc_id, r.row) for r in kept.collect()), key=repr) == [(3, ""), (5, ""), (7, "a"), (None, "")]


def test_sentence_runs(spark, docs, made):
    rng = random.Random(8)
    passage = prose(rng, 60)
    rows = [(i, prose(rng, 80) + "\n" + (passage if i in (3, 5, 9) else "") + " " + prose(rng, 40)) for i in range(12)]
    rows += [(20, None), (21, ""), (22, " \n. "), (23, "word " * 3000)]
    out = {r.doc_id: r for r in sentences.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    inner = passage[passage.index(".") + 1:passage.rindex(".", 0, -1)]
    assert inner in out[3].text and out[3].n_removed == 0 and not out[3].changed
    for i in (5, 9):
        assert inner not in out[i].text and out[i].changed and 3 in out[i].first_doc_ids
    assert all(out[i].text == t for i, t in rows if i not in (5, 9))
    assert out[20].text is None and out[20].n_sentences == 0
    copies = [r for r in sentences.remove_repeats(docs).collect() if r.doc_id == 60]
    assert len(made[0][1].split()) > 20 and copies[0].text == "" and copies[0].n_removed == copies[0].n_sentences


def test_sentences_join_to_the_text(made):
    for r in made:
        assert "".join(sentences.sentences(r[1])) == (r[1] or "")


def test_sentence_runs_equal_plain(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["a b.", "c d e!", "f.", "g h i j?"]) for _ in range(rng.randint(1, 12)))) for i in range(30)]
    first, gone = {}, {}
    for i, t in rows:
        s = sentences.sentences(t)
        enough = lambda k, m: m - k >= 2 and len(" ".join(s[k:m]).split()) >= 5 or len(
            " ".join(s[k:m]).split()) >= 10
        spans = {(k, next((m for m in range(k + 1, len(s) + 1) if enough(k, m)), None)) for k in range(len(s))}
        spans |= {(next((k for k in range(m - 1, -1, -1) if enough(k, m)), None), m) for m in range(1, len(s) + 1)}
        for k, m in sorted(x for x in spans if None not in x):
            if first.setdefault(tuple(x.strip() for x in s[k:m]), (i, k)) != (i, k):
                gone.setdefault(i, set()).update(range(k, m))
    got = sentences.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), 2, 5).collect()
    assert {r.doc_id: r.n_removed for r in got} == {i: len(gone.get(i, ())) for i, _ in rows}


@pytest.mark.parametrize("ends", ["stops", "none", "inside"])
def test_passages_that_begin_and_end_inside_sentences(spark, ends):
    """Of equal passages of 51 words and more, all but words near the ends go, wherever sentences end."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghijklmno") for _ in range(rng.randint(2, 9)))

    def some(n):
        return [word() + ("." if ends == "stops" and rng.random() < 0.06 else "") for _ in range(n)]
    rows, passages = [], {}
    for i in range(0, 200, 2):
        passages[i + 1] = some(rng.randint(51, 70))
        if ends == "inside":  # one stop in the middle
            passages[i + 1][25] += "."
        rows += [(i + k, " ".join([*some(rng.randint(5, 90)), *passages[i + 1], *some(rng.randint(5, 90))])) for k in (0, 1)]
    rows += [(1000 + i, " ".join(some(300))) for i in range(20)]
    out = {r.doc_id: r for r in sentences.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(out[i].text == t for i, t in rows if i not in passages)
    gone = {i: len(t.split()) - len(out[i].text.split()) for i, t in rows if i in passages}
    assert all(gone[i] <= len(p) for i, p in passages.items())
    assert sum(n == 0 for n in gone.values()) <= 4
    assert sum(gone.values()) >= 0.8 * sum(len(p) for p in passages.values())
    assert all(any(word not in out[i].text.split() for word in p) == (gone[i] > 0) for i, p in passages.items())


def test_units_join_to_the_text(made):
    for r in made:
        parts, of = sentences.units(r[1])
        assert "".join(parts) == (r[1] or "") and len(parts) == len(of) and of == sorted(of)


# --- decontamination -----------------------------------------------------------------------------------------------


def test_decontamination_equals_plain(spark, docs, made):
    rng = random.Random(4)
    items = [(i, " ".join(words_plain(made[i][1])[5:25]) or None) for i in range(6)]
    items += [(50, "one two"), (51, "one"), (52, None), (53, ""), (54, prose(rng, 30)), (0, items[0][1]), (None, "two")]
    bench = spark.createDataFrame(items, "item_id long, text string")

    def plain(text):
        w = words_plain(text)
        hit, found = set(), set()
        for item, t in items:
            b = words_plain(t)
            for k in range(max(len(b) - 10, 0) + 1 if b else 0):
                win = b[k:k + 10]
                for s in range(len(w) - len(win) + 1):
                    if w[s:s + len(win)] == win:
                        hit.update(range(s, s + len(win)))
                        found.add("" if item is None else str(item))
        return len(w), len(hit), tuple(sorted(found))

    want = Counter((r[0], *plain(r[1])) for r in made)
    for block in (100_000, 7):
        got = decontaminate.find(docs, bench, block=block).select(
            "doc_id", "n_words", decontaminate.hit_words("hits").alias("n"), F.array_sort("items").alias("items"), "near")
        rows = got.collect()
        assert Counter((r.doc_id, r.n_words, r.n, tuple(r["items"])) for r in rows) == want
        assert all(set(r["items"]) <= set(r.near) for r in rows)
    kept = decontaminate.clean(docs, bench)
    assert kept.columns == docs.columns
    assert Counter(map(tuple, kept.collect())) == Counter(r for r in made if not plain(r[1])[2])
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.clean(docs, none).count() == len(made)
    assert decontaminate.find(docs.limit(0), bench).count() == 0


def test_windows_are_asked_of_segments_that_have_their_rarest_word(spark):
    docs = spark.createDataFrame([(1, "a a a a b b c"), (2, "a a a b"), (3, "c a"), (4, None)], "doc_id long, text string")
    index = decontaminate.positional_index(docs.coalesce(1), segment_words=1)
    windows = spark.createDataFrame([(1, b"a b"), (2, b"c a"), (3, b"a d"), (4, b"a")], "wid long, words binary")
    rows = index.select("segment", F.col("ids")[0].alias("id")).collect()
    of = {r.segment: r.id for r in rows}
    got = decontaminate._asked(index, windows, Scratch(spark, "test")).collect()
    assert sorted((r.wid, of[r.segment]) for r in got) == [(1, 1), (1, 2), (2, 1), (2, 3), (4, 1), (4, 2), (4, 3)]


def test_a_preamble_of_all_items_and_a_very_long_text(spark):
    rng = random.Random(6)
    preamble = prose(rng, 15)
    bench = spark.createDataFrame([(i, f"{preamble} {'x' * (i + 1)} {prose(rng, 12)}") for i in range(300)],
                                  "item_id long, text string")
    long = prose(rng, 60_000)
    docs = spark.createDataFrame([(1, f"{long} {preamble} {long}"), (2, long), (3, preamble)], "doc_id long, text string")
    got = {r.doc_id: r for r in decontaminate.find(docs, bench).collect()}
    assert [len(got[i]["items"]) for i in (1, 2, 3)] == [300, 0, 300]
    assert got[1].n_words == sum(len(words_plain(x)) for x in (long, preamble, long))
    assert [(h.s, h.e) for h in got[3].hits] == [(0, len(words_plain(preamble)))]


def test_proximity_matches(spark):
    bench = spark.createDataFrame([(1, "red green blue")], "item_id long, text string")
    rows = [(1, "blue x red y green"), (2, "red green x x x blue"), (3, "red green blue"), (4, "red green")]
    got = decontaminate.find(spark.createDataFrame(rows, "doc_id long, text string"), bench, slop=2).collect()
    assert {r.doc_id: (list(r["items"]), list(r.near)) for r in got} == {
        1: ([], ["1"]), 2: ([], []), 3: (["1"], ["1"]), 4: ([], [])}


# --- personal data -------------------------------------------------------------------------------------------------

PII_TEXTS = [
    "mail bob.42@mail8.example.com now", "a@b.c_d@e.f", "a@b", "x" * 3000 + "@y.z", "a@b" + ".c" * 3000,
    "ip 42.144.35.254 and 1.2.3.4.5 and 256.1.1.1 and 000001.2.3.4 and 1.2.3", "1.2.3.4.5.6.7.8.9",
    "card 4337166598464399 4337 1665 9846 4399 4337-1665-9846-4398", "9" * 4000, "call +1 (988) 555-2485 ok",
    "+12345678 +123456789 +1234567890123456 ++1 5", "🙂 é +1 (456) 555-2186", "DE89 3704 0044 0532 0130 00 iban",
    "GB82WEST12345698765432", "DE89 3704 0044 0532 0130 01", "", None, "+4 4337166598464399", "to 4111 1111 1111 1111.2.3.4",
]


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        n = int(c) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def pii_plain(t):
    t = t or ""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def test_pii_equals_plain(spark, docs, made):
    rows = list(enumerate(PII_TEXTS)) + [(100 + i, r[1]) for i, r in enumerate(made)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.found for r in pii.find(df).collect()}
    for i, t in rows:
        assert [(x.s, x.k, x.e) for x in got[i] if x.k < pii.BASE] == pii_plain(t), t
    ibans = {i for i, _ in rows if any(x.k == 4 for x in got[i])}
    assert ibans == {12, 13}
    assert [x.score for x in got[0]] == [1.0] and [x.score for x in got[1]] == [0.9, 0.9]


def test_pii_mask(spark, docs, made):
    df = spark.createDataFrame([(0, PII_TEXTS[0]), (1, "🙂 +1 (456) 555-2186!"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii.mask(df).collect()}
    assert got == {0: "mail [EMAIL] now", 1: "🙂 [PHONE]!", 2: None}
    out = pii.mask(docs)
    assert out.columns == docs.columns and out.count() == len(made)


def test_pii_many_matches_in_one_text(spark):
    n = 20_000
    texts = ["🙂 ".join(f"a{i}@ex.org" for i in range(k)) for k in (n, pii.CHUNK - 1, pii.CHUNK, pii.CHUNK + 1)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.find(df).collect():
        assert [(x.s, x.k, x.e) for x in r.found] == pii_plain(texts[r.doc_id])
    for r in pii.mask(df).collect():
        assert r.text == "🙂 ".join(["[EMAIL]"] * (texts[r.doc_id].count("@")))


# --- licenses ------------------------------------------------------------------------------------------------------


def test_license_phrases_equal_plain(spark, docs, made):
    extra = [(900, "MIT License mit  license. The GNU General Public License; apache-license"), (901, "mit licenses")]
    rows = [(r[0], r[1]) for r in made] + extra
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()

    def plain(t):
        w = words_plain(t)
        at = [(i, label) for p, label in licenses.PHRASES.items() for i in range(len(w))
              if w[i:i + len(p.split())] == p.split()]
        places = [i for i, _ in at]
        return (len(w), len(at), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in at})))
    assert Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got) == Counter(
        (i, *plain(t)) for i, t in rows)


def license_labels(text):
    m = licenses.Matcher(licenses.TEMPLATES, licenses.PHRASES)
    w = licenses.words_of(text)
    return ",".join(sorted({x for _, x in m.phrase_places(w)} | {x for *_, x in m.template_places(w)}))


@pytest.mark.parametrize("text,labels", [
    ("Licensed under the Apache License, Version 2.0.", "apache,apache-2.0-notice,apache-notice"),
    ("Licensed under the Apache License, Version 1.1.", "apache,apache-notice"),
    ("licensed under the apache license", "apache,apache-notice"),
    ("under the apache license", "apache"),
    ("This work is licensed under the GNU General Public License, version 3.", "gpl,gpl-3.0-notice,gpl-notice"),
    ("It is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
     "published by the Free Software Foundation, either version 2 of the License", "gpl,gpl-2.0-notice,gpl-notice"),
    ("Released under the General Public License", "gpl,gpl-notice"),
    ("Released under the terms of the MIT License", "mit,mit-notice"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
     "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies only on "
     "Sundays", ""),
])
def test_license_templates(text, labels):
    assert license_labels(text) == labels


def licence_text(template, filler="some party"):
    """Words of a text that the template accepts, without its optional parts, and which of them it fixes."""
    bare = re.sub("<<optional>>.*?<<end>>", "", template)
    bare = re.sub(r"<<one:([^>]*)>>", lambda m: m[1].split("|")[-1], bare)
    words, fixed = [], []
    for part in re.split(r"<<(var:[0-9]+)>>", bare):
        own = filler.split() if part.startswith("var:") else [w.decode() for w in licenses.words_of(part)]
        words += own
        fixed += [not part.startswith("var:")] * len(own)
    return words, fixed


@pytest.mark.parametrize("label", list(licenses.TEMPLATES))
def test_each_mandatory_word_counts(label):
    """A word changed, or left out, and the template is refused; optional parts and names may differ."""
    template = licenses.TEMPLATES[label]
    accepts = lambda words: label in license_labels("x " + " ".join(words) + " y").split(",")
    sql = re.compile(licenses.pattern(template))
    words, fixed = licence_text(template)
    assert accepts(words) and sql.search(" " + " ".join(words) + " ")
    full = [w.decode() for w in licenses.words_of(re.sub("<<(optional|end)>>", "", re.sub(
        "<<one:([^>|]*)[^>]*>>", r"\1", re.sub("<<var:[0-9]+>>", "the author", template))))]
    assert accepts(full)
    for i, own in enumerate(fixed):
        for other in (words[:i] + ["zzz"] + words[i + 1:], words[:i] + words[i + 1:]):
            if own:
                assert not accepts(other) and not sql.search(" " + " ".join(other) + " "), (i, words[i])
            else:
                assert accepts(other)


def test_two_and_three_clauses_are_told_apart():
    two, three = (" ".join(licence_text(licenses.TEMPLATES[f"bsd-{n}-clause"])[0]) for n in (2, 3))
    assert license_labels(two) == "bsd-2-clause" and license_labels(three) == "bsd-3-clause"


def test_template_markup():
    a = licenses.compile_template("begin<<optional>> one<<optional>> two<<end>><<end>> <<var:2>> end")
    ends = [a.longest(licenses.words_of(t), 0) for t in (
        "begin end", "begin one end", "begin one two end", "begin x y end", "begin one two x y end", "begin x y z end")]
    assert ends == [2, 3, 4, 4, 6, -1]
    for bad in ("<<var:1>> a", "<<optional>>a<<end>>", "a <<optional>>b"):
        with pytest.raises(ValueError):
            licenses.compile_template(bad)


# --- tokens --------------------------------------------------------------------------------------------------------


def viterbi_plain(text, pieces):
    """All segmentations by dynamic programming over characters, longest piece first on ties."""
    scores = dict(pieces)
    unknown = min(scores.values()) - 10
    t = "▁" + text.replace(" ", "▁") if text else ""
    best = [(0.0, 0)] + [None] * len(t)
    for e in range(1, len(t) + 1):
        for s in range(max(0, e - 20), e):
            p = t[s:e]
            if p in scores:
                c = (best[s][0] + scores[p], best[s][1] + 1)
            elif e - s == 1:
                c = (best[s][0] + unknown, best[s][1] + len(p.encode()))
            else:
                continue
            if best[e] is None or c[0] > best[e][0]:
                best[e] = c
    return best[-1][1]


def test_tokens_equal_plain(docs, made):
    pieces = tokens.load_pieces(f"/opt/tokenizers/{tokens.VOCABULARY}")
    got = docs.select("doc_id", "text", tokens.counter(pieces)("text").alias("n")).collect()
    for r in got:
        if len(r.text or "") < 3000:
            assert r.n == viterbi_plain(r.text or "", pieces), r.text


def test_tokens_equal_public_tokenizer(made):
    """The same vocabulary in a unigram model of a public library."""
    from tokenizers import Tokenizer, models, normalizers

    pieces = tokens.load_pieces(f"/opt/tokenizers/{tokens.VOCABULARY}")
    bytes_ = [(f"<0x{i:02X}>", -1e12) for i in range(256)]
    t = Tokenizer(models.Unigram([("<unk>", -1e12), *pieces, *bytes_], 0, True))
    t.normalizer = normalizers.Sequence([normalizers.Prepend("▁"), normalizers.Replace(" ", "▁")])
    c = tokens.Counter(pieces)
    texts = [r[1] for r in made if r[1]] + ["  two  spaces ", "naïve 東京 テスト ☃", "x▁y"]
    for text in texts:
        if len(text) < 4000:
            assert c.count(text) == len(t.encode(text, add_special_tokens=False).ids), text


def test_tokens_ties_and_memo():
    pieces = [("▁", -1.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁a", -2.0), ("aba", -3.0)]
    for memo in (1, 1000):
        c = tokens.Counter(pieces, memo)
        for text in ("a", "ab", "aba", "abab", "ab ab", "zé", "", "abba aab"):
            assert c.count(text) == viterbi_plain(text, pieces), text


# --- toxicity ------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(700):
        toxic = i % 5 == 0
        w = prose(rng, rng.randint(20, 120)).split()
        if toxic:
            for _ in range(2):
                w.insert(rng.randrange(len(w)), rng.choice(["idiot", "moron", "scum"]))
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(toxic)))
    rows += [(None, None), (1000, ""), (1001, None)]
    labels += [(1000, 1, 0), (1001, 0, None), (None, 0, 1), (5000, 0, 1)]
    return (spark.createDataFrame(rows, "doc_id long, text string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_toxicity_on_held_out_rows(labelled):
    docs, labels = labelled
    model = toxicity.fit(docs, labels.where(~toxicity.held_out()))
    out = docs.select("doc_id", toxicity.held_out().alias("h"), toxicity.scorer(model)("text").alias("p")).collect()
    assert len(out) == 703 and all(0 <= r.p <= 1 for r in out)
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out if r.doc_id is not None)
    held = [(r.p >= 0.3, r.doc_id % 5 == 0) for r in out if r.h and r.doc_id is not None and r.doc_id < 1000]
    assert len(held) > 100 and sum(a == b for a, b in held) / len(held) > 0.95
    again = toxicity.fit(docs.repartition(3), labels.where(~toxicity.held_out()))
    assert np.allclose(model[0], again[0]) and np.isclose(model[1], again[1])


def test_toxicity_filter_and_single_class(labelled):
    docs, labels = labelled
    kept = toxicity.reject_toxic(docs.withColumn("_label", F.lit("x")), labels)
    assert kept.columns == ["doc_id", "text", "_label"]
    ids = {r.doc_id for r in kept.collect()}
    assert len([i for i in range(700) if i % 5 and i not in ids]) < 10
    assert len([i for i in range(700) if i % 5 == 0 and i in ids]) < 20
    weights, b = toxicity.fit(docs, labels.where("toxic = 0"))
    assert not weights.any() and b < 0
    assert toxicity.fit(docs, labels.limit(0))[1] == 0


def test_grams_cover_blocks(monkeypatch):
    text = prose(random.Random(1), 3000)
    whole = {n for g in toxicity.grams(text) for n in g.tolist()}
    monkeypatch.setattr(toxicity, "_BLOCK", 101)
    assert {n for g in toxicity.grams(text) for n in g.tolist()} == whole
    assert [len(g) for g in toxicity.grams("")] == [] and len(whole) > 1000


# --- mixing --------------------------------------------------------------------------------------------------------


def test_mixing_reaches_targets(spark):
    rng = random.Random(9)
    texts = ["Plain words here", "A | table | row of it", "ALL CAPITALS", "more plain words that go on"]
    df = spark.createDataFrame(
        [(i, rng.choice(texts), rng.choice(["en", "en", "en", "de", None]), rng.choice(["s0", "s0", "s0", "s1", ""]))
         for i in range(900)] + [(None, texts[0], "en", "s0"), (3, texts[0], "en", "s0"), (900, None, "xx", "s9")],
        "doc_id long, text string, lang string, source string")
    rows = mixing.mix(df).collect()
    assert len(rows) == 903 and all(0 <= r.probability <= 1 for r in rows)
    assert max(r.probability for r in rows) == 1.0
    assert [r.probability for r in rows if r.doc_id == 900] == [0.0]
    for d in mixing.DIMS:
        total, raw = Counter(), Counter()
        for r in rows:
            total[r[d]] += r.probability * r.n_tokens
            raw[r[d]] += r.n_tokens
        p = {k: v ** mixing.TEMPERATURES[d] for k, v in raw.items() if v}
        for k, v in p.items():
            assert math.isclose(total[k] / sum(total.values()), v / sum(p.values()), rel_tol=1e-6), (d, k)
    for r in rows:
        u = int(hashlib.md5(f"1:{'' if r.doc_id is None else r.doc_id}".encode()).hexdigest()[:8], 16) / 2 ** 32
        assert r.sampled == (u < r.probability)


def test_mixing_given_targets_and_sample(spark, docs, made):
    made_ = {"source": [("s0", 0.5), ("s1", 0.5)], "lang": [("en", 1.0)], "topic": [("prose", 1.0)]}
    targets = {d: spark.createDataFrame(v, "level string, share double") for d, v in made_.items()}
    rows = mixing.mix(docs, targets=targets, rounds=3).collect()
    assert all(r.probability == 0 for r in rows if r.source not in ("s0", "s1") or r.topic != "prose")
    got = mixing.sample(docs, rounds=3)
    assert got.columns == [*docs.columns, "mix_topic", "mix_probability"]
    want = Counter(r.doc_id for r in mixing.mix(docs, rounds=3).collect() if r.sampled)
    assert Counter(r.doc_id for r in got.collect()) == want
    assert mixing.sample(docs.limit(0), rounds=1).count() == 0


def test_mixing_stops_at_the_tolerance_or_fails(spark, docs, monkeypatch):
    made_ = {"source": [("s0", 0.6), ("nowhere", 0.4)], "lang": [("en", 1.0)], "topic": [("prose", 1.0)]}
    targets = {d: spark.createDataFrame(v, "level string, share double") for d, v in made_.items()}
    monkeypatch.setattr(mixing, "MOST_ROUNDS", 3)
    with pytest.raises(ValueError, match="not met"):
        mixing.mix(docs, targets=targets)
    assert mixing.mix(docs, targets=targets, rounds=2).count() == docs.count()
    assert mixing.mix(docs.limit(0)).count() == 0


# --- language model ------------------------------------------------------------------------------------------------


def test_language_model_base_equals_plain(docs, made):
    marked = docs.withColumn("held_out", language_model.held_out())
    got = language_model.score(marked, segment=300, bucket=200).collect()
    split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(t or "")) + ["\n"]
    out = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1
    c = Counter(w for r in made if not out(r[0]) for w in split(r[1]))
    n, v = sum(c.values()), len(c)
    want = sorted((str(r[0]), out(r[0]), len(split(r[1])), sum(c[w] > 0 for w in split(r[1])), n,
                   round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in split(r[1])), 6)) for r in made)
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
                  for r in got) == want
    held = [r for r in got if r.held_out and r.n_tokens > 20]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    whole = language_model.score(marked.repartition(1), segment=300).collect()
    again = language_model.score(marked.repartition(1), segment=300).collect()
    assert whole == again


def test_language_model_without_training_or_rows(docs):
    none = language_model.score(docs.withColumn("held_out", F.lit(True))).collect()
    assert all(r.score == 0 and r.train_tokens == 0 and r.n_known == 0 for r in none)
    assert language_model.score(docs.limit(0).withColumn("held_out", F.lit(False))).count() == 0


def test_language_model_adds_up_to_one():
    rng = np.random.default_rng(3)
    n = 40
    types = np.unique(np.stack([rng.integers(0, n, 400), rng.integers(90, 99, 400) * 257]), axis=1)
    types = np.vstack([types, rng.integers(1, 30, types.shape[1])]).astype(np.int64)
    types[0] = np.unique(types[0], return_inverse=True)[1]
    words = types[0].max() + 1
    b = language_model.Bucket(np.arange(words, dtype=np.uint64), types)
    totals = lambda: language_model.Totals([
        dict(zip(("level", "context", "customers", "tables"), r)) for r in b.totals()])
    for _ in range(5):
        m = totals()
        for two in (types[1][0], 12_345, language_model.START_TWO):
            asked = np.arange(-1, words)
            assert math.isclose(b.predict(m, asked, np.full(len(asked), two)).sum(), 1, rel_tol=1e-9)
        b.sweep(m, rng)
        # customers of a restaurant are the tables below it
        assert (b.low.customers() == types[2]).all()
        assert b.middle.customers().sum() == b.low.tables().sum()
        assert b.top.customers().sum() == b.middle.tables().sum()
        assert (b.low.tables() <= types[2]).all() and (b.low.size > 0).all()


def test_seating_follows_the_posterior():
    """Table counts of one dish under many Gibbs moves against their exact law."""
    d, opening, c = 0.5, 1.5, 4
    law = {}

    def grow(tables, i, p):
        if i == c:
            law[len(tables)] = law.get(len(tables), 0) + p
            return
        grow([*tables, 1], i + 1, p * opening)
        for k in range(len(tables)):
            grow(tables[:k] + [tables[k] + 1] + tables[k + 1:], i + 1, p * (tables[k] - d))
    grow([1], 1, opening)
    n = 4000
    s = language_model.Seating.one_table(np.full(n, c))
    rng = np.random.default_rng(1)
    for _ in range(40):
        s.leave(np.arange(n), rng)
        s.come(np.arange(n), np.full(n, opening), d, rng)
    got = np.bincount(s.tables(), minlength=c + 1)[1:] / n
    want = np.array([law[k] for k in range(1, c + 1)]) / sum(law.values())
    assert np.abs(got - want).max() < 0.03


@pytest.mark.parametrize("few", [1, 10 ** 9])
def test_every_customer_is_reseated(monkeypatch, few):
    """A few sweeps over dishes of 60 customers reach the exact law, moved side by side and dish by dish."""
    monkeypatch.setattr(language_model, "FEW", few)
    n, c, d, opening = 500, 60, 0.75, 4.0
    law = np.zeros(c + 2)
    law[1] = 1
    for i in range(1, c):  # weights of table counts as customers come
        law = np.append(0, law[:-1]) * opening + law * np.maximum(i - d * np.arange(c + 2), 0)
    law /= law.sum()
    s, rng = language_model.Seating.one_table(np.full(n, c)), np.random.default_rng(4)
    for _ in range(8):
        s.reseat(np.full(n, c), np.full(n, opening), d, rng)
        assert (s.customers() == c).all()
    mean = (law * np.arange(c + 2)).sum()
    spread = ((law * np.arange(c + 2) ** 2).sum() - mean ** 2) ** 0.5
    assert abs(s.tables().mean() - mean) < 5 * spread / n ** 0.5 and abs(s.tables().std() / spread - 1) < 0.2
    # others come and leave until there are as many as wanted
    wanted = np.arange(n) % 7
    s.reseat(wanted, np.full(n, opening), d, rng)
    assert (s.customers() == wanted).all() and (s.tables() <= wanted).all() and (s.size > 0).all()
    s.reseat(np.full(n, 20), np.full(n, opening), d, rng)
    assert (s.customers() == 20).all() and (np.diff(s.owner) >= 0).all()


def test_a_sweep_moves_more_than_one_customer_of_a_dish():
    types = np.array([[0, 0, 1], [97 * 257, 98 * 257, 99 * 257], [3000, 2000, 1]], np.int64)
    b = language_model.Bucket(np.arange(2, dtype=np.uint64), types)
    m = language_model.Totals([dict(zip(("level", "context", "customers", "tables"), r)) for r in b.totals()])
    m.t2[:] = 30
    b.sweep(m, np.random.default_rng(1))
    assert (b.low.tables()[:2] > 4).all()
    assert (b.low.customers() == types[2]).all() and b.middle.customers().sum() == b.low.tables().sum()
    assert b.top.customers().sum() == b.middle.tables().sum()


def test_seating_is_counted_once_for_all_segments(monkeypatch):
    """Every segment asks of the same seating: its tables are not counted again for each of them."""
    m = language_model.Totals([])
    b = language_model.Bucket(np.arange(2, dtype=np.uint64), np.array([[0, 1], [97 * 257, 98 * 257], [5, 1]], np.int64))
    word, two = np.array([0, 1, -1]), np.full(3, 97 * 257)
    plain, seen, calls = b.predict(m, word, two), b.seen(m), []
    monkeypatch.setattr(language_model.Seating, "tables", lambda self: calls.append(1))
    assert (b.predict(m, word, two, seen) == plain).all() and not calls


def test_stored_seats_are_the_same_seats():
    rng = np.random.default_rng(1)
    s = language_model.Seating.one_table(np.array([0, 5, 1, 0, 900, 0]))
    s.reseat(np.array([0, 5, 1, 0, 900, 0]), np.full(6, 3.0), 0.75, rng)
    again = language_model.Seating.unpacked(*s.packed())
    assert again.dishes == 6 and (again.owner == s.owner).all() and (again.size == s.size).all()


def test_whole_words_are_contexts(spark):
    """Words that end alike have successors of their own."""
    held = [("qab red",), ("qab blue",), ("zab red",), ("zab blue",)]
    rows = [(i, t, False) for i, t in enumerate(["qab red", "zab blue"] * 50)] + [
        (1000 + i, *t, True) for i, t in enumerate(held)]
    got = language_model.score(spark.createDataFrame(rows, "doc_id long, text string, held_out boolean"), bucket=3)
    red, blue, other_red, other_blue = (r.score for r in got.where("held_out").orderBy("doc_id").collect())
    assert red > blue + 1 and other_blue > other_red + 1


def test_contexts_of_words_add_up_to_one():
    """Probabilities of all words and an unknown one after each word, before and after sweeps; customers are tables below."""
    rng, n = np.random.default_rng(3), 30
    hashes, classes = np.sort(rng.integers(0, 2 ** 63, 12).astype(np.uint64)), rng.integers(97, 99, 12) * 257
    known = language_model.context_of(hashes, classes)
    assert (language_model.two_of(known) == classes).all()
    word, context = (x.ravel() for x in np.meshgrid(np.arange(n + 1), np.arange(12), indexing="ij"))
    customers = np.where((word < n) & (context < 11), rng.integers(0, 40, len(word)) * rng.integers(0, 2, len(word)), 0)
    customers[(word < n) & (context == 0)] = 1  # word n and the last context are in no training text
    b = language_model.Pairs(np.arange(n + 1, dtype=np.uint64), known, np.array([word, context, customers]))
    for _ in range(4):
        m = language_model.Totals([dict(zip(("level", "context", "customers", "tables"), r)) for r in b.totals()])
        assert (m.v, m.n) == (n, customers.sum())
        c, t = b.shares()
        above = b.above
        assert np.allclose(above.of_types(m), above.predict(m, above.types[0], above.types[1]), rtol=1e-12)
        assert np.allclose(np.bincount(context, b.predict(m, c, t)), 1, rtol=1e-9)
        seats = [bytes(x) for x in b.seats()]
        again = language_model.Pairs(b.words, known, b.types, seats)
        assert again.seats() == seats and (again.predict(m, c, t) == b.predict(m, c, t)).all()
        b.sweep(m, t, rng)
        assert (b.low.customers() == customers).all()
        assert b.above.low.customers().sum() == b.low.tables().sum()
        assert b.above.middle.customers().sum() == b.above.low.tables().sum()
        assert b.above.top.customers().sum() == b.above.middle.tables().sum()
        assert b.low.tables().sum() > (customers > 0).sum()


def test_restaurants_of_words_are_summed_over_buckets():
    pack, unpack = language_model.pack, language_model.unpack
    known = [np.array(x, np.uint64) << np.uint64(60) for x in ([1, 5, 12], [5, 6, 12, 15])]
    shares = pd.DataFrame([r | {"bucket": i} for i, k in enumerate(known) for r in language_model._shares(
        k, np.arange(len(k)) + 1, np.ones(len(k), int), 3)])
    replies = pd.concat([language_model._summed((k,), g) for k, g in shares.groupby("shard")])
    assert shares["shard"].nunique() > 1
    for i, (customers, tables) in enumerate((([1, 3, 6], [1, 2, 2]), ([3, 2, 6, 4], [2, 1, 2, 1]))):
        c, t = language_model._replied(replies[replies["bucket"] == i])
        assert c.tolist() == customers and t.tolist() == tables
    assert unpack(shares.iloc[0]["known"]).tolist() == (known[0][:2]).tolist()


def test_packed_numbers():
    for x in ([], [0], [1, 2, 300, 70_000], [2 ** 64 - 1, 0, 5]):
        assert language_model.unpack(language_model.pack(np.array(x, np.uint64))).tolist() == x
    assert language_model.unpack(language_model.pack(np.array([3, 9, 2 ** 63], np.uint64), True)).tolist() == [3, 9, 2 ** 63]


# --- empty tables, NULLs in every column, clashing names -----------------------------------------------------------

CLASH = ["row", "_row", "_id", "_text", "_found", "_hit", "_draw", "_source", "_level_source", "_topic", "hash", "span",
         "code", "c", "n", "found", "root", "node", "mix_topic", "probability", "a b", "segment"]


def test_clashing_names_and_nulls(spark):
    rows = [(1, "a plain text of words", "en", "s"), (None, None, None, None), (2, None, "en", None), (3, "", None, "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for name in CLASH:
        df = df.withColumn(name, F.lit("x"))
    bench = spark.createDataFrame([(None, None), (1, None), (None, "a plain")], "item_id long, text string")
    labels = spark.createDataFrame([(None, None, None), (1, 0, None), (2, 1, 1)], "doc_id long, quality int, toxic int")
    for how in ({}, {"words": 5}):
        one = simhash.keep_one(df, **how)
        assert one.columns == df.columns and sorted(r.doc_id for r in one.collect()) == [1, 2]
    assert decontaminate.clean(df, bench).count() == 3 and decontaminate.clean(df, bench).columns == df.columns
    assert pii.mask(df).columns == df.columns and pii.mask(df).count() == 4
    assert toxicity.reject_toxic(df, labels, threshold=1.1).count() == 4
    out = mixing.sample(df, rounds=2)
    assert out.columns == [c for c in df.columns if c != "mix_topic"] + ["mix_topic", "mix_probability"]
    assert [r.doc_id for r in out.collect()] == [1]
    assert mixing.mix(df, rounds=2).count() == 4 and licenses.scan(df).count() == 4 and sentences.remove_repeats(df).count() == 4
    assert language_model.score(df.withColumn("held_out", F.lit(None).cast("boolean"))).count() == 4
    assert [r.n for r in df.select(tokens.counter([("a", -1.0)])("text").alias("n")).orderBy("n").collect()][:3] == [0, 0, 0]


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for out in (simhash.near_duplicates(none), simhash.keep_one(none), simhash.keep_one(none, words=5), sentences.remove_repeats(none), pii.find(none),
                pii.mask(none), licenses.scan(none), none.select(tokens.counter([("a", -1.0)])("text")),
                toxicity.reject_toxic(none, labels), mixing.mix(none, rounds=1)):
        assert out.count() == 0
