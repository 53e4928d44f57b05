"""Pairs of texts with a given Jaccard similarity of word shingles: runs of two, lossless bounds, exact check."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartorio.llm.common import Scratch, components

#: Texts whose shingles are counted to know frequent ones, and how many of these are kept at the most.
SAMPLE, FREQUENT = 10_000, 100_000
#: Groups that the partners of one text are dealt to when they are checked.
DEALT = 64
#: Pairs of texts of different components that a run may give for each of its texts; where it gives more, its
#: texts get a second prefix.
CROWD = 1
_SLACK = 1e-9
_POST = "fp long, n int, gram long, pos int"
_PAIR = "a long, b long"
_SKETCH = "fp long, n int, odd binary, head array<long>"
#: Mixes the hash of a shingle with that of the next one.
_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of a text's runs of ``words`` words (of all its words where there are fewer)."""
    w = (text or "").encode().lower().split()
    if not w:
        return np.zeros(0, np.uint64)
    k, parts = min(words, len(w)), []
    n = len(w) - k + 1
    for at in range(0, n, 1 << 15):
        part = w[at:at + (1 << 15) + k - 1]
        parts.append(np.array([xxhash.xxh64_intdigest(b" ".join(g)) for g in zip(*(part[i:] for i in range(k)))],
                              np.uint64))
    return np.unique(np.concatenate(parts))


def least(n, similarity: float):
    """Shingles that a text of ``n`` has in common with any text as similar as that."""
    return np.ceil(similarity * n - _SLACK).astype(np.int64)


def _longs(x: np.ndarray):
    return pa.array(x.view(np.int64), pa.int64())


def _grams(words: int):
    def run(batches):
        for b in batches:
            for text in b.column(b.num_columns - 1).to_pylist():
                yield pa.RecordBatch.from_arrays([_longs(shingles(text, words))], ["gram"])
    return run


def _frequent(texts: DataFrame, words: int) -> np.ndarray:
    """Shingles that a sample of texts has most, the rarer first. It only orders the prefixes: any order is right."""
    share = max(1, texts.count() // SAMPLE)
    rows = texts.where(F.pmod(F.xxhash64("fp"), F.lit(share)) == 0).select("text").mapInArrow(_grams(words), "gram long")
    top = rows.groupBy("gram").count().where("count > 2").orderBy(F.desc("count"), "gram").limit(FREQUENT)
    return top.select("gram").toArrow().column("gram").to_numpy().astype(np.int64).view(np.uint64)[::-1]


def _runs(g: np.ndarray, similarity: float):
    """``(hashes, places)`` by which a text is found, of its shingles ``g`` in the common order (see ``links``).

    Hashes are of two shingles in a row. Where a partner so small is possible that two similar texts need not have
    two in a row, single ones are given as well.
    """
    n = len(g)
    both = np.arange(max(0, min(n - 1, int(2 * (1 - similarity) * n + _SLACK) + 1)))
    runs, low = (g[both] * _MIX) ^ g[both + 1], int(least(n, similarity))
    if (3 * similarity / (1 + similarity) - 1) * (n + low) > 1 + _SLACK:
        return runs, both
    one = np.arange(n - low + 1)
    return np.concatenate([runs, g[one]]), np.concatenate([both, one])


def _prefixes(words: int, similarity: float, frequent: np.ndarray):
    order = np.argsort(frequent)
    known, rank = frequent[order], order + 1

    def batch(rows):
        sizes = [len(g) for _, _, g, _ in rows]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.array([r[0] for r in rows], np.int64), sizes)),
             pa.array(np.repeat(np.array([r[1] for r in rows], np.int32), sizes)),
             _longs(np.concatenate([r[2] for r in rows])),
             pa.array(np.concatenate([r[3] for r in rows]).astype(np.int32))],
            [c.split()[0] for c in _POST.split(", ")])

    def run(batches):
        met = set()  # a task gives each text once, so copies do not fill the exchange
        for b in batches:
            rows, held = [], 0
            for fp, text in zip(*(c.to_pylist() for c in b.columns)):
                if fp in met:
                    continue
                met.add(fp)
                g = shingles(text, words)
                n = len(g)
                if not n:
                    continue
                heavy = np.zeros(n, np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, g), len(known) - 1)
                    heavy = np.where(known[at] == g, rank[at], 0)
                rows.append((fp, n, *_runs(g[np.lexsort((g, heavy))], similarity)))
                held += len(rows[-1][2])
                if held > 100_000:
                    yield batch(rows)
                    rows, held = [], 0
            if rows:
                yield batch(rows)
    return run


def sketch(grams: np.ndarray) -> bytes:
    """Whether the shingles of each class of hashes are odd in number: at least a class, and 1,024, for each shingle."""
    width = max(1024, 1 << max(len(grams) - 1, 0).bit_length())
    odd = np.bincount((grams & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def apart(x: bytes, y: bytes) -> int:
    """Shingles in which two sets differ, at the least; a longer sketch is folded to the length of the other."""
    x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
    if len(x) < len(y):
        x, y = y, x
    while len(x) > len(y):
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


def _head(odd: bytes) -> list[int]:
    """A sketch folded to 1,024 classes, as longs: what Spark compares by itself."""
    x = np.frombuffer(odd, "<i8")
    while len(x) > 16:
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    return x.tolist()


def _sketches(words: int):
    def run(batches):
        met = set()
        for b in batches:
            rows = []
            for fp, text in zip(*(c.to_pylist() for c in b.columns)):
                if fp not in met:
                    met.add(fp)
                    g = shingles(text, words)
                    if len(g):
                        rows.append((fp, len(g), odd := sketch(g), _head(odd)))
            cols = list(zip(*rows)) if rows else [[], [], [], []]
            kinds = [pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(cols, kinds)], ["fp", "n", "odd", "head"])
    return run


def _close(similarity: float):
    def run(batches):
        for b in batches:
            most = (1 - similarity) / (1 + similarity)  # of both sizes together
            keep = [apart(x, y) <= most * (n + m) + _SLACK and min(n, m) >= similarity * max(n, m) - _SLACK
                    for _, _, n, m, x, y in zip(*(c.to_pylist() for c in b.columns))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _narrowed(pairs: DataFrame, sketches: DataFrame, similarity: float) -> DataFrame:
    """Those of ``pairs(a, b)`` whose sketches of 1,024 classes do not rule out that they are similar enough."""
    heads = sketches.select("fp", "n", "head")
    rows = pairs.join(heads.toDF("a", "n", "x"), "a").join(heads.toDF("b", "m", "y"), "b")
    differ = F.aggregate(F.zip_with("x", "y", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda x, y: x + y)
    most = (1 - similarity) / (1 + similarity)  # of both sizes together
    return rows.where(differ <= (F.col("n") + F.col("m")) * most + _SLACK).select("a", "b")


def _possible(pairs: DataFrame, sketches: DataFrame, similarity: float, scratch: Scratch) -> DataFrame:
    """Those of ``pairs(a, b)`` whose sketches do not rule out that they are similar enough."""
    whole = sketches.select("fp", "n", "odd")
    rows = pairs.join(whole.toDF("a", "n", "x"), "a").join(whole.toDF("b", "m", "y"), "b")
    return scratch.store(rows.select("a", "b", "n", "m", "x", "y").mapInArrow(_close(similarity), _PAIR))


def _alike(words: int, similarity: float):
    """Over groups of one text (``side`` 0, first) and its partners: those partners that are similar enough."""
    def run(batches):
        key, own = None, None
        for b in batches:
            out = []
            for a, deal, side, fp, text in zip(*(c.to_pylist() for c in b.columns)):
                if not side:
                    key, own = (a, deal), shingles(text, words)
                elif key == (a, deal):
                    other = shingles(text, words)
                    both = len(np.intersect1d(own, other, assume_unique=True))
                    if both >= similarity * (len(own) + len(other) - both) - _SLACK:
                        out.append((a, fp))
            cols = list(zip(*out)) if out else [[], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["a", "b"])
    return run


def verified(pairs: DataFrame, texts: DataFrame, words: int, similarity: float, scratch: Scratch) -> DataFrame:
    """Those of the distinct ``pairs(a, b)`` whose sets of shingles are similar enough, by the sets themselves.

    The text of ``a`` goes once to each of the at most ``DEALT`` groups its partners are dealt to, that of ``b`` once
    a pair; a group is read as a stream. ``texts(fp, text)`` are brought down to the ends of pairs first, a row each.
    """
    deal = F.pmod(F.xxhash64("b"), F.lit(DEALT)).cast("int").alias("deal")
    members = pairs.select("a", deal, F.lit(1).alias("side"), F.col("b").alias("fp"))
    sides = members.unionByName(members.select(
        "a", "deal", F.lit(0).alias("side"), F.col("a").alias("fp")).distinct())
    ends = pairs.select(F.explode(F.array("a", "b")).alias("fp")).distinct()
    held = scratch.store(texts.select("fp", "text").join(ends, "fp", "left_semi").groupBy("fp").agg(
        F.min("text").alias("text")))
    rows = sides.join(held, "fp").select("a", "deal", "side", "fp", "text").repartition("a", "deal")
    out = scratch.store(rows.sortWithinPartitions("a", "deal", "side").mapInArrow(_alike(words, similarity), _PAIR))
    scratch.drop(held)
    return out


def _every(words: int):
    def run(batches):
        for b in batches:
            for fp, text in zip(*(c.to_pylist() for c in b.columns)):
                g = shingles(text, words)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(g), fp, np.int64)), _longs(g)], ["fp", "gram"])
    return run


def _second(words: int, similarity: float):
    """Prefixes of ``fp, root, text, held, counts`` in the order of ``counts`` of the ``held`` shingles, others first."""
    def run(batches):
        for b in batches:
            for fp, root, text, held, counts in zip(*(c.to_pylist() for c in b.columns)):
                g = shingles(text, words)
                n, heavy = len(g), np.zeros(len(g), np.int64)
                if held:
                    heavy[np.searchsorted(g, np.array(held, np.int64).view(np.uint64))] = counts
                size = n - int(least(n, similarity)) + 1
                yield pa.RecordBatch.from_arrays(
                    [_longs(g[np.lexsort((g, heavy))[:size]]), pa.array(np.full(size, fp, np.int64)),
                     pa.array(np.full(size, n, np.int32)), pa.array(np.arange(size, dtype=np.int32)),
                     pa.array(np.full(size, root, np.int64))], ["gram", "fp", "n", "pos", "root"])
    return run


def _joined(post: DataFrame, allowed) -> DataFrame:
    return post.alias("p").join(post.alias("q"), (F.col("p.gram") == F.col("q.gram")) & (
        F.col("p.fp") < F.col("q.fp")) & allowed).select(F.col("p.fp").alias("a"), F.col("q.fp").alias("b"))


def _early(similarity: float, of: str = ""):
    """Whether a run can be the first common one of its text and another that is no smaller (see ``links``)."""
    n, pos = F.col(f"{of}n"), F.col(f"{of}pos")
    return pos <= n * (3 - 6 * similarity / (1 + similarity)) + _SLACK


def _placed(similarity: float, runs: bool):
    """Whether what ``p`` and ``q`` share can be the first they share, runs or single shingles (see ``links``)."""
    left = F.least(F.col("p.n") - F.col("p.pos"), F.col("q.n") - F.col("q.pos"))
    if runs:
        left = left + F.least(F.col("p.pos"), F.col("q.pos"), (F.col("p.pos") + F.col("q.pos")) / 3)
    # J >= s: common >= s / (1 + s) of both sizes together
    return left >= (F.col("p.n") + F.col("q.n")) * (similarity / (1 + similarity)) - _SLACK


def _remaining(post: DataFrame, texts: DataFrame, words: int, similarity: float, allowed, scratch: Scratch):
    """``(a, b)`` of ``post(gram, fp, n, pos, root)``: all pairs of different roots that can be similar enough.

    A run with few such pairs for its texts gives them all. Texts of the others, crowded ones, are all texts that
    have one, so their pairs lie among these texts. They get prefixes of single shingles in another common order: shingles
    of two or more components (of one text of each) stand last, the rarer of these first. A passage in many texts that are
    otherwise different is then in no prefix, as far as a text has enough besides it, and copies edited too much stand
    first by what is their own. All components are counted: a shingle that a count of some passes over would stand first
    in all texts that have it and pair them all. Pairs of two late places are neither given nor counted.
    """
    by_root = post.groupBy("gram", "root").agg(
        F.count("*").alias("k"), F.sum((~_early(similarity)).cast("long")).alias("l"))
    crowds = scratch.store(by_root.groupBy("gram").agg(
        F.sum("k").alias("m"), F.sum(F.col("k") * F.col("k")).alias("same"),
        F.sum("l").alias("late"), F.sum(F.col("l") * F.col("l")).alias("same_late")).where(
        f"m * m - same - (late * late - same_late) > {2 * CROWD} * m").select("gram"))
    either = _early(similarity, "p.") | _early(similarity, "q.")
    pairs = _joined(post.join(crowds, "gram", "left_anti"), allowed & either & _placed(similarity, True))
    members = post.join(crowds, "gram", "left_semi").select("fp", "root").distinct()
    own = scratch.store(texts.join(members, "fp").groupBy("fp", "root").agg(F.min("text").alias("text")))
    every = own.select("fp", "text").mapInArrow(_every(words), "fp long, gram long")
    counted = own.join(own.groupBy("root").agg(F.min("fp").alias("fp")), ["root", "fp"], "left_semi").select(
        "text").mapInArrow(_grams(words), "gram long")
    heavy = scratch.store(counted.groupBy("gram").agg(F.count("*").cast("int").alias("m")).where("m > 1"))
    held = every.join(heavy, "gram").groupBy("fp").agg(
        F.collect_list(F.struct("gram", "m")).alias("h")).select("fp", F.col("h.gram").alias("held"), F.col("h.m").alias("counts"))
    again = scratch.store(own.join(held, "fp", "left").select("fp", "root", "text", "held", "counts").mapInArrow(
        _second(words, similarity), "gram long, fp long, n int, pos int, root long"))
    scratch.drop(own)
    scratch.drop(heavy)
    return pairs.unionByName(_joined(again, allowed & _placed(similarity, False))), [crowds, again]


def links(texts: DataFrame, words: int, similarity: float, scratch: Scratch, first: DataFrame | None = None):
    """Pairs ``(a, b)`` and their components ``(node, root)``, None where there is no pair, of ``texts(fp, text)``.

    Rows of one ``fp`` are copies. All pairs given are as similar as asked, and any two texts as similar as asked are
    linked by a chain of them: no such pair is lost. ``first(a, b)`` are pairs to look at first.

    Each text's shingles stand in one common order, frequent ones last. Two texts of n and m shingles, c in common, differ
    in d = n + m - 2c; merged, these leave d + 1 gaps, and c >= s / (1 + s) * (n + m) is more than that for s over a half,
    so some gap has two common ones: both texts have them in a row. Texts are found by such runs of two, which few
    texts share by chance, however many there are. Texts so small that c may be d + 1 are found by single shingles too.
    Before the first common run at the places i and j stand k common ones, each in a gap of its own: k <= (i + j) / 3.
    Enough must be left: k + min(n - i, m - j) >= c. So i <= 2 (1 - s) n, and i <= (3 - 6s / (1 + s)) n in the smaller
    text, "early"; every similar pair has such a run, and others need not give it again.

    In one exchange by run those that one text alone has are dropped, and those early in none. Every text is held against
    one text of each of its runs, first the smallest, then one by chance, another for each run, so a large group of near copies
    becomes one component by stars; runs whose texts are all in one component are dropped. Then all pairs that share a
    run and are in different components are looked at, as far as sizes and places allow them; where a run would
    give many such pairs, its texts are looked at by a second prefix (``_remaining``). It ends when no run is left.

    Before texts are compared, sketches of about a bit for each shingle rule out most pairs that are not similar:
    sets differ in at least as many shingles as their counts by class differ in parity. Sketches folded to 1,024 bits
    are compared first.

    NULL texts and texts without words have no shingles and link with nothing; so does a NULL ``fp``. An empty
    table gives no pairs. Other columns are ignored.
    """
    texts = texts.select("fp", "text").where("fp is not null")
    post = texts.mapInArrow(_prefixes(words, similarity, _frequent(texts, words)), _POST)
    by_gram = Window.partitionBy("gram").orderBy("fp")
    once = post.withColumn("last", F.lag("fp").over(by_gram)).where("last is null or last <> fp").drop("last")
    whole = Window.partitionBy("gram")
    shared = scratch.store(once.withColumn("before", F.lag("fp").over(by_gram)).withColumn(
        "after", F.lead("fp").over(by_gram)).where("before is not null or after is not null").drop(
        "before", "after").withColumn("early", F.max(_early(similarity)).over(whole)).where("early").drop("early"))
    sketches = scratch.store(texts.mapInArrow(_sketches(words), _SKETCH).groupBy("fp").agg(
        F.first("n").alias("n"), F.first("odd").alias("odd"), F.first("head").alias("head")))
    found = tried = roots = None
    if first is not None:
        tried = scratch.store(first.select("a", "b").where("a <> b").distinct())
        found = verified(_possible(tried, sketches, similarity, scratch), texts, words, similarity, scratch)
        roots = None if found.isEmpty() else components(found, scratch)
    allowed = (F.col("p.root") != F.col("q.root")) & (
        F.least("p.n", "q.n") >= F.greatest("p.n", "q.n") * similarity - _SLACK)
    columns = ["gram", "fp", "n", "pos"]
    for way in ("low", "mixed", "all"):
        placed = shared.withColumn("root", F.col("fp"))
        if roots is not None:
            placed = shared.select(columns).join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
                *columns, F.coalesce("root", "fp").alias("root"))
        open_ = placed.withColumn("r", F.min("root").over(whole)).withColumn("s", F.max("root").over(whole)).where("r < s")
        open_ = scratch.store(open_.select(*columns, "root"))
        scratch.drop(shared)
        shared, done = open_, []
        if open_.isEmpty():
            break
        if way == "all":
            pairs, done = _remaining(open_, texts, words, similarity, allowed, scratch)
        else:
            order = Window.partitionBy("gram").orderBy(*(["fp"] if way == "low" else [F.xxhash64("fp", "gram"), "fp"]))
            pairs = open_.select(F.struct("*").alias("q"), F.first(F.struct("*")).over(order).alias("p")).where(
                F.col("p.fp") != F.col("q.fp")).where(allowed & _placed(similarity, True)).select(F.col("p.fp").alias("a"), F.col("q.fp").alias("b"))
        pairs = pairs.distinct()
        if tried is not None:  # what was looked at before is known already
            both = tried.unionByName(tried.select(F.col("b").alias("a"), F.col("a").alias("b")))
            pairs = pairs.join(both, ["a", "b"], "left_anti")
        pairs = scratch.store(_narrowed(pairs, sketches, similarity))
        for t in done:
            scratch.drop(t)
        alike = verified(_possible(pairs, sketches, similarity, scratch), texts, words, similarity, scratch)
        tried = pairs if tried is None else tried.unionByName(pairs)
        found = alike if found is None else found.unionByName(alike)
        if not alike.isEmpty():  # else the components are what they were
            old, edges = roots, alike.select("a", "b")
            if old is not None:  # components so far are stars already
                edges = edges.unionByName(old.select(F.col("node").alias("a"), F.col("root").alias("b")))
            roots = components(edges, scratch)
            if old is not None:
                scratch.drop(old)
    scratch.drop(shared)
    if found is None:  # no two texts share anything
        found = scratch.spark.createDataFrame([], _PAIR)
    return found, roots
