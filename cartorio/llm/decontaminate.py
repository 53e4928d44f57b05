"""Benchmark decontamination over a positional inverted index of the training texts."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartorio.llm.common import Scratch, query, table
from cartorio.llm.words import words_of

#: Positions left free between two documents of a segment, so that no match reaches over.
GAP = 64
_INDEX = ("segment string, ids array<bigint>, keys array<bigint>, sizes array<bigint>, "
          "terms binary, counts binary, positions binary")
_MATCHED = "segment string, row int, windows array<bigint>, near array<bigint>, hits array<struct<s:int,e:int>>"


def _pack(x: np.ndarray) -> bytes:
    """32-bit numbers as compressed byte planes of their differences."""
    steps = np.diff(x.astype("<i4"), prepend=np.int32(0)).astype("<i4")
    return zstandard.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 4).T).tobytes(), 1)


def _unpack(blob: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(bytes(blob)), np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(raw.T).view("<i4").ravel(), dtype=np.int64)


def _indexer(segment_words: int):
    def run(batches):
        part, made = TaskContext.get().partitionId(), 0
        ids, keys, sizes, of, tokens = [], [], [], {}, []

        def segment():
            flat = np.concatenate([np.asarray(t, np.int32) for t in tokens]) if tokens else np.zeros(0, np.int32)
            n = np.array(sizes, np.int64)
            start = np.concatenate([[0], np.cumsum(n + GAP)[:-1]])
            where = np.arange(len(flat)) + np.repeat(start - np.concatenate([[0], np.cumsum(n)[:-1]]), n)
            order = np.argsort(flat, kind="stable")
            return pa.RecordBatch.from_arrays([
                pa.array([f"{part}-{made}"]), pa.array([ids], pa.list_(pa.int64())),
                pa.array([keys], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int64())),
                pa.array([zstandard.compress(b" ".join(of), 1)]),
                pa.array([_pack(np.bincount(flat, minlength=len(of)))]), pa.array([_pack(where[order])])],
                ["segment", "ids", "keys", "sizes", "terms", "counts", "positions"])

        held = 0
        for b in batches:
            for i, key, text in zip(*(c.to_pylist() for c in b.columns)):
                w = words_of(text)
                tokens.append([of.setdefault(x, len(of)) for x in w])
                ids.append(i)
                keys.append(key)
                sizes.append(len(w))
                held += len(w) + GAP
                if held >= segment_words:
                    yield segment()
                    made, held, ids, keys, sizes, of, tokens = made + 1, 0, [], [], [], {}, []
        if ids:
            yield segment()
    return run


def positional_index(docs: DataFrame, segment_words: int = 400_000) -> DataFrame:
    """One row per segment of about ``segment_words`` words of whole documents, from ``docs(doc_id, text)``.

    A segment has its documents' ids and sizes, every term that occurs in it, and each term's posting list
    (positions counted through the segment, with a gap between documents). NULL texts have no words. A single
    document is never cut, so a segment is as large as the largest text at least. ``keys`` are text hashes.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"), "text") \
        .mapInArrow(_indexer(segment_words), _INDEX)


def _near(lists, span: int):
    """Starts of stretches of ``span`` words holding a posting of every list; lists from the shortest."""
    at = lists[0]
    for p in lists[1:]:
        i = np.searchsorted(p, at - span + 1)
        at = at[(i < len(p)) & (p[np.minimum(i, len(p) - 1)] < at + span)]
        if not len(at):
            return at
    starts = (at[:, None] - np.arange(span)).ravel()
    for p in lists:
        i = np.searchsorted(p, starts)
        starts = starts[(i < len(p)) & (p[np.minimum(i, len(p) - 1)] < starts + span)]
    return starts


def _terms(batches):
    """Every term of a segment with its count."""
    for b in batches:
        for segment, terms, counts in zip(*(c.to_pylist() for c in b.columns)):
            n = _unpack(counts)
            names = zstandard.decompress(terms).split(b" ") if len(n) else []
            yield pa.RecordBatch.from_arrays(
                [pa.array([segment] * len(n), pa.string()), pa.array(names, pa.binary()).cast(pa.string()),
                 pa.array(n.astype(np.int32))], ["segment", "term", "n"])


def _merged(spans):
    out = []
    for s, e in sorted(spans):
        if out and s <= out[-1]["e"]:
            out[-1]["e"] = max(e, out[-1]["e"])
        else:
            out.append({"s": s, "e": e})
    return out


def _match(slop: int):
    """A segment and the windows asked of it: a row per document with the windows it has, exactly or nearby."""
    def run(_, segment: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        names = ["segment", "row", "windows", "near", "hits"]
        if not len(segment) or not len(asked):
            return pd.DataFrame([], columns=names)
        row = segment.iloc[0]
        sizes = np.array(row["sizes"], np.int64)
        base = np.concatenate([[0], np.cumsum(sizes + GAP)[:-1]])
        counts, where = _unpack(row["counts"]), _unpack(row["positions"])
        ends = np.cumsum(counts)
        of = {t: i for i, t in enumerate(zstandard.decompress(bytes(row["terms"])).split(b" "))}
        exact, near, hits = {}, {}, {}
        for wid, window in zip(asked["wid"], asked["words"]):
            words = bytes(window).split(b" ")
            if not all(w in of for w in words):
                continue
            terms = [of[w] for w in words]
            lists = {t: where[ends[t] - counts[t]:ends[t]] for t in terms}
            order = sorted(range(len(terms)), key=lambda k: counts[terms[k]])  # the rarest term first
            starts = lists[terms[order[0]]] - order[0]
            for k in order[1:]:
                p = lists[terms[k]]
                i = np.searchsorted(p, starts + k)
                starts = starts[(i < len(p)) & (p[np.minimum(i, len(p) - 1)] == starts + k)]
                if not len(starts):
                    break
            for s, d in zip(starts, np.searchsorted(base, starts, "right") - 1):
                exact.setdefault(d, set()).add(wid)
                hits.setdefault(d, []).append((int(s - base[d]), int(s - base[d]) + len(words)))
            around = _near(sorted(lists.values(), key=len), len(words) + slop)
            for d in np.unique(np.searchsorted(base, np.maximum(around, 0), "right") - 1):
                near.setdefault(d, set()).add(wid)
        return pd.DataFrame([(row["segment"], d, sorted(exact.get(d, ())), sorted(near.get(d, ())),
                              _merged(hits.get(d, ()))) for d in sorted(exact.keys() | near.keys())], columns=names)
    return run


def _windows(size: int):
    def run(batches):
        for b in batches:
            names, texts = [], []
            for item, text in zip(*(c.to_pylist() for c in b.columns)):
                w = words_of(text)
                for i in range(max(len(w) - size, 0) + 1 if w else 0):
                    names.append(item)
                    texts.append(b" ".join(w[i:i + size]))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(texts, pa.binary())],
                                             ["item", "words"])
    return run


def benchmark_windows(benchmark: DataFrame, window: int = 10) -> DataFrame:
    """Distinct ``words, item``: runs of ``window`` words of ``benchmark(item_id, text)`` and an item that has them.

    A shorter item is one run, an item without words none. A NULL id is the empty id; repeated rows add nothing.
    """
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")), "text")
    return rows.mapInArrow(_windows(window), "item string, words binary").distinct()


def _asked(index: DataFrame, windows: DataFrame, scratch: Scratch) -> DataFrame:
    """``segment, wid, words``: the segments of ``index`` that hold the anchor of a window of ``windows(wid, words)``.

    The anchor is the word of a window that all segments together have least; ties go by the word. Windows with a
    word that no segment has are asked of none.
    """
    needed = scratch.store(windows.select("wid", F.explode(F.array_distinct(F.split(
        F.col("words").cast("string"), " "))).alias("term")))
    terms = index.select("segment", "terms", "counts").mapInArrow(_terms, "segment string, term string, n int")
    present = scratch.store(terms.join(needed.select("term").distinct(), "term", "left_semi"))
    total = present.groupBy("term").agg(F.sum("n").alias("n"))
    anchors = needed.join(total, "term", "left").groupBy("wid").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "term")).alias("a")).where("a.n > 0")
    at = anchors.select("wid", F.col("a.term").alias("term")).join(present, "term").select("segment", "wid")
    return scratch.store(at.join(windows, "wid").select("segment", "wid", "words"))


def matches(docs: DataFrame, benchmark: DataFrame, window: int = 10, slop: int = 2, block: int = 100_000):
    """Three stored tables: ``segment, row, doc_id, key, n_words`` of all rows of ``docs(doc_id, text)``; ``segment,
    row, windows, near, hits`` of those with windows; ``wid, item`` with the items that have a window.

    Windows are joined to the segments that hold their rarest word, and only these look for them: posting lists are
    intersected from the rarest term of the segment on, shifted by the term's place in the window. A segment that
    is asked for more than ``block`` windows is given to several tasks. Item ids stay out of the tasks.
    """
    if window + slop > GAP:
        raise ValueError(f"a window and its slop hold at most {GAP} words")
    scratch = Scratch(docs.sparkSession, "decontaminate")
    pairs = scratch.store(benchmark_windows(benchmark, window))
    windows = scratch.store(pairs.select("words").distinct().withColumn("wid", F.monotonically_increasing_id()))
    owners = scratch.store(pairs.join(windows, "words").select("wid", "item"))
    index = scratch.store(positional_index(docs))
    asked = _asked(index, windows, scratch)
    parts = scratch.store(asked.groupBy("segment").agg(F.ceil(F.count("*") / block).cast("int").alias("parts")))
    dealt = asked.join(parts, "segment").select(
        "segment", F.pmod(F.xxhash64("wid"), "parts").cast("int").alias("part"), "wid", "words")
    copies = index.select("segment", "sizes", "terms", "counts", "positions").join(parts, "segment").withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    found = scratch.store(copies.groupBy("segment", "part").cogroup(dealt.groupBy("segment", "part")).applyInPandas(
        _match(slop), _MATCHED))
    rows = index.select("segment", F.posexplode(F.arrays_zip("ids", "keys", "sizes")).alias("row", "d")).select(
        "segment", "row", F.col("d.ids").alias("doc_id"), F.col("d.keys").alias("key"), F.col("d.sizes").alias("n_words"))
    return rows, found, owners


def find(docs: DataFrame, benchmark: DataFrame, window: int = 10, slop: int = 2,
         block: int = 100_000) -> DataFrame:
    """For every row of ``docs(doc_id, text)``: ``doc_id, key, n_words, items, near, hits``.

    ``items`` have an exact window in the document, ``near`` have all words of a window, in any order, within
    ``slop`` more words than it has. ``hits`` are the words inside exact windows, as spans ``s`` to ``e``. For the way
    see ``matches``. Repeated rows are found alike, NULL and empty texts have no words; other columns are ignored.
    """
    rows, found, owners = matches(docs, benchmark, window, slop, block)
    at = ["segment", "row"]
    hits = found.groupBy(*at).agg(F.flatten(F.collect_list("hits")).alias("hits"))
    # every exact match is a near one
    named = found.select(*at, F.explode("near").alias("wid"), F.array_contains("windows", F.col("wid")).alias("exact")).join(
        owners, "wid").groupBy(*at, "item").agg(F.max("exact").alias("exact"))
    named = named.groupBy(*at).agg(
        F.collect_list(F.when(F.col("exact"), F.col("item"))).alias("items"), F.collect_list("item").alias("near"))
    out = rows.join(hits, at, "left").join(named, at, "left")
    none = F.array().cast("array<string>")
    return out.select("doc_id", "key", "n_words", F.coalesce("items", none).alias("items"),
                      F.coalesce("near", none).alias("near"),
                      F.coalesce("hits", F.array().cast("array<struct<s:int,e:int>>")).alias("hits"))


def hit_words(hits: str):
    """Number of words in spans that may overlap."""
    start = F.struct(F.lit(0).alias("e"), F.lit(0).cast("long").alias("n"))
    step = lambda a, x: F.struct(
        F.greatest(a.e, x.e).alias("e"),
        (a.n + F.greatest(F.lit(0), x.e - F.greatest(a.e, x.s))).cast("long").alias("n"))
    return F.aggregate(F.array_sort(hits), start, step, lambda a: a.n)


def clean(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` whose text holds no exact window of the benchmark, all columns as they are.

    NULL and empty texts stay, repeated rows stay or go together; an empty table or benchmark takes none away.
    """
    rows, found, _ = matches(docs, benchmark, **how)
    bad = rows.join(found.where(F.size("windows") > 0), ["segment", "row"], "left_semi").select(
        F.col("key").alias("_hit")).distinct()
    bad = Scratch(docs.sparkSession, "decontaminate").store(bad)
    kept = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    return kept.join(bad, F.xxhash64("_row.text") == F.col("_hit"), "left_anti").select("_row.*")


@query("op5_decontamination")
def op5(spark, sf_dir):
    found = find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", hit_words("hits").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
        (F.size("items") > 0).alias("contaminated"), F.size("near").cast("long").alias("n_near_items"))
