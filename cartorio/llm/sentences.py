"""Substring dedup: runs of consecutive sentences that stand elsewhere already are removed."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartorio.llm.common import Scratch, query, table

#: A sentence ends after its stop and the white space that follows, or with its line.
_SENTENCE = re.compile(r"[^.!?\n]*(?:[.!?]+(?=\s|$)|[.!?]+|\n|$)[^\S\n]*\n*")

#: Sentences of so many words are cut into pieces, on the average one for ``PIECE`` words.
LONG, PIECE = 20, 4
_WORD = re.compile(r"[^ \t\n\x0b\f\r]+[ \t\n\x0b\f\r]*")


def sentences(text: str | None) -> list[str]:
    """The sentences of a text, white space after them included: joined, they give the text back."""
    return [s for s in _SENTENCE.findall(text or "") if s]


def pieces(sentence: str) -> list[str]:
    """A long sentence cut after words that their own hash chooses, others whole; a word repeated at once ends none.

    Where a cut stands depends on a word and the one before it, so a passage is cut alike in any sentence.
    """
    words = _WORD.findall(sentence)
    if len(words) < LONG:
        return [sentence]
    words[0] = sentence[:len(sentence) - sum(map(len, words))] + words[0]  # white space before the first word
    out, start, before = [], 0, None
    for i, with_space in enumerate(words[:-1]):
        word = with_space.strip(" \t\n\x0b\f\r")
        if word != before and zlib.crc32(word.encode()) % PIECE == 0:
            out.append("".join(words[start:i + 1]))
            start = i + 1
        before = word
    return [*out, "".join(words[start:])]


def units(text: str | None) -> tuple[list[str], list[int]]:
    """The pieces of all sentences, which joined give the text back, and for each the number of its sentence."""
    parts, of = [], []
    for i, s in enumerate(sentences(text)):
        cut = pieces(s)
        parts += cut
        of += [i] * len(cut)
    return parts, of


def runs(parts: list[str], of: list[int], least_sentences: int, least_words: int) -> list[tuple[int, int, int]]:
    """``(hash, first, last)`` of the shortest long enough run from every unit on, and up to every unit.

    A run is of units with words; it reaches over ``least_sentences`` sentences and has ``least_words`` words, or has
    1.4 times that many words in fewer sentences. Words are compared as they stand, white space does not count. Runs
    in both directions cover a repeated passage up to its first and its last whole unit.
    """
    words = [p.encode().split() for p in parts]
    full = [i for i, w in enumerate(words) if w]
    line = [b" ".join(words[i]) for i in full]
    upto = np.concatenate([[0], np.cumsum([len(words[i]) for i in full])]).astype(np.int64)
    n, at, alone = len(full), np.arange(len(full)), -(-7 * least_words // 5)
    number = np.unique([of[i] for i in full], return_inverse=True)[1] if full else at
    ahead = np.minimum(np.maximum(np.searchsorted(upto, upto[:-1] + least_words),
                                  np.searchsorted(number, number + least_sentences - 1) + 1),
                       np.searchsorted(upto, upto[:-1] + alone))
    back = np.maximum(np.minimum(np.searchsorted(upto, upto[1:] - least_words, "right") - 1,
                                 np.searchsorted(number, number - least_sentences + 1, "right") - 1),
                      np.searchsorted(upto, upto[1:] - alone, "right") - 1)
    spans = {(a, b) for a, b in zip(at.tolist(), ahead.tolist()) if b <= n}
    spans |= {(a, b + 1) for a, b in zip(back.tolist(), at.tolist()) if a >= 0}
    out = []
    for a, b in sorted(spans):
        h = xxhash.xxh64_intdigest(b" ".join(line[a:b]))
        out.append((h - (1 << 64) if h >> 63 else h, full[a], full[b - 1]))
    return out


def _runs(least_sentences, least_words):
    def go(batches):
        for b in batches:
            rows = []
            for i, key, text in zip(*(c.to_pylist() for c in b.columns)):
                rows += [(i, key, h, first << 32 | last)
                         for h, first, last in runs(*units(text), least_sentences, least_words)]
                if len(rows) > 50_000:
                    yield _run_batch(rows)
                    rows = []
            yield _run_batch(rows)
    return go


def _run_batch(rows):
    cols = zip(*rows) if rows else [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["doc_id", "key", "hash", "span"])


def repeated_runs(docs: DataFrame, least_sentences: int = 2, least_words: int = 20) -> DataFrame:
    """``doc_id, key, first, last, of``: the runs of sentences, or of pieces of long ones, that are not the first of their hash.

    ``of`` is the id of the document that has the first one: the smallest id (NULL ids come last), then text hash
    ``key``, then place. Counting per hash merges before the shuffle, so a run that a third of all documents share
    is one row per task; the join back is an ordinary one, which adaptive execution splits where a hash is hot.
    """
    held = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("key"), "text").mapInArrow(
        _runs(least_sentences, least_words), "doc_id long, key long, hash long, span long")
    scratch = Scratch(docs.sparkSession, "sentences")
    held = scratch.store(held)
    # most runs occur once: only the others are met with their places
    often = scratch.store(held.groupBy("hash").count().where("count > 1").select("hash"))
    met = scratch.store(held.join(often, "hash", "left_semi"))
    scratch.drop(held)
    place = F.struct(F.isnull("doc_id").alias("none"), "doc_id", "key", "span")
    firsts = met.groupBy("hash").agg(F.min(place).alias("p"))
    # stored, so that the join meets two plain tables and a hot hash can be split
    back = met.join(scratch.store(firsts), "hash").where(
        ~(F.col("doc_id").eqNullSafe(F.col("p.doc_id")) & (F.col("key") == F.col("p.key"))
          & (F.col("span") == F.col("p.span"))))
    return back.select(
        "doc_id", "key", F.shiftright("span", 32).cast("int").alias("first"),
        F.col("span").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("last"), F.col("p.doc_id").alias("of"))


@F.pandas_udf(T.StructType([
    T.StructField("text", T.StringType()), T.StructField("n_sentences", T.LongType()),
    T.StructField("n_removed", T.LongType())]))
def _without(texts, covered):
    rows = []
    for text, spans in zip(texts, covered):
        parts, _ = units(text)
        gone = np.zeros(len(parts), bool)
        for s in spans if spans is not None else ():
            gone[s["first"]:s["last"] + 1] = True
        rows.append((text if not gone.any() else "".join(p for p, g in zip(parts, gone) if not g), len(parts),
                     int(gone.sum())))
    return pd.DataFrame(rows, columns=["text", "n_sentences", "n_removed"])


def remove_repeats(docs: DataFrame, least_sentences: int = 2, least_words: int = 20) -> DataFrame:
    """``doc_id, text, n_sentences, n_removed, first_doc_ids, changed`` for every row of ``docs(doc_id, text)``.

    ``text`` lacks every sentence, or piece of a long one, that some non-first repeated run covers; ``n_sentences`` and
    ``n_removed`` count both. ``first_doc_ids`` are the documents that keep the runs. NULL and empty texts stay as they are. Rows with the same id and text are one document:
    each of them gets the same text. Other columns are ignored.
    """
    found = repeated_runs(docs, least_sentences, least_words)
    # spans of a document that cover the same sentences are merged before they are gathered
    spans = found.groupBy("doc_id", "key", "first").agg(F.max("last").alias("last"), F.min("of").alias("of"))
    spans = spans.groupBy("doc_id", "key").agg(
        F.collect_list(F.struct("first", "last")).alias("covered"), F.collect_set("of").alias("firsts"))
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("key"))
    joined = rows.alias("d").join(spans.alias("s"), F.col("d.doc_id").eqNullSafe(F.col("s.doc_id"))
                                  & (F.col("d.key") == F.col("s.key")), "left")
    out = joined.select("d.doc_id", _without("d.text", "s.covered").alias("o"), "s.firsts")
    return out.select("doc_id", "o.text", "o.n_sentences", "o.n_removed",
                      F.array_sort(F.coalesce("firsts", F.array().cast("array<bigint>"))).alias("first_doc_ids"),
                      (F.col("o.n_removed") > 0).alias("changed"))


@query("op8_sentence_runs")
def op8(spark, sf_dir):
    return remove_repeats(table(spark, sf_dir, "documents"))
