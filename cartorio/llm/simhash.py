"""SimHash near-duplicates by segment popcounts: a grid range-join under a Manhattan lower bound."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartorio.llm import resemblance
from cartorio.llm.common import Scratch, components, query, table

#: Bits of a block; a block is a run of two-bit segments.
BLOCKS = (10, 10, 10, 10, 12, 12)
#: Fingerprints link at this many differing bits or fewer; the six blocks leave three untouched then.
BITS = 3


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _masks() -> list[int]:
    out, at = [], 0
    for width in BLOCKS:
        out.append(((1 << width) - 1) << at)
        at += width
    return out


def fingerprint(text: str | None, words: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of a text's word shingles, repeats included; 0 where there are no words."""
    if not text:
        return 0
    w = text.encode().lower().split()  # bytes: only A-Z change, only ASCII white space splits
    if not w:
        return 0
    k = min(words, len(w))
    sums, n = np.zeros(64, np.int64), len(w) - k + 1
    for at in range(0, n, 1 << 15):
        part = w[at:at + (1 << 15) + k - 1]
        grams = [b" ".join(g) for g in zip(*(part[i:] for i in range(k)))]
        h = np.array([xxhash.xxh64_intdigest(g, seed) for g in grams], dtype="<u8")
        sums += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * sums > n, bitorder="little").view("<u8")[0])


def simhash_of(words: int):
    """Column function: the fingerprints of whole texts by shingles of so many words, their 64 bits as longs."""
    @F.pandas_udf(T.LongType())
    def prints(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, words) for t in texts], dtype=np.uint64).view(np.int64))
    return prints


simhash = simhash_of(3)


def links(prints: DataFrame, bits: int = BITS) -> DataFrame:
    """Pairs ``(a, b)``, a < b, of distinct fingerprints ``fp`` at ``bits`` (at most 3) or fewer differing bits.

    A fingerprint is embedded as the popcounts of its 32 two-bit segments, each written in unary, so the
    Manhattan distance of two embeddings is the bit count of their XOR. That distance never exceeds the
    Hamming distance. Within 3, at most three of six blocks differ: the pair shares the grid cell of some
    three blocks. Every fingerprint goes to its 20 cells; a pair is taken in its first common cell only,
    tested by the lower bound, then by the bits themselves.
    """
    if bits > len(BLOCKS) - 3:
        raise ValueError("the grid holds distances up to 3")
    masks, low = _masks(), 0x5555555555555555
    lit = lambda x: F.lit(_signed(x)).cast("long")
    shifted = F.shiftrightunsigned("fp", 1)
    either = F.col("fp").bitwiseOR(shifted).bitwiseAND(lit(low))
    each = F.col("fp").bitwiseAND(shifted).bitwiseAND(lit(low))
    coded = prints.select("fp", either.bitwiseOR(F.shiftleft(each, 1)).alias("code"))
    cells = F.array(*[
        F.struct(F.lit(i).alias("cell"), F.lit(c[2]).alias("last"),
                 F.col("code").bitwiseAND(lit(masks[c[0]] | masks[c[1]] | masks[c[2]])).alias("at"))
        for i, c in enumerate(combinations(range(len(BLOCKS)), 3))])
    placed = coded.select("fp", "code", F.explode(cells).alias("c")).select("fp", "code", "c.*")
    a, b = placed.alias("a"), placed.drop("last").alias("b")
    diff = F.col("a.code").bitwiseXOR(F.col("b.code"))
    earlier = sum((((diff.bitwiseAND(lit(m)) == 0) & (F.lit(i) < F.col("a.last"))).cast("int")
                   for i, m in enumerate(masks)), F.lit(0))
    return a.join(
        b, (F.col("a.cell") == F.col("b.cell")) & (F.col("a.at") == F.col("b.at")) & (F.col("a.fp") < F.col("b.fp"))
        & (F.bit_count(diff) <= bits) & (F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= bits)
        & (earlier == 2)).select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))


def _classes(fps: DataFrame, roots: DataFrame | None) -> DataFrame:
    """``(fp, class_fp)`` of the distinct ``fps``: the ``root`` of their component, or themselves."""
    if roots is None:
        return fps.select("fp", F.col("fp").alias("class_fp"))
    return fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("class_fp"))


def _print_classes(prints: DataFrame, bits: int, scratch: Scratch) -> DataFrame:
    """``(fp, class_fp)``: the smallest fingerprint that links reach from each distinct ``fp``."""
    fps = scratch.store(prints.select("fp").distinct())
    return _classes(fps, components(links(fps, bits), scratch))


def _proposed(prints: DataFrame, bits: int, scratch: Scratch) -> DataFrame:
    """``(a, b)``: each text of ``prints(fp, print)`` and the smallest one of its class of fingerprints."""
    rows = scratch.store(prints.select("fp", "print").distinct())
    classes = scratch.store(_print_classes(rows.select(F.col("print").alias("fp")), bits, scratch).select(
        F.col("fp").alias("print"), "class_fp"))
    placed = rows.join(classes, "print")
    hubs = placed.groupBy("class_fp").agg(F.min("fp").alias("a"))
    return placed.join(hubs, "class_fp").where("a <> fp").select("a", F.col("fp").alias("b"))


def near_duplicates(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """``(doc_id, fp, class_fp, component_id)`` for every row of ``docs(doc_id, text)``.

    Copies share a fingerprint, so the join sees each distinct one once, however many rows have it. Other
    columns of ``docs`` are ignored. NULL and empty texts have fingerprint zero. Repeated rows give repeated
    rows. NULL ids are passed over in the minimum; a group of NULL ids alone has a NULL component. ``class_fp``
    is the smallest fingerprint of the component.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    prints = scratch.store(docs.select(F.col("doc_id").cast("long"), simhash("text").alias("fp")))
    classes = scratch.store(_print_classes(prints, bits, scratch))
    low = prints.groupBy("fp").agg(F.min("doc_id").alias("low"))
    ids = low.join(classes, "fp").groupBy("class_fp").agg(F.min("low").alias("component_id"))
    named = scratch.store(classes.join(ids, "class_fp").select("fp", "class_fp", "component_id"))
    return prints.join(named, "fp").select("doc_id", "fp", "class_fp", "component_id")


def hex_of(fp: str):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, bits: int = BITS, words: int | None = None, similarity: float = 0.8) -> DataFrame:
    """One row of each near-duplicate group: that of the smallest id, NULL ids last, then of the smallest text hash.

    Without ``words``, texts are near-duplicates where their fingerprints differ in ``bits`` or fewer. With ``words``
    they are where the Jaccard similarity of their shingles of so many words is at least ``similarity``:
    fingerprints of such shingles propose pairs, which their shingles decide, and a join by shingles finds all pairs
    that fingerprints pass over, so none is lost.

    NULL and empty texts and texts without words are copies of each other. All columns of ``docs`` stay as they
    are, whatever their names. Rows of one id and text count as one, the first by all its columns. An empty table
    gives none. Very long texts are worked on whole.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    key = [F.col("doc_id").cast("long").alias("_id"), F.xxhash64("text").alias("_text")]
    if words:
        # texts without words are copies of each other
        fp = F.when(F.coalesce("text", F.lit("")).rlike(r"[^ \t\n\x0b\f\r]"), F.xxhash64("text")).otherwise(F.lit(0))
        fp = fp.cast("long").alias("fp")
        prints = scratch.store(docs.select(*key, fp, simhash_of(words)("text").alias("print")))
        _, roots = resemblance.links(
            docs.select(fp, "text"), words, similarity, scratch, _proposed(prints, bits, scratch))
        classes = scratch.store(_classes(prints.select("fp").distinct(), roots))
    else:
        prints = scratch.store(docs.select(*key, simhash("text").alias("fp")))
        classes = scratch.store(_print_classes(prints, bits, scratch))
    rows = prints.groupBy("_id", "_text", "fp").agg(F.count("*").alias("n")).join(classes, "fp")
    first = rows.groupBy("class_fp").agg(
        F.min(F.struct(F.isnull("_id").alias("none"), "_id", "_text", "n")).alias("c"))
    chosen = scratch.store(first.select("c._id", "c._text", "c.n"))
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *key).alias("d").join(
        chosen.alias("c"), F.col("d._id").eqNullSafe(F.col("c._id")) & (F.col("d._text") == F.col("c._text")))
    # only rows that occur more than once need to be brought together
    many = held.where("n > 1").select("row", F.col("d._id").alias("_id"), F.col("d._text").alias("_text")).groupBy(
        "_id", "_text").agg(F.min_by("row", F.to_json("row")).alias("row"))
    return held.where("n = 1").select("row.*").unionByName(many.select("row.*"))


@query("op2_simhash_near_duplicates")
def op2(spark, sf_dir):
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", hex_of("fp").alias("fingerprint"), "component_id")
