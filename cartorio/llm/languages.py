"""Language identification: n-gram presence kernel, Nystrom landmarks, one-versus-rest kernel ridge regression."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartorio.llm.common import Scratch, query, table

#: Sizes of the blended n-grams, in bytes of the lower-cased text; they are known by a hash of 16 bits.
SIZES = (1, 2, 3, 4)
BUCKETS = 1 << 16
UNKNOWN = "und"
#: Bytes of a text worked on at once; texts whose kernels are one matrix product.
_BLOCK, _BATCH = 1 << 20, 64
#: Sharpness of the score: how far ridge outputs, about -1 and 1, are told apart.
_SHARP = 2.0


def grams(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the n-grams of a whole text."""
    raw, seen = np.frombuffer((text or "").lower().encode(), np.uint8), np.zeros(BUCKETS, bool)
    for at in range(0, len(raw), _BLOCK):
        b = raw[at:at + _BLOCK + max(SIZES) - 1].astype(np.uint64)
        h = np.zeros(len(b), np.uint64)
        for n in range(1, max(SIZES) + 1):
            if n > len(b):
                break
            h = h[:len(b) - n + 1] * np.uint64(257) + b[n - 1:] + np.uint64(1)
            if n in SIZES:
                seen[(h * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(48)).astype(np.int64)] = True
    return np.flatnonzero(seen).astype(np.int32)


class Landmarks:
    """Presence vectors of the landmark texts as one matrix, a column each; only n-grams that one of them has."""

    def __init__(self, lists: list[np.ndarray]):
        self.m = len(lists)
        self.used = np.unique(np.concatenate(lists)) if lists else np.zeros(0, np.int32)
        bits = np.zeros((len(self.used), self.m), bool)
        for j, own in enumerate(lists):
            bits[np.searchsorted(self.used, own), j] = True
        self.sizes = np.array([len(x) for x in lists], float)
        self.bits, self.matrix, self.place = np.packbits(bits, axis=1), None, None

    def kernel(self, lists: list[np.ndarray]) -> np.ndarray:
        """Common n-grams with each landmark over the root of both sizes' product; a product of matrices a batch."""
        if self.matrix is None:  # unpacked once in each Python worker
            self.matrix = np.unpackbits(self.bits, axis=1, count=self.m).astype(np.float32)
            self.place = np.full(BUCKETS, -1, np.int32)
            self.place[self.used] = np.arange(len(self.used))
        out = np.zeros((len(lists), self.m))
        for at in range(0, len(lists), _BATCH):
            part = lists[at:at + _BATCH]
            present = np.zeros((len(part), len(self.used)), np.float32)
            for i, own in enumerate(part):
                cols = self.place[own]
                present[i, cols[cols >= 0]] = 1
            norms = np.sqrt(np.array([max(len(x), 1) for x in part], float)[:, None] * np.maximum(self.sizes, 1))
            out[at:at + len(part)] = (present @ self.matrix) / norms
        return out

    def __getstate__(self):
        return {**self.__dict__, "matrix": None, "place": None}


class Model:
    """Languages, landmarks, the map from kernels to features and the weights of every language."""

    def __init__(self, langs: list[str], landmarks: Landmarks, whiten: np.ndarray, weights: np.ndarray):
        self.langs, self.landmarks, self.whiten, self.weights = langs, landmarks, whiten, weights

    def outputs(self, lists: list[np.ndarray]) -> np.ndarray:
        return _features(self.landmarks.kernel(lists), self.whiten) @ self.weights

    def predict(self, lists: list[np.ndarray]) -> tuple[list[str], np.ndarray]:
        """The language of the largest output (of ties the first by name) and its share of all of them."""
        if not len(lists):
            return [], np.zeros(0)
        e = np.exp(_SHARP * self.outputs(lists))
        best = e.argmax(1)
        return [self.langs[i] for i in best], e[np.arange(len(e)), best] / e.sum(1)


def _features(kernel: np.ndarray, whiten: np.ndarray) -> np.ndarray:
    """Nystrom features of unit length; zero for a text that has nothing in common with any landmark."""
    phi = kernel @ whiten
    size = np.linalg.norm(phi, axis=1, keepdims=True)
    return phi / np.where(size > 0, size, 1)


def solve(kernel: np.ndarray, own: np.ndarray, labels: np.ndarray, classes: int, ridge: float):
    """Whitening of the landmarks' kernel ``own`` and ridge weights of each class against the rest (1 and -1).

    Every class has the same weight in all, however many texts it has.
    """
    values, vectors = np.linalg.eigh(own)
    keep = values > 1e-6 * values.max()
    whiten = vectors[:, keep] / np.sqrt(values[keep])
    phi = _features(kernel, whiten)
    share = (1 / np.bincount(labels, minlength=classes))[labels]
    target = np.where(labels[:, None] == np.arange(classes), 1.0, -1.0)
    left = (phi * share[:, None]).T @ phi + ridge * classes * np.eye(phi.shape[1])
    return whiten, np.linalg.solve(left, (phi * share[:, None]).T @ target)


def held_out(doc_id: str = "doc_id"):
    """Rows that no fit sees: crc32 of the id as text, modulo 5, is 0; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def has_letter(text: str = "text"):
    return F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))


def _listed(batches):
    for b in batches:
        made = [grams(t) for t in b.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([g.tobytes() for g in made], pa.binary())],
                                         ["lang", "h", "grams"])


def fit(docs: DataFrame, sample: int = 8_000, landmarks: int = 128, ridge: float = 1e-3) -> Model | None:
    """Learns from ``docs(doc_id, text, lang)``: rows with a language and a text that has a letter; else None.

    The fit uses at most ``sample`` texts, dealt evenly to the languages, those of the smallest hashes of their
    ids, one row an id and language. Of these, ``landmarks`` (at least one a language) are what all texts are
    compared with. Only hashes of n-grams, 256 KB a text at the most, and one row of kernels a text come to the driver.
    """
    scratch = Scratch(docs.sparkSession, "languages")
    rows = docs.where("lang is not null and text is not null").select(
        "lang", F.xxhash64(F.col("doc_id").cast("string")).alias("h"), "text").where(has_letter())
    keys = rows.groupBy("lang", "h").agg(F.lit(1).alias("one"))
    langs = sorted(r["lang"] for r in rows.select("lang").distinct().collect())
    if not langs:
        return None
    each, some = max(1, sample // len(langs)), max(1, landmarks // len(langs))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    # one row a language
    upto = keys.withColumn("place", place).where(F.col("place") <= each).groupBy("lang").agg(
        F.max("h").alias("upto"), F.max(F.when(F.col("place") <= some, F.col("h"))).alias("marks"))
    upto = scratch.store(upto)
    chosen = rows.join(F.broadcast(upto), "lang").where("h <= upto").groupBy("lang", "h").agg(F.min("text").alias("text"))
    listed = scratch.store(chosen.mapInArrow(_listed, "lang string, h long, grams binary"))
    marks = listed.join(F.broadcast(upto), "lang").where("h <= marks").orderBy("lang", "h").collect()
    held = Landmarks([np.frombuffer(r["grams"], np.int32) for r in marks])
    own = held.kernel([np.frombuffer(r["grams"], np.int32) for r in marks])

    def kernels(batches):
        for b in batches:
            k = held.kernel([np.frombuffer(g, np.int32) for g in b.column(2).to_pylist()]).astype(np.float32)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([x.tobytes() for x in k], pa.binary())],
                                             ["lang", "h", "kernel"])

    got = listed.mapInArrow(kernels, "lang string, h long, kernel binary").orderBy("lang", "h").collect()
    kernel = np.array([np.frombuffer(r["kernel"], np.float32) for r in got], float)
    labels = np.array([langs.index(r["lang"]) for r in got])
    return Model(langs, held, *solve(kernel, own, labels, len(langs), ridge))


def languages(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1), of whole texts; columns of these names are replaced.

    A NULL text and one without a letter (empty ones too) are ``und`` with score 0, and so is every text where there
    is no model. A text of letters that no landmark has gets the first language and an even share. Rows are scored
    one by one, repeated rows alike; NULL ids are kept.
    """
    if model is None:
        return docs.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})

    @F.pandas_udf("lang string, score double")
    def named(texts: pd.Series) -> pd.DataFrame:
        langs, scores = [], []
        for at in range(0, len(texts), _BATCH):
            made = model.predict([grams(t) for t in texts.iloc[at:at + _BATCH]])
            langs += made[0]
            scores.append(made[1])
        return pd.DataFrame({"lang": langs, "score": np.concatenate(scores) if scores else np.zeros(0)})

    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "score")]
    made = docs.select(F.struct(*kept).alias("row"), has_letter().alias("known"), named("text").alias("named"))
    return made.select("row.*", F.when(F.col("known"), F.col("named.lang")).otherwise(F.lit(UNKNOWN)).alias("lang_pred"),
                       F.when(F.col("known"), F.col("named.score")).otherwise(F.lit(0.0)).alias("score"))


@query("op13_language_identification")
def op13(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = languages(docs.select("doc_id", held_out().alias("held_out"), "text"), fit(docs.where(~held_out())))
    return out.select("doc_id", "held_out", "lang_pred", "score")
