"""Hard negatives by angular triangle filtering: angles to reference directions bound every score before it is computed."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartorio.llm.common import Scratch, query, table

_ROW = "at long, vec_id long, label long, dim int, q binary, norm double, angles binary"
_OUT = "akey long, anchor_id long, w int, positive_id long, positive_score long, id long, score long"
_KEY = ["dim", "grp", "part"]
#: Added to stored angles (single precision) and to products of norms, far above their rounding.
_ANGLE, _SCORE = 1e-6, 1e-9
#: Norms of integer vectors from here on are left out: products of two might not fit a long.
BIG = 2.0 ** 31
_LOW = np.iinfo(np.int64).min


def directions(sample: list, count: int, seed: int = 11) -> dict[int, np.ndarray]:
    """Unit reference directions of each vector length: spherical k-means over a sample of vectors."""
    out, rng = {}, np.random.default_rng(seed)
    for dim in sorted({len(v) for v in sample}):
        x = np.array([v for v in sample if len(v) == dim], float)
        size = np.linalg.norm(x, axis=1)
        good = (size > 0) & np.isfinite(size)
        x = x[good] / size[good, None]
        made = x[rng.permutation(len(x))[:count]]
        for _ in range(6 if len(made) else 0):
            near = (x @ made.T).argmax(1)
            for j in range(len(made)):
                mid = x[near == j].sum(0)
                if np.linalg.norm(mid) > 0:
                    made[j] = mid / np.linalg.norm(mid)
        out[dim] = made
    return out


def _references(refs: dict[int, np.ndarray], dim: int, count: int) -> np.ndarray:
    """Those of a length; random ones for a length that the sample has not."""
    have = refs.get(dim, np.zeros((0, dim)))
    if len(have) or not dim:
        return have if len(have) else np.zeros((1, dim))
    x = np.random.default_rng(dim).normal(size=(count, dim))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _packed(q: np.ndarray) -> bytes:
    small = q.astype("<i2")
    return (small if (small == q).all() else q.astype("<i8")).tobytes()


def _whole(rows: list, dim: int) -> np.ndarray:
    return np.array([np.frombuffer(r, "<i2" if len(r) == 2 * dim else "<i8") for r in rows], np.int64).reshape(len(rows), dim)


def _encoder(refs: dict[int, np.ndarray], count: int, scale: float):
    def run(batches):
        for b in batches:
            out = []
            for at, vec_id, label, vec in zip(*(c.to_pylist() for c in b.columns)):
                x = np.floor(np.array(vec, float) * scale)
                norm = float(np.linalg.norm(x))
                if norm < BIG:
                    r = _references(refs, len(x), count)
                    cos = np.clip(r @ x / norm, -1, 1) if norm else np.zeros(len(r))
                    out.append((at, vec_id, label, len(x), _packed(x.astype(np.int64)), norm,
                                np.arccos(cos).astype("<f4").tobytes()))
            cols = list(zip(*out)) if out else [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(),
                                                       pa.float64(), pa.binary()])],
                [c.split()[0] for c in _ROW.split(", ")])
    return run


def score_bounds(a_angles, a_norm, low, high, least, most):
    """Bounds of the scores of anchors with strips of rows, as integers that no score passes.

    A row at angle t to a reference is at no less than ``|s - t|`` and no more than ``min(s + t, 2 pi - s - t)``
    to an anchor at angle s to it, whatever the reference: the strictest of all of them holds. Strips have the
    ranges ``low..high`` of angles and ``least..most`` of norms.
    """
    s = a_angles[:, None, :]
    near = np.maximum(np.maximum(s - high, low - s), 0).max(2) - 2 * _ANGLE
    far = np.where(s + high <= math.pi, s + high, np.where(s + low >= math.pi, 2 * math.pi - s - low, math.pi))
    far = far.min(2) + 2 * _ANGLE
    top, bottom = np.cos(np.clip(near, 0, math.pi)), np.cos(np.clip(far, 0, math.pi))
    up = a_norm[:, None] * np.where(top >= 0, most, least) * top
    down = a_norm[:, None] * np.where(bottom >= 0, least, most) * bottom
    slack = 1 + a_norm[:, None] * most * _SCORE
    return np.floor(up + slack), np.ceil(down - slack)


class Block:
    """Rows of one block as strips of rows at like angles."""

    def __init__(self, rows: list[dict], strip: int):
        dim = rows[0]["dim"]
        angles = np.array([np.frombuffer(r["angles"], "<f4") for r in rows], float)
        near = angles.argmin(1)
        order = np.lexsort((angles[np.arange(len(rows)), near], near))
        angles = angles[order]
        self.q = _whole([r["q"] for r in rows], dim)[order]
        self.norm = np.array([r["norm"] for r in rows])[order]
        self.ids = np.array([r["vec_id"] for r in rows], np.int64)[order]
        self.labels = np.array([r["label"] for r in rows], np.int64)[order]
        at = np.arange(0, len(rows), strip)
        self.parts = [slice(i, min(i + strip, len(rows))) for i in at]
        self.low, self.high = np.minimum.reduceat(angles, at), np.maximum.reduceat(angles, at)
        self.least, self.most = np.minimum.reduceat(self.norm, at), np.maximum.reduceat(self.norm, at)
        self.floats = self.q.astype(float)

    def best(self, anchors: list[dict], spans: list[list[tuple[int, int]]], k: int, same: bool):
        """``(anchor, span, id, score)``: the first ``k`` rows by score within each span of scores of each anchor.

        Rows are those of the anchor's label but its own id, or of other labels. Only strips whose bounds reach
        into a span, above the ``k``-th score found so far, are scored, in whole numbers.
        """
        n, wide = len(anchors), max(map(len, spans))
        q = _whole([a["q"] for a in anchors], anchors[0]["dim"])
        norm = np.array([a["norm"] for a in anchors])
        ids = np.array([a["vec_id"] for a in anchors], np.int64)
        labels = np.array([a["label"] for a in anchors], np.int64)
        floor, roof = np.ones((n, wide), np.int64), np.zeros((n, wide), np.int64)
        for i, own in enumerate(spans):
            for w, (lo, hi) in enumerate(own):
                floor[i, w], roof[i, w] = lo, hi
        angles = np.array([np.frombuffer(a["angles"], "<f4") for a in anchors], float)
        up, down = score_bounds(angles, norm, self.low, self.high, self.least, self.most)
        exact = norm.max() * self.norm.max() < 2.0 ** 52
        floats = q.astype(float)
        top = np.full((n, wide, k), _LOW)
        found = []
        # strips that may hold the highest scores first
        for s in np.argsort(-up.max(0), kind="stable"):
            bar = np.maximum(floor, top[:, :, 0])
            use = np.nonzero(((up[:, s, None] >= bar) & (down[:, s, None] <= roof) & (floor <= roof)).any(1))[0]
            if not len(use):
                continue
            part = self.parts[s]
            if exact:  # sums of whole numbers below 2^53 are exact in doubles
                score = (floats[use] @ self.floats[part].T).astype(np.int64)
            else:
                score = q[use] @ self.q[part].T
            mate = labels[use, None] == self.labels[None, part]
            mate = mate & (ids[use, None] != self.ids[None, part]) if same else ~mate
            fit = mate[:, None, :] & (score[:, None, :] >= bar[use][:, :, None]) & (
                score[:, None, :] <= roof[use][:, :, None])
            i, w, j = np.nonzero(fit)
            if not len(i):
                continue
            found.append((use[i], w, self.ids[part][j], score[i, j]))
            i, w = np.nonzero(fit.any(2))
            both = np.concatenate([top[use[i], w], np.where(fit[i, w], score[i], _LOW)], 1)
            top[use[i], w] = np.partition(both, both.shape[1] - k, 1)[:, -k:]
        if not found:
            return
        a, w, row, score = (np.concatenate(c) for c in zip(*found))
        keep = score >= top[:, :, 0].copy()[a, w]
        a, w, row, score = a[keep], w[keep], row[keep], score[keep]
        order = np.lexsort((row, -score, w, a))
        a, w, row, score = a[order], w[order], row[order], score[order]
        group = a * wide + w
        first = np.r_[0, np.nonzero(np.diff(group))[0] + 1]
        rank = np.arange(len(group)) - np.repeat(first, np.diff(np.r_[first, len(group)]))
        yield from zip(*(x[rank < k].tolist() for x in (a, w, row, score)))


def _matcher(k: int, same: bool, low: int, high: int, base: int, strip: int, batch: int):
    """Over rows sorted by block, those of the table before the anchors: the best of each block for each anchor."""
    def spans(anchor):
        if same:
            return [(_LOW + 1, np.iinfo(np.int64).max)]
        limit = lambda x: max(_LOW + 1, min(x, -_LOW - 1))
        return [(limit(-((-low * p) // base)), limit(high * p // base)) for p in anchor["positive_score"]]

    def rows(batches):
        key, held, block, asked = None, [], None, []

        def answer():
            marks = [spans(a) for a in asked]
            for a, w, row, score in block.best(asked, marks, k, same):
                own = asked[a]
                yield (own["akey"], own["vec_id"], w, *((None, None) if same else
                       (own["positive_id"][w], own["positive_score"][w])), row, score)

        for b in batches:
            for r in b.to_pylist():
                now = tuple(r[c] for c in _KEY)
                if now != key:
                    if asked and block:
                        yield from answer()
                    key, held, block, asked = now, [], None, []
                if r["akey"] is None:
                    held.append(r)
                    continue
                if held:
                    block, held = Block(held, strip), []
                asked.append(r)
                if len(asked) == batch and block:
                    yield from answer()
                    asked = []
        if asked and block:
            yield from answer()

    def run(batches):
        held = []
        names, types = [c.split()[0] for c in _OUT.split(", ")], [pa.int64()] * 7
        types[2] = pa.int32()

        def made():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)

        for row in rows(batches):
            held.append(row)
            if len(held) == 50_000:
                yield made()
                held = []
        if held:
            yield made()
    return run


def _met(rows: DataFrame, anchors: DataFrame, sizes: DataFrame, by: list[str], block: int, **how) -> DataFrame:
    """The best rows of every block for every anchor that is to meet it."""
    parts = sizes.groupBy(*by).agg(F.ceil(F.sum("n") / block).cast("int").alias("parts"))
    grp = (F.col("label") if "label" in by else F.lit(0)).cast("long").alias("grp")
    columns = ["dim", "grp", "part", "akey", "vec_id", "label", "q", "norm", "angles", "positive_id", "positive_score"]
    none = F.lit(None).cast("array<long>")
    there = rows.join(parts, by).withColumn("part", F.pmod(F.xxhash64("at"), F.col("parts")).cast("int")).select(
        "*", grp, F.lit(None).cast("long").alias("akey"), none.alias("positive_id"), none.alias("positive_score"))
    asked = anchors.join(parts, by).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "*", grp)
    spark = rows.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    both = there.select(columns).unionByName(asked.select(columns)).repartition(tasks, *_KEY)
    return both.sortWithinPartitions(*_KEY, F.col("akey").isNotNull()).mapInArrow(_matcher(**how), _OUT)


def hard_negatives(vectors: DataFrame, anchor="vec_id % 100 = 0", positives: int = 5, negatives: int = 10,
                   low: int = 30, high: int = 90, base: int = 100, scale: float = 256, references: int = 16,
                   sample: int = 2048, block: int = 4096, strip: int = 64) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` of ``vectors(vec_id, embedding, label)``.

    Components become ``floor(scale * x)``; a score is the integer inner product with an anchor, higher ones come
    first, ties by id. An anchor's positives are its first rows of the same label, its negatives for each of them
    the first rows of other labels with ``low * positive <= base * negative <= high * positive``.

    Rows with a NULL id, label or vector, or a NULL or non-finite component take no part; nor do vectors whose
    integer norm is 2^31 or more, whose scores need not fit a long. Vectors of other lengths do not meet. Rows of
    the anchor's own id are not its positives. Repeated rows are partners of their own, a repeated anchor counts
    once. An anchor without positives or without negatives has no rows. Other columns are ignored.

    The reference directions are those of k-means over ``sample`` rows of the smallest hashes of their ids; they
    decide how many scores are computed, never the result. Rows are dealt to blocks of about ``block`` rows
    whatever their label or id; anchors go to the blocks they have to meet, a batch of them at a time.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "negatives")
    plain = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                           F.col("embedding").cast("array<double>").alias("vec"))
    plain = plain.where(
        "vec_id is not null and label is not null and vec is not null").where(F.forall(
            "vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    chosen = plain.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("vec").collect()
    refs = directions([r["vec"] for r in chosen], references)
    rows = scratch.store(plain.select(F.monotonically_increasing_id().alias("at"), "vec_id", "label", "vec").mapInArrow(
        _encoder(refs, references, scale), _ROW))
    sizes = scratch.store(rows.groupBy("dim", "label").agg(F.count("*").alias("n")))
    anchors = scratch.store(rows.where(anchor).withColumn("akey", F.xxhash64("vec_id", "label", "q")).dropDuplicates(
        ["akey"]).drop("at"))
    none = F.lit(None).cast("array<long>")
    how = dict(low=low, high=high, base=base, strip=strip, batch=256, block=block)
    mates = _met(rows, anchors.withColumn("positive_id", none).withColumn("positive_score", none), sizes,
                 ["dim", "label"], k=positives, same=True, **how)
    first = Window.partitionBy("akey", "w").orderBy(F.desc("score"), "id")
    mates = mates.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= positives)
    mates = mates.groupBy("akey").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("p"))
    ready = scratch.store(anchors.join(mates, "akey").withColumn("positive_id", F.col("p.id")).withColumn(
        "positive_score", F.col("p.score")).drop("p"))
    found = _met(rows, ready, sizes, ["dim"], k=negatives, same=False, **how)
    found = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= negatives)
    return found.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"),
                        F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
             list_inner_product(a.q, b.q)::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id)::INT AS rank,
       s.id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id) <= 10
"""


@query("op12_hard_negatives", _SQL)
def op12(spark, sf_dir):
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", shifted))
