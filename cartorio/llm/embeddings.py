"""Embedding near-duplicates: randomised-rotation binary codes with correction factors and confidence bounds."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartorio.llm.common import Scratch, components, query, table

_ROWS = "grp string, cell long, turn int, rep long, m long, dim int, vec binary, sign binary, factor double"
_OUT = "rep long, n long, root long"


def rotation(dim: int, seed: int = 7) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def encode(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signs of the rotated unit vectors, and the correction factor: the inner product of a vector with its code."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    spun = unit @ turn
    return spun > 0, np.abs(spun).sum(1) / math.sqrt(vectors.shape[1])


def estimate(signs: np.ndarray, factors: np.ndarray, queries: np.ndarray, sure: float):
    """Unbiased inner products of coded unit vectors with rotated unit ``queries``, and the half-width around them.

    ``<code, q> / <code, v>`` is unbiased over the rotation, its error at most
    ``sqrt((1 - f^2) / f^2) * sure / sqrt(dim - 1)`` but for a chance that falls as ``exp(-sure^2 / 2)``.
    """
    dim = signs.shape[1]
    codes = np.where(signs, 1.0, -1.0) / math.sqrt(dim)
    f = np.maximum(factors, 1e-9)[:, None]
    wide = np.sqrt(np.maximum(1 - f * f, 0)) / f * sure / math.sqrt(max(dim - 1, 1))
    return codes @ queries.T / f, wide


def _plan(n: int, least: float, recall: float) -> tuple[int, int]:
    """Bits of a cell and number of tables, so that a pair at the threshold meets in some table."""
    bits = max(4, min(24, math.ceil(math.log2(max(n, 16) / 16))))
    meet = (1 - math.acos(least) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - meet)))


def _bytes(x: np.ndarray) -> bytes:
    """A vector in single precision where that loses nothing."""
    low = x.astype("<f4")
    return (low if (low == x).all() else x.astype("<f8")).tobytes()


class Turns:
    """Rotations and sign planes for each vector length, from a seed; every task makes the same."""

    def __init__(self, bits: int, tables: int, seed: int):
        self.bits, self.tables, self.seed, self.made = bits, tables, seed, {}

    def of(self, dim: int):
        if dim not in self.made:
            planes = np.random.default_rng((self.seed, dim)).normal(size=(dim, self.bits * self.tables))
            self.made[dim] = rotation(dim, self.seed), planes
        return self.made[dim]

    def cells(self, x: np.ndarray) -> np.ndarray:
        """The cell of every vector in every table: sign bits under the table's planes."""
        side = (x @ self.of(x.shape[1])[1] > 0).reshape(len(x), self.tables, self.bits)
        return (side * (1 << np.arange(self.bits, dtype=np.int64))).sum(2)


def _encoder(turns: Turns):
    """Rows for every table of every vector."""
    def run(batches):
        for b in batches:
            by_dim = {}
            for g, rep, m, vec in zip(*(c.to_pylist() for c in b.columns)):
                by_dim.setdefault(len(vec), []).append((g, rep, m, vec))
            for dim, rows in by_dim.items():
                x = np.array([r[3] for r in rows], float)
                signs, factors = encode(x, turns.of(dim)[0])
                cells, n = turns.cells(x), len(rows)
                vecs, codes = [_bytes(v) for v in x], [s.tobytes() for s in np.packbits(signs, axis=1)]
                for t in range(turns.tables):
                    yield pa.RecordBatch.from_arrays([
                        pa.array([r[0] for r in rows]), pa.array(cells[:, t]), pa.array([t] * n, pa.int32()),
                        pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64()),
                        pa.array([dim] * n, pa.int32()), pa.array(vecs), pa.array(codes), pa.array(factors)],
                        [c.split()[0] for c in _ROWS.split(", ")])
    return run


def _cell_links(rows, turns: Turns, least: float, sure: float):
    """Linked pairs of one cell or pair of blocks: link counts and a spanning forest."""
    t, dim = rows[0]["turn"], rows[0]["dim"]
    x = np.array([np.frombuffer(r["vec"], "<f4" if len(r["vec"]) == 4 * dim else "<f8") for r in rows], float)
    signs = np.unpackbits(np.array([np.frombuffer(r["sign"], np.uint8) for r in rows]), axis=1)[:, :dim] > 0
    factors = np.array([r["factor"] for r in rows])
    m = np.array([r["m"] for r in rows], np.int64)
    block = np.array([r["block"] for r in rows])
    norm = np.linalg.norm(x, axis=1)
    spun = (x / norm[:, None]) @ turns.of(dim)[0]
    n, links, low = len(rows), np.zeros(len(rows), np.int64), np.arange(len(rows))
    cells = turns.cells(x)[:, :t]
    for at in range(0, n, 512):
        part = slice(at, min(at + 512, n))
        est, wide = estimate(signs[part], factors[part], spun, sure)
        maybe = est + wide >= least  # below the bound nothing is computed again
        maybe &= np.arange(n)[None, :] > np.arange(at, part.stop)[:, None]
        if block.max() != block.min():  # two blocks meet only across
            maybe &= block[part, None] != block[None, :]
        i, j = np.nonzero(maybe)
        i += at
        if t and len(i):  # each pair once: in the first table where it meets
            fresh = ~(cells[i] == cells[j]).any(1)
            i, j = i[fresh], j[fresh]
        ok = np.einsum("ij,ij->i", x[i], x[j]) / (norm[i] * norm[j]) >= least
        i, j = i[ok], j[ok]
        np.add.at(links, i, m[j])
        np.add.at(links, j, m[i])
        while len(i):  # smallest label of each component within the cell
            before = low.copy()
            both = np.minimum(low[i], low[j])
            np.minimum.at(low, low[i], both)
            np.minimum.at(low, low[j], both)
            low = low[low]
            if (before == low).all():
                break
    while (low[low] != low).any():
        low = low[low]
    for k in np.nonzero(links)[0]:
        yield rows[k]["rep"], int(links[k]), rows[low[k]]["rep"]


def _linker(turns: Turns, least: float, sure: float):
    """Over rows sorted by cell and block pair: links of every run of equal keys."""
    def run(batches):
        held, key, out = [], None, []

        def flush():
            if len(held) > 1:
                out.extend(_cell_links(held, turns, least, sure))

        def batch():
            cols = list(zip(*out)) if out else [[], [], []]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["rep", "n", "root"])

        for b in batches:
            for row in b.to_pylist():
                now = row["grp"], row["dim"], row["turn"], row["cell"], row["lo"], row["hi"]
                if now != key:
                    flush()
                    held, key = [], now
                held.append(row)
            if len(out) > 10_000:
                yield batch()
                out = []
        flush()
        yield batch()
    return run


def links(distinct: DataFrame, scratch: Scratch, least: float = 0.98, recall: float = 0.995, sure: float = 4.0,
          block: int = 1024, seed: int = 7) -> DataFrame:
    """``rep, n, root``: link counts, weighted by ``m``, and spanning edges among ``distinct(grp, rep, m, vec)``.

    Vectors meet where they share a cell, some sign bits under one of several random rotations; the number of
    bits follows the logarithm of the row count, so a cell keeps about the same size, and the number of tables
    gives a pair at the threshold the chance ``recall`` of meeting. In a cell, binary codes with their correction
    factors estimate every inner product; only pairs whose upper confidence bound reaches ``least`` are computed
    in double precision. Cells over ``block`` rows are split into blocks, each pair of blocks a unit of its own.
    """
    bits, tables = _plan(distinct.count(), least, recall)
    turns = Turns(bits, tables, seed)
    rows = scratch.store(distinct.select("grp", "rep", "m", "vec").mapInArrow(_encoder(turns), _ROWS))
    cell = ["grp", "dim", "turn", "cell"]
    cells = rows.groupBy(*cell).agg(F.count("*").alias("size")).where("size > 1").withColumn(
        "blocks", F.ceil(F.col("size") / block).cast("int"))
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    spread = rows.join(cells, cell).withColumn("block", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = spread.select(
        *cell, F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
        "block", "rep", "m", "vec", "sign", "factor")
    key = [*cell, "lo", "hi"]
    return dealt.repartition(*key).sortWithinPartitions(*key).mapInArrow(_linker(turns, least, sure), _OUT)


def near_duplicates(vectors: DataFrame, least: float = 0.98, **how) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors(vec_id, embedding, label)``.

    Vectors link where labels are equal and not NULL, lengths are equal and the cosine in double precision is at
    least ``least``. NULL, empty and zero vectors and such with NULL or non-finite parts link with nothing.
    Exact copies are one vector with a multiplicity and link with each other. Repeated ids count as rows of their
    own; a row with a NULL id is counted as a partner, has a NULL component if it is alone, and is never kept.
    """
    scratch = Scratch(vectors.sparkSession, "embeddings")
    plain = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("grp"),
                           F.col("embedding").cast("array<double>").alias("vec"))
    good = F.coalesce(F.col("grp").isNotNull() & F.exists("vec", lambda x: x != 0) & F.forall(
        "vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    rows = plain.withColumn("good", good)
    classes = scratch.store(rows.where("good").groupBy("grp", "vec").agg(
        F.min("vec_id").alias("low"), F.count("*").alias("m")).withColumn("rep", F.xxhash64("grp", "vec")))
    found = scratch.store(links(classes, scratch, least, **how))
    counted = found.groupBy("rep").agg(F.sum("n").alias("n"))
    roots = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")), scratch)
    named = classes.join(counted, "rep", "left").join(roots, classes.rep == roots.node, "left").withColumn(
        "root", F.coalesce("root", "rep"))
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    named = scratch.store(named.join(lowest, "root").select(
        "grp", "vec", (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"), "component_id"))
    alone = rows.where("not good").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                          F.col("vec_id").alias("component_id"))
    joined = rows.where("good").join(named, ["grp", "vec"]).select("vec_id", "n_links", "component_id")
    return joined.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


@query("op6_embedding_near_duplicates")
def op6(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "embeddings"))
