"""Language-model scores by a hierarchical Pitman-Yor model with sampled seating."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartorio.llm.common import Scratch, query, table

#: Contexts of a token: the word before it, above it the class of words with its last two bytes, then of those with its
#: last byte, then the root. Words grow with the corpus, classes are at most 65,536 + 256 besides those of the start.
TWO, ONE = 65_537, 257
START_TWO, START_ONE = 65_536, 256
#: The end of a text as a token; no word holds a space.
END = b" "
#: Discounts and strengths of the restaurants of two bytes, of one byte, and of the root; those of whole words.
DISCOUNTS, STRENGTHS = (0.75, 0.7, 0.6), (1.0, 1.0, 1.0)
DISCOUNT, STRENGTH = 0.8, 1.0
#: A word as a context is a number: 47 bits of its hash, then its class.
CLASS = np.uint64(2 ** 17 - 1)
#: Customers that are seated side by side, dishes of more apart; fewer dishes than ``FEW`` move one after another.
ROOM, FEW = 1_000_000, 64

_SEGMENT = ("segment string, ids array<bigint>, held array<boolean>, sizes array<bigint>, tokens binary, "
            "hashes binary, classes binary, per_word binary")
_ASK = "bucket int, segment string, hashes binary, per_word binary, contexts binary, counts binary"
#: Rows of a bucket: its pairs (``words`` is given), a segment's places in them (``segment``), how they are seated
#: (``totals``), and what it has of a slice of the restaurants of whole words (``shard``).
_PAIRS = "bucket int, words binary, known binary, per_word binary, contexts binary, customers binary"
_SEATS = "bucket int, seats array<binary>, totals array<struct<level:int,context:int,customers:bigint,tables:bigint>>"
_SHARE = "bucket int, shard int, known binary, customers binary, tables binary"
_OPENED = f"{_PAIRS}, segment string, pairs binary{_SEATS.removeprefix('bucket int')}"
_SWEPT = f"{_SEATS}{_SHARE.removeprefix('bucket int')}"
_REPLY = "bucket int, shard int, customers binary, tables binary"
_ANSWER = "segment string, bucket int, counts binary, logs binary"
_SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
           "score double")


def pack(numbers: np.ndarray, steps: bool = False) -> bytes:
    """Unsigned numbers as compressed byte planes; ``steps`` for sorted ones keeps their differences."""
    x = np.asarray(numbers).astype("<u8")
    if steps and len(x):
        x = np.diff(x, prepend=np.uint64(0))
    width = max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 1
    planes = np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8)[:, :width].T)
    return bytes([width, steps]) + zstandard.compress(planes.tobytes(), 1)


def unpack(blob: bytes) -> np.ndarray:
    blob = bytes(blob)
    raw = np.frombuffer(zstandard.decompress(blob[2:]), np.uint8).reshape(blob[0], -1)
    out = np.zeros((raw.shape[1], 8), np.uint8)
    out[:, :blob[0]] = raw.T
    out = out.view("<u8").ravel()
    return np.cumsum(out, dtype=np.uint64) if blob[1] else out


def held_out(doc_id: str = "doc_id"):
    """Rows the model does not learn from: crc32 of the id as text, modulo 5, is 1; a NULL id is the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 5 == 1


def tokens_of(text: str | None) -> list[bytes]:
    """Words of a text, A-Z in lower case, then the end."""
    return [*(text or "").encode().lower().split(), END]


def two_bytes(words: list[bytes]) -> np.ndarray:
    """Classes of words, which are contexts of their own: their last two bytes."""
    last = np.frombuffer(b"".join([w[-2:].rjust(2, b"\0") for w in words]), ">u2").astype(np.int64)
    return np.where(np.array([w == END for w in words], bool), START_TWO, last)


class _Numbers(dict):
    """Words by the order in which they come first."""

    def __missing__(self, word):
        self[word] = n = len(self)
        return n


def context_of(hashes: np.ndarray, classes: np.ndarray) -> np.ndarray:
    return hashes & ~CLASS | classes.astype(np.uint64)


def two_of(contexts: np.ndarray) -> np.ndarray:
    return (contexts & CLASS).astype(np.int64)


def one_byte(two):
    return np.where(two == START_TWO, START_ONE, two & 255)


# --- segments: documents as numbers, and what they ask of the model -----------------------------------------------


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _starts(sizes) -> np.ndarray:
    """Place of the first token of each text."""
    return np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)


def _segments(size: int):
    def run(batches):
        part, made = TaskContext.get().partitionId(), 0
        ids, held, sizes, of, flat = [], [], [], _Numbers(), []

        def segment():
            words = list(of)
            hashes = np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)
            order = np.argsort(hashes)  # words stand by hash, so every bucket's are a slice
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            tok = rank[np.array(flat, np.int64)]
            before = np.concatenate([tok[:1], tok[:-1]])
            before[_starts(sizes)] = rank[of[END]]
            pairs, back = np.unique(tok * len(words) + before, return_inverse=True)
            return pa.RecordBatch.from_arrays([
                pa.array([f"{part}-{made}"]), pa.array([ids], pa.list_(pa.int64())), pa.array([held]),
                pa.array([sizes], pa.list_(pa.int64())), *[pa.array([x]) for x in (
                    pack(back), pack(hashes[order], True), pack(two_bytes(words)[order]),
                    pack(np.bincount(pairs // len(words), minlength=len(words))))]], _names(_SEGMENT))

        n = 0
        for b in batches:
            for i, out, text in zip(*(c.to_pylist() for c in b.columns)):
                t = tokens_of(text)
                flat.extend(map(of.__getitem__, t))
                ids.append(i)
                held.append(bool(out))
                sizes.append(len(t))
                n += len(t)
                if n >= size:
                    yield segment()
                    made, n, ids, held, sizes, of, flat = made + 1, 0, [], [], [], _Numbers(), []
        if ids:
            yield segment()
    return run


def _bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _pairs_of(row) -> tuple[np.ndarray, ...]:
    """Words of a segment, how many contexts each has, these contexts, and the training counts of the pairs."""
    hashes, classes, per, tokens = (unpack(row[c]) for c in ("hashes", "classes", "per_word", "tokens"))
    tokens, per, sizes = tokens.astype(np.int64), per.astype(np.int64), np.array(row["sizes"])
    word = np.repeat(np.arange(len(per)), per)
    # a pair's context is the word of the token before it
    context = np.empty(len(word), np.int64)
    context[tokens[1:]] = word[tokens[:-1]]
    starts = _starts(sizes)
    context[tokens[starts]] = word[tokens[-1]]  # every text ends with the token that also stands before the first one
    counts = np.bincount(tokens[np.repeat(~np.array(row["held"], bool), sizes)], minlength=len(word))
    return hashes, per, context_of(hashes, classes)[context], counts


def _asking(buckets: int):
    """One row per segment and bucket of words: its words, their contexts, and their training counts."""
    names = _names(_ASK)
    kinds = pa.schema([("bucket", pa.int32()), ("segment", pa.string()), *[(c, pa.binary()) for c in names[2:]]])

    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                hashes, per, contexts, counts = _pairs_of(row)
                bucket = _bucket_of(hashes, buckets)
                upto = np.concatenate([[0], np.cumsum(per)])
                rows = []
                for k in np.unique(bucket):
                    i, j = np.searchsorted(bucket, [k, k + 1])
                    pairs = slice(upto[i], upto[j])
                    rows.append((int(k), row["segment"], pack(hashes[i:j], True), pack(per[i:j]),
                                 pack(contexts[pairs]), pack(counts[pairs])))
                yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], kinds)
    return run


# --- seating -------------------------------------------------------------------------------------------------------


class Seating:
    """Tables of many dishes at once: ``owner`` is the dish of each table, in order, ``size`` its customers."""

    def __init__(self, owner: np.ndarray, size: np.ndarray, dishes: int):
        self.owner, self.size, self.dishes = owner, size, dishes

    @classmethod
    def one_table(cls, customers: np.ndarray) -> Seating:
        full = np.nonzero(customers > 0)[0].astype(np.int32)
        return cls(full, customers[full].astype(np.int32), len(customers))

    def packed(self) -> list[bytes]:
        return [pack(self.tables()), pack(self.size)]

    @classmethod
    def unpacked(cls, tables: bytes, size: bytes) -> Seating:
        n = unpack(tables).astype(np.int64)
        return cls(np.repeat(np.arange(len(n), dtype=np.int32), n), unpack(size).astype(np.int32), len(n))

    def tables(self) -> np.ndarray:
        return np.bincount(self.owner, minlength=self.dishes)

    def customers(self) -> np.ndarray:
        return np.bincount(self.owner, self.size, minlength=self.dishes).astype(np.int64)

    def _in_rooms(self, who: np.ndarray, room: np.ndarray, opening: np.ndarray, discount: float, rng, work) -> None:
        """``work`` on the customers of the dishes ``who``, some dishes at a time, the largest first."""
        order = np.argsort(-room, kind="stable")
        who, room, opening = who[order], room[order], opening[order]
        upto = np.cumsum(self.tables())  # tables stand by dish
        first, last = np.where(who > 0, upto[who - 1], 0), upto[who]
        moved = np.zeros(self.dishes, bool)
        moved[who] = True
        stay = ~moved[self.owner]
        owners, sizes = [self.owner[stay]], [self.size[stay]]
        batch = (np.cumsum(room) - room) // ROOM
        for low, high in zip(*(np.searchsorted(batch, np.unique(batch), side) for side in ("left", "right"))):
            part = slice(low, high)
            held = [self.size[slice(*ends)] for ends in zip(first[part], last[part])] if high - low < 100 else [
                self.size[_ranges(first[part], last[part] - first[part])]]
            r = _Room(np.concatenate(held), last[part] - first[part], room[part], opening[part], discount, rng)
            work(r, part, order)
            full = np.nonzero(r.size)[0]
            owners.append(np.repeat(who[part].astype(np.int32), room[part])[full])
            sizes.append(r.size[full])
            del r
        self.owner, self.size = np.concatenate(owners), np.concatenate(sizes)
        del owners, sizes
        order = np.argsort(self.owner, kind="stable")
        self.owner, self.size = self.owner[order], self.size[order]

    def leave(self, who: np.ndarray, rng) -> None:
        """A customer, each as likely as any other, leaves every dish of ``who``; empty tables go."""
        self._in_rooms(who, self.customers()[who], np.ones(len(who)), 0.0, rng, lambda r, part, order: r.shrink(r.seated - 1))

    def come(self, who: np.ndarray, opening: np.ndarray, discount: float, rng) -> None:
        """A customer sits down at every dish of ``who``: at a new table in proportion to ``opening``."""
        self._in_rooms(who, self.customers()[who] + 1, opening, discount, rng,
                       lambda r, part, order: r.move(r.seated, r.seated + 1, False))

    def reseat(self, wanted: np.ndarray, opening: np.ndarray, discount: float, rng) -> None:
        """Customers come or leave until every dish has ``wanted``; then every one of them leaves and sits down again.

        They do so one at a time, in random order, each where all others sit by then.
        """
        now = self.customers()
        who = np.nonzero((wanted > 1) | (now != wanted))[0]  # a lone customer has one table whatever is drawn
        goal = wanted[who]

        def work(r, part, order):
            upto = goal[order[part]]
            r.shrink(np.minimum(upto, r.seated))
            r.move(r.seated, upto, False)
            r.move(np.zeros(len(upto), np.int64), upto, True)
        self._in_rooms(who, np.maximum(now, wanted)[who], opening[who], discount, rng, work)


def _ranges(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """``first .. first + n`` of all entries, one after another."""
    return np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())


class _Room:
    """The customers of some dishes one by one: ``at`` is the table of each, ``size`` the customers of each table.

    A dish has ``room`` places for customers, the first ``seated`` of them taken, and as many for tables; ``free`` has the
    ``left`` empty ones among these.
    """

    def __init__(self, sizes: np.ndarray, tables: np.ndarray, room: np.ndarray, opening: np.ndarray, discount: float, rng):
        self.room, self.opening, self.discount, self.rng = room, opening, discount, rng
        self.first, total = np.cumsum(room) - room, int(room.sum())
        slots = _ranges(self.first, tables)
        self.size = np.zeros(total, np.int32)
        self.size[slots] = sizes
        upto = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(tables)])]
        self.seated = np.diff(upto).astype(np.int64)
        self.at = np.zeros(total, np.int32)
        self.at[_ranges(self.first, self.seated)] = np.repeat(slots, sizes)
        self.free = (np.arange(total) + np.repeat(tables, room)).astype(np.int32)
        self.left = room - tables

    def _emptied(self, d: np.ndarray, table: np.ndarray) -> None:
        """A customer of each of these tables, of different dishes, is gone."""
        self.size[table] -= 1
        gone = self.size[table] == 0
        d = d[gone]
        self.free[self.first[d] + self.left[d]] = table[gone]
        self.left[d] += 1

    def shrink(self, upto: np.ndarray) -> None:
        """Customers, each as likely as any other, leave until every dish has ``upto``."""
        d = np.nonzero(self.seated > upto)[0]
        while len(d):
            place = self.first[d] + (self.rng.random(len(d)) * self.seated[d]).astype(np.int64)
            self._emptied(d, self.at[place])
            self.seated[d] -= 1
            self.at[place] = self.at[self.first[d] + self.seated[d]]
            d = d[self.seated[d] > upto[d]]

    def move(self, start: np.ndarray, upto: np.ndarray, again: bool) -> None:
        """The customers ``start .. upto`` of every dish sit down one by one; ``again``: each leaves its table first."""
        gap = upto - start
        order = np.argsort(-gap, kind="stable")
        first, start, opening = self.first[order], start[order], self.opening[order]
        all_others = upto[order] - 1
        rounds = np.sort(gap[gap > 0])
        j = 0
        while len(rounds) and j < rounds[-1]:
            n = len(rounds) - int(np.searchsorted(rounds, j, "right"))
            if n < FEW:
                for k in order[:n]:
                    self._one_dish(k, int(upto[k] - gap[k] + j), int(upto[k]), again)
                break
            d, place = order[:n], start[:n] + j
            if again:  # one of those that have not moved yet
                other = first[:n] + place + (self.rng.random(n) * (all_others[:n] + 1 - place)).astype(np.int64)
                table = self.at[other]
                self.at[other] = self.at[first[:n] + place]
                self._emptied(d, table)
            others = all_others[:n] if again else place
            self.at[first[:n] + place] = self._sit(d, first[:n], place, others, opening[:n])
            j += 1
        self.seated = np.maximum(self.seated, upto)

    def _sit(self, d, first, place, others, opening) -> np.ndarray:
        """The table of a customer of each dish: a new one, or that of another customer, less likely at small tables."""
        out, todo = np.empty(len(d), np.int32), None
        while True:
            draw = self.rng.random((2, len(d)))
            r = draw[0] * (opening + others) - opening
            new = np.flatnonzero((r < 0) | (others == 0))
            at = np.minimum(r.astype(np.int64), others - 1)
            at += at >= place
            at += first
            at[new] = first[new]
            table = self.at[at]
            size = draw[1] * self.size[table]
            size[new] = 1
            more = np.flatnonzero(size < self.discount)
            if len(new):
                who = d[new]
                self.left[who] -= 1
                table[new] = self.free[first[new] + self.left[who]]
            if todo is None:
                out[:] = table
            else:
                out[todo] = table
            if not len(more):
                self.size[table] += 1
                return out
            self.size[np.delete(table, more)] += 1
            todo = more if todo is None else todo[more]
            d, first, place, others, opening = (x[more] for x in (d, first, place, others, opening))

    def _one_dish(self, d: int, start: int, upto: int, again: bool) -> None:
        """As ``move`` for one dish."""
        first, opening, discount = int(self.first[d]), float(self.opening[d]), self.discount
        part = slice(first, first + int(self.room[d]))
        at, size = (self.at[part] - first).tolist(), self.size[part].tolist()
        free = (self.free[first:first + int(self.left[d])] - first).tolist()
        draw = _numbers(self.rng).__next__
        for j in range(start, upto):
            others = j
            if again:
                others = upto - 1
                i = j + int(draw() * (upto - j))
                k = at[i]
                at[i] = at[j]
                size[k] -= 1
                if not size[k]:
                    free.append(k)
            while True:
                r = draw() * (opening + others) - opening
                if r < 0 or not others:
                    k = free.pop()
                    break
                i = min(int(r), others - 1)
                k = at[i + 1 if i >= j else i]
                if draw() * size[k] >= discount:
                    break
            size[k] += 1
            at[j] = k
        self.at[part], self.size[part] = np.array(at, np.int32) + first, size
        self.left[d] = len(free)
        self.free[first:first + len(free)] = np.array(free, np.int32) + first


def _numbers(rng):
    while True:
        yield from rng.random(4096).tolist()


class Bucket:
    """All restaurants' shares of some words: a word's dishes in the contexts of two bytes, of one, and in the root."""

    def __init__(self, words: np.ndarray, types: np.ndarray):
        self.words, self.types = words, types  # types: word, context of two bytes, customers
        word, two = types[0], types[1]
        mid, self.mid_of = np.unique(word * ONE + one_byte(two), return_inverse=True)
        self.mid_word, self.mid_context = mid // ONE, mid % ONE
        self.low = Seating.one_table(types[2])
        self.middle = Seating.one_table(
            np.bincount(self.mid_of, self.low.tables(), minlength=len(mid)).astype(np.int64))
        self.top = Seating.one_table(self._above(self.middle))

    def _above(self, middle: Seating) -> np.ndarray:
        return np.bincount(self.mid_word, middle.tables(), minlength=len(self.words)).astype(np.int64)

    def root(self, m) -> np.ndarray:
        c, t = self.top.customers(), self.top.tables()
        return (c - DISCOUNTS[2] * t + (STRENGTHS[2] + DISCOUNTS[2] * m.t0) / (m.v + 1)) / (STRENGTHS[2] + m.c0)

    def seen(self, m):
        """What ``predict`` looks up, the same for all that is asked of one seating."""
        return self.root(m), *((keys, s.customers(), s.tables()) for keys, s in (
            (self.mid_word * ONE + self.mid_context, self.middle), (self.types[0] * TWO + self.types[1], self.low)))

    def _middle(self, m, root: np.ndarray) -> np.ndarray:
        """Probability of the words in the contexts of one byte they have."""
        c, t = self.middle.customers(), self.middle.tables()
        return (c - DISCOUNTS[1] * t + (STRENGTHS[1] + DISCOUNTS[1] * m.t1[self.mid_context])
                * root[self.mid_word]) / (STRENGTHS[1] + m.c1[self.mid_context])

    def of_types(self, m) -> np.ndarray:
        """As ``predict`` for every type, looked up nowhere."""
        two, c, t = self.types[1], self.low.customers(), self.low.tables()
        return (c - DISCOUNTS[0] * t + (STRENGTHS[0] + DISCOUNTS[0] * m.t2[two])
                * self._middle(m, self.root(m))[self.mid_of]) / (STRENGTHS[0] + m.c2[two])

    def predict(self, m, word: np.ndarray, two: np.ndarray, seen=None) -> np.ndarray:
        """Probability of words of this bucket (-1: none of them) after contexts of two bytes."""
        root, middle, low = seen or self.seen(m)
        none = (STRENGTHS[2] + DISCOUNTS[2] * m.t0) / (m.v + 1) / (STRENGTHS[2] + m.c0)
        p = np.append(root, none)[word]
        one = one_byte(two)
        c, t = _looked_up(*middle, word * ONE + one)
        p = (c - DISCOUNTS[1] * t + (STRENGTHS[1] + DISCOUNTS[1] * m.t1[one]) * p) / (STRENGTHS[1] + m.c1[one])
        c, t = _looked_up(*low, word * TWO + two)
        return (c - DISCOUNTS[0] * t + (STRENGTHS[0] + DISCOUNTS[0] * m.t2[two]) * p) / (STRENGTHS[0] + m.c2[two])

    def sweep(self, m, rng) -> None:
        """One Gibbs sweep: every customer of every dish moves, from the contexts of two bytes up to the root."""
        root = self.root(m)
        opening = (STRENGTHS[0] + DISCOUNTS[0] * m.t2[self.types[1]]) * self._middle(m, root)[self.mid_of]
        self.low.reseat(self.types[2], opening, DISCOUNTS[0], rng)
        opening = (STRENGTHS[1] + DISCOUNTS[1] * m.t1[self.mid_context]) * root[self.mid_word]
        wanted = np.bincount(self.mid_of, self.low.tables(), minlength=len(self.mid_word)).astype(np.int64)
        self.middle.reseat(wanted, opening, DISCOUNTS[1], rng)
        opening = np.full(len(self.words), (STRENGTHS[2] + DISCOUNTS[2] * m.t0) / (m.v + 1))
        self.top.reseat(self._above(self.middle), opening, DISCOUNTS[2], rng)

    def totals(self):
        """``level, context, customers, tables`` of this bucket's share of every restaurant."""
        for level, context, s in ((2, self.types[1], self.low), (1, self.mid_context, self.middle)):
            c, t = np.bincount(context, s.customers()), np.bincount(context, s.tables())
            for k in np.nonzero(c)[0]:
                yield level, int(k), int(c[k]), int(t[k])
        yield 0, 0, int(self.top.customers().sum()), int(self.top.tables().sum())
        yield -1, 0, len(self.words), int(self.types[2].sum())


def _looked_up(known: np.ndarray, customers: np.ndarray, tables: np.ndarray, asked: np.ndarray):
    """Customers and tables of the asked dishes, 0 for unknown ones; ``known`` is sorted."""
    if not len(known):
        return np.zeros(len(asked)), np.zeros(len(asked))
    at = np.minimum(np.searchsorted(known, asked), len(known) - 1)
    hit = known[at] == asked
    return np.where(hit, customers[at], 0), np.where(hit, tables[at], 0)


class Totals:
    """Customers and tables of every restaurant, distinct training tokens and all training tokens."""

    def __init__(self, rows):
        self.c2, self.t2, self.c1, self.t1 = (np.zeros(n) for n in (TWO, TWO, ONE, ONE))
        self.c0 = self.t0 = self.v = self.n = 0
        for r in rows:
            if r["level"] == 2:
                self.c2[r["context"]], self.t2[r["context"]] = r["customers"], r["tables"]
            elif r["level"] == 1:
                self.c1[r["context"]], self.t1[r["context"]] = r["customers"], r["tables"]
            elif r["level"] == 0:
                self.c0, self.t0 = r["customers"], r["tables"]
            else:
                self.v, self.n = r["customers"], r["tables"]


class Pairs:
    """Some words after every word: their dishes in the restaurants of whole words, and in those above."""

    def __init__(self, words: np.ndarray, known: np.ndarray, types: np.ndarray, seats: list[bytes] | None = None):
        """``types``: word, place of the context in ``known``, customers; without ``seats`` a dish has one table."""
        self.words, self.known = words, known
        self.types = types[0].astype(np.int32), types[1].astype(np.int32), types[2].astype(np.int64)
        above, of = np.unique(self.types[0].astype(np.int64) * TWO + two_of(known)[self.types[1]], return_inverse=True)
        self.above_of = of.astype(np.int32)
        self.low = Seating.unpacked(*seats[:2]) if seats else Seating.one_table(types[2])
        self.above = Bucket(words, np.array([above // TWO, above % TWO, self._guests(len(above))]))
        if seats:
            self.above.low, self.above.middle, self.above.top = (Seating.unpacked(*seats[i:i + 2]) for i in (2, 4, 6))

    def _guests(self, dishes: int) -> np.ndarray:
        """Customers in the classes: the tables of whole words."""
        return np.bincount(self.above_of, self.low.tables(), minlength=dishes).astype(np.int64)

    def _classes(self, m) -> np.ndarray:
        """Probability of the word of each pair after the class of its context."""
        return self.above.of_types(m)[self.above_of]

    def predict(self, m, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """Probability of each pair's word after its context; given are the totals of the restaurants ``known``."""
        context, c, t = self.types[1], self.low.customers(), self.low.tables()
        return (c - DISCOUNT * t + (STRENGTH + DISCOUNT * tables[context]) * self._classes(m)) / (
            STRENGTH + customers[context])

    def sweep(self, m, tables: np.ndarray, rng) -> None:
        """One Gibbs sweep from the contexts of whole words up to the root."""
        opening = (STRENGTH + DISCOUNT * tables[self.types[1]]) * self._classes(m)
        self.low.reseat(self.types[2], opening, DISCOUNT, rng)
        self.above.types[2] = self._guests(len(self.above.types[2]))
        self.above.sweep(m, rng)

    def counts(self) -> np.ndarray:
        """Training counts of the words."""
        return np.bincount(self.types[0], self.types[2], minlength=len(self.words)).astype(np.int64)

    def seats(self) -> list[bytes]:
        return [x for s in (self.low, self.above.low, self.above.middle, self.above.top) for x in s.packed()]

    def shares(self):
        """Customers and tables that the restaurants ``known`` have here."""
        return tuple(np.bincount(self.types[1], x, minlength=len(self.known)).astype(np.int64)
                     for x in (self.types[2], self.low.tables()))

    def totals(self):
        """As those of the restaurants above; words and customers (level -1) are those of training texts."""
        yield from (r for r in self.above.totals() if r[0] >= 0)
        n = self.counts()
        yield -1, 0, int((n > 0).sum()), int(n.sum())


def _open(key, rows: pd.DataFrame) -> pd.DataFrame:
    """A bucket's words, all pairs (word, context) asked with their training counts, and the pairs of every segment."""
    asked = [(r["segment"], *(unpack(r[c]) for c in ("hashes", "per_word", "contexts", "counts")))
             for r in rows.to_dict("records")]
    words, word = np.unique(np.concatenate([h for _, h, *_ in asked]), return_inverse=True)
    known, place = np.unique(np.concatenate([c for *_, c, _ in asked]), return_inverse=True)
    place += np.repeat(word, np.concatenate([per for _, _, per, *_ in asked]).astype(np.int64)) * len(known)
    pairs, of = np.unique(place, return_inverse=True)
    del word, place
    customers = np.bincount(of, np.concatenate([n for *_, n in asked]), minlength=len(pairs)).astype(np.int64)
    ends = np.cumsum([len(c) for *_, c, _ in asked])
    asks = [{"segment": segment, "pairs": pack(x)} for (segment, *_), x in zip(asked, np.split(of, ends[:-1]))]
    del asked, of
    types = (pairs // len(known)).astype(np.int32), (pairs % len(known)).astype(np.int32), customers
    state = {
        "words": pack(words, True), "known": pack(known, True),
        "per_word": pack(np.bincount(types[0], minlength=len(words))), "contexts": pack(types[1]),
        "customers": pack(customers)}
    del pairs
    return _rows(_OPENED, key, [state, {"seats": [], "totals": _totals(Pairs(words, known, types))}, *asks])


def _rows(schema: str, key, rows: list[dict]) -> pd.DataFrame:
    return pd.DataFrame([dict.fromkeys(_names(schema)) | r | {"bucket": int(key[0])} for r in rows])


def _totals(pairs: Pairs) -> list[dict]:
    return [dict(zip(("level", "context", "customers", "tables"), r)) for r in pairs.totals()]


def _shares(known: np.ndarray, customers: np.ndarray, tables: np.ndarray, shards: int) -> list[dict]:
    """What a bucket has of the restaurants of whole words, in slices of their numbers."""
    shard, out = _bucket_of(known, shards), []
    for k in np.unique(shard):
        part = slice(*np.searchsorted(shard, [k, k + 1]))
        out.append({"shard": int(k), "known": pack(known[part], True), "customers": pack(customers[part]),
                    "tables": pack(tables[part])})
    return out


def _first_shares(shards: int):
    """As ``_shares`` before the first sweep, with one table a dish."""
    kinds = pa.schema([("bucket", pa.int32()), ("shard", pa.int32()),
                       *[(c, pa.binary()) for c in ("known", "customers", "tables")]])

    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                known, contexts, n = (unpack(row[c]) for c in ("known", "contexts", "customers"))
                customers, tables = (np.bincount(contexts.astype(np.int64), x, minlength=len(known)) for x in (n, n > 0))
                yield pa.RecordBatch.from_pylist(
                    [r | {"bucket": row["bucket"]} for r in _shares(known, customers, tables, shards)], kinds)
    return run


def _seated(rows: pd.DataFrame) -> Pairs:
    """A bucket as its seats have it, or with one table a dish before the first sweep."""
    row = rows[rows["words"].notna()].to_dict("records")[0]
    (seats,) = rows.loc[rows["seats"].notna(), "seats"]
    per = unpack(row["per_word"]).astype(np.int64)
    types = np.repeat(np.arange(len(per), dtype=np.int32), per), unpack(row["contexts"]), unpack(row["customers"])
    return Pairs(unpack(row["words"]), unpack(row["known"]), types, list(seats))


def _summed(key, rows: pd.DataFrame) -> pd.DataFrame:
    """Totals of the restaurants of a slice, for every bucket in the order it gave them."""
    known, customers, tables = ([unpack(x) for x in rows[c]] for c in ("known", "customers", "tables"))
    _, of = np.unique(np.concatenate(known), return_inverse=True)
    customers, tables = (np.bincount(of, np.concatenate(x)).astype(np.int64)[of] for x in (customers, tables))
    ends = np.cumsum([len(x) for x in known])[:-1]
    return pd.DataFrame({"bucket": rows["bucket"], "shard": rows["shard"],
                         **{n: [pack(x) for x in np.split(all_, ends)]
                            for n, all_ in (("customers", customers), ("tables", tables))}})


def _replied(replies: pd.DataFrame):
    """Customers and tables of a bucket's restaurants of whole words, which stand by number, so by slice."""
    replies = replies.sort_values("shard")
    return tuple(np.concatenate([unpack(x) for x in replies[c]]).astype(np.int64) for c in ("customers", "tables"))


def _swept(now: Totals, i: int, shards: int, seed: int):
    """Seats of a bucket after its sweep number ``i``, and its shares."""
    def run(key, rows: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        pairs = _seated(rows)
        pairs.sweep(now, _replied(replies)[1], np.random.default_rng((seed, i, int(key[0]))))
        seats = {"seats": pairs.seats(), "totals": _totals(pairs)}
        return _rows(_SWEPT, key, [seats, *_shares(pairs.known, *pairs.shares(), shards)])
    return run


def _answering(now: Totals, burn: int, samples: int, apart: int, seed: int):
    """For every segment: training counts of its words, and log10 of their mean probabilities over the samples."""
    def run(key, rows: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        pairs = _seated(rows)
        customers, tables = _replied(replies)
        rng = np.random.default_rng((seed, burn, int(key[0])))
        total = 0
        for s in range(samples):
            for _ in range(apart if s else 0):
                pairs.sweep(now, tables, rng)
            total = total + pairs.predict(now, customers, tables)
        logs, count = np.log10(total / samples).astype("<f4").view("<u4"), pairs.counts()
        out = []
        for ask in rows[rows["segment"].notna()].to_dict("records"):
            asked = unpack(ask["pairs"]).astype(np.int64)
            word = pairs.types[0][asked]
            first = np.diff(word, prepend=-1) != 0  # a segment's words stand by hash here too
            out.append({"segment": ask["segment"], "bucket": int(key[0]), "counts": pack(count[word[first]]),
                        "logs": pack(logs[asked])})
        return pd.DataFrame(out)
    return run


def _scoring(v: int, n: int):
    def run(_, segment: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        row = segment.to_dict("records")[0]
        per, tokens = (unpack(row[c]).astype(np.int64) for c in ("per_word", "tokens"))
        parts = answers.sort_values("bucket").to_dict("records")  # words stand by hash, so by bucket
        counts = np.concatenate([unpack(a["counts"]) for a in parts]).astype(float)
        logs = np.concatenate([unpack(a["logs"]).astype("<u4").view("<f4") for a in parts]).astype(float)
        word = np.repeat(np.arange(len(per)), per)
        base = np.log10((counts + 0.5) / (n + 0.5 * (v + 1)))[word]
        first = _starts(row["sizes"])
        add = lambda x: np.add.reduceat(x[tokens], first)
        return pd.DataFrame({
            "doc_id": pd.array(row["ids"], "Int64"), "held_out": row["held"], "n_tokens": row["sizes"],
            "n_known": add((counts > 0)[word].astype(np.int64)), "train_tokens": n,
            "base_score": add(base), "score": add(logs)})
    return run


def score(docs: DataFrame, held: str = "held_out", segment: int = 1_000_000, bucket: int = 2_000_000, burn: int = 2,
          samples: int = 3, apart: int = 1, seed: int = 1) -> DataFrame:
    """Scores of every row of ``docs(doc_id, text, held_out)`` under a model of the rows that are not held out.

    A hierarchical Pitman-Yor model: tokens are dishes, a context is the whole word before, its parent the class of
    words with the same last two bytes, then that with the same last byte, then the root, whose base is uniform
    over the distinct training tokens and one unknown.
    Customers start at one table per dish; in a Gibbs sweep every customer of every dish leaves and sits down again.
    ``burn`` sweeps go before, then ``samples`` seatings, ``apart`` sweeps apart, give probabilities that are
    averaged; their logarithms are kept in single precision. The totals of the restaurants are those of the
    start of a sweep (of the first sample, while sampling), so that buckets of words can be swept side by side.

    Work is split twice. Documents form segments of about ``segment`` tokens, which ask each (word, context) once,
    however often it occurs; words form buckets by hash, about one per ``bucket`` asked pairs, which count, seat
    and answer. Restaurants of whole words grow with the corpus and have guests in many buckets: before each sweep their
    totals are summed in slices by hash and sent to the buckets that have them. Only the totals of the
    restaurants of classes and of the root, of which there are at most 65,796, come to the driver.

    Repeated rows are texts of their own. NULL texts are empty: one token, the end. Other columns are ignored.
    With no training rows, every token has the base probability 1.
    """
    scratch = Scratch(docs.sparkSession, "language-model")
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col(held), F.lit(False)), "text")
    segments = scratch.store(rows.mapInArrow(_segments(segment), _SEGMENT))
    tokens = segments.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    buckets = max(1, math.ceil(tokens * 3 / 4 / bucket))  # up to three in four tokens are pairs new to their segment
    asked = segments.select("segment", "held", "sizes", "tokens", "hashes", "classes", "per_word").mapInArrow(
        _asking(buckets), _ASK)
    opened = scratch.store(asked.repartition(buckets, "bucket").groupBy("bucket").applyInPandas(_open, _OPENED), True)
    pairs = opened.where("words is not null").select(_names(_PAIRS))
    seats = opened.where("totals is not null").select(_names(_SEATS))
    shares, swept = pairs.select("bucket", "known", "contexts", "customers").mapInArrow(_first_shares(buckets), _SHARE), None
    for i in range(burn + 1):
        now = Totals(seats.select(F.explode("totals").alias("t")).groupBy("t.level", "t.context").agg(
            F.sum("t.customers").alias("customers"), F.sum("t.tables").alias("tables")).collect())
        replies = scratch.store(
            shares.repartition(buckets, "shard").groupBy("shard").applyInPandas(_summed, _REPLY), True)
        if i:  # the shares are done with
            seats = scratch.store(seats)
            scratch.drop(swept)
        rows = pairs.unionByName(seats.select("bucket", "seats"), allowMissingColumns=True)
        if i == burn:
            rows = rows.unionByName(opened.where("segment is not null").select("bucket", "segment", "pairs"),
                                    allowMissingColumns=True)
        rows, told = (df.repartition(buckets, "bucket").groupBy("bucket") for df in (rows, replies))
        if i < burn:  # the seating is stored, so a sweep is made once
            swept = scratch.store(rows.cogroup(told).applyInPandas(_swept(now, i, buckets, seed), _SWEPT), True)
            if i:
                scratch.drop(seats)
            scratch.drop(replies)
            seats, shares = (swept.where(f"{kind} is not null").select(_names(columns))
                             for kind, columns in (("totals", _SEATS), ("shard", _SHARE)))
    answers = scratch.store(rows.cogroup(told).applyInPandas(_answering(now, burn, samples, apart, seed), _ANSWER), True)
    for df in (opened, replies, *([seats] if burn else [])):
        scratch.drop(df)
    return segments.select("segment", "ids", "held", "sizes", "tokens", "per_word").groupBy("segment").cogroup(
        answers.groupBy("segment")).applyInPandas(_scoring(now.v, now.n), _SCORES)


@query("op3_language_model")
def op3(spark, sf_dir):
    return score(table(spark, sf_dir, "documents").withColumn("held_out", held_out()))
