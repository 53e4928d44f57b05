"""Prefix trie of conversations: union-find over the common prefixes of sorted neighbours, deepest first."""

from __future__ import annotations

import hashlib
from itertools import accumulate, groupby

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartorio.llm.common import Scratch, query, table

#: Bytes of a turn's digest in a key.
WIDE = 16
NODE, PIECE, END, BORDER = range(4)
_FOREST = ("kind int, id binary, parent_id binary, conv_id long, parent_conv_id long, depth long, n long, "
           "leaves long, shared long, before long, edges long, ends long, sha string, key binary, words array<int>")
_TYPES = [pa.int32(), pa.binary(), pa.binary(), *[pa.int64()] * 9, pa.string(), pa.binary(), pa.list_(pa.int32())]
_NAMES = [c.split()[0] for c in _FOREST.split(", ")]
_NONE = hashlib.sha256(b"").hexdigest()


def keys(turns: DataFrame) -> DataFrame:
    """``conv_id, key, words``: each conversation's turns in order, as digests of 16 bytes, and their word counts.

    ``turns(conv_id, turn, role, text)`` are ordered by turn, NULL first, ties by digest; repeated rows are turns
    of their own. NULL roles and texts are empty. Rows without a conversation are left out, other columns too.
    Only digests and counts are gathered by conversation, 20 bytes a turn; texts never are.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    rows = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        digest.alias("digest"), F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("int").alias("words"))
    held = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "digest", "words"))).alias("t"))
    hexed = F.array_join(F.transform("t", lambda x: F.hex(x["digest"])), "")
    return held.select("conv_id", F.unhex(hexed).alias("key"), F.col("t.words").alias("words"))


def _common(a: bytes, b: bytes) -> int:
    """Turns that two keys have in common from the start."""
    low, high = 0, min(len(a), len(b)) // WIDE
    if a[:high * WIDE] == b[:high * WIDE]:
        return high
    while high - low > 1:
        mid = (low + high) // 2
        if a[low * WIDE:mid * WIDE] == b[low * WIDE:mid * WIDE]:
            low = mid
        else:
            high = mid
    return low


def _ids(key: bytes, depth: int) -> list[bytes]:
    """Names of the nodes of a key down to ``depth``: digests of its prefixes."""
    h, out = hashlib.md5(), []
    for d in range(depth + 1):
        out.append(h.copy().digest())
        h.update(key[d * WIDE:(d + 1) * WIDE])
    return out


def _listed(convs) -> str:
    return hashlib.sha256(",".join(map(str, convs)).encode()).hexdigest() if convs else _NONE


def _forest(keys: list[bytes], convs: list[int], words: list[list[int]], before: bytes | None, after: bytes | None):
    """The trie of one block of sorted keys: rows of its finished nodes, and of pieces of those that go on outside.

    ``before`` and ``after`` are the neighbouring keys where they are known. Edges between neighbours are taken
    in descending depth of their common prefix; where components meet, a branching node is made, and the nodes
    on the way from it down to each part are finished. All figures are sums over members and edges, so pieces of
    a node from several blocks add up: ``shared`` has the words of each edge's common prefix.
    """
    m = len(keys)
    deep = [len(k) // WIDE for k in keys]
    sums = [list(accumulate(w, initial=0)) for w in words]
    lcp = [0] + [_common(keys[i - 1], keys[i]) for i in range(1, m)]
    left = deep[0] if before is None else _common(before, keys[0])
    right = deep[-1] if after is None else _common(keys[-1], after)
    left_ids, right_ids = _ids(keys[0], left), _ids(keys[-1], right)
    leaves = [int(lcp[i + 1] < deep[i]) for i in range(m - 1)] + [int(after is not None and right < deep[-1])]
    n, low, shared, edges, ends = [1] * m, list(convs), [0] * m, [0] * m, [1] * m
    depth, last, parent = list(deep), list(range(m)), list(range(m))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def name(first, end, d):
        """Of a node that other blocks may have too; None for one that lies within this block."""
        if first == 0 and d <= left:
            return left_ids[d]
        return right_ids[d] if end == m - 1 and d <= right else None

    def chain(c, top, above, first, end):
        """Rows from the lowest node of component ``c`` up to below depth ``top`` of the component it goes to."""
        for d in range(depth[c], top, -1):
            lowest, on_top = d == depth[c], d == top + 1
            e, k = (edges[c], ends[c]) if lowest else (0, 0)
            prior = sums[c][d - 1] if d else 0
            own = name(c, last[c], d)
            up = None if d == 0 else name(first, end, d - 1) if on_top else name(c, last[c], d - 1)
            if own is None:
                yield (NODE, None, up, low[c], (above if on_top else low[c]) if up is None else None, d, n[c], leaves[c],
                       shared[c] - (n[c] - 1) * prior, 0, e + 1 - k, k, _listed(convs[c:c + k]), None, None)
                continue
            more = shared[c]
            if c == 0 and before is not None and d <= left:
                more, e = more + sums[0][left], e + (d == left)
            yield PIECE, own, up, low[c], None, d, n[c], leaves[c], more, prior, e, k, None, None, None
            for conv in convs[c:c + k]:  # those that end at the node sort first
                yield END, own, None, conv, None, d, 0, 0, 0, 0, 0, 0, None, None, None

    for d, group in groupby(sorted(range(1, m), key=lambda i: (-lcp[i], i)), key=lambda i: lcp[i]):
        met = {}
        for i in group:
            a, b = find(i - 1), find(i)
            parts = met.pop(a, None) or [a]
            parts.extend(met.pop(b, None) or [b])
            parent[b], met[a] = a, parts
        for a, parts in met.items():
            above, end = min(low[p] for p in parts), last[parts[-1]]
            for p in parts:
                if depth[p] > d:
                    yield from chain(p, d, above, a, end)
            ends[a] = sum(depth[p] == d for p in parts)
            n[a], leaves[a] = sum(n[p] for p in parts), sum(leaves[p] for p in parts)
            edges[a] = len(parts) - 1
            shared[a] = sum(shared[p] for p in parts) + edges[a] * sums[a][d]
            depth[a], low[a], last[a] = d, above, end
    yield from chain(0, -1, None, 0, m - 1)


def _batches(rows):
    """Rows in record batches of some thousands."""
    held = []
    for row in rows:
        held.append(row)
        if len(held) == 20_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), _TYPES)], _NAMES)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), _TYPES)], _NAMES)


def _forests(block: int):
    """Over one slice of the sorted keys: forests of blocks of about ``block`` turns, and the slice's two borders."""
    def rows(batches):
        keys, convs, words, before, size = [], [], [], None, 0

        def border(i, side):
            return (BORDER, None, None, convs[i], None, side, *[0] * 6, None, keys[i], words[i])

        for b in batches:
            for key, conv, w in zip(*(c.to_pylist() for c in b.columns)):
                if size >= block:
                    yield from _forest(keys, convs, words, before, key)
                    before, size = keys[-1], 0
                    keys, convs, words = [], [], []
                keys.append(key)
                convs.append(conv)
                words.append(w)
                if before is None and len(keys) == 1:
                    yield border(0, 0)
                size += 1 + len(w)
        if keys:
            yield border(-1, 1)
            yield from _forest(keys, convs, words, before, None)
    return lambda batches: _batches(rows(batches))


def _borders(batches):
    """What the edge from a slice's last key to the next slice's first one adds to the nodes above it."""
    def rows():
        for b in batches:
            for key, w, after in zip(*(c.to_pylist() for c in b.columns)):
                sums, deep = list(accumulate(w, initial=0)), len(w)
                both = -1 if after is None else _common(key, after)
                for d, own in enumerate(_ids(key, deep)):
                    yield (PIECE, own, None, None, None, d, 0, int(both < deep), sums[both] if d <= both else 0,
                           sums[d - 1] if d else 0, int(d == both), 0, None, None, None)
    return _batches(rows())


def _digests(batches):
    """SHA-256 of the ids of each node, over rows sorted by node and id: no list of them is ever held."""
    now, h, ids, shas = None, None, [], []
    for b in batches:
        part = []
        for own, conv in zip(*(c.to_pylist() for c in b.columns)):
            if own != now:
                if now is not None:
                    h.update(",".join(part).encode())
                    ids.append(now)
                    shas.append(h.hexdigest())
                now, h, part = own, hashlib.sha256(), [str(conv)]
            else:
                part.append("," + str(conv) if not part else str(conv))
        h.update(",".join(part).encode())
        if len(ids) > 20_000:
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), pa.array(shas)], ["id", "sha"])
            ids, shas = [], []
    if now is not None:
        ids.append(now)
        shas.append(h.hexdigest())
    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), pa.array(shas, pa.string())], ["id", "sha"])


def prefix_trie(keyed: DataFrame, block: int = 200_000) -> DataFrame:
    """Every node of the trie of ``keyed(conv_id, key, words)``, rows as of ``keys``; conversation ids are distinct.

    A node is a distinct sequence of first turns, the root that of none; its members are the conversations that
    start with it. Columns: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (that of the parent; NULL
    for the root), ``n_convs``, ``n_children``, ``n_leaves`` (childless nodes in its subtree), ``saved_tokens`` (words
    of last turns in the subtree, once for every member but one), ``ends_sha256`` (of the ids that end here).

    Keys are sorted over all tasks, copies by id, so a group of copies is cut like anything else. Blocks of a
    sorted slice build forests on their own. Nodes that reach a block's edge go out as pieces, contracted to one
    row a depth; a group by their names merges them, with one row more for each edge between two slices.
    Conversations without turns are members of the root. An empty table has no nodes.
    """
    scratch = Scratch(keyed.sparkSession, "trie")
    held = scratch.store(keyed.select("key", "conv_id", "words"))
    ranged = held.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    forest = scratch.store(ranged.mapInArrow(_forests(block), _FOREST))
    # two rows a slice
    after = F.lead("key").over(Window.orderBy("key", "conv_id", "depth")).alias("after")
    lasts = forest.where(F.col("kind") == BORDER).select("key", "words", after, "depth").where("depth = 1")
    edges = lasts.select("key", "words", "after").mapInArrow(_borders, _FOREST)
    pieces = forest.where(F.col("kind") == PIECE).unionByName(edges)
    opened = scratch.store(pieces.groupBy("id").agg(
        F.max("parent_id").alias("parent_id"), F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"),
        F.max("before").alias("before"), *[F.sum(c).alias(c) for c in ("n", "leaves", "shared", "edges", "ends")]))
    ended = forest.where(F.col("kind") == END).select("id", "conv_id").repartition("id").sortWithinPartitions(
        "id", "conv_id").mapInArrow(_digests, "id binary, sha string")
    merged = opened.join(ended, "id", "left").select(
        "conv_id", "depth", "parent_id", F.lit(None).cast("long").alias("parent_conv_id"), "n",
        (F.col("edges") + 1 - F.col("ends")).alias("edges"), "leaves",
        (F.col("shared") - (F.col("n") - 1) * F.col("before")).alias("shared"),
        F.coalesce("sha", F.lit(_NONE)).alias("sha"))
    closed = forest.where(F.col("kind") == NODE).select(merged.columns)
    parents = opened.select(F.col("id").alias("parent_id"), F.col("conv_id").alias("above"))
    unnamed = closed.where("parent_id is not null").unionByName(merged).join(parents, "parent_id", "left")
    nodes = closed.where("parent_id is null").withColumn("above", F.col("parent_conv_id")).unionByName(
        unnamed.select(*merged.columns, "above"))
    return nodes.select(
        "conv_id", "depth", F.col("above").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("edges").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("shared").alias("saved_tokens"),
        F.col("sha").alias("ends_sha256"))


def with_shared_openings(keyed: DataFrame, group: int = 20, most: int = 4) -> DataFrame:
    """Each conversation ``c`` with its first ``h`` turns taken from conversation ``c - c % group``.

    ``h`` is crc32 of the decimal id modulo ``most``; where the other one is absent or shorter there are fewer.
    """
    h, head = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int"), most - 1
    heads = keyed.select(F.col("conv_id").alias("base"), F.expr(f"substring(key, 1, {WIDE * head})").alias("head"),
                         F.slice("words", 1, head).alias("head_words"))
    rows = keyed.select("*", (F.col("conv_id") - F.col("conv_id") % group).alias("base"), h.alias("h")).join(
        heads, "base", "left")
    return rows.select(
        "conv_id",
        F.expr(f"concat(coalesce(substring(head, 1, {WIDE} * h), X''), substring(key, {WIDE} * h + 1))").alias("key"),
        F.expr("concat(coalesce(slice(head_words, 1, h), array()), slice(words, h + 1, size(words)))").alias("words"))


_CRC = """xor(4294967295::UBIGINT, list_reduce(
  list_prepend(4294967295::UBIGINT, list_transform(generate_series(1, length(s)), lambda i: ascii(substr(s, i, 1))::UBIGINT)),
  lambda acc, b: list_reduce(list_prepend(xor(acc, b), [0,0,0,0,0,0,0,0]::UBIGINT[]),
    lambda r, z: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384::UBIGINT) ELSE r >> 1 END)))"""

_SQL = f"""
WITH t AS (
  SELECT conv_id, turn, length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '') AS said,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS w
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(said)) AS pos FROM t),
convs AS (SELECT conv_id, conv_id - conv_id % 20 AS base, {_CRC} % 4 AS h
          FROM (SELECT DISTINCT conv_id, conv_id::VARCHAR AS s FROM t)),
made AS (
  SELECT c.conv_id, 0 AS part, o.pos, o.said, o.w FROM convs c JOIN own o ON o.conv_id = c.base AND o.pos <= c.h
  UNION ALL
  SELECT c.conv_id, 1, o.pos, o.said, o.w FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.pos > c.h),
whole AS (SELECT conv_id, list(said ORDER BY part, pos) AS path, list(w ORDER BY part, pos) AS ws FROM made GROUP BY 1
          UNION ALL SELECT conv_id, [], [] FROM convs WHERE conv_id NOT IN (SELECT conv_id FROM made)),
starts AS (SELECT conv_id, d, path[1:d] AS node, path[1:d - 1] AS up, CASE WHEN d = 0 THEN 0 ELSE ws[d] END AS w,
                  len(path) = d AS ends
           FROM whole, unnest(generate_series(0, len(path))) AS g(d)),
nodes AS (SELECT node, d, min(up) AS up, min(conv_id) AS conv_id, count(*) AS n, min(w) AS w,
                 sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS sha
          FROM starts GROUP BY node, d),
kids AS (SELECT up AS node, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
full_nodes AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM nodes n LEFT JOIN kids k ON k.node = n.node),
below AS (SELECT node[1:g] AS node, sum((n_children = 0)::BIGINT) AS n_leaves, sum((n - 1) * w) AS saved
          FROM full_nodes, unnest(generate_series(0, d)) AS s(g) GROUP BY 1)
SELECT f.conv_id::BIGINT AS conv_id, f.d::BIGINT AS depth, p.conv_id::BIGINT AS parent_conv_id, f.n::BIGINT AS n_convs,
       f.n_children::BIGINT AS n_children, b.n_leaves::BIGINT AS n_leaves, b.saved::BIGINT AS saved_tokens,
       f.sha AS ends_sha256
FROM full_nodes f JOIN below b ON b.node = f.node LEFT JOIN nodes p ON f.d > 0 AND p.node = f.up
"""


@query("op11_conversation_trie", _SQL)
def op11(spark, sf_dir):
    return prefix_trie(with_shared_openings(keys(table(spark, sf_dir, "conversations"))))
