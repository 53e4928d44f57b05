"""Personal data by regular expressions, checksums and context words; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartorio.llm.common import query, table

KINDS = ("email", "ip", "card", "phone", "iban")
#: Kinds of the contract; those after them are the method's own.
BASE = 4
# Possessive repeats never backtrack and never recurse, and no match starts inside a run that an earlier start has
# already tried, so the time stays linear in the text; what they match is what the plain patterns match.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
}
#: A text without this cannot match; saves a pass with the pattern.
_NEEDS = {"email": "@", "phone": "+", "ip": "."}
#: Confidence of a span that passed its check, and the words shortly before it that raise it.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.8}
CONTEXT = {
    "email": "e-?mail|contact|write|mail", "ip": r"\bip\b|host|server|address", "card": "card|visa|credit|payment",
    "phone": "phone|call|tel|mobile|fax", "iban": "iban|account|bank|transfer",
}
RAISE, REACH = 0.2, 40
#: Matches worked on between two appends to the whole result, and characters of a block that pieces are cut from.
CHUNK, BLOCK = 256, 256


def _mod97(iban: Column) -> Column:
    """Remainder of an account number by 97, its country and check digits moved to the end, letters as 10 to 35."""
    v = F.regexp_replace(iban, r"\x20", "")
    moved = F.concat(F.substring(v, 5, 34), F.substring(v, 1, 4))
    step = lambda acc, c: F.when(
        F.ascii(c) >= 65, (acc * 100 + F.ascii(c) - 55) % 97).otherwise((acc * 10 + F.ascii(c) - 48) % 97)
    return F.aggregate(F.filter(F.split(moved, ""), lambda c: c != ""), F.lit(0), step)


def _valid(kind: str, v: Column) -> Column:
    digits = F.regexp_replace(v, "[^0-9]", "")
    return {
        "email": lambda: F.lit(True),
        # as doubles, parts of any length compare
        "ip": lambda: F.forall(F.split(v, r"\."), lambda p: p.cast("double") <= 255),
        "card": lambda: F.length(digits).between(12, 19) & F.call_function("luhn_check", digits),
        "phone": lambda: F.length(digits).between(9, 15),
        "iban": lambda: _mod97(v) == 1,
    }[kind]()


def _let(value: Column, made) -> Column:
    """``made(value)``, with ``value`` computed once however often it is used."""
    return F.element_at(F.transform(F.array(value), made), 1)


def _carried(items: Column, kind: str, step, finish, last=lambda acc: acc.out) -> Column:
    """``items`` from first to last, with a place ``at`` carried along and a list ``out`` of ``kind`` grown by ``step``.

    Appending copies a list, so it is done to the list of one chunk; ``finish`` makes one value of each chunk's list,
    and these are what is appended to the whole. The time grows with the number of items, not with its square.
    """
    none = lambda of: F.array().cast(f"array<{of}>").alias("out")
    whole = kind if finish is not None else f"array<{kind}>"
    chunks = lambda a: F.transform(
        F.sequence(F.lit(0), ((F.size(a) - 1) / CHUNK).cast("int")), lambda i: F.slice(a, i * CHUNK + 1, CHUNK))
    one = finish or (lambda x: x)
    merged = lambda acc, chunk: F.aggregate(
        chunk, F.struct(acc.at.alias("at"), none(kind)), step,
        lambda r: F.struct(r.at.alias("at"), F.array_append(acc.out, one(r.out)).alias("out")))
    return _let(items, lambda a: F.aggregate(
        chunks(a), F.struct(F.lit(0).alias("at"), none(whole)), merged, last))


def _proposed(text: Column, kind: str) -> Column:
    """All matches of a kind as ``s, k, e, v, before``: the texts between matches give the places."""
    k, pattern = KINDS.index(kind), PATTERNS[kind]
    item = "struct<s:int,k:int,e:int,v:string,before:string>"
    none = F.array().cast(f"array<{item}>")
    found, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    pairs = F.slice(F.arrays_zip(gaps.alias("gap"), found.alias("v")), F.lit(1), F.size(found))

    def step(acc, x):
        s = acc.at + F.length(x["gap"])
        e = s + F.length(x["v"])
        made = F.struct(s.alias("s"), F.lit(k).alias("k"), e.alias("e"), x["v"].alias("v"),
                        F.right(x["gap"], F.lit(REACH)).alias("before"))
        return F.struct(e.alias("at"), F.array_append(acc.out, made).alias("out"))

    spans = F.when(F.regexp_like(text, F.lit(pattern)), F.flatten(_carried(pairs, item, step, None)))
    if kind in _NEEDS:
        spans = F.when(F.contains(text, F.lit(_NEEDS[kind])), spans)
    return F.coalesce(spans, none)


def spans(text: Column) -> Column:
    """Confirmed spans of all kinds in a whole text, by start, then kind: ``s, k, e, score``.

    Starts and exclusive ends count code points from 0, ``k`` is the place in ``KINDS``. Within a kind matches are
    leftmost and do not overlap; a match that fails its check is dropped, without a retry. ``score`` is that of
    the kind, raised where a context word stands within 40 characters before. NULL counts as empty.
    """
    text = F.coalesce(text, F.lit(""))

    def confirmed(kind):
        ok = F.filter(_proposed(text, kind), lambda x: _valid(kind, x["v"]))
        near = lambda x: F.regexp_like(F.lower(x["before"]), F.lit(CONTEXT[kind]))
        score = lambda x: F.when(near(x), F.least(F.lit(1.0), F.lit(SCORES[kind] + RAISE))).otherwise(
            F.lit(SCORES[kind]))
        return F.transform(ok, lambda x: F.struct(
            x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e"), score(x).alias("score")))
    return F.array_sort(F.concat(*[confirmed(k) for k in KINDS]))


def _written(found: Column) -> Column:
    name = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(found, lambda x: F.concat_ws(
        ":", F.element_at(name, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


def find(docs: DataFrame) -> DataFrame:
    """``doc_id, found`` for every row of ``docs(doc_id, text)``; other columns are ignored, repeated rows repeat."""
    return docs.select("doc_id", spans(F.col("text")).alias("found"))


def masked(text: Column, found: Column) -> Column:
    """The text with every confirmed span replaced by its kind in brackets; overlapping spans become one.

    Finding a character of a text takes a walk from its start, so pieces are cut from blocks of ``BLOCK`` characters.
    """
    name = F.array(*map(F.lit, KINDS))

    def done(blocks):
        def piece(start, end):
            first = (start / BLOCK).cast("int")
            held = F.slice(blocks, first + 1, ((end - 1) / BLOCK).cast("int") - first + 1)
            return F.when(end > start, F.substr(F.array_join(held, ""), start - first * BLOCK + 1, end - start)).otherwise("")

        def step(acc, x):
            new = F.concat(piece(acc.at, x["s"]), F.lit("["), F.upper(F.element_at(name, x["k"] + 1)), F.lit("]"))
            return F.struct(F.greatest(acc.at, x["e"]).alias("at"), F.when(
                x["s"] >= acc.at, F.array_append(acc.out, new)).otherwise(acc.out).alias("out"))

        return _carried(found, "string", step, lambda x: F.array_join(x, ""), lambda acc: F.concat(
            F.array_join(acc.out, ""), piece(acc.at, F.length(text))))

    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))
    return F.when(F.size(found) > 0, _let(blocks, done)).otherwise(text)


def mask(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data masked in ``text``, and ``n_chars``, where there is one, counted anew."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                       spans(F.col("text")).alias("_found"))
    rows = rows.select("_row", masked(F.col("_row.text"), F.col("_found")).alias("_text"))
    put = {"text": F.col("_text"), "n_chars": F.length("_text").cast("long")}
    return rows.select(*[
        (put[c] if c in put and (c == "text" or docs.schema["n_chars"].dataType.simpleString() == "bigint")
         else F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])


# the contract's plain patterns; word bounds in place of look-around
_SQL_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
    "card": r"[0-9](?:[\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b",
}
_SQL_VALID = {
    "email": "true",
    "ip": "list_max(list_transform(string_split(v, '.'), lambda x: CAST(x AS DOUBLE))) <= 255",
    "card": "length(digits) BETWEEN 12 AND 19 AND list_sum(list_transform(string_split(reverse(digits), ''), lambda c, i: "
            "CASE WHEN i % 2 = 1 THEN CAST(c AS INTEGER) WHEN CAST(c AS INTEGER) > 4 THEN 2 * CAST(c AS INTEGER) - 9 "
            "ELSE 2 * CAST(c AS INTEGER) END)) % 10 = 0",
    "phone": "length(digits) BETWEEN 9 AND 15",
    "iban": "list_reduce(list_transform(string_split(substr(replace(v, ' ', ''), 5) || substr(replace(v, ' ', ''), 1, 4), ''), "
            "lambda c: CASE WHEN c >= 'A' THEN ascii(c) - 55 ELSE ascii(c) - 48 END), "
            "lambda a, b: CASE WHEN b > 9 THEN (a * 100 + b) % 97 ELSE (a * 10 + b) % 97 END, 0) = 1",
}


def oracle() -> str:
    parts = [f"""
        SELECT doc_id, {k} AS k, s, s + length(v) AS e,
               CASE WHEN regexp_matches(lower(right(gap, {REACH})), '{CONTEXT[kind]}')
                    THEN least(1.0, {SCORES[kind]} + {RAISE}) ELSE {SCORES[kind]} END AS score
        FROM (SELECT doc_id, m[i] AS v, g[i] AS gap, regexp_replace(m[i], '[^0-9]', '', 'g') AS digits,
                     CAST(list_sum(list_transform(g[1:i], lambda x: length(x)))
                          + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s
              FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM (
                  SELECT doc_id, regexp_extract_all(t, '{_SQL_PATTERNS[kind]}') AS m,
                         string_split_regex(t, '{_SQL_PATTERNS[kind]}') AS g FROM docs)))
        WHERE {_SQL_VALID[kind]}""" for k, kind in enumerate(KINDS)]
    name = "['" + "', '".join(KINDS) + "'][k + 1] || ':' || s || ':' || e"
    counts = ", ".join(f"COUNT(*) FILTER (WHERE k = {i}) AS n_{kind}" for i, kind in enumerate(KINDS))
    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({' UNION ALL '.join(parts)})
SELECT doc_id, {counts}, sha256(coalesce(string_agg({name}, ',' ORDER BY s, k) FILTER (WHERE k < {BASE}), '')) AS base_sha256,
       coalesce(string_agg({name}, ',' ORDER BY s, k), '') AS spans, coalesce(CAST(MAX(score) AS DOUBLE), 0.0) AS top_score
FROM docs LEFT JOIN found USING (doc_id) GROUP BY doc_id"""


@query("op7_pii", oracle())
def op7(spark, sf_dir):
    found = find(table(spark, sf_dir, "documents"))
    n = lambda i: F.size(F.filter("found", lambda x: x["k"] == i)).cast("long")
    base = F.filter("found", lambda x: x["k"] < BASE)
    return found.select(
        "doc_id", *[n(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.sha2(_written(base), 256).alias("base_sha256"), _written(F.col("found")).alias("spans"),
        F.aggregate("found", F.lit(0.0), lambda a, x: F.greatest(a, x["score"])).alias("top_score"))
