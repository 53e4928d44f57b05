"""License scans: template markup compiled into token automata."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartorio.llm.common import query, table
from cartorio.llm.words import words_of

# The phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Notices and whole licence texts as templates. <<optional>>...<<end>> may be left out, <<var:n>> stands
# for up to n words, <<one:a|b>> for one of several wordings; all other words are mandatory.
_GRANTED = "<<one:is licensed|is free software: you can redistribute it and/or modify it|licensed|released>> under the"
_GPL = (_GRANTED + "<<optional>> terms of the<<end>><<optional>> GNU<<end>> General Public License"
        "<<optional>> as published by the Free Software Foundation<<end>>")
_BSD_OPENING = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:<<optional>> 1.<<end>> Redistributions of source code must retain the above copyright "
    "notice, this list of conditions and the following disclaimer.<<optional>> 2.<<end>> Redistributions in binary form "
    "must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution.")
_BSD_NAMES = (
    "<<optional>> 3.<<end>> Neither the name of <<var:8>> nor the names of its contributors may be used to endorse or "
    "promote products derived from this software without specific prior written permission.")
_BSD_DISCLAIMER = (
    " THIS SOFTWARE IS PROVIDED BY <<var:8>> AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, "
    "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL "
    "<<var:8>> BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, "
    "BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
    "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT "
    "(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE "
    "POSSIBILITY OF SUCH DAMAGE.")
TEMPLATES = {
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0<<optional>> (the License)<<end>>",
    "apache-notice": "Licensed under the Apache License",
    "bsd-2-clause": _BSD_OPENING + _BSD_DISCLAIMER,
    "bsd-3-clause": _BSD_OPENING + _BSD_NAMES + _BSD_DISCLAIMER,
    "gpl-2.0-notice": _GPL + "<<optional>>, either<<end>> version 2",
    "gpl-3.0-notice": _GPL + "<<optional>>, either<<end>> version 3",
    "gpl-notice": _GPL,
    "isc": "Permission to use, copy, modify, and<<optional>>/or<<end>> distribute this software for any purpose with or "
           "without fee is hereby granted, provided that the above copyright notice and this permission notice appear "
           "in all copies. THE SOFTWARE IS PROVIDED AS IS AND <<var:6>> DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS "
           "SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL <<var:6>> BE "
           "LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM "
           "LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING "
           "OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "mit-notice": "<<one:licensed|released|distributed|available>> under the<<optional>> terms of the<<end>> "
                  "MIT License",
    "mit-terms": "Permission is hereby granted, free of charge, to any person obtaining a copy of <<var:6>> and "
                 "associated documentation files<<optional>> (the Software)<<end>>, to deal in the Software without "
                 "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
                 "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software "
                 "is furnished to do so, subject to the following conditions: The above copyright notice and this "
                 "permission notice<<optional>> (including the next paragraph)<<end>> shall be included in all copies or "
                 "substantial portions of the Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, "
                 "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
                 "PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL <<var:6>> BE LIABLE FOR ANY CLAIM, DAMAGES OR "
                 "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
                 "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
}

_MARK = re.compile(r"<<(optional|end|var:\d+|one:[^>]*)>>")


@dataclass
class Automaton:
    """States with moves on one word (``moves``), on any word (``wild``) and on none (``free``)."""

    moves: list[dict[bytes, list[int]]] = field(default_factory=list)
    wild: list[list[int]] = field(default_factory=list)
    free: list[list[int]] = field(default_factory=list)
    final: int = 0

    def state(self) -> int:
        self.moves.append({})
        self.wild.append([])
        self.free.append([])
        return len(self.moves) - 1

    def spell(self, at: int, text: str) -> int:
        for w in words_of(text):
            to = self.state()
            self.moves[at].setdefault(w, []).append(to)
            at = to
        return at

    def closed(self, states) -> set[int]:
        out, todo = set(), list(states)
        while todo:
            s = todo.pop()
            if s not in out:
                out.add(s)
                todo += self.free[s]
        return out

    def longest(self, words: list[bytes], start: int) -> int:
        """End of the longest accepted run of words from ``start``, or -1."""
        now, end = self.closed([0]), -1
        for i in range(start, len(words) + 1):
            if self.final in now:
                end = i
            if i == len(words):
                break
            step = [t for s in now for t in (*self.moves[s].get(words[i], ()), *self.wild[s])]
            if not step:
                break
            now = self.closed(step)
        return end

    def first_words(self) -> set[bytes]:
        return {w for s in self.closed([0]) for w in self.moves[s]}


def compile_template(template: str) -> Automaton:
    """An automaton over words; optional regions may nest. A template must start with a wording, not a variable."""
    a = Automaton()
    at, open_regions, done = a.state(), [], 0
    for m in [*_MARK.finditer(template), None]:
        at = a.spell(at, template[done:m.start() if m else len(template)])
        if m is None:
            break
        done, mark = m.end(), m[1]
        if mark == "optional":
            open_regions.append(at)
        elif mark == "end":
            to = a.state()
            a.free[at].append(to)
            a.free[open_regions.pop()].append(to)
            at = to
        elif mark.startswith("var:"):
            to = a.state()
            a.free[at].append(to)
            for _ in range(int(mark[4:])):
                after = a.state()
                a.wild[at].append(after)
                a.free[after].append(to)
                at = after
            at = to
        else:
            to = a.state()
            for wording in mark[4:].split("|"):
                a.free[a.spell(at, wording)].append(to)
            at = to
    if open_regions:
        raise ValueError("an optional region is not ended")
    a.final = at
    if not a.first_words() or at in a.closed([0]) or any(a.wild[s] for s in a.closed([0])):
        raise ValueError("a template must start with mandatory words")
    return a


class Matcher:
    def __init__(self, templates: dict[str, str], phrases: dict[str, str]):
        self.templates = {label: compile_template(t) for label, t in templates.items()}
        self.phrases = {p.encode(): label for p, label in phrases.items()}
        self.starts: dict[bytes, list[str]] = {}
        for label, a in self.templates.items():
            for w in a.first_words():
                self.starts.setdefault(w, []).append(label)

    def phrase_places(self, words: list[bytes]) -> list[tuple[int, str]]:
        """Word numbers at which a phrase stands, and its label."""
        line, out = b" " + b" ".join(words) + b" ", []
        for phrase, label in self.phrases.items():
            sought, at, n, counted = b" " + phrase + b" ", 0, 0, 0
            while (at := line.find(sought, at)) >= 0:
                n += line.count(b" ", counted, at)
                counted = at
                out.append((n, label))
                at += 1
        return sorted(out)

    def template_places(self, words: list[bytes]) -> list[tuple[int, int, str]]:
        """Accepted runs of words: start, end, label."""
        out = []
        for i, w in enumerate(words):
            for label in self.starts.get(w, ()):
                end = self.templates[label].longest(words, i)
                if end >= 0:
                    out.append((i, end, label))
        return out


_SCAN = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
         "labels string, score double, spans string")


def _scanner(matcher: Matcher):
    seen = [w for w in matcher.starts]

    def row(text):
        words = words_of(text)
        base = matcher.phrase_places(words)
        have = set(words)
        full = matcher.template_places(words) if any(w in have for w in seen) else []
        at, base_labels = [i for i, _ in base], {x for _, x in base}
        labels = base_labels | {x for _, _, x in full}
        score = 1.0 if full else 0.5 if base else 0.0
        return (len(words), len(base), at[0] if at else None, at[-1] if at else None,
                ",".join(sorted(base_labels)), ",".join(sorted(labels)), score,
                ",".join(f"{label}:{s}:{e}" for s, e, label in full))

    def run(batches):
        for b in batches:
            rows = [row(t) for t in b.column(1).to_pylist()]
            cols = list(zip(*rows)) if rows else [[]] * 8
            kinds = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.float64(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(c, k) for c, k in zip(cols, kinds)]],
                [x.split()[0] for x in _SCAN.split(", ")])
    return run


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, phrases: dict[str, str] = PHRASES) -> DataFrame:
    """Phrases and accepted templates in every whole text of ``docs(doc_id, text)``; one row per row.

    ``n_base`` counts places where a phrase's words stand one after another, ``first_word`` and ``last_word``
    are their smallest and largest word numbers (NULL where there are none), ``base_labels`` and ``labels`` are
    distinct and sorted, ``spans`` has the accepted runs as label:start:end in words. ``score`` is 1 where a
    template is accepted, 0.5 where only phrases stand, else 0. NULL is the empty text: no words, empty labels.
    Other columns are ignored, repeated rows repeat.
    """
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _scanner(Matcher(templates, phrases)), _SCAN)


def pattern(template: str) -> str:
    """A regular expression for the template over words with a space before each."""
    spelt = lambda text: "".join(f" {w.decode()}" for w in words_of(text))
    out, done = "", 0
    for m in _MARK.finditer(template):
        out, done, mark = out + spelt(template[done:m.start()]), m.end(), m[1]
        if mark == "optional":
            out += "(?:"
        elif mark == "end":
            out += ")?"
        elif mark.startswith("var:"):
            out += f"(?: [^ ]+){{0,{mark[4:]}}}"
        else:
            out += "(?:" + "|".join(spelt(w) for w in mark[4:].split("|")) + ")"
    return out + spelt(template[done:]) + " "


def oracle() -> str:
    at = " OR ".join(
        "(" + " AND ".join(f"w[i + {k}] = '{x}'" for k, x in enumerate(p.split(), 1)) + ")" for p in PHRASES)
    base = ", ".join(f"CASE WHEN contains(line, ' {p} ') THEN '{label}' END" for p, label in PHRASES.items())
    full = ", ".join(f"CASE WHEN regexp_matches(line, '{pattern(t)}') THEN '{label}' END" for label, t in TEMPLATES.items())
    listed = "array_to_string(list_sort(list_distinct(list_filter([{}], lambda x: x IS NOT NULL))), ',')"
    return f"""
WITH lower_case AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
                    FROM documents),
words AS (SELECT doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM lower_case),
lines AS (SELECT *, ' ' || array_to_string(w, ' ') || ' ' AS line,
                 list_filter(range(0, len(w)), lambda i: {at}) AS places FROM words)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(places) AS BIGINT) AS n_base,
       list_min(places) AS first_word, list_max(places) AS last_word, {listed.format(base)} AS base_labels,
       {listed.format(base + ', ' + full)} AS labels,
       CAST(CASE WHEN {listed.format(full)} <> '' THEN 1.0 WHEN len(places) > 0 THEN 0.5 ELSE 0.0 END AS DOUBLE) AS score
FROM lines"""


@query("op10_license_templates", oracle())
def op10(spark, sf_dir):
    return scan(table(spark, sf_dir, "documents")).drop("spans")
