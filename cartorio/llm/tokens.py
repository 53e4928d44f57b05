"""Token counts by a count-only Viterbi over a unigram vocabulary."""

from __future__ import annotations

import re

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartorio.llm.common import query, table

#: The public vocabulary used by the query; its path is a parameter of the operator.
VOCABULARY = "piece_bpe_32k.model"
SPACE = "▁"
_UNKNOWN = 10.0  # an unknown character costs this much more than the worst piece


def load_pieces(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece model file, without its control, unknown and byte pieces."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(m.id_to_piece(i), m.get_score(i)) for i in range(m.get_piece_size())
            if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i))]


class Counter:
    """Number of pieces of the best segmentation of a text.

    White space is written as a piece mark and one mark is put before the text. The best segmentation has the
    largest sum of scores. Of equal sums up to a place, the piece that starts first wins, as in the tokenizer,
    which keeps the earlier candidate unless a later one is better. A character that is no piece costs the lowest
    score less 10 and counts one piece per UTF-8 byte.
    """

    def __init__(self, pieces: list[tuple[str, float]], memo: int = 200_000):
        self.auto = ahocorasick.Automaton()
        for p, score in pieces:
            self.auto.add_word(p, (len(p), score))
        self.auto.make_automaton()
        self.single = {p for p, _ in pieces if len(p) == 1}
        self.unknown = min((s for _, s in pieces), default=0.0) - _UNKNOWN
        known = {c for p, _ in pieces for c in p} - {SPACE}
        inner = any(SPACE in p.lstrip(SPACE) for p, _ in pieces)
        # no piece reaches over these cuts, so the parts have segmentations of their own
        cls = re.escape("".join(sorted(known)))
        self.cut = re.compile(f"{SPACE}+[{cls}]*|[{cls}]+|[^{cls}{SPACE}]+" if cls else f"{SPACE}+|[^{SPACE}]+")
        self.whole = inner
        self.memo, self.limit = {}, memo

    def best(self, part: str) -> int:
        n = len(part)
        score, count = [0.0] + [None] * n, [0] * (n + 1)
        found = self.auto.iter(part)
        pending = next(found, None)
        for end in range(1, n + 1):
            while pending is not None and pending[0] + 1 == end:  # longest piece, so earliest start, first
                size, s = pending[1]
                total = score[end - size] + s
                if score[end] is None or total > score[end]:
                    score[end], count[end] = total, count[end - size] + 1
                pending = next(found, None)
            if part[end - 1] not in self.single:
                total = score[end - 1] + self.unknown
                if score[end] is None or total > score[end]:
                    score[end] = total
                    count[end] = count[end - 1] + len(part[end - 1].encode())
        return count[n]

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        marked = SPACE + text.replace(" ", SPACE)
        memo, total = self.memo, 0
        for part in [marked] if self.whole else self.cut.findall(marked):
            n = memo.get(part)
            if n is None:
                n = self.best(part)
                if len(part) <= 64:
                    if len(memo) >= self.limit:
                        memo.clear()
                    memo[part] = n
            total += n
        return total


def counter(pieces: list[tuple[str, float]]):
    """Column function: the token count of a whole text; NULL and empty texts have none.

    The vocabulary goes with the plan; it is a tokenizer's file and does not grow with the data.
    """
    made = {}

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        if "c" not in made:
            made["c"] = Counter(pieces)
        return pd.Series(np.array([made["c"].count(t) for t in texts], np.int64))
    return count


def token_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id, n_tokens`` for every row of ``docs(doc_id, text)``; other columns are ignored, repeats repeat."""
    return docs.select("doc_id", counter(load_pieces(vocabulary))("text").alias("n_tokens"))


@query("op1_token_counts")
def op1(spark, sf_dir):
    return token_counts(table(spark, sf_dir, "documents"), f"/opt/tokenizers/{VOCABULARY}")
