"""Operator 6: token counts by a count-only Viterbi search.

An Aho-Corasick automaton over the unigram vocabulary yields every piece that
ends at each character, longest first; dynamic programming carries only the
best score and its piece count, so no path is kept.  Tie rules are those of
the public library's unigram model: scores add in double precision, a later
candidate must be strictly better, and candidates arrive from the leftmost
start.  A character without a piece of its own costs the lowest score minus
ten and counts one piece per UTF-8 byte (byte fallback).

A space stands as a word mark (U+2581), and a text begins with one.  Texts are
split before each run of marks, over which no piece reaches unless one holds a
mark after another character; for such a vocabulary they are not split.  So a
word's result does not depend on its neighbours; results of words up to
``LONG`` characters are remembered in two generations of bounded size.  The
text is taken as it is: a vocabulary's own Unicode normaliser is not applied.
Whole scores (as the ranks that a BPE file's pieces carry) add exactly.

Null and empty texts have no pieces and score 0; repeated rows each get a
row; columns beyond the key and the text are dropped.
"""

from __future__ import annotations

import re

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tremor.llm.common import map_rows

MARK = "▁"
UNKNOWN_PENALTY = 10.0
CACHE_WORDS = 200_000
#: Characters up to which a word is remembered.
LONG = 100
_WORD = re.compile(f"{MARK}+[^{MARK}]*")
_MARK_INSIDE = re.compile(f"[^{MARK}]{MARK}")


def read_pieces(model_file: str) -> list[tuple[str, float]]:
    """(piece, score) of a SentencePiece model file; a few MB by format, read on the driver."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    return [(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size())]


class UnigramCounter:
    def __init__(self, pieces: list[tuple[str, float]], cache: int = CACHE_WORDS):
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.splits = not any(_MARK_INSIDE.search(piece) for piece, _ in pieces)
        self.unknown = min(s for _, s in pieces) - UNKNOWN_PENALTY
        self.size, self.young, self.old = cache, {}, {}

    def word(self, word: str) -> tuple[float, int]:
        """Best score and its piece count of a word with its leading marks."""
        n = len(word)
        score: list[float] = [0.0] + [float("-inf")] * n
        count = [0] * (n + 1)
        matches = iter(self.automaton.iter(word))
        end, found = next(matches, (n, None))
        for e in range(1, n + 1):
            best, pieces, own = float("-inf"), 0, False
            while end == e - 1:
                size, gain = found
                own = own or size == 1
                if (s := score[e - size] + gain) > best:
                    best, pieces = s, count[e - size] + 1
                end, found = next(matches, (n, None))
            if not own and (s := score[e - 1] + self.unknown) > best:
                best, pieces = s, count[e - 1] + len(word[e - 1].encode())
            score[e], count[e] = best, pieces
        return score[n], count[n]

    def _remember(self, word: str) -> tuple[float, int]:
        if (got := self.old.get(word)) is None:
            got = self.word(word)
        if len(word) > LONG:
            return got
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
        self.young[word] = got
        return got

    def text(self, text: str | None) -> tuple[float, int]:
        if not text:
            return 0.0, 0
        marked = text.replace(" ", MARK)
        if marked[0] != MARK:
            marked = MARK + marked
        total, pieces = 0.0, 0
        for word in _WORD.findall(marked) if self.splits else (marked,):
            got = self.young.get(word)
            if got is None:
                got = self._remember(word)
            total += got[0]
            pieces += got[1]
        return total, pieces


def count_tokens(docs: DataFrame, pieces: list[tuple[str, float]], key: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``key``, ``n_tokens`` (long), ``score`` (double) of every text."""
    def start():
        counter = UnigramCounter(pieces)

        def row(k, text):
            total, n = counter.text(text)
            return k, n, total
        return row

    schema = T.StructType([docs.schema[key], T.StructField("n_tokens", T.LongType()),
                           T.StructField("score", T.DoubleType())])
    return map_rows(docs.select(key, text_col), start, schema)
