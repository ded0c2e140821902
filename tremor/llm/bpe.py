"""Operator 3: byte-pair encoding and decoding with forced-boundary splitting.

A byte pair that never stands inside any vocabulary token marks a certain
cut: no merge can ever join its two sides, so the fragments between such cuts
are merged independently and their ids concatenated; those of all words that
a task meets together are merged side by side, in arrays.  Pairs whose right byte
ends a word are looked up on their own, as the word-end mark is part of that
byte's symbol.

Normaliser and pre-tokenizer are those that the vocabulary file names, run by
the public library; merging and decoding are done here.  Where the file names
lower-casing and a split by a pattern, texts and chunks of Latin characters up to U+017F,
which composing leaves as they are, are lower-cased and split by that pattern
without the library.  The ids of words and of other chunks are remembered, in two
generations of bounded size; a worker's memory does not grow with the corpus.  The
vocabulary file is read once on the driver and sent with the task closure as bytes (a fixed public file of under
2 MB), so executors need no copy of it.

Results: null and empty texts give no ids and an empty decoded text; extra
input columns are dropped unless named in ``keep``; repeated rows each get a
row; an empty table gives no rows.
"""

from __future__ import annotations

import gc
import json
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from tokenizers import Tokenizer

from tremor.llm.common import in_batches

#: Words, and white-space-separated chunks, remembered per generation and task.
CACHE_WORDS = 80_000
#: Texts that are encoded together.
CHUNK = 128
#: Characters from which a word's fragments are merged one by one; longer words are not remembered.
LONG = 100
#: Characters that are normalised and pre-tokenized at once.
PART = 1 << 20
#: Characters of unseen words that are merged side by side.
TOGETHER = 1 << 17
_NONE = 1 << 30
_PLACE_BITS = 20         # places among TOGETHER + LONG characters
_CHARS = 0x200           # the characters that stand for bytes lie below
_ODD_SPACE = regex.compile(r"[\x1c-\x1f]")
_LATIN = regex.compile("[\t-\r -~\xa1-\u017f]*")
#: The normalisers, and the byte level after the pattern, that the short way stands for.
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
                {"type": "Lowercase"}]
_BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}


def _is_latin(text: str) -> bool:
    return _LATIN.fullmatch(text) is not None


def _never(chunk: str) -> bool:
    return False


def _parts(piece: str) -> Iterator[str]:
    """A long piece in parts cut at blanks, over which the pre-tokenizer never joins."""
    at = 0
    while len(piece) - at > PART and (end := piece.find(" ", at + PART)) >= 0:
        yield piece[at:end]
        at = end
    yield piece[at:]


class Remembered:
    """A dictionary of two generations: what an age has not used is forgotten after it."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def get(self, key: str) -> tuple[int, ...] | None:
        got = self.young.get(key)
        if got is None and (got := self.old.get(key)) is not None:
            self.add(key, got)
        return got

    def known(self, keys: Iterable[str]) -> tuple[dict[str, tuple[int, ...] | None], list[str]]:
        """What is held of every distinct key, and the keys of which nothing is."""
        held = dict.fromkeys(keys)
        young = self.young.get
        for key in held:
            held[key] = young(key)
        new = []
        for key in [key for key, value in held.items() if value is None]:
            value = self.get(key)
            if value is None:
                new.append(key)
            else:
                held[key] = value
        return held, new

    def add(self, key: str, value: tuple[int, ...]) -> None:
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
        self.young[key] = value


def _latin_pattern(spec: dict) -> regex.Pattern | None:
    """The pattern whose matches are the words of a lower-cased Latin chunk, if the file's
    normaliser and pre-tokenizer come to that."""
    steps = (spec["pre_tokenizer"] or {}).get("pretokenizers") or [{}]
    split = {k: v for k, v in steps[0].items() if k != "pattern"}
    if ((spec["normalizer"] or {}).get("normalizers") == _NORMALIZERS and steps[1:] == [_BYTE_LEVEL]
            and split == {"type": "Split", "behavior": "Removed", "invert": True}):
        return regex.compile(steps[0]["pattern"]["Regex"])
    return None


class ForcedBoundaryBpe:
    """Encoder and decoder for a word-level byte BPE vocabulary file (JSON)."""

    def __init__(self, raw: bytes, cache: int = CACHE_WORDS):
        spec = json.loads(raw)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        self.ids = model["vocab"]
        # the id that a rank's pair becomes
        self.merged = np.array([self.ids[a + b] for a, b in model["merges"]], np.int64)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (1 + max([*self.ids.values(), *self.special.values()]))
        for text, i in [*self.ids.items(), *self.special.items()]:
            self.tokens[i] = text
        # the ranks of pairs, by left id times base plus right id; the last stands for no pair
        self.base = len(self.tokens) + 1
        pairs = np.array([(self.ids[a], self.ids[b]) for a, b in model["merges"]], np.int64).reshape(-1, 2)
        # of a pair that the file lists twice, the later rank counts
        codes, last = np.unique((pairs[:, 0] * self.base + pairs[:, 1])[::-1], return_index=True)
        self.pair_codes = np.append(codes, self.base ** 2)
        self.pair_ranks = np.append(len(pairs) - 1 - last, _NONE)
        self.rank_of = dict(zip(self.pair_codes.tolist(), self.pair_ranks.tolist()))
        self.split_special = regex.compile(
            "(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        named = Tokenizer.from_str(raw.decode())
        self.normalizer, self.splitter = named.normalizer, named.pre_tokenizer
        self.pattern = _latin_pattern(spec)
        # The character that stands for each byte, as the library's byte level writes it.
        printed = [*range(0x21, 0x7f), *range(0xa1, 0xad), *range(0xae, 0x100)]
        others = iter(range(0x100, 0x200))
        self.byte_chars = {b: chr(b) if b in printed else chr(next(others)) for b in range(256)}
        self.inner, self.final = self._joined_pairs()
        self.symbols, self.end_symbols = np.zeros((2, _CHARS), np.int64)
        for c in self.byte_chars.values():
            self.symbols[ord(c)], self.end_symbols[ord(c)] = self.ids[c], self.ids[c + self.end]
        self.inner_pairs, self.final_pairs = map(self._marked, (self.inner, self.final))
        self.words, self.chunks = Remembered(cache), Remembered(cache)

    def _joined_pairs(self) -> tuple[set[str], set[str]]:
        """Byte pairs inside tokens: those followed by more bytes or no word end, and those
        whose right byte carries the word end."""
        inner, final = set(), set()
        for token in self.ids:
            ends = token.endswith(self.end) and token != self.end
            body = token[:-len(self.end)] if ends else token
            pairs = [body[i:i + 2] for i in range(len(body) - 1)]
            inner.update(pairs[:-1] if ends else pairs)
            if ends:
                final.update(pairs[-1:])
        return inner, final

    @staticmethod
    def _marked(pairs: set[str]) -> np.ndarray:
        """Pairs of characters as a table by both code points."""
        out = np.zeros(_CHARS ** 2, np.bool_)
        out[[ord(a) * _CHARS + ord(b) for a, b in pairs]] = True
        return out

    def _rank(self, left: int, right: int) -> int:
        return self.rank_of.get(left * self.base + right, _NONE)

    def fragments(self, word: str) -> list[tuple[list[int], list[int]]]:
        """A word (one character a byte) cut wherever no token can span: each fragment's
        symbols, and the ranks of their neighbouring pairs."""
        symbols = [*map(self.ids.__getitem__, word[:-1]), self.ids[word[-1] + self.end]]
        joins = [a + b in self.inner for a, b in zip(word, word[1:-1])]
        if len(word) > 1:
            joins.append(word[-2:] in self.final)
        cuts = [0, *(i for i, join in enumerate(joins, 1) if not join), len(symbols)]
        ranks = [*map(self._rank, symbols, symbols[1:])]
        return [(symbols[lo:hi], ranks[lo:hi - 1]) for lo, hi in zip(cuts, cuts[1:])]

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids; ``_NONE`` where a pair has none."""
        code = left * self.base + right
        at = np.searchsorted(self.pair_codes, code)
        return np.where(self.pair_codes[at] == code, self.pair_ranks[at], _NONE)

    def merge_words(self, words: list[str]) -> list[tuple[int, ...]]:
        """Ids of words of at most ``LONG`` bytes.

        All fragments of all words are merged side by side: a step applies to each the merge
        of its lowest rank, the leftmost on ties, until none has one left.
        """
        n = sum(map(len, words))
        chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        starts = ends - np.diff(ends, prepend=0)
        last = np.zeros(n, np.bool_)
        last[ends - 1] = True
        # place n stands for what is beyond a fragment: an id that has no pair
        parts = np.append(np.where(last, self.end_symbols[chars], self.symbols[chars]), self.base - 1)
        pair = chars[:-1] * _CHARS + chars[1:]
        cut = np.ones(n, np.bool_)          # no token spans this place and the next
        cut[:-1] = last[:-1] | ~np.where(last[1:], self.final_pairs[pair], self.inner_pairs[pair])
        place = np.arange(n + 1)
        after = np.append(np.where(cut, n, place[1:]), n)
        before = np.append(n, np.where(cut, n, place[:-1]))
        before[n] = n
        key = self._ranks(parts, parts[after]) << _PLACE_BITS | place
        alive = np.ones(n, np.bool_)
        heads = np.flatnonzero(np.append(True, cut[:-1]))
        size = np.diff(np.append(heads, n))
        at = place[:-1]
        while len(size):
            best = np.minimum.reduceat(key[at], np.cumsum(size) - size)
            more = best < _NONE << _PLACE_BITS
            if not more.all():
                at, size, best = at[np.repeat(more, size)], size[more], best[more]
            i = best & (1 << _PLACE_BITS) - 1
            j, h = after[i], before[i]
            k = after[j]
            made = self.merged[best >> _PLACE_BITS]
            parts[i], after[i], before[k], alive[j] = made, k, i, False
            key[j] = _NONE << _PLACE_BITS
            ranks = self._ranks(np.append(parts[h], made), np.append(made, parts[k]))
            key[h] = ranks[:len(h)] << _PLACE_BITS | h
            key[i] = ranks[len(h):] << _PLACE_BITS | i
        ids = parts[:-1][alive].tolist()
        stops = np.cumsum(alive)[ends - 1].tolist()
        return [tuple(ids[lo:hi]) for lo, hi in zip([0, *stops], stops)]

    def _merge_long(self, parts: list[int], ranks: list[int]) -> list[int]:
        """Ids of one long fragment, by the order of ``merge_words``: a linked list and a
        heap of (rank, place).  ``ranks`` are those of the neighbouring pairs."""
        n = len(parts)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))

        def pair(i):
            return self._rank(parts[i], parts[right[i]]) if right[i] < n else _NONE
        heap = [(r, i) for i, r in enumerate(ranks) if r != _NONE]
        heapify(heap)
        while heap:
            r, i = heappop(heap)
            if parts[i] is None or pair(i) != r:
                continue                    # one side has been merged since
            j = right[i]
            parts[i], parts[j] = int(self.merged[r]), None
            right[i] = right[j]
            if right[i] < n:
                left[right[i]] = i
            for k in (i, left[i]):
                if k >= 0 and (r := pair(k)) != _NONE:
                    heappush(heap, (r, k))
        return [x for x in parts if x is not None]

    def _merged(self, words: list[str]) -> Iterator[tuple[int, ...]]:
        """Ids of each word (one character a byte), in order."""
        waiting, size = [], 0
        for word in words:
            if len(word) <= LONG and size < TOGETHER:
                waiting.append(word)
                size += len(word)
                continue
            if waiting:
                yield from self.merge_words(waiting)
            waiting, size = [], 0
            if len(word) > LONG:
                yield tuple([i for part in self.fragments(word) for i in self._merge_long(*part)])
            else:
                waiting, size = [word], len(word)
        if waiting:
            yield from self.merge_words(waiting)

    def _ids_of_words(self, words: Iterable[str]) -> dict[str, tuple[int, ...]]:
        """Ids of every distinct Latin word."""
        known, new = self.words.known(words)
        spelled = [w if w.isascii() else "".join(map(self.byte_chars.__getitem__, w.encode()))
                   for w in new]
        for word, ids in zip(new, self._merged(spelled)):
            known[word] = ids
            if len(word) <= LONG:
                self.words.add(word, ids)
        return known

    def _words_of(self, chunks: list[str]) -> list[list[str]]:
        """Words of chunks that hold no white space, normalised and split together."""
        plain = self.normalizer.normalize_str(" ".join(chunks))
        found = self.splitter.pre_tokenize_str(plain)
        ends = [i for i, c in enumerate(plain) if c == " "] if " " in plain else []
        if len(ends) != len(chunks) - 1:        # the normaliser made or took blanks
            half = len(chunks) // 2
            if half:
                return self._words_of(chunks[:half]) + self._words_of(chunks[half:])
            return [[word for word, _ in found]]
        ends.append(len(plain))
        out: list[list[str]] = [[] for _ in chunks]
        at = 0
        for word, (start, _) in found:
            while start >= ends[at]:
                at += 1
            out[at].append(word)
        return out

    def _ids_of_chunks(self, chunks: Iterable[str]) -> dict[str, tuple[int, ...]]:
        """Ids of every distinct chunk: a special token, or no white space in it."""
        known, new = self.chunks.known(chunks)
        split: dict[str, list[str]] = {}
        for lo in range(0, len(new), 1000):
            part = [chunk for chunk in new[lo:lo + 1000] if chunk not in self.special]
            split.update(zip(part, self._words_of(part) if part else ()))
        words = [*dict.fromkeys(chain.from_iterable(split.values()))]
        ids_of = dict(zip(words, self._merged(words))).__getitem__
        for chunk in new:
            ids = ((self.special[chunk],) if chunk in self.special
                   else tuple(chain.from_iterable(map(ids_of, split[chunk]))))
            known[chunk] = ids
            if len(chunk) <= LONG:
                self.chunks.add(chunk, ids)
        return known

    def _pieces(self, text: str) -> Iterator[tuple[int, bool, list[str]]]:
        """A text's length, kind and strings piece by piece: Latin words (true) or other chunks."""
        is_latin = _is_latin if self.pattern else _never
        for piece in self.split_special.split(text):
            if piece in self.special:
                yield len(piece), False, [piece]
                continue
            for part in _parts(piece):
                if is_latin(part):
                    yield len(part), True, self.pattern.findall(part.lower())
                    continue
                chunks = regex.split(r"\s+", part) if _ODD_SPACE.search(part) else part.split()
                for latin, some in groupby(chunks, is_latin):
                    if latin:
                        joined = " ".join(some)
                        yield len(joined), True, self.pattern.findall(joined.lower())
                    else:
                        others = [*some]
                        yield sum(map(len, others)), False, others

    def encode_all(self, texts: list[str | None]) -> list[list[int]]:
        """Ids of several texts; words that no cache holds are merged together."""
        out: list[list[int]] = [[] for _ in texts]
        waiting: list[tuple[list[int], bool, list[str]]] = []
        size = 0
        for ids, text in zip(out, texts):
            for length, latin, strings in self._pieces(text or ""):
                waiting.append((ids, latin, strings))
                size += length
                if size >= PART:
                    self._encode(waiting)
                    waiting, size = [], 0
        self._encode(waiting)
        return out

    def _encode(self, waiting: list[tuple[list[int], bool, list[str]]]) -> None:
        """Add the ids of words and chunks to the list that stands with them."""
        of = [find(chain.from_iterable(strings for _, latin, strings in waiting if latin == kind)).__getitem__
              for kind, find in enumerate((self._ids_of_chunks, self._ids_of_words))]
        for ids, latin, strings in waiting:
            ids += chain.from_iterable(map(of[latin], strings))

    def encode(self, text: str | None) -> list[int]:
        return self.encode_all([text])[0]

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by spaces, as the library does for a vocabulary without a decoder."""
        return " ".join(map(self.tokens.__getitem__, ids))


def encode_decode(docs: DataFrame, vocabulary: str, text_col: str = "text",
                  keep: tuple[str, ...] = ("doc_id",), cache: int = CACHE_WORDS) -> DataFrame:
    """``keep`` columns, ``ids`` (array of int) and ``decoded`` (string) of every text."""
    with open(vocabulary, "rb") as f:
        raw = f.read()

    schema = T.StructType([*[docs.schema[c] for c in keep],
                           T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("decoded", T.StringType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.unfreeze()       # what an earlier task in this worker left goes
        bpe = ForcedBoundaryBpe(raw, cache)
        gc.collect()
        gc.freeze()         # the tables stay as long as the task: no need to visit them
        for batch in batches:
            for lo in range(0, batch.num_rows, CHUNK):
                text, *kept = batch.slice(lo, CHUNK).columns
                ids = bpe.encode_all(text.to_pylist())
                columns = [*kept, pa.array(ids, pa.list_(pa.int32())), pa.array([*map(bpe.decode, ids)], pa.string())]
                yield pa.RecordBatch.from_arrays(
                    [c if c.type == f.type else c.cast(f.type) for c, f in zip(columns, arrow)],
                    schema=arrow)

    return in_batches(docs.select(text_col, *keep), run, schema)
