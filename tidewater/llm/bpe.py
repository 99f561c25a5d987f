"""Byte-level BPE: speculate with greedy longest match, verify adjacent pairs, merge what fails.

A text is split at the special tokens and then by the vocabulary's pattern. For
every different word of a batch the greedy longest match proposes tokens. A
proposal is the BPE encoding exactly when each adjacent pair of its tokens is
what BPE makes of the pair's own bytes (a lone token: of its own bytes), so all
pairs of the batch are tested at once against a table of judged pairs, and pairs
not met before are judged by exact merging. Words with a failing pair are merged
exactly. Memory is bounded: texts are taken in steps of about ``STEP_BYTES``, the word
and pair tables are emptied at a fixed size and at the end of each task, so that workers
kept for later stages hold the vocabulary alone.

Token ids travel as binary: little-endian unsigned 32-bit integers.

Defined results: a null text encodes like an empty one, to no ids; null ids
decode to an empty text; ids that are not valid UTF-8 together decode with
replacement characters. Rows stay as they are otherwise; repeated rows give
repeated results, a column named like a result is replaced, and an empty table gives an
empty one.
"""

from __future__ import annotations

import gc
import json
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache
from heapq import heapify, heappop, heappush
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CONTROL = re.compile("[\x1c-\x1f]")
NO_RANK = 1 << 60
TABLE_WORDS = 250_000  # two generations of this size
TABLE_PAIRS = 2_000_000
STEP_BYTES = 1 << 20  # a longer text is a step of its own


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in vocabulary files."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


# The split pattern of the byte-level vocabularies, in the standard library's classes
# (fixed value); right for texts without the characters of ``odd_characters``.
QUICK = re.compile(r"""'(?:[stmd]|re|ve|ll)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+""")

# The same for ASCII texts without the characters of ``CONTROL``: sets of characters, not of classes.
QUICK_ASCII = re.compile(r"""'(?:[stmd]|re|ve|ll)| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+""")


@cache
def odd_characters() -> frozenset[str]:
    """Characters that the two engines class differently, or that newer Unicode versions added.

    Texts holding one are split by the tokenizer library's own pre-tokenizer.
    """
    points = "".join(map(chr, (i for i in range(sys.maxunicode + 1) if not 0xD800 <= i < 0xE000)))
    odd: set[str] = set()
    for ours, theirs in ((r"[^\W\d_]", r"\p{L}"), (r"\d", r"\p{N}"), (r"\s", r"\s")):
        odd |= set(re.findall(ours, points)) ^ set(regex.findall(theirs, points))
    odd |= {c for c in regex.findall(r"[\p{L}\p{N}\s]", points)
            if unicodedata.ucd_3_2_0.category(c) == "Cn"}
    return frozenset(odd)


@cache
def library_splitter() -> tokenizers.pre_tokenizers.PreTokenizer:
    return tokenizers.pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)


def split_words(text: str) -> list[str]:
    if text.isascii():
        if not CONTROL.search(text):
            return QUICK_ASCII.findall(text)
    elif odd_characters().isdisjoint(set(text)):
        return QUICK.findall(text)
    return [text[a:b] for _, (a, b) in library_splitter().pre_tokenize_str(text)]


@contextmanager
def paused_collection():
    """No cycle collection meanwhile: the many short lists made here hold no cycles."""
    gc.disable()
    try:
        yield
    finally:
        gc.enable()


class Encoder:
    """One vocabulary; ``encode`` and ``decode`` work on lists of texts."""

    def __init__(self, vocabulary: str):
        spec = json.loads(vocabulary)
        letters = byte_letters()
        as_bytes = lambda token: bytes(letters[c] for c in token)
        self.ids = {as_bytes(t): i for t, i in spec["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = max([*self.ids.values(), *self.special.values()]) + 1
        self.tokens = [b""] * size
        for t, i in [*self.ids.items(), *((s.encode(), i) for s, i in self.special.items())]:
            self.tokens[i] = t
        self.single = [self.ids[bytes([b])] for b in range(256)]
        self.ranks: dict[tuple[int, int], int] = {}
        self.made: list[int] = []
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = (as_bytes(x) for x in (pair.split(" ") if isinstance(pair, str) else pair))
            self.ranks[self.ids[a], self.ids[b]] = rank
            self.made.append(self.ids[a + b])
        self.longest = max(map(len, self.ids))
        self.at_special = regex.compile(
            "(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") \
            if self.special else None
        self.forget()

    def forget(self) -> None:
        """Empty the tables of words and pairs."""
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.pairs: dict[tuple[int, int], bool] = {}

    def merged(self, word: bytes) -> tuple[int, ...]:
        """Exact BPE: join the adjacent pair of lowest rank, leftmost first, until none joins."""
        ids = [self.single[b] for b in word]
        if len(ids) > 64:
            return self._merged_long(ids)
        rank_of, none = self.ranks.get, NO_RANK
        ranks = [rank_of(p, none) for p in zip(ids, ids[1:])]
        while ranks and (rank := min(ranks)) != none:
            at = ranks.index(rank)
            ids[at:at + 2] = [self.made[rank]]
            del ranks[at]
            if at:
                ranks[at - 1] = rank_of((ids[at - 1], ids[at]), none)
            if at < len(ranks):
                ranks[at] = rank_of((ids[at], ids[at + 1]), none)
        return tuple(ids)

    def _merged_long(self, ids: list[int]) -> tuple[int, ...]:
        """The same with a heap over a linked list, for words of any length."""
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(self.ranks[p], i, p) for i, p in enumerate(zip(ids, ids[1:])) if p in self.ranks]
        heapify(heap)
        while heap:
            rank, i, pair = heappop(heap)
            j = after[i] if ids[i] is not None else n
            if j >= n or (ids[i], ids[j]) != pair:
                continue  # one of the two has been merged meanwhile
            ids[i], ids[j] = self.made[rank], None
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < n and (p := (ids[left], ids[right])) in self.ranks:
                    heappush(heap, (self.ranks[p], left, p))
        return tuple(x for x in ids if x is not None)

    def longest_match(self, word: bytes) -> tuple[int, ...]:
        out, at, end, ids = [], 0, len(word), self.ids
        while at < end:
            for stop in range(min(end, at + self.longest), at, -1):
                if (i := ids.get(word[at:stop])) is not None:
                    out.append(i)
                    at = stop
                    break
        return tuple(out)

    def learn(self, words: list[str]) -> None:
        """Enter the encodings of words that are not in the table yet."""
        raw = [w.encode() for w in words]
        proposed = [self.longest_match(w) for w in raw]
        flat = np.fromiter(chain.from_iterable(proposed), np.int64)
        ends = np.cumsum([len(p) for p in proposed])
        # a pair is a token and its right neighbour in the word; a lone token is paired with -1
        right = np.append(flat[1:], -1)
        right[ends - 1] = -1
        lone = np.zeros(len(flat), bool)
        lone[ends[np.diff(ends, prepend=0) == 1] - 1] = True
        tested = (right >= 0) | lone
        keys = (flat << 32) | (right & 0xFFFFFFFF)
        different, where = np.unique(keys[tested], return_inverse=True)
        good = np.fromiter((self.agrees(int(k) >> 32, int(k) & 0xFFFFFFFF) for k in different), bool, len(different))
        bad = np.zeros(len(flat), bool)
        bad[tested] = ~good[where]
        failing = np.add.reduceat(bad, np.append(0, ends[:-1])) > 0 if len(flat) else bad
        for w, b, p, fails in zip(words, raw, proposed, failing.tolist()):
            self.words[w] = array("I", self.merged(b) if fails else p).tobytes()

    def agrees(self, a: int, b: int) -> bool:
        """Whether BPE makes exactly these two tokens (b = 0xFFFFFFFF: this one) of their bytes."""
        known = self.pairs.get((a, b))
        if known is None:
            want = (a,) if b == 0xFFFFFFFF else (a, b)
            known = self.merged(b"".join(self.tokens[i] for i in want)) == want
            if len(self.pairs) >= TABLE_PAIRS:
                self.pairs.clear()
            self.pairs[a, b] = known
        return known

    def pieces(self, text: str) -> list[str]:
        if self.at_special is None or not self.at_special.search(text):
            return split_words(text)
        out = []
        for i, part in enumerate(self.at_special.split(text)):
            out += [part] if i % 2 else split_words(part)
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; the words that are new in this list are learnt together."""
        with paused_collection():
            split = [self.pieces(t) for t in texts]
            need = set(chain.from_iterable(split))
            new = need.difference(self.words)
            if len(self.words) + len(new) > TABLE_WORDS:
                self.words, self.older, new = {}, self.words, need
            self.words.update([(w, self.older[w]) for w in new if w in self.older])
            new = [w for w in new if w not in self.words]
            self.words.update((w, np.uint32(self.special[w]).tobytes()) for w in new if w in self.special)
            if new := [w for w in new if w not in self.special]:
                self.learn(new)
            return [b"".join(map(self.words.__getitem__, words)) for words in split]

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.tokens.__getitem__, ids.tolist())).decode("utf-8", "replace")


_encoders: dict[int, Encoder] = {}


def encoder(vocabulary: str) -> Encoder:
    """One encoder per vocabulary and Python worker."""
    key = hash(vocabulary)
    if key not in _encoders:
        _encoders[key] = Encoder(vocabulary)
    return _encoders[key]


def steps(values: pa.Array) -> Iterator[tuple[int, int]]:
    """(first, number) of runs of about ``STEP_BYTES`` of values."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(ends):
        limit = (ends[at - 1] if at else 0) + STEP_BYTES
        stop = max(at + 1, int(np.searchsorted(ends, limit, "right")))
        yield at, stop - at
        at = stop


def encode(docs: DataFrame, vocabulary_path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` plus ``ids``. The vocabulary (1.5 MB) is read here and broadcast."""
    return _mapped(docs, vocabulary_path, text, ids, "binary", pa.binary(), lambda enc, values:
                   enc.encode([v or "" for v in values]))


def decode(docs: DataFrame, vocabulary_path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """``docs`` plus ``text``, decoded from ``ids``."""
    return _mapped(docs, vocabulary_path, ids, text, "string", pa.string(), lambda enc, values: [
        enc.decode(np.frombuffer(v or b"", "<u4")) for v in values])


def _mapped(docs, vocabulary_path, source, result, kind, arrow, convert) -> DataFrame:
    words = docs.sparkSession.sparkContext.broadcast(Path(vocabulary_path).read_text())
    names = [c for c in docs.columns if c != result]
    src = docs.select(*names, F.col(source).alias("_source"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(words.value)
        try:
            for b in batches:
                source = b.column(len(names))
                for at, n in steps(source):
                    part = [b.column(i).slice(at, n) for i in range(len(names))]
                    made = pa.array(convert(enc, source.slice(at, n).to_pylist()), arrow)
                    yield pa.RecordBatch.from_arrays([*part, made], [*names, result])
        finally:
            enc.forget()

    return src.mapInArrow(run, docs.select(*names).schema.add(result, kind))
