"""SentencePiece BPE: exact encoding by backtracking, and decoding.

The model merges the best-scored adjacent pair of a text, leftmost first. A row of
pieces is that encoding exactly when every two neighbours are what merging makes of
their own text (a first piece: of its own), so no text is merged as a whole: an
Aho-Corasick automaton gives the longest piece from every place, pieces are laid
greedily, and a piece that does not suit its left neighbour, judged by re-merging the
two once and remembered, gives way to its next shorter prefix. A place from which
nothing suits is marked in a bitfield of failed positions and its piece is taken back;
no place is left twice, so the work stays in proportion to the text.

No piece has a space behind another character, and some characters stand in no piece of
two or more; texts are cut there, and each different cut is encoded once per table. The
tables hold ``TABLE_WORDS`` cuts and ``TABLE_PAIRS`` pairs and start anew when full, texts
are taken in steps of about ``STEP``, so memory does not grow with the input.

Defined results: a null text encodes like an empty one, to the end id alone; null ids
decode to an empty text; characters that are no piece become byte pieces; bytes that are
not valid UTF-8 together decode to U+FFFD each. Repeated rows give repeated results, very
long texts are steps of their own, an empty table gives an empty one, and a column
named like a result is replaced.
"""

from __future__ import annotations

import codecs
import re
from array import array
from collections.abc import Iterator
from itertools import chain, filterfalse
from pathlib import Path

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, IntegerType, StringType

from tidewater.llm.bpe import paused_collection

SPACE = "▁"  # the model's mark for a space
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6  # piece types of model files (fixed values)
BPE_MODEL = 2
UNKNOWN_TEXT = " ⁇ "  # what the unknown id decodes to (fixed value)
TABLE_WORDS = 200_000
TABLE_PAIRS = 1_000_000
SLOT_BITS = 20
LONG_CUT = 64  # longer cuts backtrack alone
STEP = 1 << 20  # bytes of text, or ids, taken at once; a longer row is a step of its own

codecs.register_error("piece_bytes", lambda e: ("�" * (e.end - e.start), e.end))


class Pieces:
    """One model; ``encode`` and ``decode`` work on lists."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2
        spec = sentencepiece_model_pb2.ModelProto.FromString(model)
        rules = spec.normalizer_spec
        kinds = {p.type for p in spec.pieces}
        if spec.trainer_spec.model_type != BPE_MODEL or rules.precompiled_charsmap or rules.remove_extra_whitespaces \
                or not rules.escape_whitespaces or not kinds <= {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("needs a BPE model without normalisation, user-defined or unused pieces")
        self.prefixed = rules.add_dummy_prefix
        self.end = spec.trainer_spec.eos_id
        self.text = [p.piece.replace(SPACE, " ") for p in spec.pieces]
        self.size = list(map(len, self.text))
        self.ids = {self.text[i]: i for i, p in enumerate(spec.pieces) if p.type == NORMAL}
        self.score = {self.text[i]: p.score for i, p in enumerate(spec.pieces) if p.type == NORMAL}
        joined = {c for t in self.ids if len(t) > 1 for c in t}
        if any(" " in t.lstrip(" ") for t in self.ids) or not joined <= self.ids.keys():
            raise ValueError("needs pieces with spaces in front only and a piece for each of their characters")
        byte_ids = {int(p.piece[3:5], 16): i for i, p in enumerate(spec.pieces) if p.type == BYTE}
        unknown = [i for i, p in enumerate(spec.pieces) if p.type == UNKNOWN]
        self.byte_ids = [byte_ids.get(b, unknown[0]) for b in range(256)]
        self.raw = [t.encode() for t in self.text]
        for i, p in enumerate(spec.pieces):
            if p.type == BYTE:
                self.raw[i] = bytes([int(p.piece[3:5], 16)])
            elif p.type != NORMAL:
                self.raw[i] = UNKNOWN_TEXT.encode() if p.type == UNKNOWN else b""
        self.control = {i for i, p in enumerate(spec.pieces) if p.type == CONTROL}
        self.automaton = ahocorasick.Automaton()
        for t, i in self.ids.items():
            self.automaton.add_word(t, i)
        self.automaton.make_automaton()
        # the longest shorter piece that begins each piece's text (-1: none)
        self.shorter = [-1] * len(self.text)
        for t, i in self.ids.items():
            self.shorter[i] = next((self.ids[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in self.ids), -1)
        self.shorter = np.array(self.shorter)
        self.sizes = np.append(self.size, 0)  # the last one: no piece
        self.joined = joined
        self.cuts = self._cuts()
        self.pairs: dict[int, bool] = {}
        self.slot_keys = np.full(1 << SLOT_BITS, -1, np.int64)
        self.slot_fits = np.zeros(1 << SLOT_BITS, bool)
        self.forget()

    def _cuts(self) -> re.Pattern:
        """Cuts that no piece crosses: spaces, then leading characters, then inner ones.

        Letters and digits are inner, and so is what any piece has behind an inner
        character; no piece has one of the others there.
        """
        behind: dict[str, set[str]] = {}
        for t in self.ids:
            for a, b in zip(t, t[1:]):
                behind.setdefault(a, set()).add(b)
        inner = {c for c in self.joined if c.isalnum()}
        new = inner
        while new:
            new = set().union(*(behind.get(c, ()) for c in new)) - inner
            inner = inner | new
        inside = "".join(map(re.escape, sorted(inner)))
        lead = "".join(map(re.escape, sorted(self.joined - inner - {" "}))) or "\\0"
        return re.compile(f" +[{lead}]*[{inside}]*|[{lead}]+[{inside}]*|[{inside}]+|[^{lead}{inside} ]+")

    def forget(self) -> None:
        """Empty the table of cuts (two generations); judged pairs stay."""
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def merged(self, text: str) -> list[str]:
        """The model's merging of a short text: best score first, leftmost of equals."""
        parts, score = list(text), self.score.get
        while len(parts) > 1:
            found = [s if (s := score(a + b)) is not None else -np.inf for a, b in zip(parts, parts[1:])]
            best = max(found)
            if best == -np.inf:
                break
            at = found.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, left: int, right: int) -> bool:
        """Whether the two stay neighbours when their text is merged (left = -1: none)."""
        want = [self.text[right]] if left < 0 else [self.text[left], self.text[right]]
        if len(self.pairs) >= TABLE_PAIRS:
            self.pairs.clear()
        known = self.pairs[(left + 1) * len(self.text) + right] = self.merged("".join(want)) == want
        return known

    def backtracked(self, word: str) -> list[int]:
        """Pieces of a cut whose characters all are pieces."""
        n, size, shorter, known, many = len(word), self.size, self.shorter.tolist(), self.pairs.get, len(self.text)
        longest = [-1] * n
        for last, piece in self.automaton.iter(word):  # ends ascend: the last one entered is the longest
            longest[last + 1 - size[piece]] = piece
        failed = bytearray((n >> 3) + 1)
        out: list[int] = []
        at, left, piece = 0, -1, longest[0]
        while at < n:
            while piece >= 0:
                end = at + size[piece]
                if not failed[end >> 3] >> (end & 7) & 1:
                    good = known((left + 1) * many + piece)
                    if good or (good is None and self.fits(left, piece)):
                        break
                piece = shorter[piece]
            if piece < 0:
                failed[at >> 3] |= 1 << (at & 7)
                piece = out.pop()
                at -= size[piece]
                left = out[-1] if out else -1
            else:
                out.append(piece)
                at, left = end, piece
                piece = longest[at] if at < n else -1
        return out

    def fitting(self, keys: np.ndarray) -> np.ndarray:
        """``fits`` of many pairs; judged pairs stand in a table of one slot a hash."""
        slot = ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        strange = np.flatnonzero(self.slot_keys[slot] != keys)
        out = self.slot_fits[slot]
        if len(strange):
            many = len(self.text)
            new, where = np.unique(keys[strange], return_inverse=True)
            good = np.fromiter((k if (k := self.pairs.get(key)) is not None else self.fits(key // many - 1, key % many)
                                for key in new.tolist()), bool, len(new))[where]
            out[strange] = good
            self.slot_keys[slot[strange]], self.slot_fits[slot[strange]] = keys[strange], good
        return out

    def learn(self, words: list[str]) -> None:
        """Enter cuts of pieces into the table: all backtrack together, a step of each at a time."""
        whole = "\0".join(words) + "\0"  # no piece holds it, so no match crosses a cut
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1) - 1
        starts = ends - sizes
        longest = np.full(len(whole), -1, np.int64)
        found = np.fromiter(chain.from_iterable(self.automaton.iter(whole)), np.int64).reshape(-1, 2)
        longest[found[:, 0] + 1 - self.sizes[found[:, 1]]] = found[:, 1]  # ends ascend: the longest one stays
        failed = np.zeros(len(whole) + 1, bool)
        placed = np.full(len(whole) + 1, -1, np.int64)  # the piece laid from a place
        before = np.zeros(len(whole) + 1, np.int64)  # where the piece that ends in a place begins
        first, last, at = starts, ends, starts.copy()
        left, piece = np.full(len(words), -1, np.int64), longest[starts]
        many = len(self.text)
        while len(at):
            end = at + self.sizes[piece]
            open_ = (piece >= 0) & ~failed[np.where(piece >= 0, end, 0)]
            some = np.flatnonzero(open_)
            open_[some] = self.fitting((left[some] + 1) * many + piece[some])
            lay, back = np.flatnonzero(open_), np.flatnonzero(piece < 0)
            short = np.flatnonzero(~open_ & (piece >= 0))
            placed[at[lay]], before[end[lay]] = piece[lay], at[lay]
            piece[short] = self.shorter[piece[short]]
            failed[at[back]] = True
            at[lay], left[lay] = end[lay], piece[lay]
            piece[lay] = longest[at[lay]]
            at[back] = before[at[back]]
            piece[back] = placed[at[back]]
            left[back] = np.where(at[back] > first[back], placed[before[at[back]]], -1)
            going = at < last
            if not going.all():
                first, last, at, left, piece = (x[going] for x in (first, last, at, left, piece))
        laid = np.zeros(len(whole), bool)
        at, first = ends, starts
        while len(at):
            at = before[at]
            laid[at] = True
            going = at > first
            at, first = at[going], first[going]
        places = np.flatnonzero(laid)
        raw = placed[places].astype("<u4").tobytes()
        cuts = (4 * np.searchsorted(places, ends)).tolist()
        self.words.update(zip(words, (raw[a:b] for a, b in zip([0, *cuts], cuts))))

    def spelt(self, word: str) -> bytes:
        """A cut of characters that never join: pieces of their own, or bytes."""
        ids = chain.from_iterable([self.ids[c]] if c in self.ids else [self.byte_ids[b] for b in c.encode()]
                                  for c in word)
        return array("I", ids).tobytes()

    def enter(self, words: list[str]) -> None:
        together = []
        for w in words:
            if w[0] != " " and w[0] not in self.joined:
                self.words[w] = self.spelt(w)
            elif len(w) > LONG_CUT:
                self.words[w] = array("I", self.backtracked(w)).tobytes()
            else:
                together.append(w)
        if together:
            self.learn(together)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, the end id last, as little-endian unsigned 32-bit integers."""
        first, end = " " if self.prefixed else "", array("I", [self.end]).tobytes()
        with paused_collection():
            split = [self.cuts.findall(first + t.replace(SPACE, " ")) if t else [] for t in texts]
            new = set(filterfalse(self.words.__contains__, chain.from_iterable(split)))
            if len(self.words) + len(new) > TABLE_WORDS:
                self.words, self.older, new = {}, self.words, set(chain.from_iterable(split))
            self.words.update([(w, self.older[w]) for w in new if w in self.older])
            self.enter([w for w in new if w not in self.older])
            return [b"".join(map(self.words.__getitem__, words)) + end for words in split]

    def decode(self, ids: list[int]) -> str:
        """Text of ids. Control pieces are empty; bytes before and behind one do not join."""
        raw = b"".join(map(self.raw.__getitem__, ids))
        if not self.control.isdisjoint(ids[:-1]):
            parts, part = [], []
            for i in ids:
                if i in self.control:
                    parts.append(b"".join(part).decode("utf-8", "piece_bytes").encode())
                    part = []
                else:
                    part.append(self.raw[i])
            raw = b"".join(parts) + b"".join(part)
        if self.prefixed and raw[:1] == b" ":
            lead = next(i for i in ids if i not in self.control)
            raw = raw[1:] if self.ids.get(self.text[lead]) == lead else raw
        return raw.decode("utf-8", "piece_bytes")


_models: dict[int, Pieces] = {}


def pieces(model: bytes) -> Pieces:
    """One model per Python worker."""
    key = hash(model)
    if key not in _models:
        _models[key] = Pieces(model)
    return _models[key]


def encode(docs: DataFrame, model_path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` plus ``ids`` (array of int, the end id last). The model (0.5 MB) is read here and broadcast."""
    def convert(model: Pieces, texts: pa.Array) -> pa.Array:
        made = model.encode([t or "" for t in texts.to_pylist()])
        ends = np.cumsum([0, *(len(m) // 4 for m in made)], dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(made), np.int32)))

    return _mapped(docs, model_path, text, ids, ArrayType(IntegerType()), convert)


def decode(docs: DataFrame, model_path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """``docs`` plus ``text``, decoded from ``ids``."""
    def convert(model: Pieces, values: pa.Array) -> pa.Array:
        every = values.flatten().to_numpy(zero_copy_only=False).tolist()
        ends = np.cumsum(pc.fill_null(pc.list_value_length(values), 0).to_numpy(zero_copy_only=False)).tolist()
        return pa.array([model.decode(every[a:b]) for a, b in zip([0, *ends], ends)], pa.string())

    return _mapped(docs, model_path, ids, text, StringType(), convert)


def runs(values: pa.Array) -> Iterator[tuple[int, int]]:
    """(first, number) of runs of rows of about ``STEP``."""
    sizes = pc.list_value_length(values) if pa.types.is_list(values.type) else pc.binary_length(values)
    ends = np.cumsum(pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(ends):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + STEP, "right")))
        yield at, stop - at
        at = stop


def _mapped(docs: DataFrame, model_path: str, source: str, result: str, kind: DataType, convert) -> DataFrame:
    model = docs.sparkSession.sparkContext.broadcast(Path(model_path).read_bytes())
    names = [c for c in docs.columns if c != result]
    src = docs.select(*names, F.col(source).alias("_source"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with_model = pieces(model.value)
        try:
            for b in batches:
                values = b.column(len(names))
                for at, n in runs(values):
                    part = [b.column(i).slice(at, n) for i in range(len(names))]
                    yield pa.RecordBatch.from_arrays([*part, convert(with_model, values.slice(at, n))],
                                                     [*names, result])
        finally:
            with_model.forget()

    return src.mapInArrow(run, docs.select(*names).schema.add(result, kind))
