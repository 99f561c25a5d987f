"""Vectorised text kernels for tasks: word hashes of an Arrow text column, packed key sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 4 << 20
U = np.uint64
_codec = pa.Codec("zstd", compression_level=1)

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, *range(9, 14)]] = True
FOLD = np.arange(256, dtype=np.uint8)  # A-Z to a-z
FOLD[65:91] += 32
BYTE_VALUES = np.random.default_rng(20_240_601).integers(1, 1 << 63, 256, dtype=np.uint64)[FOLD]
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_powers = {BASE: np.ones(1, U), pow(BASE, -1, 1 << 64): np.ones(1, U)}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers[base]
    if len(have) < n:
        step = np.full(max(n, 1 << 16), base, U)
        step[0] = 1
        have = _powers[base] = np.cumprod(step, dtype=U)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's UTF-8 bytes (null: none) and the n+1 offsets into them."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1] \
        if len(texts) else np.zeros(1, np.int64)
    data = texts.buffers()[2] if len(texts) else None
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None and len(data) \
        else np.empty(0, np.uint8)
    return raw, offsets - offsets[0]


def chunks(texts: pa.Array | pa.ChunkedArray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """(first row, slice) of about ``limit`` bytes each; a longer text is a slice of its own."""
    parts = texts.chunks if isinstance(texts, pa.ChunkedArray) else [texts]
    first = 0
    for part in parts:
        _, offsets = text_bytes(part)
        at = 0
        while at < len(part):
            stop = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
            stop = min(max(stop, at + 1), len(part))
            yield first + at, part.slice(at, stop - at)
            at = stop
        first += len(part)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every word between ASCII white space, A-Z lower-cased, in order.

    A word's hash is a polynomial of its bytes' random values modulo 2**64, taken
    from one prefix sum over the column and shifted back to the word's start.
    """
    raw, offsets = text_bytes(texts)
    n = len(raw)
    if not n:
        return np.empty(0, U), np.empty(0, np.int64)
    word = ~IS_SPACE[raw]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = word[:-1]
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = word[1:]
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    sums = np.zeros(n + 1, U)
    np.cumsum(BYTE_VALUES[raw] * powers(BASE, n), out=sums[1:])
    shift = powers(pow(BASE, -1, 1 << 64), n)
    hashes = mix((sums[ends] - sums[starts]) * shift[starts])
    return hashes, np.searchsorted(offsets, starts, "right") - 1


def with_ends(hashes: np.ndarray, rows: np.ndarray, n: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, row): ``end`` before the first word and after each row's last, so that every
    neighbouring pair is (context, token) of the row of its second part."""
    seq = np.full(len(hashes) + n + 1, end, U)
    at = np.arange(len(hashes)) + rows + 1
    seq[at] = hashes
    owner = np.full(len(seq), -1, np.int64)
    owner[at] = rows
    ends = np.cumsum(np.bincount(rows, minlength=n) + 1)
    owner[ends] = np.arange(n)
    return seq, owner[1:]


def distinct(keys: np.ndarray) -> np.ndarray:
    """Sorted different keys. ``np.unique`` hashes them, which takes many times the sort when most differ."""
    keys = np.sort(keys)
    return keys[np.append(True, keys[1:] != keys[:-1])] if len(keys) else keys


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different keys and the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(counts, first)


def pack_numbers(values: np.ndarray) -> bytes:
    """Unsigned integers as compressed byte planes (small numbers cost little)."""
    width = values.dtype.itemsize
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, width).T.tobytes()
    return np.array([len(values), width], "<u4").tobytes() + _codec.compress(planes, asbytes=True)


def unpack_numbers(data: bytes) -> np.ndarray:
    n, width = np.frombuffer(data, "<u4", 2).tolist()
    planes = np.frombuffer(_codec.decompress(data[8:], n * width, asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, n).T).view(f"<u{width}").reshape(n)


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys as compressed differences."""
    return pack_numbers(np.diff(keys, prepend=U(0)))


def unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpack_numbers(data), dtype=U)


def shard_bits(shards: int) -> int:
    return max(shards - 1, 0).bit_length()


def by_shard(keys: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """(shard, slice of the sorted keys) by the keys' top bits, empty shards left out."""
    top = (keys >> U(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    cuts = np.searchsorted(top, np.arange((1 << bits) + 1))
    for s in range(1 << bits):
        if cuts[s] < cuts[s + 1]:
            yield s, slice(int(cuts[s]), int(cuts[s + 1]))


class KeyIndex:
    """Places of known keys: a bucket per hash, all lookups of an array at once."""

    def __init__(self, keys: np.ndarray):
        self.shift = U(64 - max(4, (4 * len(keys)).bit_length()))
        slots = 1 << (64 - int(self.shift))
        bucket = self._bucket(keys)
        self.place = np.argsort(bucket, kind="stable")
        self.keys = keys[self.place]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(bucket, minlength=slots))[:-1]]).astype(np.int32)

    def _bucket(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * U(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key among the keys given at the start; all must be known."""
        at = self.first[self._bucket(keys)]
        open_ = np.flatnonzero(self.keys[at] != keys)
        while len(open_):
            at[open_] += 1
            open_ = open_[self.keys[at[open_]] != keys[open_]]
        return self.place[at]
