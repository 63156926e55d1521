"""Words of many texts at once, as 64-bit hashes computed from the UTF-8 bytes of an Arrow column.

A word is a run of bytes other than space and tab to carriage return (0x20, 0x09-0x0D). Hashes are
polynomials over random byte values modulo 2**64, taken from running sums, then mixed. Such polynomials
agree for some pairs of long words (from 1,024 letters on, made of two letters by a rule), so words of
more than LONG bytes are hashed one by one with BLAKE2 instead.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
PIECE = 1 << 18
LONG = 128
SPACES = [0x20, *range(0x09, 0x0E)]


@cache
def _tables(lower: bool, seed: int):
    values = np.random.default_rng(seed).integers(1, 2**63, 256, dtype=np.int64).astype(U64) | U64(1)
    if lower:
        values[65:91] = values[97:123]
    values[SPACES] = 0
    return values


@cache
def _inside():
    table = np.ones(256, bool)
    table[SPACES] = False
    return table


_POWERS: dict[int, np.ndarray] = {}


def powers(count: int, base: int = BASE) -> np.ndarray:
    """base**0 .. base**(count - 1) modulo 2**64."""
    have = _POWERS.get(base)
    if have is None or len(have) < count:
        size = max(count, PIECE + 1)
        with np.errstate(over="ignore"):
            have = np.concatenate([np.ones(1, U64), np.full(size - 1, base, U64)]).cumprod(dtype=U64)
        if size <= 1 << 22:  # longer ones are for a single word or text
            _POWERS[base] = have
    return have[:count]


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U64(33))
    x *= U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


@dataclass
class Words:
    """Words of a column of texts: byte ranges, hashes, and the range of words of each text."""

    data: np.ndarray  # bytes of all texts
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # words of text d are first[d] .. first[d + 1]

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    @property
    def left(self) -> np.ndarray:
        """Words from each word to the end of its text, itself included."""
        return np.repeat(self.first[1:], self.counts) - np.arange(len(self.hash))


def column_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    count = len(column)
    offsets = np.frombuffer(offsets, np.int64, count + 1, column.offset * 8) if count else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def split_words(column, lower: bool = False, seed: int = 1, hashed: bool = True) -> Words:
    """Words of every text. ``lower`` folds A-Z only, for the hashes; the bytes stay as they are."""
    data, offsets = column_bytes(column)
    inside = _inside()[data]
    before = np.empty_like(inside)
    after = np.empty_like(inside)
    if len(data):
        before[0] = False
        before[1:] = inside[:-1]
        before[offsets[:-1][offsets[:-1] < len(data)]] = False
        after[-1] = False
        after[:-1] = inside[1:]
        after[offsets[1:][offsets[1:] > 0] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    hashes = _hashes(data, start, end, lower, seed) if hashed else np.zeros(0, U64)
    return Words(data, start, end, hashes, np.searchsorted(start, offsets))


def word_array(words: Words) -> pa.Array:
    """The words of all texts as one Arrow column."""
    sizes = words.end - words.start
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    total = int(offsets[-1])
    source = np.repeat(words.start - offsets[:-1], sizes) + np.arange(total)
    return pa.StringArray.from_buffers(len(sizes), pa.py_buffer(offsets.tobytes()), pa.py_buffer(words.data[source].tobytes()))


def _hashes(data, start, end, lower, seed) -> np.ndarray:
    """Word by word in pieces of bytes that end where a word ends, so memory stays bounded."""
    values, out = _tables(lower, seed), np.empty(len(start), U64)
    inverse = pow(BASE, -1, 2**64)
    at = 0
    while at < len(start):
        upto = max(at + 1, int(np.searchsorted(end, start[at] + PIECE, "right")))
        low, high = int(start[at]), int(end[upto - 1])
        sums = np.zeros(high - low + 1, U64)
        np.cumsum(values[data[low:high]] * powers(high - low), dtype=U64, out=sums[1:])
        begin = start[at:upto] - low
        out[at:upto] = (sums[end[at:upto] - low] - sums[begin]) * powers(high - low + 1, inverse)[begin]
        at = upto
    out = mix(out)
    for k in np.flatnonzero(end - start > LONG).tolist():
        word = data[start[k] : end[k]].tobytes()
        digest = blake2b(word.lower() if lower else word, digest_size=8, key=seed.to_bytes(8, "little"))
        out[k] = int.from_bytes(digest.digest(), "little")
    return out


def grams(hashes: np.ndarray, size: int, salt: int = 0) -> np.ndarray:
    """Hash of each run of ``size`` words, by first word; the last size - 1 words start none."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.zeros(0, U64)
    keyed = mix(hashes ^ U64(salt)) if salt else hashes
    total = np.zeros(count, U64)
    for k in range(size):
        total *= U64(BASE)
        total += keyed[k : k + count]
    return mix(total)


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket by the leading bits: non-decreasing in the hash."""
    return ((hashes >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int32)


def pack(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def unpack(bits: bytes, count: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(bits, np.uint8), count=count).astype(bool)
