"""Words of whole Arrow batches as 64-bit hashes, vectorised.

Texts stay in their Arrow buffer: words are byte ranges of it and no Python
object is made per word, so a worker needs memory for one slice of texts and no
table of words. A word's hash is a pair of polynomials over its bytes modulo
two 31-bit primes, mixed; it depends on the word alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

_U = np.uint64
#: (prime, base) of the two polynomials, and the bytes hashed at a time.
_FIELDS = ((2147483647, 911382323), (2147483629, 972663749))
_CHUNK = 1 << 18
_STEP = _U(0x9E3779B97F4A7C15)
#: Bytes of text that are worked on at a time (a longer text is a slice of its own).
SLICE_BYTES = 1 << 22


def byte_set(chars: bytes) -> np.ndarray:
    """Table of 256 flags: the bytes in ``chars``."""
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


BLANK = byte_set(b" \t\n\x0b\x0c\r")


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


@lru_cache(1)
def _powers() -> list[tuple[np.ndarray, np.ndarray]]:
    """Powers of each base and of its inverse."""
    out = []
    for p, base in _FIELDS:
        pair = []
        for b in (base, pow(base, -1, p)):
            x = np.ones(1, np.uint64)
            while len(x) < _CHUNK:
                x = np.concatenate([x, x * _U(pow(b, len(x), p)) % _U(p)])
            pair.append(x)
        out.append(tuple(pair))
    return out


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of text, one row at least."""
    for b in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        lo = 0
        while lo < len(ends):
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + limit, side="right")))
            yield b.slice(lo, hi - lo)
            lo = hi


class Words:
    """The words of a string column (null: none).

    ``data``: the texts' bytes; ``ends``: where texts begin and end in it;
    per word ``first`` and ``last`` (byte range), ``row`` and ``hash``; per text
    ``begin`` (number of its first word) and ``count``.
    """

    def __init__(self, texts: pa.Array, blank: np.ndarray = BLANK, fold: bool = False):
        """``blank``: the bytes between words; ``fold``: A-Z count as a-z."""
        if texts.null_count:
            texts = pc.fill_null(texts, "")
        if len(texts):
            wide = pa.types.is_large_string(texts.type)
            ends = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
        else:
            ends = np.zeros(1, np.int64)
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]] if len(texts) else np.zeros(0, np.uint8)
        self.data, self.ends, self.fold = data, ends - ends[0], fold
        word = ~blank[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[self.ends] = True
        start, stop = word.copy(), word.copy()
        if len(data):
            start[1:] &= ~word[:-1] | edge[1:-1]
            stop[:-1] &= ~word[1:] | edge[1:-1]
        self.first, self.last = np.flatnonzero(start), np.flatnonzero(stop) + 1
        self.row = np.searchsorted(self.ends, self.first, side="right") - 1
        self.count = np.bincount(self.row, minlength=len(texts))
        self.begin = np.concatenate([[0], np.cumsum(self.count)])[:len(texts)].astype(np.int64)
        self.hash = self._hash()

    def folded(self) -> np.ndarray:
        """The bytes as they count."""
        return np.where((self.data >= 65) & (self.data <= 90), self.data + 32, self.data).astype(np.uint8) if self.fold else self.data

    def _hash(self) -> np.ndarray:
        value = np.arange(1, 257, dtype=np.uint64)
        if self.fold:
            value[65:91] += _U(32)
        out = np.empty(len(self.first), np.uint64)
        i = 0
        while i < len(out):
            base = self.first[i]
            j = int(np.searchsorted(self.last, base + _CHUNK, side="right"))
            if j == i:  # a word longer than a chunk
                word = self.data[base:self.last[i]].tobytes()
                out[i] = xxhash.xxh3_64_intdigest(word.lower() if self.fold else word)
                i += 1
                continue
            s, e = self.first[i:j] - base, self.last[i:j] - base
            byte = value[self.data[base:self.last[j - 1]]]
            both = np.zeros(j - i, np.uint64)
            for (p, _), (power, inverse) in zip(_FIELDS, _powers()):
                total = np.zeros(len(byte) + 1, np.uint64)
                np.cumsum(byte * power[:len(byte)], out=total[1:])
                both = both << _U(31) | (total[e] - total[s]) % _U(p) * inverse[s] % _U(p)
            out[i:j] = mix(both)
            i = j
        return out

    def runs(self, size: int) -> np.ndarray:
        """Numbers of the words at which ``size`` words of one text start."""
        at = np.arange(max(len(self.first) - size + 1, 0))
        return at[at + size <= (self.begin + self.count)[self.row[at]]]


def rolling(h: np.ndarray, size: int) -> np.ndarray:
    """Polynomial (modulo 2^64, not mixed) of every ``size`` consecutive hashes."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, have, block, span = np.zeros(n, np.uint64), 0, h, 1
    power = lambda k: _U(pow(int(_STEP), k, 1 << 64))
    while True:
        if size & span:
            out = out * power(span) + block[have:have + n]
            have += span
        if 2 * span > size:
            return out
        block = block[:len(block) - span] * power(span) + block[span:]
        span *= 2
