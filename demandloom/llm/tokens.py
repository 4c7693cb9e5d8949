"""Words of many texts at once, and their hashes, as numpy arrays.

A word is a run of bytes without ASCII white space (space, tab to carriage
return) in the UTF-8 form of a text, which is the same as the run of characters.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Odd 64-bit multipliers of the rolling hashes and of the final mixing.
BASE = np.uint64(0x9E3779B97F4A7C15)
WINDOW_BASE = np.uint64(0xD6E8FEB86659FD93)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX1
    x ^= x >> np.uint64(27)
    x *= _MIX2
    x ^= x >> np.uint64(31)
    return x


def powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i below n; kept for slices of usual size."""
    have = _powers.get(int(base))
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        have = []
        for b in (base, inverse):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            have.append(np.cumprod(p, dtype=np.uint64))
        have = (have[0], have[1])
        if size <= 8 << 20:
            _powers[int(base)] = have
    return have[0][:n], have[1][:n]


def prefix_sums(values: np.ndarray, base: np.uint64) -> np.ndarray:
    """P with P[0] = 0 and P[i+1] = P[i] + values[i] * base**i, modulo 2**64."""
    up, _ = powers(base, max(len(values), 1))
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:len(values)], dtype=np.uint64, out=out[1:])
    return out


@dataclass
class Words:
    """Words of a slice of texts; ``first[d]:first[d + 1]`` are those of text d."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc(self) -> np.ndarray:
        """Number of the text of each word."""
        return np.repeat(np.arange(len(self.first) - 1, dtype=np.int64), self.counts)

    def hashes(self) -> np.ndarray:
        """A 64-bit value of each word: its length and its eight-byte blocks, mixed in one by one."""
        size = self.end - self.start
        value = mix(size.astype(np.uint64) ^ BASE)
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        blocks = np.ndarray((len(self.data) + 1,), "<u8", padded, 0, (1,))
        live = np.flatnonzero(size <= LONG_WORD)
        for at in range(0, LONG_WORD, 8):
            live = live[size[live] > at]
            if not len(live):
                break
            block = blocks[self.start[live] + at] & _HEAD[np.minimum(size[live] - at, 8)]
            value[live] = mix(value[live] * WINDOW_BASE + block)
        for i in np.flatnonzero(size > LONG_WORD):
            digest = hashlib.blake2b(self.data[self.start[i]:self.end[i]], digest_size=8).digest()
            value[i] = int.from_bytes(digest, "little")
        return value


#: Words of more bytes are hashed by a library digest.
LONG_WORD = 1024
#: Masks of the first 0 to 8 bytes of a block.
_HEAD = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)

#: Bytes inside plain words: ASCII letters and digits, and all of other characters.
PLAIN = np.zeros(256, bool)
PLAIN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow string array without nulls, and where each text begins."""
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    kind = np.int64 if wide else np.int32
    bounds = np.frombuffer(offsets, kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    if data is None:
        raw = np.zeros(0, np.uint8)
    else:
        raw = np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]]
    return raw, bounds - bounds[0]


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    return raw + (((raw >= 65) & (raw <= 90)).view(np.uint8) << 5)


def scan(texts: pa.Array, lower: bool = False, solid: np.ndarray | None = None, single: bool = False) -> Words:
    """Words of an Arrow string array without nulls; ``solid`` is a table of the
    bytes that make words, where these are not all but ASCII white space.  With
    ``single``, each character of scripts without spaces is a word."""
    raw, bounds = text_bytes(texts)
    if lower:
        raw = lower_ascii(raw)
    solid = solid[raw] if solid is not None else (raw != 32) & ((raw < 9) | (raw > 13))
    edge = np.zeros(len(raw) + 1, bool)
    edge[0] = edge[-1] = True
    np.not_equal(solid[1:], solid[:-1], out=edge[1:-1])
    edge[bounds] = True
    if single:  # three bytes, U+3000 to U+D7FF: kana, ideographs, hangul
        lead = np.flatnonzero((raw >= 0xE3) & (raw <= 0xED))
        edge[lead] = True
        edge[np.minimum(lead + 3, len(raw))] = True
    cuts = np.flatnonzero(edge)
    if len(raw):
        inside = solid[cuts[:-1]]
        start, end = cuts[:-1][inside], cuts[1:][inside]
    else:
        start = end = np.zeros(0, np.int64)
    return Words(raw, start, end, np.searchsorted(start, bounds))


def shingles(words: Words, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of each run of ``size`` words; a text with fewer words,
    but at least one, has its whole sequence as its only shingle."""
    counts = words.counts
    runs = np.maximum(counts - size + 1, 0)
    doc = np.repeat(np.arange(len(counts)), runs)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(runs) - runs, runs) + words.first[doc]
    value = np.zeros(len(doc), np.uint64)
    for k in range(size):
        value = value * WINDOW_BASE + hashes[at + k]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        tail = np.zeros(len(short), np.uint64)
        for k in range(size - 1):
            on = counts[short] > k
            tail[on] = tail[on] * WINDOW_BASE + hashes[words.first[short[on]] + k]
        doc = np.concatenate([doc, short])
        value = np.concatenate([value, tail + counts[short].astype(np.uint64)])
    return doc, mix(value)


def distinct(doc: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (doc, value) pairs, ordered by doc, then value."""
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    return doc[new], value[new]


def strings(words: Words, at: np.ndarray) -> pa.Array:
    """The words at some places, as an Arrow array."""
    size = words.end[at] - words.start[at]
    offsets = np.concatenate([[0], np.cumsum(size)])
    spread = np.repeat(words.start[at] - offsets[:-1], size) + np.arange(offsets[-1])
    return pa.Array.from_buffers(pa.large_string(), len(at), [
        None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(words.data[spread])]).cast(pa.string())
