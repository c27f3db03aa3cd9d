"""Words of whole texts as 64-bit hashes, computed per Arrow batch with numpy.

A word is a run of bytes outside ``\\x20 \\x09-\\x0D``. The text column of a
batch is one byte buffer; word borders come from one pass over it, and word
hashes from the prefix sums of a polynomial over the bytes, so no Python string
is made per word. Null texts count as empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

_BLOCK = 1 << 20  # bytes hashed at a time, and the length of the power tables
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i below the block length."""
    if base not in _TABLES:
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(_BLOCK, b, np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        _TABLES[base] = (out[0], out[1])
    return _TABLES[base]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte start and end of every word, and the first word of each row (one more at the end)."""
    if len(data) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    full = ~_SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    begin = full.copy()
    begin[1:] &= ~full[:-1] | first[1:-1]
    last = full.copy()
    last[:-1] &= ~full[1:] | first[1:-1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hash_words(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False, base: int = 0
) -> np.ndarray:
    """64-bit hash of each word; equal words have equal hashes. ``base`` 0 or 1 picks the function."""
    powers, inverse = _powers(_BASES[base])
    out = np.zeros(len(starts), np.uint64)
    if not len(starts):
        return out
    a = 0
    while a < len(starts):
        if ends[a] - starts[a] >= _BLOCK:
            word = data[starts[a] : ends[a]]
            out[a] = xxhash.xxh3_64_intdigest((_LOWER[word] if lower else word).tobytes(), seed=base)
            a += 1
            continue
        b = int(np.searchsorted(ends, starts[a] + _BLOCK, side="left"))
        seg = data[starts[a] : ends[b - 1]]
        terms = (_LOWER[seg] if lower else seg).astype(np.uint64)
        terms += np.uint64(1)
        terms *= powers[: len(seg)]
        sums = np.zeros(len(seg) + 1, np.uint64)
        np.cumsum(terms, out=sums[1:])
        s, e = starts[a:b] - starts[a], ends[a:b] - starts[a]
        out[a:b] = mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64))
        a = b
    return out


def window_hashes(words: np.ndarray, length: int, factor: int = 0xD6E8FEB86659FD93) -> np.ndarray:
    """Hash of each run of ``length`` consecutive words (over row borders too; the caller leaves those out)."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    acc = np.zeros(n, np.uint64)
    for k in range(length):
        acc = acc * np.uint64(factor) + words[k : k + n]
    return mix(acc)
