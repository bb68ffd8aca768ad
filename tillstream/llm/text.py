"""Words and word hashes of many texts at once, on the bytes of an Arrow array.

A word is a run of bytes other than space and 0x09 to 0x0D; A to Z are lowered.
No byte of a longer UTF-8 sequence is one of these, so bytes suffice.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

U = np.uint64
BLOCK_BYTES = 1 << 20
_LEVEL = 1 << 12


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the finaliser of splitmix64)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def odd_constants(n: int, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mixed(np.arange(1, n + 1, dtype=U) * U(0x9E3779B97F4A7C15) + U(seed)) | U(1)


SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256)
LOWER[65:91] += 32
BYTE = odd_constants(256, 11)[LOWER]
RAW_BYTE = odd_constants(256, 11)
PLACE = odd_constants(_LEVEL, 12)
PLACE_HIGH = odd_constants(_LEVEL, 13)


class Words(NamedTuple):
    """`first[d]` to `first[d + 1]` are the words of text d."""

    hashes: np.ndarray
    lengths: np.ndarray
    starts: np.ndarray
    first: np.ndarray


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array and the offsets of its texts; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[pa.Array]:
    """Slices of about `limit` bytes; a longer text is a slice of its own."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    _, at = bytes_of(texts)
    row = 0
    while row < len(texts):
        stop = max(row + 1, int(np.searchsorted(at, at[row] + limit, "right")) - 1)
        yield texts.slice(row, stop - row)
        row = stop


def words_of(texts: pa.Array, lower: bool = True) -> Words:
    data, at = bytes_of(texts)
    inside = ~SPACE[data]
    if not inside.any():
        none = np.zeros(0, np.int64)
        return Words(none.astype(U), none, none, np.zeros(len(at), np.int64))
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside
    before[at[at < len(data)]] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    breaks = np.cumsum(np.concatenate([[0], inside]))
    packed_starts = breaks[starts]
    packed = data[inside]
    lengths = np.diff(np.append(packed_starts, len(packed)))
    place = np.arange(len(packed)) - np.repeat(packed_starts, lengths)
    value = (BYTE if lower else RAW_BYTE)[packed] * PLACE[place & (_LEVEL - 1)]
    if lengths.max() > _LEVEL:
        value = value * PLACE_HIGH[(place >> 12) & (_LEVEL - 1)]
    hashes = mixed(np.add.reduceat(value, packed_starts) + lengths.astype(U))
    return Words(hashes, lengths, starts, np.searchsorted(starts, at))


def runs(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `size` consecutive words, and the word each begins with.

    Runs do not leave their text.
    """
    n = len(words.hashes) - size + 1
    if n <= 0:
        return np.zeros(0, U), np.zeros(0, np.int64)
    factor = odd_constants(size, 100 + size)
    total = np.zeros(n, U)
    for k in range(size):
        total += words.hashes[k : k + n] * factor[k]
    left = np.repeat(words.first[1:], np.diff(words.first))[:n] - np.arange(n)
    at = np.flatnonzero(left >= size)
    return mixed(total[at]), at


def shingle_sets(words: Words, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of every text, one after the other, and their offsets.

    A text with fewer than `size` words has its whole sequence as one shingle; one
    without words has none.
    """
    hashes, at = runs(words, size)
    counts = np.diff(words.first)
    doc = np.repeat(np.arange(len(counts)), counts)[at]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        factor = odd_constants(size, 200)
        whole = np.zeros(len(short), U)
        for k in range(size - 1):
            has = counts[short] > k
            whole[has] += words.hashes[words.first[short[has]] + k] * factor[k]
        hashes = np.concatenate([hashes, mixed(whole + counts[short].astype(U))])
        doc = np.concatenate([doc, short])
    order = np.lexsort((hashes, doc))
    hashes, doc = hashes[order], doc[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    return hashes[new], np.searchsorted(doc[new], np.arange(len(counts) + 1))
