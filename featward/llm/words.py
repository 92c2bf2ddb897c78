"""Words, shingles and their 64-bit hashes for whole Arrow batches of texts, in NumPy.

A word hash is a polynomial over random odd values per byte, mixed at the end; it depends on
nothing but the word's bytes. Two given words or shingles share a hash with probability about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
CHUNK_BYTES = 1 << 18  # text worked on at once; a longer text is a chunk of its own
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
ALNUM = np.zeros(256, bool)
ALNUM[[*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1), *range(128, 256)]] = True

_random = np.random.default_rng(20240305)
_BYTE = _random.integers(1, 2**63, 256, dtype=U64) | U64(1)
_BASE = U64(int(_random.integers(1, 2**62)) * 2 + 1)
_PLACE = _random.integers(1, 2**63, 16, dtype=U64) | U64(1)
_power = np.ones(1, U64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the finaliser of SplitMix64)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _powers(n: int) -> np.ndarray:
    global _power
    if len(_power) < n:
        grown = np.full(max(n, 256), _BASE, U64)
        grown[0] = 1
        _power = np.cumprod(grown, dtype=U64)
    return _power


@dataclass
class Texts:
    """Consecutive texts of a batch: their bytes one after the other, and where each begins."""

    first: int  # row of the batch
    data: np.ndarray  # uint8
    offsets: np.ndarray  # int64, one more than there are texts

    def __len__(self) -> int:
        return len(self.offsets) - 1


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Texts]:
    """The column's texts in chunks of at most ``limit`` bytes, NULL as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] else np.zeros(0, np.uint8)
    start = 0
    while start < len(column):
        stop = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        stop = min(max(stop, start + 1), len(column))
        yield Texts(start, data[offsets[start] : offsets[stop]], offsets[start : stop + 1] - offsets[start])
        start = stop


@dataclass
class Words:
    hashes: np.ndarray  # uint64 per word
    offsets: np.ndarray  # text i has the words from offsets[i] up to offsets[i + 1]
    starts: np.ndarray  # first byte of each word
    ends: np.ndarray  # byte after each word

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)


def words_of(texts: Texts, letters: np.ndarray | None = None) -> Words:
    """The words of lower-cased (A-Z) texts: runs of bytes that ``letters`` marks, by default all but
    white space. ``letters`` is a mask over lower-cased bytes."""
    low = LOWER[texts.data]
    inside = (~SPACE if letters is None else letters)[low]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = texts.offsets[:-1][np.diff(texts.offsets) > 0]
    begins[heads] = inside[heads]
    last = inside.copy()
    last[:-1] &= begins[1:] | ~inside[1:]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(last) + 1
    offsets = np.searchsorted(starts, texts.offsets)
    if not len(starts):
        return Words(np.zeros(0, U64), offsets, starts, ends)
    lengths = ends - starts
    place = np.flatnonzero(inside) - np.repeat(starts, lengths)
    terms = _BYTE[low[inside]] * _powers(int(lengths.max()))[place]
    heads = np.zeros(len(starts), np.int64)
    np.cumsum(lengths[:-1], out=heads[1:])
    return Words(mix(np.add.reduceat(terms, heads)), offsets, starts, ends)


def combine(columns: list[np.ndarray]) -> np.ndarray:
    """One hash for each row of word hashes, dependent on their order and number."""
    total = np.full(len(columns[0]), U64(len(columns)), U64)
    for place, column in zip(_PLACE, columns):
        total = total + column * place
    return mix(total)


def shingles_of(words: Words, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``k`` words of each text, and the texts' offsets among them.

    A text with fewer words gives its whole sequence as one; a text without words gives none.
    """
    counts = words.counts
    numbers = np.where(counts >= k, counts - k + 1, (counts > 0).astype(np.int64))
    offsets = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(numbers, out=offsets[1:])
    first = np.arange(offsets[-1]) - np.repeat(offsets[:-1], numbers) + np.repeat(words.offsets[:-1], numbers)
    length = np.repeat(np.minimum(counts, k), numbers)
    out = np.empty(len(first), U64)
    for n in range(1, k + 1):
        at = np.flatnonzero(length == n) if n < k else (length == k)
        start = first[at]
        if len(start):
            out[at] = combine([words.hashes[start + j] for j in range(n)])
    return out, offsets


def distinct_per_text(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's hashes sorted and without repeats, and the new offsets."""
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = np.lexsort((hashes, text)) if len(offsets) > 2 else np.argsort(hashes)
    hashes, text = hashes[order], text[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    hashes, text = hashes[new], text[new]
    return hashes, np.searchsorted(text, np.arange(len(offsets)))


def signed(hashes: np.ndarray) -> pa.Array:
    """Hashes as Spark's signed longs, with the same bits."""
    return pa.array(np.ascontiguousarray(hashes).view(np.int64))
