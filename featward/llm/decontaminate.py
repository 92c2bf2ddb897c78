"""Benchmark decontamination: SimHash of item-sized windows, multi-index lookup, exact verification."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from math import acos, ceil, comb, pi, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featward.llm.words import ALNUM, U64, Texts, chunks, mix, shingles_of, words_of

SHINGLE = 5
SIMILARITY = 0.75
BITS = 128
BLOCKS = 8  # of 16 bits
LOSS = 1e-6  # chance that a pair exactly at the threshold is farther apart than the radius
COUNTED = 512  # shingles up to which the chance of a bit to differ is counted out
ITEM_BLOCK = 20_000  # items in one index
WINDOWS = 512  # windows compared at once
SPAN = 8192  # words at most between the first and the last of them
CELLS = 1 << 19  # windows times buckets compared at once

_SECOND = U64(0x9E3779B97F4A7C15)


def _signs(hashes: np.ndarray) -> np.ndarray:
    """+1 or -1 for each bit of each hash."""
    wide = np.stack([mix(hashes), mix(hashes ^ _SECOND)], axis=1)
    bits = np.unpackbits(wide.view(np.uint8).reshape(-1, BITS // 8), axis=1)
    return bits.astype(np.int8) * 2 - 1


def _fingerprint(sums: np.ndarray) -> np.ndarray:
    """One row of two words for each row of sums."""
    return np.packbits(sums > 0, axis=1).view(U64) if len(sums) else np.zeros((0, 2), U64)


def least_shared(size: int, width: int, threshold: float) -> int:
    """Shingles that a window of ``width`` has to share with an item of ``size``."""
    return ceil(threshold / (1 + threshold) * (size + width) - 1e-9)


def _coins(n: int) -> np.ndarray:
    return np.array([comb(n, k) / 2**n for k in range(n + 1)])


def _bit_differs(shared: int, own: int, other: int) -> float:
    """Chance that a sum of ``shared`` signs and ``own`` more is above zero where that with ``other`` more is not, or
    the other way round."""
    at = 2 * np.arange(shared + 1) - shared

    def above(n: int) -> np.ndarray:
        at_least = np.append(np.cumsum(_coins(n)[::-1])[::-1], 0)
        return at_least[np.clip((n - at) // 2 + 1, 0, n + 1)]

    a, b = above(own), above(other)
    return float(_coins(shared) @ (a * (1 - b) + b * (1 - a)))


@lru_cache(4096)
def radius(size: int, width: int, threshold: float) -> int:
    """Bits in which the fingerprints of such a window and item may differ; -1 if they cannot be similar enough.

    The least number of which two that share just enough differ in more with a chance below LOSS.
    """
    shared = least_shared(size, width, threshold)
    if shared > min(size, width):
        return -1
    if size <= COUNTED:
        share = _bit_differs(shared, size - shared, width - shared)
    else:  # as often as the angle between both is of a half turn
        share = acos(shared / sqrt(size * width)) / pi
    beyond, most = 1.0, -1
    while beyond > LOSS and most < BITS:
        most += 1
        beyond -= comb(BITS, most) * share**most * (1 - share) ** (BITS - most)
    return most


@dataclass
class SizeIndex:
    """The items of one size."""

    items: np.ndarray  # places in the whole index
    prints: np.ndarray  # SimHash of each
    buckets: list[tuple[np.ndarray, np.ndarray]]  # per block: its distinct values, and which of them each item has
    held: np.ndarray  # which of all shingles these items hold, as a mask


@dataclass
class ItemIndex:
    ids: np.ndarray  # item ids
    sizes: np.ndarray  # shingles of each item
    shingles: np.ndarray  # sorted distinct hashes of all items
    counts: list[tuple[np.ndarray, np.ndarray]]  # per item: places in shingles, and their weights
    by_size: dict[int, SizeIndex]
    table: np.ndarray  # which 18-bit ends of hashes occur at all


def build_index(ids: np.ndarray, texts: pa.Array) -> ItemIndex:
    hashes, sizes = [], []
    for part in chunks(texts):
        found, offsets = shingles_of(words_of(part, ALNUM), SHINGLE)
        hashes += np.split(found, offsets[1:-1])
        sizes += list(np.diff(offsets))
    keep = [i for i, n in enumerate(sizes) if n]
    hashes, ids = [hashes[i] for i in keep], ids[keep]
    sizes = np.array([len(h) for h in hashes], np.int64)
    every = np.unique(np.concatenate([*hashes, np.zeros(0, U64)]))
    counts = [np.unique(np.searchsorted(every, h), return_counts=True) for h in hashes]
    by_size = {}
    for size in np.unique(sizes):
        mine = np.flatnonzero(sizes == size)
        mask = np.zeros(len(every), bool)
        for i in mine:
            mask[counts[i][0]] = True
        own = np.concatenate([_fingerprint(_signs(hashes[i]).sum(0, dtype=np.int64)[None]) for i in mine])
        buckets = [np.unique(block, return_inverse=True) for block in _blocks(own).T]
        by_size[int(size)] = SizeIndex(mine, own, buckets, np.packbits(mask))
    table = np.zeros(1 << 18, bool)
    table[(every & U64((1 << 18) - 1)).astype(np.int64)] = True
    return ItemIndex(ids, sizes, every, counts, by_size, table)


def _blocks(prints: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(prints).view(np.uint16).reshape(-1, BLOCKS)


def candidates(index: SizeIndex, prints: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (window, place in ``index.items``) whose fingerprints differ in at most ``most`` bits.

    Of blocks that may differ in t1, t2, … bits, one does not if the (t + 1) add up to more than ``most``. So a bucket of
    items with the same block is opened for the windows that are within the block's t of it, and the whole fingerprints
    of the items in opened buckets are compared.
    """
    windows, places = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for at, touched in _touched(index, prints, most):
        window, place = np.nonzero(touched)
        differ = np.bitwise_count(prints[window + at] ^ index.prints[place])
        near = differ.sum(1, dtype=np.int64) <= most
        windows.append(window[near] + at)
        places.append(place[near])
    return np.concatenate(windows), np.concatenate(places)


def _touched(index: SizeIndex, prints: np.ndarray, most: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first window, windows by items: is the item in a bucket that the window opens?)"""
    step = max(1, CELLS // max(1, len(index.items)))
    each, rest = divmod(most + 1, BLOCKS)
    for at in range(0, len(prints), step):
        part = _blocks(prints[at : at + step])
        touched = np.zeros((len(part), len(index.items)), bool)
        for b, (values, bucket) in enumerate(index.buckets):
            within = each + (b < rest) - 1
            if within >= 0:
                opened = np.bitwise_count(part[:, b, None] ^ values) <= within
                touched |= opened if len(values) == len(bucket) and (np.diff(bucket) > 0).all() else opened[:, bucket]
        yield at, touched


def similarity(index: ItemIndex, item: int, places: np.ndarray, size: int) -> float:
    """Weighted Jaccard of an item with a window of ``size`` shingles, of which ``places`` are known.

    A shingle weighs as often as it occurs.
    """
    own, weight = index.counts[item]
    known, times = np.unique(places, return_counts=True)
    at = np.minimum(np.searchsorted(own, known), len(own) - 1)
    shared = int(np.minimum(weight[at], times)[own[at] == known].sum())
    return shared / (size + int(index.sizes[item]) - shared)


def find_in(
    index: ItemIndex, texts: Texts, threshold: float, every_window: bool = False
) -> Iterator[tuple[int, int, int, int, float]]:
    """(text, item, first word, words, similarity) of the best window of each text and item."""
    words = words_of(texts, ALNUM)
    hashes, offsets = shingles_of(words, SHINGLE)
    at = np.flatnonzero(index.table[(hashes & U64((1 << 18) - 1)).astype(np.int64)])
    if not len(at) or not len(index.ids):
        return
    place = np.minimum(np.searchsorted(index.shingles, hashes[at]), len(index.shingles) - 1)
    same = index.shingles[place] == hashes[at]
    at, place = at[same], place[same]
    for text in np.unique(np.searchsorted(offsets, at, "right") - 1):
        lo, hi = offsets[text], offsets[text + 1]
        mine = (at >= lo) & (at < hi)
        found = _find_in_text(index, hashes[lo:hi], at[mine] - lo, place[mine], threshold, every_window)
        for item, start, size, value in found:
            yield int(text), item, start, min(size + SHINGLE - 1, int(words.counts[text])), value


def _find_in_text(index, hashes, at, place, threshold, every_window):
    """Windows of each item size that hold enough of its items' shingles to reach the threshold at all
    (the others cannot) are fingerprinted and looked up."""
    n = len(hashes)
    best: dict[int, tuple[float, int, int]] = {}
    for size, items in index.by_size.items():
        width = min(size, n)
        need, most = least_shared(size, width, threshold), radius(size, width, threshold)
        if most < 0 or len(at) < need:
            continue
        mask = (items.held[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 > 0
        hit = np.zeros(n + 1, np.int64)
        hit[at[mask] + 1] = 1
        hit = np.cumsum(hit)
        windows = np.flatnonzero(hit[width:] - hit[: n - width + 1] >= need)
        part = 0
        while part < len(windows):
            end = min(part + WINDOWS, int(np.searchsorted(windows, windows[part] + SPAN)))
            starts, part = windows[part:end], end
            if every_window:
                pairs = np.divmod(np.arange(len(starts) * len(items.items)), len(items.items))
            else:
                lo, hi = int(starts[0]), int(starts[-1]) + width
                sums = np.zeros((hi - lo + 1, BITS), np.int32)
                np.cumsum(_signs(hashes[lo:hi]), axis=0, out=sums[1:])
                pairs = candidates(items, _fingerprint(sums[starts + width - lo] - sums[starts - lo]), most)
            for window, item in zip(pairs[0], items.items[pairs[1]]):
                start = int(starts[window])
                i, j = np.searchsorted(at, [start, start + width])
                value = similarity(index, item, place[i:j], width)
                if value >= threshold and value > best.get(item, (0.0,))[0]:
                    best[item] = (value, start, width)
    for item, (value, start, width) in sorted(best.items()):
        yield int(item), start, width, value


MATCH = "struct<item_id:long,first_word:int,n_words:int,similarity:double>"


def match_benchmark(
    df: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    threshold: float = SIMILARITY,
    item_block: int = ITEM_BLOCK,
    into: str = "matches",
    every_window: bool = False,
) -> DataFrame:
    """The frame with an array column ``into``: the benchmark items that a text holds, or nearly.

    Of each item: item_id, ``first_word`` (from 0), ``n_words`` and ``similarity`` of the text's best
    window, of equals the first. Words are lower-cased runs of letters and digits, so punctuation
    and line ends do not matter. A window has as many words as the item (or is the whole text, if
    that is shorter); similarity is the weighted Jaccard of five-word shingles, each weighing as
    often as it occurs.

    Windows of every item size and at every word are considered. Those with too few of the items'
    shingles to reach ``threshold`` are left out by counting, which loses none; the rest get a
    128-bit SimHash, and eight blocks of it open the buckets of items of that size that hold every item within
    the radius, which follows from the size and ``threshold``. The exact similarity then decides. Of pairs exactly at the
    threshold about one in a million is farther apart, or more where a window repeats one shingle many times; above it
    far fewer. ``every_window`` verifies all counted windows against all
    items of their size instead, slowly: nothing is lost, so the difference is the loss.

    Items are indexed in blocks of ``item_block``, each one broadcast; every executor holds all of them, some
    200 bytes per word of the benchmark, so a benchmark has to fit in a worker.
    Row by row, no shuffle. NULL, empty and word-less texts and items match nothing; a text or item of
    fewer than five words is one shingle and only matches one of the same words. Repeated items are
    each listed, one with a NULL id too. A column called ``into`` is replaced.
    """
    items = benchmark.select(F.col(item_id_col).cast("long").alias("id"), F.col(item_text_col).alias("text"))
    blocks = max(1, -(-items.count() // (item_block * 3 // 4)))
    found = []
    for b in range(blocks):
        mine = items if blocks == 1 else items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b)
        found.append(_matcher(df.sparkSession, mine, threshold, every_window)(F.col(text_col)))
    return df.withColumn(into, found[0] if blocks == 1 else F.concat(*found))


def _matcher(spark: SparkSession, items: DataFrame, threshold: float, every_window: bool):
    rows = items.toArrow()
    ids = np.array(rows.column("id").to_pylist(), object)
    shared = spark.sparkContext.broadcast(build_index(ids, rows.column("text").combine_chunks()))

    @F.arrow_udf(f"array<{MATCH}>")
    def match(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index = shared.value
        kind = pa.struct(
            [("item_id", pa.int64()), ("first_word", pa.int32()), ("n_words", pa.int32()), ("similarity", pa.float64())]
        )
        for column in columns:
            out: list[list[tuple]] = [[] for _ in range(len(column))]
            for texts in chunks(column):
                for text, item, *where in find_in(index, texts, threshold, every_window):
                    out[texts.first + text].append(dict(zip(kind.names, (index.ids[item], *where))))
            yield pa.array(out, pa.list_(kind))

    return match


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """One row per document row and benchmark item that it holds: id and the fields of
    :func:`match_benchmark`, which takes ``options``. Repeated documents each get their rows, those with
    a NULL id too."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = match_benchmark(texts, benchmark, "text", **options)
    return found.select(F.col("id").alias(id_col), F.inline("matches"))
