"""Byte-level BPE: ids of a text under a rank table, and the text of ids.

A pre-token's pairs wait in a queue of one bucket per merge rank. A bitmap over the ranks, and a bitmap over
its words, say which buckets hold something, so the next rank is two find-first-sets away however
long the pre-token is. Buckets hold positions of a linked list of parts; a position whose pair has
changed since is stale and skipped when it comes up.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featward.llm.workers import give_back

MEMO_ENTRIES = 500_000  # pre-tokens remembered per worker, in each of two generations
MEMO_CHARS = 48  # longer ones are encoded anew each time
FOUND = "__bpe_found"  # a column only while the operator builds its frame
NODE_BITS = 8  # a bitmap node covers 2**8 ranks
NODE_MASK = (1 << NODE_BITS) - 1


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one pre-token: the pair of the lowest rank is merged first, of equals the leftmost.

    The queue's steps stand in line, as a call for each would take half the time.
    """
    get = ranks.get
    whole = get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    end = list(range(1, n + 1))  # of the part that begins at a position; 0 once it is merged away
    before = list(range(-1, n))  # where the part before begins; at n the last part
    pair = [get(piece[i : i + 2]) for i in range(n - 1)]  # rank of a part with the next one
    pair.append(None)
    buckets: dict[int, list[int]] = {}  # rank to positions
    words: dict[int, int] = {}  # node to the bits of its ranks that have a bucket
    summary = 0  # bits of the nodes that have any
    for i, rank in enumerate(pair):
        if rank is not None:
            if rank in buckets:
                buckets[rank].append(i)  # in order, so a heap
            else:
                buckets[rank] = [i]
                node = rank >> NODE_BITS
                words[node] = words.get(node, 0) | 1 << (rank & NODE_MASK)
                summary |= 1 << node
    while summary:
        node = (summary & -summary).bit_length() - 1
        word = words[node]
        rank = (node << NODE_BITS) + (word & -word).bit_length() - 1
        bucket = buckets[rank]
        i = heappop(bucket)
        if not bucket:
            del buckets[rank]
            words[node] = word = word & (word - 1)
            if not word:
                summary &= summary - 1
        if pair[i] != rank or not end[i]:
            continue  # stale
        gone = end[i]
        stop = end[i] = end[gone]
        end[gone] = 0
        before[stop] = i
        left = before[i]
        pair[i] = get(piece[i : end[stop]]) if stop < n else None
        if left >= 0:
            pair[left] = get(piece[left:stop])
            changed = (left, i)
        else:
            changed = (i,)
        for at in changed:
            rank = pair[at]
            if rank is not None:
                if rank in buckets:
                    heappush(buckets[rank], at)
                else:
                    buckets[rank] = [at]
                    node = rank >> NODE_BITS
                    words[node] = words.get(node, 0) | 1 << (rank & NODE_MASK)
                    summary |= 1 << node
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : end[i]]])
        i = end[i]
    return ids


class _Memo(dict):
    """Pre-token to packed ids. When full, it becomes the older generation, which what is used again
    is taken over from; so its memory is bounded and frequent pre-tokens stay."""

    def __init__(self, ranks: dict[bytes, int], entries: int) -> None:
        self.ranks, self.entries, self.older = ranks, entries, {}

    def __missing__(self, piece: str) -> bytes:
        packed = self.older.get(piece)
        if packed is None:
            ids = merge(piece.encode(), self.ranks)
            packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= MEMO_CHARS:
            if len(self) >= self.entries:
                self.older = dict(self)
                self.clear()
            self[piece] = packed
        return packed


class Codec:
    """A rank table and the pattern that splits text before its merges."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, memo_entries: int = MEMO_ENTRIES) -> None:
        self.ranks, self.split = ranks, regex.compile(pattern).findall
        self.memo = _Memo(ranks, memo_entries)
        self.token = {rank: token for token, rank in ranks.items()}

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.memo.__getitem__, self.split(text)))

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, np.frombuffer(packed, "<u4").tolist()))


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: per line a token in base64 and its rank."""
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        return {base64.b64decode(token): int(rank) for token, rank in pairs}


_codecs: dict[tuple[str, str, int], Codec] = {}


def _codec(file: str, pattern: str, memo_entries: int = MEMO_ENTRIES) -> Codec:
    key = file, pattern, memo_entries
    if key not in _codecs:  # once per worker, which keeps its memo from task to task
        _codecs[key] = Codec(read_ranks(SparkFiles.get(file)), pattern, memo_entries)
    return _codecs[key]


def _shared(spark: SparkSession, path: str) -> str:
    """Give the executors the rank file; returns its name there. It is some hundred kilobytes."""
    spark.sparkContext.addFile(path)
    return path.replace("\\", "/").rpartition("/")[2]


def encode_bpe(
    df: DataFrame,
    ranks_path: str,
    pattern: str,
    text_col: str = "text",
    ids_col: str = "ids",
    decoded_col: str | None = None,
    memo_entries: int = MEMO_ENTRIES,
) -> DataFrame:
    """The frame with ``ids_col``: the text's ids, packed as little-endian unsigned 32-bit integers.

    Each match of ``pattern`` is encoded separately, without special tokens. NULL and empty text
    give empty bytes. ``decoded_col`` also gives the bytes that the ids decode to, as
    :func:`decode_bpe` does, by the same worker and in the same pass. Row by row, no shuffle; the
    memory of a task is the batch, the rank table and a memo of up to twice ``memo_entries``
    pre-tokens (about 200 bytes each), which only changes the speed. :func:`unpack_ids` gives an
    array in place of bytes. Columns with these names are replaced. A byte that the table has no
    rank for is an error.
    """
    file = _shared(df.sparkSession, ranks_path)
    fields = ["ids", "decoded"] if decoded_col else ["ids"]

    @F.arrow_udf(f"struct<{','.join(f'{f}:binary' for f in fields)}>")
    def encode(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        give_back()
        codec = _codec(file, pattern, memo_entries)
        for texts in columns:
            ids = pa.array((codec.encode(t.as_py() or "") for t in texts), pa.binary(), size=len(texts))
            found = [ids]
            if decoded_col:
                found.append(pa.array((codec.decode(i.as_py()) for i in ids), pa.binary(), size=len(ids)))
            yield pa.StructArray.from_arrays(found, fields)

    names = dict(zip(fields, (ids_col, decoded_col)))
    rows = df.drop(*names.values()).withColumn(FOUND, encode(F.col(text_col)))
    return rows.select("*", *[F.col(f"{FOUND}.{f}").alias(n) for f, n in names.items()]).drop(FOUND)


def decode_bpe(df: DataFrame, ranks_path: str, pattern: str, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """The frame with ``bytes_col``: the bytes that the packed ids stand for; NULL gives empty bytes.

    They need not be valid UTF-8 if the ids were cut. An id that the table lacks is an error. A
    column called ``bytes_col`` is replaced.
    """
    file = _shared(df.sparkSession, ranks_path)

    @F.arrow_udf("binary")
    def decode(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(file, pattern)
        for packed in columns:
            yield pa.array((codec.decode(p.as_py() or b"") for p in packed), pa.binary(), size=len(packed))

    return df.withColumn(bytes_col, decode(F.col(ids_col)))


def unpack_ids(df: DataFrame, ids_col: str = "ids") -> DataFrame:
    """The packed ids as an array of longs."""

    @F.arrow_udf("array<long>")
    def unpack(packed: pa.Array) -> pa.Array:
        rows = [np.frombuffer(p.as_py() or b"", "<u4").astype(np.int64) for p in packed]
        return pa.array(rows, pa.list_(pa.int64()), size=len(packed))

    return df.withColumn(ids_col, unpack(F.col(ids_col)))
