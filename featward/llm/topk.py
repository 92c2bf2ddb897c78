"""Exact top-k inner products: columns of a batch, block by block, with a bound on what is left."""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featward.session import new_scratch

QUERY_BLOCK = 4096  # queries sent to the executors at once
BLOCK_DIMS = 16  # dimensions added up between two looks at the bounds
ROWS = 4096  # candidates held as columns at once; with a block of queries, 128 MB of scores
BLOCKS_AT_ONCE = 16  # query blocks searched in one job
MAX_COMPONENT = 1 << 26  # larger ones take the wide path
LONG = (1 << 63) - 1


def quantised(df: DataFrame, vec_col: str, id_col: str, scale: float) -> DataFrame:
    """``id``, ``dims`` and ``v``, floor(scale * x) of every component x, of the vectors that take part. Those with
    a large component have ``w``, the components themselves, in place of ``v``."""
    value = F.col(vec_col)
    whole = F.coalesce(
        F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))), F.lit(False)
    )
    rows = df.filter(whole & F.col(id_col).isNotNull())
    narrow = F.forall(value, lambda x: F.abs(x.cast("double")) < MAX_COMPONENT / abs(float(scale)))
    return rows.select(
        F.col(id_col).cast("long").alias("id"),
        F.size(value).alias("dims"),
        F.when(narrow, F.transform(value, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))).alias("v"),
        F.when(~narrow, F.transform(value, lambda x: x.cast("double"))).alias("w"),
    )


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims)


def whole_numbers(vector: list[float], scale: float) -> list[int]:
    """floor(scale * x) of components of any size, exact also where the product is beyond a double."""
    scaled = (scale * x for x in vector)
    return [math.floor(y) if math.isfinite(y) else math.floor(Fraction(x) * Fraction(scale)) for x, y in zip(vector, scaled)]


def _doubles(rows: list[list[int]], dims: int) -> np.ndarray:
    def near(n: int) -> float:
        try:
            return float(n)
        except OverflowError:
            return math.inf if n > 0 else -math.inf

    return np.array([[near(n) for n in row] for row in rows], float).reshape(len(rows), dims)


class _WideBest:
    """The k best candidates of each query so far by exact integers of any size."""

    def __init__(self, n: int, k: int) -> None:
        self.k, self.found = k, [[] for _ in range(n)]

    def search(self, at: list[int], q_ids, queries: list[list[int]], ids: list[int], vectors: list[list[int]]) -> None:
        """Look at all pairs of these queries, which have the places ``at``, and candidates. Doubles tell who can be among
        the best, within their error; those are compared by whole numbers."""
        if not queries or not vectors:
            return
        dims = len(vectors[0])
        q, c = _doubles(queries, dims), _doubles(vectors, dims)
        keys = [tuple(v) for v in vectors]
        id_array = np.array(ids, np.int64)
        sizes = np.abs(c)
        for i, place in enumerate(at):
            with np.errstate(all="ignore"):
                near = c @ q[i]
                error = sizes @ np.abs(q[i]) * (dims + 4) * 2.0**-51
                low, high = np.nan_to_num(near - error, nan=-np.inf), near + error
            others = np.flatnonzero(id_array != q_ids[i])
            if len(others) > self.k:
                least = np.partition(low[others], len(others) - self.k)[len(others) - self.k]
                others = others[~(high[others] < least)]
            known: dict[tuple, int] = {}  # copies of a vector are worked out once
            for j in others.tolist():
                if keys[j] not in known:
                    known[keys[j]] = sum(map(int.__mul__, queries[i], keys[j]))
                self.found[place].append((-known[keys[j]], ids[j]))
            self.found[place] = sorted(self.found[place])[: self.k]


def _beyond(score: int) -> bytes | None:
    """For scores beyond 64 bits, bytes that sort as they do."""
    if -LONG - 1 <= score <= LONG:
        return None
    size = (abs(score).bit_length() + 7) // 8
    if score > 0:
        return b"\1" + size.to_bytes(4) + score.to_bytes(size)
    return b"\0" + ((1 << 32) - 1 - size).to_bytes(4) + ((1 << 8 * size) - 1 + score).to_bytes(size)


class _Best:
    """The k best candidates of each query so far: higher score first, then smaller id."""

    def __init__(self, n: int, k: int) -> None:
        self.scores = np.full((n, k), np.iinfo(np.int64).min, np.int64)
        self.ids = np.full((n, k), np.iinfo(np.int64).max, np.int64)
        self.found = np.zeros(n, np.int64)

    def floor(self, q: int) -> float:
        """What a candidate must reach: the k-th best score, or nothing yet."""
        k = self.scores.shape[1]
        return float(self.scores[q, -1]) if self.found[q] >= k else -np.inf

    def add(self, q: int, scores: np.ndarray, ids: np.ndarray) -> None:
        k, have = self.scores.shape[1], min(self.found[q], self.scores.shape[1])
        scores = np.concatenate([self.scores[q, :have], scores])
        ids = np.concatenate([self.ids[q, :have], ids])
        order = np.lexsort((ids, -scores))[:k]
        self.scores[q, : len(order)], self.ids[q, : len(order)] = scores[order], ids[order]
        self.found[q] = len(order)


def _search(q_ids, queries, tails, ids, vectors, best: _Best, order) -> None:
    """Look through one batch of candidates for every query.

    ``vectors`` are laid out by dimension, the queries' heavy dimensions first. After each block of
    dimensions a candidate can gain at most the product of the two norms over those left
    (Cauchy-Schwarz); who cannot reach the k-th best any more goes, ties stay.
    """
    dims = vectors.shape[1]
    exact = np.int64
    if dims * float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0)) < 2**52:
        exact = np.float64  # every sum is a whole number that doubles hold exactly
    columns = np.ascontiguousarray(vectors.T[order].astype(exact))
    rows = np.ascontiguousarray(queries[:, order].astype(exact))
    squares = np.cumsum(columns[::-1].astype(float) ** 2, axis=0)[::-1]
    cuts = [*range(0, max(dims, 1), BLOCK_DIMS), dims]
    left = [np.sqrt(squares[c]) * (1 + 1e-9) + 1e-6 if c < dims else None for c in cuts]
    first = rows[:, : cuts[1]] @ columns[: cuts[1]]
    for q in range(len(rows)):
        score = first[q]
        if cuts[1] < dims:
            live = np.flatnonzero(score + tails[q, 1] * left[1] >= best.floor(q) - 1e-3)
            score = score[live]
        else:
            live = np.arange(len(score))
        for b in range(1, len(cuts) - 1):
            if not len(live):
                break
            lo, hi = cuts[b], cuts[b + 1]
            score = score + rows[q, lo:hi] @ columns[lo:hi, live]
            if hi < dims:
                keep = score + tails[q, b + 1] * left[b + 1][live] >= best.floor(q) - 1e-3
                live, score = live[keep], score[keep]
        mine = ids[live] != q_ids[q]
        live, score = live[mine], score[mine].astype(np.int64)
        take = score >= best.floor(q)
        live, score = live[take], score[take]
        if len(live):
            k = best.scores.shape[1]
            if len(live) > 4 * k:  # only the best k and their ties can matter
                cut = np.partition(score, len(score) - k)[len(score) - k]
                live, score = live[score >= cut], score[score >= cut]
            best.add(q, score, ids[live])


def _block(candidates: DataFrame, rows: list, dims: int, k: int, scale: float):
    """Top k of each query of one block in each partition of candidates, and the broadcast that it needs."""
    narrow, wide = [r for r in rows if r["v"] is not None], [r for r in rows if r["v"] is None]
    q_ids = np.array([r["id"] for r in narrow], np.int64)
    queries = np.array([r["v"] for r in narrow], np.int64).reshape(len(narrow), dims)
    wide_ids, wide_queries = [r["id"] for r in wide], [whole_numbers(r["w"], scale) for r in wide]
    order = np.argsort(-(queries.astype(float) ** 2).sum(0), kind="stable")
    squares = np.cumsum(queries[:, order][:, ::-1].astype(float) ** 2, axis=1)[:, ::-1]
    cuts = [*range(0, dims, BLOCK_DIMS)]
    tails = np.sqrt(squares[:, cuts]) * (1 + 1e-9) + 1e-6
    shared = candidates.sparkSession.sparkContext.broadcast((q_ids, queries, tails, order, wide_ids, wide_queries))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q_ids, queries, tails, order, wide_ids, wide_queries = shared.value
        n, m = len(q_ids), len(wide_ids)
        best, wide_best = _Best(n, k), _WideBest(n + m, k)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                large = part.filter(part.column("v").is_null())
                part = part.filter(part.column("v").is_valid())
                ids, vectors = part.column("id").to_numpy(zero_copy_only=False), _matrix(part.column("v"), dims)
                if n and len(ids):
                    _search(q_ids, queries, tails, ids, vectors, best, order)
                if m and len(ids):  # large queries against all candidates
                    wide_best.search(range(n, n + m), wide_ids, wide_queries, ids.tolist(), vectors.tolist())
                if large.num_rows:  # all queries against large candidates
                    ids = large.column("id").to_pylist()
                    numbers = [whole_numbers(w, scale) for w in large.column("w").to_pylist()]
                    wide_best.search(range(n), q_ids.tolist(), queries.tolist(), ids, numbers)
                    wide_best.search(range(n, n + m), wide_ids, wide_queries, ids, numbers)
        taken = np.arange(k)[None, :] < best.found[:, None]
        owner = np.broadcast_to(q_ids[:, None], taken.shape)
        beyond = pa.nulls(int(taken.sum()), pa.binary())
        names = ["query_id", "vec_id", "score", "beyond"]
        yield pa.RecordBatch.from_arrays(
            [pa.array(owner[taken]), pa.array(best.ids[taken]), pa.array(best.scores[taken]), beyond], names
        )
        owners = [*q_ids.tolist(), *wide_ids]
        rows = [(owner, i, -s) for owner, found in zip(owners, wide_best.found) for s, i in found]
        if rows:
            clipped = [max(-LONG - 1, min(LONG, s)) for *_, s in rows]
            columns = [r[0] for r in rows], [r[1] for r in rows], clipped
            beyond = pa.array([_beyond(s) for *_, s in rows], pa.binary())
            yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns], beyond], names)

    kinds = "query_id long, vec_id long, score long, beyond binary"
    return candidates.filter(F.col("dims") == dims).select("id", "v", "w").mapInArrow(search, kinds), shared


def _blocks(asked: DataFrame, query_block: int) -> list[tuple[int, int, int]]:
    """(dims, first place, last place) of blocks of at most ``query_block`` numbered queries."""
    stretch = F.expr(f"place DIV {query_block}")
    sizes = asked.groupBy("dims", stretch.alias("stretch")).agg(
        F.count("*").alias("n"), F.min("place").alias("first"), F.max("place").alias("last")
    )
    blocks, held = [], 0
    for dims, _, n, first, last in sorted(map(tuple, sizes.collect())):
        if blocks and blocks[-1][0] == dims and held + n <= query_block:
            blocks[-1] = dims, blocks[-1][1], last
            held += n
        else:
            blocks.append((dims, first, last))
            held = n
    return blocks


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    vec_col: str = "embedding",
    id_col: str = "vec_id",
    scale: float = 256.0,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """Each query's k highest integer inner products with the vectors: query_id, rank, vec_id, score.

    Components become floor(scale * x). Every row but one with the query's own id is a candidate;
    ties go to the smaller vec_id, and fewer than k rows come out if there are fewer candidates.
    Vectors and ids that are NULL, and vectors holding NULL or non-finite components, take no part;
    vectors are compared with those of their own length. A vec_id may repeat: each of its rows is a
    candidate, and rows with one id and equal scores keep their places next to each other.

    Vectors with components beyond 2**26 after scaling are compared by whole numbers of any size, which
    takes longer for them and nothing for the rest. A score beyond 64 bits is shown as the nearest
    long; its rank is exact.

    Queries are written with a number and go out in blocks of at most ``query_block``, a few blocks at
    a time: collected, broadcast, searched and released before the next ones. Every block reads the
    vectors once; a task keeps k candidates per query. Those are written to the shared scratch
    folder, and one shuffle by query merges them.
    """
    spark = vectors.sparkSession
    candidates = quantised(vectors, vec_col, id_col, scale)
    asked_path, path = new_scratch(spark, "top-k-queries"), new_scratch(spark, "top-k")
    quantised(queries, vec_col, id_col, scale).withColumn("place", F.monotonically_increasing_id()).write.parquet(asked_path)
    asked = spark.read.parquet(asked_path)
    blocks = _blocks(asked, query_block)
    if not blocks:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    for at in range(0, len(blocks), BLOCKS_AT_ONCE):
        parts = []
        for dims, first, last in blocks[at : at + BLOCKS_AT_ONCE]:
            rows = asked.filter((F.col("dims") == dims) & F.col("place").between(first, last)).collect()
            parts.append(_block(candidates, rows, dims, k, scale))
        reduce(DataFrame.unionAll, [found for found, _ in parts]).write.mode("append").parquet(path)
        for _, shared in parts:
            shared.destroy()
    found = spark.read.parquet(path)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.desc_nulls_last("beyond"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
