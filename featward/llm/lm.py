"""Interpolated modified Kneser-Ney bigram model: counted by Spark, kept as sorted hash arrays."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featward.llm.arrays import map_arrays, save_arrays
from featward.llm.components import written
from featward.llm.packing import buckets_of, by_bucket, dealt, pack, pack_sorted, unpack, unpack_sorted
from featward.llm.words import CHUNK_BYTES, U64, Texts, chunks, combine, words_of
from featward.session import new_scratch

BEGIN, END = U64(0x9AE16A3B2F90404F), U64(0xC949D7C7509E6557)  # before the first word, after the last
FLUSH = 4_000_000  # tokens a task counts before it hands the counts on
MOST_MAPPED = 1 << 15  # files a worker keeps mapped: Linux allows a process 65,530 mappings
COLUMNS = ("context", "n1", "n2", "n3", "before", "times")  # of a word, see _word_counts


@dataclass(frozen=True)
class KneserNey:
    path: str  # folder of the arrays
    buckets: int
    tokens: int  # N
    distinct: int  # V
    bigrams: int  # different ones
    by_count: tuple[float, float, float]  # discounts of bigrams seen once, twice, more often
    by_before: tuple[float, float, float]  # of words with one, two, more different words before them
    spare: float  # share of the lowest order that is spread evenly over V + 1 words


def tokens_of(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each token's hash, the hash of what stands before it, and the texts' offsets among them."""
    words = words_of(texts)
    token = np.insert(words.hashes, words.offsets[1:], END)
    before = np.insert(words.hashes, words.offsets[:-1], BEGIN)
    return before, token, words.offsets + np.arange(len(words.offsets))


def _bucket(before: np.ndarray, token: np.ndarray, buckets: int) -> np.ndarray:
    """A bigram's bucket: by its first word, and for every twelve buckets spread once more by its second,
    so that no word, however frequent, fills one bucket."""
    spread = max(1, buckets // 12)
    step = buckets // spread
    first = (before >> U64(32)) % U64(buckets) + (token >> U64(32)) % U64(spread) * U64(step)
    return (first % U64(buckets)).astype(np.min_scalar_type(buckets))


def _range(words: np.ndarray, buckets: int) -> np.ndarray:
    return ((words >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64)


def _added(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, and the sums of their values."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], *(np.add.reduceat(v[order], first) if len(first) else v for v in values)


def _order(*columns: np.ndarray) -> np.ndarray:
    """Places in rising order by the last column, then by the one before it, as np.lexsort has them but for the order
    of equal rows, in about half the time; 16-bit columns are sorted by radix."""
    order = np.argsort(columns[0])
    for column in columns[1:]:
        order = order[np.argsort(column[order], kind="stable")]
    return order


def _fitting(counts: np.ndarray) -> np.ndarray:
    """Counts with bytes enough for the largest."""
    return counts.astype("<u4" if counts.max(initial=0) < 1 << 32 else "<u8")


def _count(df: DataFrame, buckets: int) -> DataFrame:
    """Packed bigram counts: one row per task, flush and bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush():
            before, token = (np.concatenate(c) for c in zip(*held))
            bucket = _bucket(before, token, buckets)
            order = _order(token, before, bucket)
            before, token, bucket = before[order], token[order], bucket[order]
            new = np.ones(len(order), bool)
            new[1:] = (before[1:] != before[:-1]) | (token[1:] != token[:-1])
            at = np.flatnonzero(new)
            times = np.diff(at, append=len(order))
            before, token, bucket = before[at], token[at], bucket[at]
            cuts = np.searchsorted(bucket, np.arange(buckets + 1))
            rows = []
            for b, (i, j) in enumerate(zip(cuts[:-1], cuts[1:])):
                if j > i:
                    heads = np.flatnonzero(np.concatenate([[True], before[i + 1 : j] != before[i : j - 1]]))
                    runs = np.diff(heads, append=j - i)
                    words = pack_sorted(before[i:j][heads])
                    rows.append((b, words, pack(runs), token[i:j].tobytes(), pack(times[i:j])))
            kinds = [pa.int32(), *[pa.binary()] * 4]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            return pa.RecordBatch.from_arrays(columns, ["bucket", "before", "runs", "tokens", "times"])

        for batch in batches:
            for texts in chunks(batch.column("text")):
                before, token, _ = tokens_of(texts)
                held.append((before, token))
                size += len(token)
                if size >= FLUSH:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    kinds = "bucket int, before binary, runs binary, tokens binary, times binary"
    return dealt(df.mapInArrow(count, kinds), buckets)


def _word_counts(counted: DataFrame, path: str, buckets: int) -> DataFrame:
    """Write each bucket's bigrams, and give packed counts per word for the buckets of words.

    Per word: ``context``, how often it stands before a token; ``n1``, ``n2``, ``n3``, how many
    different tokens follow it once, twice, more often; ``before``, how many different words stand
    before it; ``times``, how often it occurs as a token. Rows with bucket -1 hold how many bigrams
    are seen once to four times, and their number.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, found in by_bucket(batches):
            before = np.concatenate([np.repeat(unpack_sorted(r["before"]), unpack(r["runs"])) for r in found])
            token = np.concatenate([np.frombuffer(r["tokens"], U64) for r in found])
            times = np.concatenate([unpack(r["times"]).astype(np.int64) for r in found])
            order = _order(token, before)
            before, token, times = before[order], token[order], times[order]
            new = np.ones(len(order), bool)
            new[1:] = (before[1:] != before[:-1]) | (token[1:] != token[:-1])
            at = np.flatnonzero(new)
            before, token, times = before[at], token[at], np.add.reduceat(times, at)
            keys = combine([before, token])
            order = np.argsort(keys)
            once = times[order] == 1
            save_arrays(
                f"{path}/bigrams-{bucket}",
                {"once": keys[order][once], "often": keys[order][~once], "times": _fitting(times[order][~once])},
            )
            zero = np.zeros(len(times), np.int64)
            grades = [(times == 1).astype(np.int64), (times == 2).astype(np.int64), (times > 2).astype(np.int64)]
            by_context = _added(before, times, *grades)
            by_token = _added(token, zero + 1, times)
            words = np.concatenate([by_context[0], by_token[0]])
            left, right = np.zeros(len(by_context[0]), np.int64), np.zeros(len(by_token[0]), np.int64)
            columns = [np.concatenate([c, right]) for c in by_context[1:]]
            columns += [np.concatenate([left, c]) for c in by_token[1:]]
            words, *columns = _added(words, *columns)
            cuts = np.searchsorted(_range(words, buckets), np.arange(buckets + 1))
            rows = [
                (b, pack_sorted(words[i:j]), *[pack(c[i:j]) for c in columns])
                for b, (i, j) in enumerate(zip(cuts[:-1], cuts[1:]))
                if j > i
            ]
            seen = np.array([(times == k).sum() for k in (1, 2, 3, 4)] + [len(times)], np.int64)
            rows.append((-1, pack(seen), *[b""] * 6))
            kinds = [pa.int32(), *[pa.binary()] * 7]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["bucket", "words", *COLUMNS]
            )

    kinds = ", ".join(["bucket int, words binary", *[f"{c} binary" for c in COLUMNS]])
    return counted.mapInArrow(add, kinds)


def _discounts(counts) -> tuple[float, float, float]:
    """The three discounts from how many things are counted once to four times (Chen and Goodman)."""
    n = [float(c) for c in counts[:4]]
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
    found = [k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else 0.5 * k for k in (1, 2, 3)]
    return tuple(min(max(d, 0.1), k - 0.1) for d, k in zip(found, (1, 2, 3)))


def fit_kneser_ney(df: DataFrame, text_col: str = "text") -> KneserNey:
    """Count the bigrams of all rows and write the model to the shared scratch folder.

    Words are runs without white space, A-Z lower-cased; each text ends with an end token, also a
    NULL or empty one. Each task adds up its own bigrams before they are shuffled, as packed bytes,
    to buckets that no single word or bigram can fill, as many as there is text for; a task holds one at a time. Buckets write their bigrams as sorted 64-bit
    hashes, those seen once apart from the others with their counts, and hand on counts per word,
    which are written likewise. The driver gets five numbers per bucket.
    """
    path = new_scratch(df.sparkSession, "kneser-ney")
    texts = df.select(F.col(text_col).alias("text"))
    buckets = buckets_of(texts)
    counted = written(_word_counts(_count(texts, buckets), path, buckets), "word-counts")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, found in by_bucket(batches):
            words = np.concatenate([unpack_sorted(r["words"]) for r in found])
            columns = [np.concatenate([unpack(r[c]).astype(np.int64) for r in found]) for c in COLUMNS]
            words, *columns = _added(words, *columns)
            named = dict(zip(COLUMNS, columns))
            save_arrays(f"{path}/words-{bucket}", {"words": words, **{c: _fitting(v) for c, v in named.items()}})
            before = named["before"]
            seen = [(before == k).sum() for k in (1, 2, 3, 4)]
            row = [*seen, (before > 2).sum(), (before > 0).sum(), named["times"].sum(), before.sum()]
            yield pa.RecordBatch.from_arrays([pa.array([int(v)]) for v in row], [f"v{i}" for i in range(8)])

    totals = written(
        dealt(counted.filter("bucket >= 0"), buckets).mapInArrow(add, ", ".join(f"v{i} long" for i in range(8))),
        "word-totals",
    )
    sums = [r or 0 for r in totals.agg(*[F.sum(f"v{i}") for i in range(8)]).first()]
    bigrams = [unpack(r["words"]).astype(np.int64) for r in counted.filter("bucket < 0").select("words").collect()]
    seen = np.sum(bigrams, axis=0) if bigrams else np.zeros(5, np.int64)
    by_before = _discounts(sums)
    t1, t2, more, total = sums[0], sums[1], sums[4], sums[7]
    spare = (by_before[0] * t1 + by_before[1] * t2 + by_before[2] * more) / total if total else 1.0
    return KneserNey(path, buckets, int(sums[6]), int(sums[5]), int(seen[4]), _discounts(seen), by_before, spare)


_mapped: dict[str, dict[str, np.ndarray]] = {}


def _arrays(model: KneserNey, name: str) -> dict[str, np.ndarray]:
    key = f"{model.path}/{name}"
    if key in _mapped:
        return _mapped[key]
    if len(_mapped) and next(iter(_mapped)).rpartition("/")[0] != model.path:
        _mapped.clear()  # another model's
    found = map_arrays(key)
    if len(_mapped) < MOST_MAPPED:  # files are looked into in turn, so one that is let go would be the next to be mapped
        _mapped[key] = found
    return found


def _look_up(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sorted keys: their places, and whether they are there."""
    place = np.minimum(np.searchsorted(sorted_keys, keys), max(len(sorted_keys) - 1, 0))
    return place, sorted_keys[place] == keys if len(sorted_keys) else np.zeros(len(keys), bool)


def _of_words(model: KneserNey, words: np.ndarray) -> dict[str, np.ndarray]:
    """COLUMNS for sorted distinct words, 0 where the model lacks one."""
    out = {c: np.zeros(len(words)) for c in COLUMNS}
    cuts = np.searchsorted(_range(words, model.buckets), np.arange(model.buckets + 1))
    for b in np.flatnonzero(np.diff(cuts)):
        part = _arrays(model, f"words-{b}")
        if part:
            place, there = _look_up(part["words"], words[cuts[b] : cuts[b + 1]])
            at = cuts[b] + np.flatnonzero(there)
            for c in COLUMNS:
                out[c][at] = part[c][place[there]]
    return out


def _of_bigrams(model: KneserNey, before: np.ndarray, token: np.ndarray) -> np.ndarray:
    """How often the model has seen each bigram."""
    bucket, keys = _bucket(before, token, model.buckets), combine([before, token])
    order = _order(keys, bucket)
    keys = keys[order]
    cuts = np.searchsorted(bucket[order], np.arange(model.buckets + 1))
    times = np.zeros(len(keys))
    for b in np.flatnonzero(np.diff(cuts)):
        part = _arrays(model, f"bigrams-{b}")
        if part:
            mine = slice(cuts[b], cuts[b + 1])
            place, there = _look_up(part["often"], keys[mine])
            found = times[mine]
            found[there] = part["times"][place[there]]
            found[_look_up(part["once"], keys[mine])[1]] = 1
    out = np.empty(len(keys))
    out[order] = times
    return out


def _discount(counts: np.ndarray, discounts: tuple[float, float, float]) -> np.ndarray:
    return np.array([0.0, *discounts])[np.minimum(counts, 3).astype(np.int64)]


def log_probabilities(model: KneserNey, before: np.ndarray, token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """log10 of each token's probability after its predecessor, and how often the token was seen."""
    words, where = np.unique(np.concatenate([before, token]), return_inverse=True)
    left, right = where[: len(before)], where[len(before) :]
    of = _of_words(model, words)
    total = max(model.bigrams, 1)
    lowest = (of["before"] - _discount(of["before"], model.by_before)) / total + model.spare / (model.distinct + 1)
    kept = sum(d * of[n] for d, n in zip(model.by_count, ("n1", "n2", "n3")))
    seen = of["context"] > 0
    kept = np.where(seen, kept / np.maximum(of["context"], 1), 1.0)
    times = _of_bigrams(model, before, token)
    high = (times - _discount(times, model.by_count)) / np.maximum(of["context"], 1)[left]
    return np.log10(high + kept[left] * lowest[right]), of["times"][right]


def score_kneser_ney(df: DataFrame, model: KneserNey, text_col: str = "text", into: str = "lm") -> DataFrame:
    """The frame with a struct ``into``: n_tokens, n_known, base_score, score.

    ``score``: the model's log10 probability of the text, end token included; 10 ** (-score /
    n_tokens) is its perplexity. ``base_score``: that of the unigram model with one added to each
    count. ``n_known``: tokens seen in training. NULL and empty text have the end token alone. Row
    by row, no shuffle: workers map the model's files and look up what a text has, sorted. What is
    mapped grows with the distinct bigrams trained on (about 9 bytes each), on every node; memory
    does not. A column called ``into`` is replaced.
    """

    @F.arrow_udf("struct<n_tokens:long,n_known:long,base_score:double,score:double>")
    def score(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        base_total = model.tokens + model.distinct + 1
        for column in columns:
            parts = []
            # the more files there are to look into, the more text is looked up at once
            for texts in chunks(column, CHUNK_BYTES * min(16, 1 + model.buckets // 256)):
                before, token, offsets = tokens_of(texts)
                value, times = log_probabilities(model, before, token)
                base = np.log10((times + 1) / base_total)
                heads = offsets[:-1]
                sums = [np.add.reduceat(v, heads) for v in ((times > 0).astype(np.int64), base, value)]
                parts.append((np.diff(offsets), *sums))
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64()]
            names = ["n_tokens", "n_known", "base_score", "score"]
            columns_ = [np.concatenate(c) for c in zip(*parts)] or [[]] * 4
            yield pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns_, kinds)], names)

    return df.withColumn(into, score(F.col(text_col)))
