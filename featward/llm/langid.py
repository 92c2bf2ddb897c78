"""Language proportions of documents: mixtures of character 3-gram models, fitted by EM."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featward.llm.words import LOWER, Texts, chunks

BUCKETS = 1 << 13  # hashed 3-grams
SMOOTHING = 0.5  # added to each bucket's count
ROUNDS = 12  # of EM
DOCS = 128  # documents fitted side by side
PENALTY = 1.0  # times half the logarithm of the number of 3-grams, per language beyond the first
MAX_LANGUAGES = 512
FOUND = "__languages_found"  # a column only while the operator builds its frame

_LETTER = np.full(256, 0x20, np.uint8)
_LETTER[ord("a") : ord("z") + 1] = LOWER[ord("a") : ord("z") + 1]
_LETTER[128:] = np.arange(128, 256)


@dataclass
class LanguageModel:
    languages: list[str]  # in order of their names
    grams: np.ndarray  # float32, probability of each bucket per language


def _grams(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the 3-grams around each letter byte, and the texts' offsets among them.

    Bytes but letters count as a space, as do both ends of a text.
    """
    padded = np.full(len(texts.data) + 2, 0x20, np.uint32)
    padded[1:-1] = _LETTER[LOWER[texts.data]]
    middle, before, after = padded[1:-1], padded[:-2].copy(), padded[2:].copy()
    inner = texts.offsets[1:-1]
    before[inner[inner < len(before)]] = 0x20
    after[inner[inner > 0] - 1] = 0x20
    at = np.flatnonzero(middle != 0x20)
    codes = before[at] << np.uint32(16) | middle[at] << np.uint32(8) | after[at]
    codes = (codes * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKETS.bit_length() + 1)
    return codes.astype(np.int64), np.searchsorted(at, texts.offsets)


def fit_languages(df: DataFrame, text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """3-gram counts per language over all rows with a language, added up per task and then by Spark.

    The counts collected are the model: languages times 8192. More than 512 languages are an error.
    A NULL or empty text counts nothing; a language without any letter is still one.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            languages = batch.column("lang").to_pylist()
            for texts in chunks(batch.column("text")):
                codes, offsets = _grams(texts)
                names = languages[texts.first : texts.first + len(texts)]
                distinct = {name: i for i, name in enumerate(dict.fromkeys(names))}
                if len(distinct) + len(totals) > 4 * MAX_LANGUAGES:
                    raise ValueError(f"more than {MAX_LANGUAGES} languages")
                which = np.repeat([distinct[name] for name in names], np.diff(offsets))
                counts = np.bincount(which * BUCKETS + codes, minlength=len(distinct) * BUCKETS)
                for name, i in distinct.items():
                    row = counts[i * BUCKETS : (i + 1) * BUCKETS]
                    totals[name] = totals[name] + row if name in totals else row
        for name, row in totals.items():
            at = np.flatnonzero(row) if row.any() else np.array([0])
            columns = [pa.array([name] * len(at)), pa.array(at), pa.array(row[at])]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "bucket", "n"])

    rows = df.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    counted = (
        rows.filter(F.col("lang").isNotNull())
        .mapInArrow(count, "lang string, bucket long, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
    )
    found = counted.toArrow().to_pydict()
    languages = sorted(set(found["lang"]))
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    place = {name: i for i, name in enumerate(languages)}
    counts = np.full((len(languages), BUCKETS), SMOOTHING)
    if languages:
        np.add.at(counts, ([place[name] for name in found["lang"]], found["bucket"]), found["n"])
    return LanguageModel(languages, (counts / counts.sum(1, keepdims=True)).astype(np.float32))


def _em(counts: np.ndarray, grams: np.ndarray, shares: np.ndarray, rounds: int) -> np.ndarray:
    """Shares of the languages in each document that make its 3-grams likelier, round by round."""
    total = np.maximum(counts.sum(1, keepdims=True), 1)
    for _ in range(rounds):
        shares = shares * ((counts / np.maximum(shares @ grams, 1e-30)) @ grams.T) / total
    return shares


def _loglik(counts: np.ndarray, grams: np.ndarray, shares: np.ndarray) -> np.ndarray:
    return (counts * np.log(np.maximum(shares @ grams, 1e-30))).sum(1, dtype=np.float64)


def _most(counts: np.ndarray, grams: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """A log-likelihood that no mixture of the languages exceeds: as it is concave in the shares, the steepest
    slope at ``shares`` bounds what is left to gain."""
    total = np.maximum(counts.sum(1, dtype=np.float64), 1)
    slope = ((counts / np.maximum(shares @ grams, 1e-30)) @ grams.T).max(1) / total
    return _loglik(counts, grams, shares) + total * (np.log(np.maximum(slope, 1)) + 1e-5)


def mixture(counts: np.ndarray, model: LanguageModel, penalty: float, max_set: int | None = None):
    """For each row of 3-gram counts: shares under all languages, and shares of the chosen set.

    Candidate sets are the one, two, … likeliest languages of the full fit, up to all of them or
    ``max_set``; the set of the highest penalised likelihood is chosen, of equals the smallest. A row
    is done as soon as no larger set can reach the likelihood it has.
    """
    languages = len(model.languages)
    start = np.full((len(counts), languages), 1 / languages, np.float32)
    full = _em(counts, model.grams, start, ROUNDS)
    order = np.argsort(-full, axis=1, kind="stable")
    each = penalty * 0.5 * np.log(np.maximum(counts.sum(1, dtype=np.float64), 1))  # per further language
    most = _most(counts, model.grams, full)
    best, chosen = np.full(len(counts), -np.inf), np.zeros_like(full)
    rows = np.arange(len(counts))
    for size in range(1, min(max_set or languages, languages) + 1):
        rows = rows[most[rows] - each[rows] * (size - 1) > best[rows]] if penalty >= 0 else rows
        if not len(rows):
            break
        mine = counts[rows]
        inside = np.zeros((len(rows), languages), np.float32)
        np.put_along_axis(inside, order[rows, :size], np.float32(1 / size), axis=1)
        shares = inside if size == 1 else _em(mine, model.grams, inside, ROUNDS // 2)
        value = _loglik(mine, model.grams, shares) - each[rows] * (size - 1)
        better = value > best[rows]
        best[rows[better]], chosen[rows[better]] = value[better], shares[better]
    return full, chosen


def unknown_share(counts: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """For each row of 3-gram counts: the share of a background in which all buckets are equally likely,
    fitted beside all languages. ``grams`` may hold the counted buckets only."""
    background = np.full((1, grams.shape[1]), 1 / BUCKETS, np.float32)
    every = np.vstack([grams, background])
    start = np.full((len(counts), len(every)), 1 / len(every), np.float32)
    return _em(counts, every, start, ROUNDS)[:, -1]


def identify_languages(
    df: DataFrame,
    model: LanguageModel,
    text_col: str = "text",
    penalty: float = PENALTY,
    max_set: int | None = None,
    unknown_col: str | None = None,
) -> DataFrame:
    """The frame with ``lang_pred``, ``score`` and ``languages``.

    ``languages``: the document's set of languages with their shares, largest first, chosen by
    penalised likelihood among mixtures of up to all languages, or ``max_set``. ``lang_pred`` is the first
    (of equal shares the smaller name), ``score`` its share when all languages of the model take
    part, from 0 to 1. A text that is NULL, or has no letter, or any text if the model has no
    language: ``und``, 0 and an empty array. Row by row, no shuffle; the model is languages times 32
    kilobytes. Columns of the frame with these names are replaced.

    ``unknown_col``, if given, is one more column: how much of the text is in none of the languages, from
    0 to 1 (:func:`unknown_share`); 1 where ``lang_pred`` is ``und``. The others do not depend on it.
    """
    names = model.languages
    shared = df.sparkSession.sparkContext.broadcast(model)
    kind_of = "array<struct<lang:string,share:double>>"
    kind = f"struct<lang_pred:string,score:double,languages:{kind_of},unknown:double>"

    def fit(texts: Texts, model: LanguageModel) -> Iterator[dict]:
        codes, offsets = _grams(texts)
        for at in range(0, len(texts), DOCS):
            upto = min(at + DOCS, len(texts))
            part = codes[offsets[at] : offsets[upto]]
            doc = np.repeat(np.arange(upto - at), np.diff(offsets[at : upto + 1]))
            counts = np.bincount(doc * BUCKETS + part, minlength=(upto - at) * BUCKETS)
            counts = counts.reshape(upto - at, BUCKETS).astype(np.float32)
            used = np.flatnonzero(counts.any(0))  # buckets without a count add nothing
            small = LanguageModel(names, np.ascontiguousarray(model.grams[:, used]))
            full, chosen = mixture(np.ascontiguousarray(counts[:, used]), small, penalty, max_set)
            unknown = unknown_share(counts[:, used], small.grams) if unknown_col else np.zeros(len(counts))
            for every, some, none in zip(full, chosen, unknown):
                order = np.argsort(-some, kind="stable")
                first = int(order[0])
                yield {
                    "lang_pred": names[first],
                    "score": min(max(float(every[first]), 0.0), 1.0),
                    "languages": [
                        {"lang": names[i], "share": float(some[i])} for i in order if some[i] > 1e-4
                    ],
                    "unknown": min(max(float(none), 0.0), 1.0),
                }

    @F.arrow_udf(kind)
    def identify(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        result = pa.struct(
            [
                ("lang_pred", pa.string()),
                ("score", pa.float64()),
                ("languages", pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))),
                ("unknown", pa.float64()),
            ]
        )
        for column in columns:
            yield pa.array([row for texts in chunks(column) for row in fit(texts, model)], result)

    has_letter = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    none = F.lit(None).cast(kind)
    found = identify(F.col(text_col)) if names else none
    known = has_letter & F.lit(bool(names))
    more = [unknown_col] if unknown_col else []
    unknown = [F.when(known, F.col(FOUND + ".unknown")).otherwise(1.0).alias(c) for c in more]
    rows = df.drop("lang_pred", "score", "languages", *more).withColumn(FOUND, found)
    return rows.select(
        "*",
        F.when(known, F.col(FOUND + ".lang_pred")).otherwise("und").alias("lang_pred"),
        F.when(known, F.col(FOUND + ".score")).otherwise(0.0).alias("score"),
        F.coalesce(F.when(known, F.col(FOUND + ".languages")), F.array().cast(kind_of)).alias("languages"),
        *unknown,
    ).drop(FOUND)
