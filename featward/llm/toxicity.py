"""Severity grades of toxic text by cumulative-link (proportional-odds) regression on words and parts of words."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featward.llm.sample import SAMPLE_ROWS, labelled_sample
from featward.llm.words import ALNUM, LOWER, U64, Texts, chunks, distinct_per_text, mix, signed, words_of

FEATURES = 2048  # words with a weight
MIN_DOCS = 5  # sampled documents a word must be in
TELLING = 4.0  # standard errors by which its share of toxic documents must be above that of others
LIFT = 3.0  # times the share of others that it must be, so that words of long texts do not count
GRAM_SIZES = (5, 6, 7, 8)  # bytes of a part of a word, one of them may be the space at either end
GRAM_BITS = 20  # parts are hashed to so many bits
GRAM_DOCS = 3  # sampled documents in which a part must be surprisingly frequent
SURPRISE = 2.0  # nats: times, by a Poisson count at the rate in texts that are not toxic
SPREAD = 4.0  # texts of the mean number of words over which half an occurrence is spread in that rate
GRADES = 3  # 0: not toxic; toxic documents are split among the others
STEPS = 250
FOUND = "__severity_found"


@dataclass
class SeverityModel:
    """P(grade > g) = sigmoid(weights . features - thresholds[g]); one set of weights for all g."""

    words: np.ndarray = field(default_factory=lambda: np.zeros(0, U64))  # hashes, sorted
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))  # of the words, then of the parts of words
    thresholds: np.ndarray = field(default_factory=lambda: np.zeros(0))  # rising
    grams: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # hashes of parts, sorted
    rates: np.ndarray = field(default_factory=lambda: np.zeros(0))  # per different word of a text, if not toxic


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def distinct_words(texts: Texts) -> tuple[Texts, np.ndarray]:
    """Each text's different words, in lower case with a space after each, and how many there are.

    Besides A-Z, the capitals of Latin-1 (À to Þ) are lowered."""
    low = LOWER[texts.data]
    follows = np.zeros(len(low), bool)
    follows[1:] = texts.data[:-1] == 0xC3
    low[follows & (low >= 0x80) & (low <= 0x9E) & (low != 0x97)] += 0x20
    found = words_of(Texts(texts.first, low, texts.offsets), ALNUM)
    text = np.repeat(np.arange(len(texts)), np.diff(found.offsets))
    order = np.lexsort((found.hashes, text))
    hashes, text = found.hashes[order], text[order]
    new = np.ones(len(order), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    order, cuts = order[new], np.searchsorted(text[new], np.arange(len(texts) + 1))
    lengths = found.ends[order] - found.starts[order]
    stops = np.concatenate([[0], np.cumsum(lengths + 1)])
    data = np.full(stops[-1], 0x20, np.uint8)
    within = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    data[np.repeat(stops[:-1], lengths) + within] = low[np.repeat(found.starts[order], lengths) + within]
    return Texts(texts.first, data, stops[cuts]), np.diff(cuts)


def parts_of(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The text and the hash of each part of its different words, and how many such words each text has.

    A part is a run of bytes of one of ``GRAM_SIZES`` within a word, or with the space at one end of it."""
    words, numbers = distinct_words(texts)
    data = words.data.astype(np.int64)
    owner = np.repeat(np.arange(len(words)), np.diff(words.offsets))
    spaces = np.concatenate([[0], np.cumsum(data == 0x20)])
    where, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for n in GRAM_SIZES:
        m = len(data) - n + 1
        if m < 1:
            continue
        alone = (spaces[n - 1 : n - 1 + m] == spaces[1 : 1 + m]) & (spaces[n : n + m] - spaces[:m] <= 1)
        alone &= (owner[:m] == owner[n - 1 :]) & ((data[:m] & 0xC0) != 0x80)  # from a character's first byte
        at = np.flatnonzero(alone)
        code = np.full(len(at), n, U64)
        for j in range(n):
            code = code * U64(0x9E3779B97F4A7C15) + data[at + j].astype(U64) + U64(1)
        where.append(owner[at])
        hashes.append((mix(code) >> U64(64 - GRAM_BITS)).astype(np.int64))
    return np.concatenate(where), np.concatenate(hashes), numbers


def _times(text: np.ndarray, part: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different pairs of text and part that stand in two words at least, and in how many."""
    pairs, times = np.unique(text * parts + part, return_counts=True)
    pairs, times = pairs[times > 1], times[times > 1]
    return pairs // parts, pairs % parts, times


def _surprise(times: np.ndarray, expected: np.ndarray) -> np.ndarray:
    """How much likelier so many times are at their own rate than at the expected one; 0 if there are fewer."""
    found = times * np.log(times / expected) - (times - expected)
    return np.where(times > expected, found, 0.0)


def part_features(texts: Texts, table: np.ndarray, rates: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, place of the part, log(surprise) where it is surprising; ``table`` has the place of each hash or -1."""
    text, part, numbers = parts_of(texts)
    place = table[part]
    text, place, times = _times(text[place >= 0], place[place >= 0], max(len(rates), 1))
    surprise = _surprise(times, rates[place] * numbers[text])
    much = surprise >= SURPRISE
    return text[much], place[much], np.log1p(np.floor(surprise[much]) - SURPRISE + 1)


def place_table(grams: np.ndarray) -> np.ndarray:
    table = np.full(1 << GRAM_BITS, -1, np.int64)
    table[grams] = np.arange(len(grams))
    return table


def features(texts, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse features of a chunk: text, place of the word in ``words``, log(1 + times it occurs)."""
    found = words_of(texts, ALNUM)
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    mask = (1 << 16) - 1  # most words are ruled out by 16 bits
    maybe = np.zeros(mask + 1, bool)
    maybe[(words & U64(mask)).astype(np.int64)] = True
    at = np.flatnonzero(maybe[(found.hashes & U64(mask)).astype(np.int64)])
    place = np.minimum(np.searchsorted(words, found.hashes[at]), len(words) - 1)
    same = words[place] == found.hashes[at]
    at, place = at[same], place[same]
    text = np.searchsorted(found.offsets, at, "right") - 1
    pairs, times = np.unique(text * len(words) + place, return_counts=True)
    return pairs // len(words), pairs % len(words), np.log1p(times)


def both_features(texts, words: np.ndarray, table: np.ndarray, rates: np.ndarray):
    """Features of words, then of parts of words, in the order of the texts."""
    found = [features(texts, words)]
    if len(rates):
        text, place, value = part_features(texts, table, rates)
        found.append((text, place + len(words), value))
    text, place, value = (np.concatenate(c) for c in zip(*found))
    order = np.argsort(text, kind="stable")
    return text[order], place[order], value[order]


def fit_cumulative_link(text, place, value, grade, weight, n_features: int, grades: int):
    """Weights and thresholds that minimise the weighted loss, by Adam on the whole sample.

    Weights are kept from falling below 0: a word may add to the severity, and no amount of ordinary words
    makes up for it. The ridge is that of a normal prior of variance 1 on each weight, so it gives
    way as rows grow.
    """
    n, total = len(grade), weight.sum()
    ridge = 1 / max(n, 1)
    w = np.zeros(n_features)
    above = [max(min(weight[grade > g].sum() / total, 1 - 1e-6), 1e-6) for g in range(grades - 1)]
    start = -np.log(np.array(above) / (1 - np.array(above)))
    # thresholds rise: the first is free, the gaps are exponentials
    t = np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 0.05))])
    state = [np.zeros(n_features + len(t)) for _ in range(2)]
    share = weight / total
    for step in range(1, STEPS + 1):
        cuts = t[0] + np.concatenate([[0.0], np.cumsum(np.exp(t[1:]))])
        score = np.bincount(text, value * w[place], n)
        upper = np.concatenate([[-np.inf], cuts, [np.inf]])
        # P(grade) = sigmoid(score - lower cut) - sigmoid(score - upper cut)
        low, high = _sigmoid(score - upper[grade]), _sigmoid(score - upper[grade + 1])
        chance = np.maximum(low - high, 1e-9)
        slope_low, slope_high = low * (1 - low), high * (1 - high)
        pull = -share * (slope_low - slope_high) / chance
        by_cut = np.bincount(grade, share * slope_low / chance, grades)[1:]
        by_cut = by_cut - np.bincount(grade, share * slope_high / chance, grades)[:-1]
        by_t = np.array([by_cut[g:].sum() for g in range(grades - 1)])
        by_t[1:] *= np.exp(t[1:])
        gradient = np.concatenate([np.bincount(place, value * pull[text], n_features) + ridge * w, by_t])
        state[0] = 0.9 * state[0] + 0.1 * gradient
        state[1] = 0.99 * state[1] + 0.01 * gradient**2
        move = (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.99**step)) + 1e-8)
        move *= 0.15 * (1 - step / (STEPS + 1))
        w, t = np.maximum(w - move[:n_features], 0.0), t - move[n_features:]
    return w, t[0] + np.concatenate([[0.0], np.cumsum(np.exp(t[1:]))])


def _telling_words(sample: DataFrame, n_features: int) -> np.ndarray:
    """The words that are most clearly more frequent in toxic documents than in others."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column("label").to_numpy(zero_copy_only=False)
            for texts in chunks(batch.column("text")):
                found = words_of(texts, ALNUM)
                hashes, offsets = distinct_per_text(found.hashes, found.offsets)
                mine = np.repeat(label[texts.first : texts.first + len(texts)], np.diff(offsets))
                words, where = np.unique(hashes, return_inverse=True)
                columns = [np.bincount(where[mine == k], minlength=len(words)) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([signed(words), *map(pa.array, columns)], ["word", "n0", "n1"])

    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(sizes) < 2:
        return np.zeros(0, U64)
    share = [F.col(f"n{k}") / float(sizes[k]) for k in (0, 1)]
    both = (F.col("n0") + F.col("n1")) / float(sizes[0] + sizes[1])
    error = F.sqrt(both * (1 - both) * (1 / sizes[0] + 1 / sizes[1]) + 1e-12)
    above = (share[1] - share[0]) / error
    telling = (F.col("n0") + F.col("n1") >= MIN_DOCS) & (above >= TELLING) & (share[1] >= LIFT * share[0])
    top = (
        sample.select("text", "label")
        .mapInArrow(count, "word long, n0 long, n1 long")
        .groupBy("word")
        .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
        .filter(telling)
        .orderBy(F.desc(above), "word")
        .limit(n_features)
        .toArrow()
    )
    return np.sort(top.column("word").to_numpy().view(U64))


def _part_sums(sample: DataFrame, sums) -> dict[str, np.ndarray]:
    """``sums`` gives two numbers for places of a chunk, from labels and texts; each place's, added up."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((2, 1 << GRAM_BITS), np.int64)
        for batch in batches:
            label = batch.column("label").to_numpy(zero_copy_only=False)
            for texts in chunks(batch.column("text")):
                place, *numbers = sums(label[texts.first : texts.first + len(texts)], texts)
                for total, number in zip(totals, numbers):
                    np.add.at(total, place, number)
        at = np.flatnonzero(totals.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (at, *totals[:, at])], ["place", "a", "b"])

    rows = sample.select("text", "label").mapInArrow(add, "place long, a long, b long")
    found = rows.groupBy("place").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).toArrow()
    return {name: found.column(name).to_numpy() for name in ("place", "a", "b")}


def _above(n0: np.ndarray, n1: np.ndarray, sizes: dict[int, int]) -> np.ndarray:
    """Standard errors by which the share of toxic documents is above that of others."""
    both = (n0 + n1) / (sizes[0] + sizes[1])
    error = np.sqrt(both * (1 - both) * (1 / sizes[0] + 1 / sizes[1]) + 1e-12)
    return (n1 / sizes[1] - n0 / sizes[0]) / error


def _telling_parts(sample: DataFrame, n_features: int) -> tuple[np.ndarray, np.ndarray]:
    """The parts of words that are surprisingly frequent in clearly more toxic documents than others, and
    their rates in documents that are not toxic and hold them.

    Repeated words count once, and the number expected rises with a text's words, so that neither repeated
    lines nor long texts are surprising by themselves.
    """
    empty = np.zeros(0, np.int64), np.zeros(0)
    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(sizes) < 2:
        return empty

    def in_toxic(label, texts):  # documents that hold it twice
        text, part, _ = parts_of(texts)
        mine = label[text] == 1
        _, part, times = _times(text[mine], part[mine], 1 << GRAM_BITS)
        return part, np.ones_like(times), np.zeros_like(times)

    found = _part_sums(sample.filter("label = 1"), in_toxic)
    # others count as none here, so no part that could be telling is passed over
    grams = np.sort(found["place"][_above(np.zeros(len(found["a"])), found["a"], sizes) >= TELLING])
    if not len(grams):
        return empty
    table = place_table(grams)

    def in_others(label, texts):  # times, and words of the documents that hold it; of all at the end
        text, part, numbers = parts_of(texts)
        place = table[part]
        kept = (place >= 0) & (label[text] == 0)
        pairs, times = np.unique(text[kept] * len(grams) + place[kept], return_counts=True)
        words = np.array([numbers[label == 0].sum()])
        place = np.concatenate([pairs % len(grams), [(1 << GRAM_BITS) - 1]])
        return place, np.concatenate([times, [0]]), np.concatenate([numbers[pairs // len(grams)], words])

    found = _part_sums(sample.filter("label = 0"), in_others)
    times, words = np.zeros(1 << GRAM_BITS), np.zeros(1 << GRAM_BITS)
    times[found["place"]], words[found["place"]] = found["a"], found["b"]
    mean = max(words[-1] / sizes[0], 1.0)
    rates = (times[: len(grams)] + 0.5) / (words[: len(grams)] + SPREAD * mean)

    def surprising(label, texts):
        text, place, _ = part_features(texts, table, rates)
        return place, (label[text] == 0).astype(np.int64), (label[text] == 1).astype(np.int64)

    found = _part_sums(sample, surprising)
    n0, n1 = found["a"], found["b"]
    above = _above(n0, n1, sizes)
    telling = (n0 + n1 >= GRAM_DOCS) & (above >= TELLING) & (n1 / sizes[1] >= LIFT * n0 / sizes[0])
    place, above = found["place"][telling], above[telling]
    best = np.sort(place[np.lexsort((place, -above))][:n_features])
    return grams[best], rates[best]


def fit_severity(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "toxic",
    id_col: str = "doc_id",
    text_col: str = "text",
    grades: int = GRADES,
    n_features: int = FEATURES,
    limit: int = SAMPLE_ROWS,
) -> SeverityModel:
    """A model of severity grades from labels that only say toxic (1) or not (0).

    A first fit of the two labels scores the toxic documents of the sample; they are split by equal
    numbers into grades 1, 2, … (most toxic last), and the cumulative-link model is fitted to those
    grades, each threshold with the same weights. It is fitted on the driver on at most ``limit``
    labelled rows (:func:`labelled_sample`), weighted by what they stand for, with at most
    ``n_features`` words and as many parts of words. Without labels of both kinds the model is empty and grades all text 0.
    """
    sample = labelled_sample(docs, labels, label_col, id_col, text_col, limit)
    words = _telling_words(sample, n_features)
    grams, rates = _telling_parts(sample, n_features)
    n_found = len(words) + len(grams)
    if not n_found:
        return SeverityModel()

    table = place_table(grams)

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple[bytes, bytes]] = []
            for texts in chunks(batch.column("text")):
                text, place, value = both_features(texts, words, table, rates)
                cuts = np.searchsorted(text, np.arange(len(texts) + 1))
                for i, j in zip(cuts[:-1], cuts[1:]):
                    rows.append((place[i:j].astype("<i4").tobytes(), value[i:j].astype("<f4").tobytes()))
            columns = [pa.array([r[k] for r in rows], pa.binary()) for k in (0, 1)]
            names = ["label", "weight", "place", "value"]
            yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("weight"), *columns], names)

    found = (
        sample.select("label", "weight", "text")
        .mapInArrow(sparse, "label int, weight double, place binary, value binary")
        .toArrow()
    )
    label, weight = found.column("label").to_numpy(), found.column("weight").to_numpy()
    places = [np.frombuffer(p, "<i4") for p in found.column("place").to_pylist()]
    value = np.frombuffer(b"".join(found.column("value").to_pylist()), "<f4").astype(float)
    text = np.repeat(np.arange(len(label)), [len(p) for p in places])
    place = np.concatenate([*places, np.zeros(0, "<i4")]).astype(np.int64)

    w, cuts = fit_cumulative_link(text, place, value, label.astype(np.int64), weight, n_found, 2)
    if grades > 2:
        score = np.bincount(text, value * w[place], len(label))
        toxic = np.flatnonzero(label == 1)
        grade = np.zeros(len(label), np.int64)
        order = toxic[np.argsort(score[toxic], kind="stable")]
        grade[order] = 1 + np.arange(len(order)) * (grades - 1) // max(len(order), 1)
        if len(toxic) >= grades - 1:
            w, cuts = fit_cumulative_link(text, place, value, grade, weight, n_found, grades)
    return SeverityModel(words, w, cuts, grams, rates)


def predict_severity(df: DataFrame, model: SeverityModel, text_col: str = "text") -> DataFrame:
    """The frame with ``severity``, ``grade`` and ``p_toxic``.

    ``severity``: the expected grade, the sum of P(grade > g); ``grade``: the likeliest grade, of
    equals the smaller; ``p_toxic``: P(grade > 0). Words are lower-cased runs of letters and digits.
    A NULL or empty text is scored as one without any known word or part; an empty model gives 0, 0 and 0.
    Row by row, no shuffle; the model is some ten kilobytes. Columns with these names are replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<severity:double,grade:int,p_toxic:double>")
    def predict(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        table = place_table(model.grams)
        for column in columns:
            score = np.zeros(len(column))
            for texts in chunks(column):
                text, place, value = both_features(texts, model.words, table, model.rates)
                part = np.bincount(text, value * model.weights[place], len(texts)) if len(text) else 0.0
                score[texts.first : texts.first + len(texts)] = part
            above = _sigmoid(score[:, None] - model.thresholds[None, :])
            edges = np.hstack([np.ones((len(score), 1)), above, np.zeros((len(score), 1))])
            grade = np.argmax(edges[:, :-1] - edges[:, 1:], axis=1).astype(np.int32)
            p_toxic = above[:, 0] if above.shape[1] else np.zeros(len(score))
            arrays = [pa.array(above.sum(1)), pa.array(grade), pa.array(np.ascontiguousarray(p_toxic))]
            yield pa.StructArray.from_arrays(arrays, ["severity", "grade", "p_toxic"])

    names = ["severity", "grade", "p_toxic"]
    rows = df.drop(*names).withColumn(FOUND, predict(F.col(text_col)))
    return rows.select("*", *[F.col(f"{FOUND}.{n}") for n in names]).drop(FOUND)
