"""The Kneser-Ney model against plain Python, and its probabilities' sum."""

import math
import os
import re
import resource
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from featward.llm import lm
from featward.llm.arrays import map_arrays, save_arrays
from featward.llm.lm import (
    END,
    KneserNey,
    _discounts,
    _of_bigrams,
    _word_counts,
    fit_kneser_ney,
    log_probabilities,
    score_kneser_ney,
)
from featward.llm.packing import pack, pack_sorted
from featward.llm.queries import op7_lm
from featward.llm.words import chunks, words_of

from .conftest import SF


def tokens(text):
    return ["<s>", *re.findall("[^\x20\x09-\x0d]+", (text or "").translate({i: i + 32 for i in range(65, 91)})), "</s>"]


class Plain:
    def __init__(self, texts):
        self.pairs = Counter()
        for text in texts:
            w = tokens(text)
            self.pairs.update(zip(w, w[1:]))
        self.context, self.before, self.times = Counter(), Counter(), Counter()
        self.followers = defaultdict(lambda: [0, 0, 0])
        for (a, b), c in self.pairs.items():
            self.context[a] += c
            self.before[b] += 1
            self.times[b] += c
            self.followers[a][min(c, 3) - 1] += 1
        self.n, self.v, self.types = sum(self.times.values()), len(self.times), max(len(self.pairs), 1)
        self.d2 = _discounts([sum(c == k for c in self.pairs.values()) for k in (1, 2, 3, 4)])
        self.d1 = _discounts([sum(c == k for c in self.before.values()) for k in (1, 2, 3, 4)])
        kept = sum(self.d1[min(c, 3) - 1] for c in self.before.values())
        self.spare = kept / self.types if self.pairs else 1.0

    def p(self, a, b):
        c = self.before[b]
        low = (c - (self.d1[min(c, 3) - 1] if c else 0)) / self.types + self.spare / (self.v + 1)
        if not self.context[a]:
            return low
        c = self.pairs[a, b]
        kept = sum(d * n for d, n in zip(self.d2, self.followers[a]))
        return (c - (self.d2[min(c, 3) - 1] if c else 0)) / self.context[a] + kept / self.context[a] * low

    def row(self, text):
        w = tokens(text)
        base = sum(math.log10((self.times[b] + 1) / (self.n + self.v + 1)) for b in w[1:])
        return len(w) - 1, sum(b in self.times for b in w[1:]), base, sum(math.log10(self.p(*x)) for x in zip(w, w[1:]))


def close(row, expected):
    return tuple(row)[:2] == expected[:2] and tuple(row)[2:] == pytest.approx(expected[2:], abs=1e-6)


def test_bigrams_seen_more_than_four_thousand_million_times(spark, tmp_path):
    before, token = np.array([5, 9], np.uint64), np.array([7, 8], np.uint64)
    row = (0, pack_sorted(before), pack(np.array([1, 1])), token.tobytes(), pack(np.array([2**31, 3])))
    more = (0, pack_sorted(before[:1]), pack(np.array([1])), token[:1].tobytes(), pack(np.array([2**31 + 5])))
    kinds = "bucket int, before binary, runs binary, tokens binary, times binary"
    _word_counts(spark.createDataFrame([row, more], kinds).coalesce(1), str(tmp_path), 1).collect()
    model = KneserNey(str(tmp_path), 1, 0, 0, 0, (0.5,) * 3, (0.5,) * 3, 0.0)
    assert _of_bigrams(model, before, token).tolist() == [2**32 + 5, 3]


def test_query(spark, documents):
    plain = Plain([t for i, t in documents.items() if zlib.crc32(str(i).encode()) % 7 != 2])
    rows = op7_lm(spark, str(SF)).collect()
    assert len(rows) == len(documents)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2) and r.train_tokens == plain.n
        assert close((r.n_tokens, r.n_known, r.base_score, r.score), plain.row(documents[r.doc_id]))
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_edge_texts(spark):
    train = [None, "", "a b a b", "A b a b", "a b c d", "a b c d", "é x", "the " * 3000]
    frame = spark.createDataFrame([(t,) for t in train], "text string").selectExpr("*", "1 AS lm", "2 AS bucket")
    model, plain = fit_kneser_ney(frame), Plain(train)
    assert (model.tokens, model.distinct, model.bigrams) == (plain.n, plain.v, len(plain.pairs))
    asked = [*train, "never seen words", "b a", "a b " * 40_000]
    got = score_kneser_ney(spark.createDataFrame([(t,) for t in asked], "text string"), model).collect()
    assert len(got) == len(asked) and all(close(r.lm, plain.row(r.text)) for r in got)


def test_nothing_to_learn_from(spark):
    frame = spark.createDataFrame([("a b",), (None,)], "text string")
    model = fit_kneser_ney(frame.limit(0))
    assert [tuple(r.lm) for r in score_kneser_ney(frame, model).collect()] == [(3, 0, 0.0, 0.0), (1, 0, 0.0, 0.0)]
    assert score_kneser_ney(frame.limit(0), model).count() == 0


def test_probabilities_add_up_to_one(spark, prose):
    texts = [prose(i, 60, 30) for i in range(40)]
    model = fit_kneser_ney(spark.createDataFrame([(t,) for t in texts], "text string").repartition(4))
    vocabulary = sorted({w for t in texts for w in t.split()}) + ["unknown"]
    ((part),) = chunks(__import__("pyarrow").array([" ".join(vocabulary)]))
    hashes = np.append(words_of(part).hashes, END)
    for context in (hashes[0], hashes[3], hashes[-2]):
        scores, _ = log_probabilities(model, np.full(len(hashes), context), hashes)
        assert (10**scores).sum() == pytest.approx(1.0)


def test_more_files_than_a_process_may_open(spark, prose, setting, monkeypatch):
    setting(spark__sql__shuffle__partitions="64")
    texts = [prose(i, 60, 300) for i in range(40)]
    model = fit_kneser_ney(spark.createDataFrame([(t,) for t in texts], "text string").repartition(4))
    ((part),) = chunks(__import__("pyarrow").array(texts))
    before, token, _ = lm.tokens_of(part)
    files = {(k, b) for k, of in (("words", lm._range(token, 64)), ("bigrams", lm._bucket(before, token, 64))) for b in of}
    assert model.buckets == 64 and len(files) > 100
    soft, hard = resource.getrlimit(resource.RLIMIT_NOFILE)
    free = os.dup(0)
    os.close(free)
    resource.setrlimit(resource.RLIMIT_NOFILE, (free + 64, hard))
    try:
        scores, times = log_probabilities(model, before, token)
    finally:
        resource.setrlimit(resource.RLIMIT_NOFILE, (soft, hard))
    plain = Plain(texts)
    w = [tokens(t) for t in texts]
    assert scores == pytest.approx([math.log10(plain.p(*x)) for v in w for x in zip(v, v[1:])], abs=1e-6)
    monkeypatch.setattr(lm, "MOST_MAPPED", 3)
    lm._mapped.clear()
    again, times_again = log_probabilities(model, before, token)
    assert len(lm._mapped) == 3 and (again == scores).all() and (times_again == times).all()


def test_mapped_arrays(tmp_path):
    empty, kinds = np.zeros(0, np.uint64), (np.uint64, np.uint32, np.float64)
    for name, arrays in (
        ("none", {"a": empty}),
        ("some", {"a": empty, **{str(k): np.arange(5).astype(k) for k in kinds}, "z": empty.astype("<u4")}),
    ):
        save_arrays(f"{tmp_path}/{name}", arrays)
        found = map_arrays(f"{tmp_path}/{name}")
        assert list(found) == list(arrays)
        assert all(found[n].dtype == a.dtype and found[n].tolist() == a.tolist() for n, a in arrays.items())
    assert map_arrays(f"{tmp_path}/missing") == {}
