"""Words, shingles and their hashes against plain Python."""

import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from hypothesis import given, settings
from hypothesis import strategies as st

from featward.llm.packing import pack, pack_sorted, unpack, unpack_sorted
from featward.llm.words import ALNUM, chunks, distinct_per_text, shingles_of, words_of

LOWER = {i: i + 32 for i in range(65, 91)}


def plain_words(text, pattern="[^\x20\x09-\x0d]+"):
    return re.findall(pattern, (text or "").translate(LOWER))


def hashed(texts, limit=50, letters=None):
    out = []
    for part in chunks(pa.array(texts, pa.string()), limit):
        words = words_of(part, letters)
        shingles, offsets = shingles_of(words)
        for i in range(len(part)):
            a, b = words.offsets[i], words.offsets[i + 1]
            out.append((words.hashes[a:b].tolist(), shingles[offsets[i] : offsets[i + 1]].tolist()))
    return out


TEXT = st.one_of(st.none(), st.text(alphabet=" aAbZéß\n\t\x0b\u00a0,.日-1", max_size=60))


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=8), st.integers(1, 200))
def test_hashes_are_equal_exactly_for_equal_words(texts, limit):
    seen, shingle_of = {}, {}
    for text, (words, shingles) in zip(texts, hashed(texts, limit), strict=True):
        plain = plain_words(text)
        assert len(words) == len(plain)
        for word, value in zip(plain, words):
            assert seen.setdefault(value, word) == word
        n = len(plain)
        expected = [tuple(plain[i : i + 5]) for i in range(n - 4)] if n >= 5 else [tuple(plain)] if n else []
        assert len(shingles) == len(expected)
        for run, value in zip(expected, shingles):
            assert shingle_of.setdefault(value, run) == run
    assert len(set(seen.values())) == len(seen) and len(set(shingle_of.values())) == len(shingle_of)


def test_letters_and_digits_only():
    ((one, _), (two, _)) = hashed(["Hello, wörld-7!", "hello wörld 7"], letters=ALNUM)
    assert one == two and len(one) == 3


def test_a_slice_and_a_very_long_text():
    long = "x" * 300_000 + " " + "ab " * 50_000
    column = pa.array([None, "skipped", long, "", "x"])
    (a, b, c) = [len(w) for w, _ in hashed(column.slice(2).to_pylist(), 1000)]
    assert (a, b, c) == (50_001, 0, 1)
    parts = list(chunks(column.slice(2), 1000))
    assert [p.first for p in parts] == [0, 1] and sum(map(len, parts)) == 3
    assert list(chunks(pa.array([], pa.string()))) == []


def test_distinct_per_text():
    ((_, shingles),) = hashed(["a b c d e a b c d e a b c d e"])
    values, offsets = distinct_per_text(np.array(shingles, np.uint64), np.array([0, len(shingles)]))
    assert len(shingles) == 11 and values.tolist() == sorted(set(shingles)) and offsets.tolist() == [0, 5]


def test_packing():
    draw = random.Random(1)
    for most in (0, 255, 256, 70_000, 1 << 33, (1 << 64) - 1):
        values = np.array(sorted(draw.randint(0, most) for _ in range(50)) + [most], np.uint64)
        assert unpack(pack(values)).tolist() == values.tolist()
        assert unpack_sorted(pack_sorted(values)).tolist() == values.tolist()
    assert unpack(pack(np.zeros(0, np.int64))).tolist() == []


def test_buckets_have_a_task_each_and_follow_the_text(spark, monkeypatch):
    from featward.llm import packing

    packed = spark.range(400).selectExpr("CAST(id % 50 AS INT) AS bucket", "id").repartition(7)

    def count(batches):
        for bucket, rows in packing.by_bucket(batches):
            yield pa.RecordBatch.from_arrays([pa.array([bucket]), pa.array([len(rows)])], ["bucket", "n"])

    found = packing.dealt(packed, 50)
    assert found.groupBy(F.spark_partition_id().alias("p")).agg(F.count_distinct("bucket").alias("n")).filter("n > 1").isEmpty()
    assert sorted(map(tuple, found.mapInArrow(count, "bucket long, n long").collect())) == [(b, 8) for b in range(50)]
    texts = spark.createDataFrame([("é" * 500,), (None,)], "text string")
    assert packing.buckets_of(texts) == 8
    monkeypatch.setattr(packing, "BUCKET_TEXT", 50)
    assert packing.buckets_of(texts) == 20
