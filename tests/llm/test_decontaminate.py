"""Decontamination against a brute-force search of all windows."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from featward.llm.decontaminate import (
    BITS,
    _fingerprint,
    _signs,
    _touched,
    build_index,
    candidates,
    find_contamination,
    least_shared,
    radius,
)
from featward.llm.queries import op2_decontaminate

from .conftest import SF


def words(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))


def runs(w):
    return [tuple(w[i : i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else []


def brute(docs, items, threshold=0.75):
    found = {}
    for doc_id, text in docs:
        own = runs(words(text))
        for item_id, item in items:
            wanted = runs(words(item))
            if not own or not wanted:
                continue
            size = min(len(own), len(wanted))
            for start in range(len(own) - size + 1):
                window = Counter(own[start : start + size])
                both = sum((window & Counter(wanted)).values())
                value = both / (size + len(wanted) - both)
                if value >= threshold and value > found.get((doc_id, item_id), (0,))[0]:
                    found[doc_id, item_id] = (value, start)
    return found


def as_dict(df):
    return {(r.doc_id, r.item_id): (r.similarity, r.first_word) for r in df.collect()}


def test_exact_and_altered_passages(spark, prose):
    draw = random.Random(2)
    items = [(i, prose(i, draw.randint(15, 60), 3000)) for i in range(30)]
    items += [(30, "w1 w2 w3 w4 w5 " * 6), (31, "just four words here"), (32, None), (33, ""), (None, prose(77, 40))]
    docs = []
    for n in range(120):
        text = prose(1000 + n, draw.randint(0, 150), 3000).split()
        item = draw.choice(items[:31])[1].split()
        for _ in range(draw.choice([0, 0, 1, 2])):  # a word changed
            item[draw.randrange(len(item))] = "changed"
        at = draw.randint(0, len(text))
        docs.append((n, " ".join([*text[:at], *item, *text[at:]])))
    docs += [
        (200, items[0][1].upper().replace(" ", ",\n")), (201, None), (202, ""), (203, "Just four words, here."),
        (204, "just four words here too"), (205, items[1][1] + " " + prose(1, 30_000) + " " + items[2][1]),
        (206, " ".join(items[3][1].split()[:-2])), (207, items[34][1]),
    ]
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS matches", "2 AS item_id")
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "3 AS id")
    got = as_dict(find_contamination(frame, bench))
    assert got == brute(docs, items)
    assert len(got) > 60 and (203, 31) in got and (204, 31) not in got and (207, None) in got
    assert as_dict(find_contamination(frame, bench, item_block=10)) == got
    assert as_dict(find_contamination(frame, bench, every_window=True)) == got
    twice = frame.filter("doc_id = 200").union(frame.filter("doc_id = 200"))
    assert find_contamination(twice, bench).count() == 2
    for empty in ((frame.limit(0), bench), (frame, bench.limit(0))):
        assert find_contamination(*empty).count() == 0


def items_of(sizes, seed=1):
    draw = np.random.default_rng(seed)
    texts = pa.array([" ".join(f"v{x}" for x in draw.integers(0, 9000, n + 4)) for n in sizes])
    return build_index(np.arange(len(sizes)), texts)


def prints_of(hashes):
    return _fingerprint(_signs(hashes).sum(0, dtype=int)[None])


def test_lookup_finds_every_fingerprint_within_the_radius():
    draw = np.random.default_rng(1)
    index = items_of([26] * 300).by_size[26]
    for most in (0, 5, 7, 8, 24, 43):
        near = index.prints.copy()
        for i in range(300):  # turn up to so many bits
            for bit in draw.choice(BITS, draw.integers(0, most + 1), replace=False):
                near[i, bit // 64] ^= np.uint64(1 << int(bit % 64))
        pairs = set(zip(*map(np.ndarray.tolist, candidates(index, near, most))))
        distance = np.bitwise_count(near[:, None] ^ index.prints[None, :]).sum(2, dtype=int)
        assert pairs == set(zip(*map(np.ndarray.tolist, np.nonzero(distance <= most)))) and len(pairs) >= 300


def test_lookup_touches_few_items_in_little_memory():
    """A benchmark of 4,600 items of 46 sizes: a window is compared with a small part of those of its own size."""
    index = items_of([15 + i % 46 for i in range(4600)], 2)
    draw = np.random.default_rng(3)
    for size in (15, 30, 60):
        items = index.by_size[size]
        windows = np.concatenate([prints_of(draw.integers(0, 2**63, size, dtype=np.uint64)) for _ in range(512)])
        most = radius(size, size, 0.75)
        touched = sum(int(t.sum()) for _, t in _touched(items, windows, most))
        assert len(items.items) == 100
        assert touched < 0.02 * len(windows) * len(index.ids)
        assert len(candidates(items, windows, most)[0]) < 0.001 * len(windows) * len(items.items)


def test_recall_at_the_very_threshold():
    """Sets that share just enough, of many sizes and of shorter texts: all within the radius."""
    draw = np.random.default_rng(3)
    far = tried = 0
    for size in [*range(1, 40), 60, 150, 400]:
        for width in {size, max(1, round(size * 0.8))}:
            shared, most = least_shared(size, width, 0.75), radius(size, width, 0.75)
            assert (most < 0) == (shared > min(size, width))
            for _ in range(60 if most >= 0 else 0):
                both = draw.integers(0, 2**63, shared, dtype=np.uint64)
                a, b = (
                    prints_of(np.concatenate([both, draw.integers(0, 2**63, n - shared, dtype=np.uint64)]))
                    for n in (size, width)
                )
                far += int(np.bitwise_count(a ^ b).sum()) > most
                tried += 1
    assert tried > 3000 and far == 0


def test_query(spark, duck):
    docs = duck.sql("SELECT doc_id, text FROM documents").fetchall()
    items = duck.sql("SELECT item_id, text FROM benchmark").fetchall()
    held = {r: set(runs(words(t))) for r, t in items}
    touched = [(d, t) for d, t in docs if any(len(s & set(runs(words(t)))) > len(s) / 4 for s in held.values())]
    got = as_dict(op2_decontaminate(spark, str(SF)))
    assert got == brute(touched, items) and got
    assert op2_decontaminate(spark, str(SF)).filter(F.col("similarity") < 0.75).count() == 0
