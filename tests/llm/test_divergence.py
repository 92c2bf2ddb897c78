"""Source divergence against plain dense arithmetic."""

import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from featward.llm import divergence
from featward.llm.divergence import source_divergence, terms_of
from featward.llm.queries import ASCII_LOWER, ASCII_UPPER, op12_divergence
from featward.llm.workers import prepare

from .conftest import SF

LOWER = str.maketrans(ASCII_UPPER, ASCII_LOWER)


def words(text):
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.translate(LOWER))


def value(p, q):
    return (p - q) ** 2 // q


def plain(rows):
    counts, having, groups = defaultdict(Counter), defaultdict(Counter), set()
    for row in rows:
        text, lang, source = (v or "" for v in row)
        groups.add((lang, source))
        counts[lang, source].update(words(text))
        having[lang].update(set(words(text)))
    found = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in having[lang].items() if n >= 3]
        sources = sorted(s for own, s in groups if own == lang)
        totals = {s: sum(counts[lang, s][t] for t in kept) for s in sources}

        def share(n, total):
            return 1 + 10**9 * (n + 1) // (total + len(kept))

        p = {s: {t: share(counts[lang, s][t], totals[s]) for t in kept} for s in sources}
        q = {t: share(sum(counts[lang, s][t] for s in sources), sum(totals.values())) for t in kept}
        for s in sources:
            pairs = [(-sum(value(p[s][t], p[o][t]) for t in kept), o.encode()) for o in sources if o != s]
            terms = [(-value(p[s][t], q[t]), t.encode()) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, len(pairs)), ("term", terms, 200)):
                for rank, (v, item) in enumerate(sorted(items)[:most], 1):
                    found.append((lang, s, part, item.decode(), -v, rank))
    return sorted(found)


def collected(df):
    return sorted(map(tuple, df.collect()))


def test_terms_are_runs_of_letters():
    text = "Ab1cD_é\x7fÉ Σx\x00日本-z\u00a0 {Ü}"
    assert [t.decode() for t in terms_of(text) if t] == words(text)


def test_odd_rows(spark):
    prepare(spark)
    rows = [
        ("Ab ab, cd x1y", "en", "a"), ("ab ab ef", "en", "b"), ("ab cd\x7fcd é É", "en", None), ("cd", "en", ""),
        (None, "en", "zz"), ("", "en", "zz"), ("ab", None, "q"), ("q q q", "fr", "q"), ("q", "fr", "q"), ("q r q", "fr", "q"),
        ("ab " * 50_000, "en", "b"), ("no kept", "de", "a"), ("terms", "de", "b"), (None, None, None),
    ]
    df = spark.createDataFrame(rows, "text string, lang string, source string").selectExpr("*", "1 AS term", "'' AS item", "2 AS rank")
    got = collected(source_divergence(df))
    assert got == plain(rows)
    assert ("de", "a", "pair", "b", 0, 1) in got
    assert collected(source_divergence(df.filter("false"))) == []


def test_hot_source_many_sources_and_small_batches(spark, prose, monkeypatch, setting):
    prepare(spark)
    rows = [(prose(i, 30 + i % 50), "en" if i % 4 else "fr", "hot" if i % 3 == 0 else f"s{i % 40}") for i in range(500)]
    rows = [(re.sub("[0-9]", lambda m: "abcdefghij"[int(m[0])], t), lang, source) for t, lang, source in rows]
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    setting(spark__sql__execution__arrow__maxRecordsPerBatch="7")
    assert collected(source_divergence(df)) == plain(rows)


def test_counts_and_sums_are_handed_on(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(divergence, "MOST_COUNTED", 2)
    names = ["text", "lang", "source"]
    batch = pa.RecordBatch.from_arrays([pa.array(["a b b", "b c", None]), pa.array(["en"] * 3), pa.array(["x", "x", "y"])], names)
    total, documents = Counter(), Counter()
    for part in divergence._count_terms(iter([batch])):
        for row in part.to_pylist():
            total[row["source"], row["term"]] += row["times"]
            documents[row["source"], row["term"]] += row["documents"]
    assert total == {("x", "a"): 1, ("x", "b"): 3, ("x", "c"): 1, ("x", None): 0, ("y", None): 0}
    assert documents["x", "b"] == 2


def test_shares_of_huge_counts(spark):
    row = spark.range(1).select(F.expr(divergence._share("9000000000000000000", "9000000000000000005")).alias("p")).first()
    assert row.p == 1 + 10**9 * (9 * 10**18 + 1) // (9 * 10**18 + 5)


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("text", "lang", "source")
    assert collected(op12_divergence(spark, str(SF))) == plain(map(tuple, docs.collect()))
