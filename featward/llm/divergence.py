"""How far the sources of a language differ in their words: a distance for each pair, and each one's telling terms.

The terms of each group (language and source) are counted where the texts are, and merged by term into a term-major
index: a term with all groups that have it. A task then multiplies its share of that index by its own
transpose, row by row: a group takes up its terms one after the other, and what the index holds for each goes straight
into an accumulator with a place for every other group. So no pair of postings becomes a row. The
accumulator counts only where both groups have the term; terms that one of them or both lack have the same
share for all, the zero baseline, and are added from the numbers of terms by their count.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featward.functions.names import named
from featward.llm.workers import give_back
from featward.session import new_scratch

SCALE = 1_000_000_000  # parts that a group's share of all its occurrences is given in
LEAST_DOCUMENTS = 3
TERM_RANKS = 200
MOST_COUNTED = 1_000_000  # terms that a task counts before it hands its counts on
MOST_SUMS = 4_000_000  # places of accumulators that a task holds before it hands their sums on

# bytes that make up terms: letters of ASCII, lower-cased, and all beyond ASCII; others are blanks
_TERM_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def terms_of(text: str) -> list[bytes]:
    return text.encode().translate(_TERM_BYTES).split(b" ")


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial sums (lang, source, term, times, documents) of a task; a row without a term names a group."""
    give_back()
    times: dict[tuple[str, str], Counter] = {}
    documents: dict[tuple[str, str], Counter] = {}
    names = ["lang", "source", "term", "times", "documents"]

    def flushed() -> Iterator[pa.RecordBatch]:
        for group, counts in times.items():
            found = documents[group]
            terms = list(counts)
            for at in range(0, len(terms), 100_000):
                part = terms[at : at + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([group[0]] * len(part), pa.string()),
                        pa.array([group[1]] * len(part), pa.string()),
                        pa.array(part, pa.binary()).cast(pa.string()),
                        pa.array([counts[t] for t in part], pa.int64()),
                        pa.array([found[t] for t in part], pa.int64()),
                    ],
                    names,
                )
        for lang, source in times:
            rows = [[lang], [source], [None], [0], [0]]
            kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, kinds)], names)
        times.clear()
        documents.clear()

    held = 0
    for batch in batches:
        for text, lang, source in zip(*(batch.column(i) for i in range(3))):
            group = lang.as_py() or "", source.as_py() or ""
            counts = times.setdefault(group, Counter())
            found = documents.setdefault(group, Counter())
            own = Counter(terms_of(text.as_py() or ""))
            own.pop(b"", None)
            before = len(counts)
            counts.update(own)
            found.update(own.keys())
            held += len(counts) - before
            if held >= MOST_COUNTED:
                yield from flushed()
                held = 0
    yield from flushed()


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """(p - q)**2 / q, rounded down; exact, as shares are at most SCALE + 1 and its square fits in 64 bits."""
    apart = p - q
    return apart * apart // q


class _Rows:
    """One dense row of sums per group, over the groups of its language."""

    def __init__(self) -> None:
        self.sums: dict[tuple[str, int], np.ndarray] = {}
        self.held = 0

    def row(self, lang: str, group: int, size: int) -> np.ndarray:
        found = self.sums.get((lang, group))
        if found is None:
            found = self.sums[lang, group] = np.zeros(size, np.int64)
            self.held += size
        return found

    def flushed(self) -> Iterator[pa.RecordBatch]:
        for (lang, group), sums in self.sums.items():
            peers = np.flatnonzero(sums)
            n = len(peers)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * n, pa.string()), pa.array([group] * n, pa.int32()), pa.array(peers, pa.int32()), pa.array(sums[peers], pa.int64())],
                ["lang", "a", "b", "both"],
            )
        self.sums.clear()
        self.held = 0


def _accumulate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums over the terms of this share of the index that two groups have both: for each group and each of its peers what
    these terms add, less what the zero baselines would."""
    give_back()
    rows = _Rows()
    for batch in batches:
        column = {n: batch.column(n) for n in batch.schema.names}
        postings = column["postings"]
        offsets = postings.offsets.to_numpy()
        entries = postings.values.flatten() if hasattr(postings.values, "flatten") else postings.values
        group, share, zero = (np.asarray(entries[i]) for i in range(3))
        langs = column["lang"].to_pylist()
        sizes = column["groups"].to_numpy()
        # terms of one language follow each other; each stretch is multiplied on its own
        cuts = [i for i in range(1, len(langs)) if langs[i] != langs[i - 1]]
        for start, stop in zip([0, *cuts], [*cuts, len(langs)]):
            span = slice(offsets[start], offsets[stop])
            _multiply(
                rows, langs[start], int(sizes[start]), offsets[start : stop + 1] - offsets[start],
                group[span].astype(np.int64), share[span].astype(np.int64), zero[span].astype(np.int64),
            )
            if rows.held >= MOST_SUMS:
                yield from rows.flushed()
    yield from rows.flushed()


def _multiply(rows: _Rows, lang: str, size: int, offsets, group, share, zero) -> None:
    """Row by row: a group's terms, and for each of them all entries of the term-major index."""
    term = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = np.argsort(group, kind="stable")
    mine = group[order]
    starts = np.flatnonzero(np.append(True, mine[1:] != mine[:-1])) if len(mine) else []
    for at, until in zip(starts, [*starts[1:], len(mine)]):
        own = order[at:until]  # this group's entries
        counts = offsets[term[own] + 1] - offsets[term[own]]
        total = int(counts.sum())
        first = np.repeat(offsets[term[own]] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
        met = first + np.arange(total)  # the entries of all groups for these terms
        p, z = np.repeat(share[own], counts), zero[own[0]]
        q, y = share[met], zero[met]
        added = distance(p, q) - distance(p, y) - distance(z, q) + distance(z, y)
        np.add.at(rows.row(lang, int(mine[at]), size), group[met], added)


def _store(df: DataFrame, label: str) -> DataFrame:
    path = new_scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _share(times: str, total: str) -> str:
    """1 + floor(SCALE * (times + 1) / total), exact for counts of any size."""
    return f"1 + CAST(CAST({SCALE} AS DECIMAL(10,0)) * CAST({times} + 1 AS DECIMAL(20,0)) DIV CAST({total} AS DECIMAL(20,0)) AS BIGINT)"


def _distance(p: str, q: str) -> str:
    return f"(({p}) - ({q})) * (({p}) - ({q})) DIV ({q})"


def source_divergence(
    df: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    least_documents: int = LEAST_DOCUMENTS,
    term_ranks: int = TERM_RANKS,
) -> DataFrame:
    """lang, source, part, item, value, rank: how each source differs from its peers, and by which terms.

    NULL text, language and source read as ''. A term is a run of letters of ASCII, lower-cased, and of any characters
    beyond ASCII. A language keeps the V terms that at least ``least_documents`` of its rows have. A
    group, which is a source within a language, and the language as a whole give each kept term the share
    p = 1 + floor(10**9 * (count + 1) / (N + V)); N sums the counts of the kept terms. The value of two shares is
    floor((p - q)**2 / q).

    Part ``pair`` has a row for each other source of the language: the sum of the values over all kept terms, q
    being the other source's; 0 if no term is kept. Part ``term`` has the kept terms that the group has and
    whose share is above the language's, q, up to rank ``term_ranks``. Ranks go by falling value, then
    by the item's bytes. All sums are integers and exact; a language whose total would exceed 64 bits is an error.

    Rows without terms still make their group occur, an empty table gives no rows; repeated rows count each;
    other columns, whatever their names, are not looked at. A text is counted by one task, with about 100 bytes
    per term; counts are handed on after a million. A posting list has at most one entry per source, a task's
    accumulators at most some 32 MB and one row, and what is multiplied at once a batch of the index.
    """

    def text(name: str) -> F.Column:
        return F.coalesce(named(name).cast("string"), F.lit(""))

    counted = df.select(text(text_col).alias("text"), text(lang_col).alias("lang"), text(source_col).alias("source")).mapInArrow(
        _count_terms, "lang string, source string, term string, times long, documents long"
    )
    by_source = F.struct("source", "times")
    # one shuffle by term gives both sums; the row without a term lists the groups that occur
    found = _store(
        counted.repartition("lang", "term")
        .groupBy("lang", "term", "source")
        .agg(F.sum("times").alias("times"), F.sum("documents").alias("documents"))
        .groupBy("lang", "term")
        .agg(F.sum("documents").alias("documents"), F.sum("times").alias("all_times"), F.collect_list(by_source).alias("entries"))
        .filter((F.col("documents") >= least_documents) | F.col("term").isNull()),
        "divergence-index",
    )
    index = found.filter("term IS NOT NULL").drop("documents")
    entries = index.selectExpr("lang", "term", "all_times", "inline(entries)")
    by_count = _store(entries.groupBy("lang", "source", "times").agg(F.count("*").alias("terms")), "divergence-histogram")
    kept = index.groupBy("lang").agg(F.count("*").alias("v"), F.sum("all_times").alias("n_lang"))
    occurring = found.filter("term IS NULL").selectExpr("lang", "inline(entries)").select("lang", "source")
    sums = by_count.groupBy("lang", "source").agg(F.sum(F.col("times") * F.col("terms")).alias("n"), F.sum("terms").alias("own"))
    groups = (
        occurring.join(sums, ["lang", "source"], "left")
        .join(kept, "lang", "left")
        .selectExpr("lang", "source", "coalesce(n, 0) AS n", "coalesce(v, 0) AS v", "coalesce(n_lang, 0) AS n_lang")
        .withColumn("number", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
        .withColumn("groups", F.count("*").over(Window.partitionBy("lang")))
        .withColumn("zero", F.expr(f"IF(v > 0, {_share('0', 'n + v')}, NULL)"))
    )
    groups = _store(groups, "divergence-groups")
    # both have the term
    share = _share("times", "n + v")
    postings = (
        entries.join(groups, ["lang", "source"])
        .selectExpr("lang", "term", "groups", f"struct(CAST(number AS INT) AS number, {share} AS share, zero) AS entry")
        .groupBy("lang", "groups", "term")
        .agg(F.collect_list("entry").alias("postings"))
        .sortWithinPartitions("lang")
        .select("lang", "groups", "postings")
    )
    both = postings.mapInArrow(_accumulate, "lang string, a int, b int, both long").groupBy("lang", "a", "b").agg(F.sum("both").alias("both"))
    # one lacks it: x has `terms` terms of a share, and y its zero baseline
    x = by_count.join(groups, ["lang", "source"]).selectExpr(
        "lang", "CAST(number AS INT) AS x", f"{share} AS p", "zero AS zx", "terms"
    )
    y = groups.selectExpr("lang", "CAST(number AS INT) AS y", "zero AS zy")
    baselines = f"({_distance('zx', 'zy')})"
    turned = f"({_distance('zy', 'zx')})"
    one = (
        x.join(y, "lang")
        .filter("x <> y")
        .groupBy("lang", "x", "y")
        .agg(
            F.expr(f"sum(terms * (({_distance('p', 'zy')}) - {baselines}))").alias("mine"),
            F.expr(f"sum(terms * (({_distance('zy', 'p')}) - {turned}))").alias("theirs"),
        )
    )
    mine = one.selectExpr("lang", "x AS a", "y AS b", "mine AS one")
    theirs = one.selectExpr("lang", "y AS a", "x AS b", "theirs AS one")
    parts = both.selectExpr("lang", "a", "b", "both AS one").unionAll(mine).unionAll(theirs)
    parts = parts.groupBy("lang", "a", "b").agg(F.sum("one").alias("part"))
    a = groups.selectExpr("lang", "source", "v", "CAST(number AS INT) AS a", "zero AS za")
    b = groups.selectExpr("lang", "source AS item", "CAST(number AS INT) AS b", "zero AS zb")
    pairs = (
        a.join(b, "lang")
        .filter("a <> b")
        .join(parts, ["lang", "a", "b"], "left")
        .selectExpr(
            "lang", "source", "'pair' AS part", "item",
            f"CAST(IF(v = 0, 0, v * ({_distance('za', 'zb')}) + coalesce(part, 0)) AS BIGINT) AS value",
        )
    )
    terms = (
        entries.join(groups, ["lang", "source"])
        .selectExpr("lang", "source", "'term' AS part", "term AS item", f"{share} AS p", f"{_share('all_times', 'n_lang + v')} AS q")
        .filter("p > q")
        .selectExpr("lang", "source", "part", "item", f"CAST({_distance('p', 'q')} AS BIGINT) AS value")
    )
    best = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = F.row_number().over(best).alias("rank")
    return pairs.select("*", ranked).unionAll(terms.select("*", ranked).filter(F.col("rank") <= term_ranks))
