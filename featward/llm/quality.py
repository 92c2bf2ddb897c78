"""Text quality by a sparse rule ensemble: tree paths over text statistics, weighted by a lasso."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featward.llm.sample import SAMPLE_ROWS, labelled_sample
from featward.llm.words import SPACE, chunks, distinct_per_text, words_of
from featward.session import new_scratch

STATISTICS = (
    "log_bytes", "log_words", "word_length", "upper", "digit", "symbol", "punctuation", "bang", "bar",
    "space", "line", "high", "distinct_words", "repeated_next", "long_words", "short_words",
)
TREES = 24
DEPTH = 3
LASSO = 0.001
FOUND = "__text_statistics"


def _class(characters: str) -> np.ndarray:
    mask = np.zeros(256, bool)
    mask[list(characters.encode())] = True
    return mask


_SHARES = {
    "upper": _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    "digit": _class("0123456789"),
    "symbol": _class("#$%&*+<=>@\\^_`{}~"),
    "punctuation": _class(".,;:?'\"-()"),
    "bang": _class("!"),
    "bar": _class("|/"),
    "space": SPACE,
    "line": _class("\n"),
    "high": np.arange(256) >= 128,
}


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def statistics_of(texts) -> np.ndarray:
    """One row of STATISTICS per text; all shares of an empty text are 0."""
    n_bytes = np.diff(texts.offsets).astype(float)
    words = words_of(texts)
    counts = words.counts.astype(float)
    some_bytes, some_words = np.maximum(n_bytes, 1), np.maximum(counts, 1)
    columns = {"log_bytes": np.log1p(n_bytes), "log_words": np.log1p(counts)}
    for name, mask in _SHARES.items():
        columns[name] = _sums(mask[texts.data], texts.offsets) / some_bytes
    lengths = (words.ends - words.starts).astype(float)
    columns["word_length"] = _sums(lengths, words.offsets) / some_words
    columns["long_words"] = _sums(lengths > 24, words.offsets) / some_words
    columns["short_words"] = _sums(lengths < 3, words.offsets) / some_words
    columns["distinct_words"] = np.diff(distinct_per_text(words.hashes, words.offsets)[1]) / some_words
    again = np.zeros(len(words.hashes), bool)
    again[1:] = words.hashes[1:] == words.hashes[:-1]
    heads = words.offsets[:-1][words.counts > 0]
    again[heads] = False
    columns["repeated_next"] = _sums(again, words.offsets) / some_words
    return np.column_stack([columns[name] for name in STATISTICS])


def with_statistics(df: DataFrame, text_col: str, into: str) -> DataFrame:
    """The frame with a struct column of doubles, one per statistic; NULL text counts as empty."""
    kind = f"struct<{','.join(f'{name}:double' for name in STATISTICS)}>"

    @F.arrow_udf(kind)
    def measure(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            rows = [statistics_of(texts) for texts in chunks(column)]
            table = np.vstack([*rows, np.zeros((0, len(STATISTICS)))])
            yield pa.StructArray.from_arrays(
                [pa.array(np.ascontiguousarray(table[:, i])) for i in range(len(STATISTICS))], list(STATISTICS)
            )

    return df.withColumn(into, measure(F.col(text_col)))


@dataclass(frozen=True)
class Rule:
    """A conjunction: for each statistic (by number), above one bound and not above another."""

    bounds: tuple[tuple[int, float, float], ...]  # (statistic, low, high]: low < x <= high

    def condition(self, names: Sequence[str], source: str) -> str:
        tests = []
        for number, low, high in self.bounds:
            value = f"{source}.{names[number]}"
            tests += [f"{value} > {low!r}D"] * (low > -math.inf) + [f"{value} <= {high!r}D"] * (high < math.inf)
        return " AND ".join(tests)


@dataclass
class RuleModel:
    rules: list[Rule]
    weights: list[float]
    intercept: float
    names: tuple[str, ...] = STATISTICS

    def score(self, source: str) -> Column:
        """The probability as one expression over the struct of statistics called ``source``."""
        terms = [f"IF({r.condition(self.names, source)}, {w!r}D, 0D)" for r, w in zip(self.rules, self.weights) if w]
        margin = " + ".join([f"{self.intercept!r}D", *terms])
        return F.expr(f"1D / (1D + exp(-({margin})))")


_SPLIT = re.compile(r"^( *)(If|Else) \(feature (\d+) (<=|>) ([-+0-9.Ee]+)\)$")


def tree_paths(dump: str) -> set[Rule]:
    """All conjunctions on the way from a dumped tree's root to any of its nodes."""
    rules, path = set(), []
    for line in dump.splitlines():
        if not (found := _SPLIT.match(line)):
            continue
        depth, _, number, sign, bound = found.groups()
        path = [step for step in path if step[0] < len(depth)] + [(len(depth), int(number), sign, float(bound))]
        box: dict[int, tuple[float, float]] = {}
        for _, n, s, b in path:
            low, high = box.get(n, (-math.inf, math.inf))
            box[n] = (low, min(high, b)) if s == "<=" else (max(low, b), high)
        rules.add(Rule(tuple((n, low, high) for n, (low, high) in sorted(box.items()))))
    return rules


def fit_rules(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = SAMPLE_ROWS,
    trees: int = TREES,
    depth: int = DEPTH,
    lasso: float = LASSO,
) -> RuleModel:
    """Rules and weights from at most ``limit`` labelled rows (:func:`labelled_sample`).

    A random forest of shallow trees gives the rules, a logistic regression with an L1 penalty over
    them the weights, most of which it sets to 0. Both are Spark's own and count a row by what it
    stands for. Without labels of both kinds the model has no rule and scores every text alike.
    """
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    sample = labelled_sample(docs, labels, label_col, id_col, text_col, limit)
    path = new_scratch(docs.sparkSession, "text-statistics")
    with_statistics(sample, "text", "s").select("label", "weight", "s").write.parquet(path)
    measured = docs.sparkSession.read.parquet(path)
    seen = {r["label"]: r["w"] for r in measured.groupBy("label").agg(F.sum("weight").alias("w")).collect()}
    if len(seen) < 2:
        return RuleModel([], [], 4.0 if 1 in seen else -4.0 if 0 in seen else 0.0)

    flat = measured.select("label", "weight", "s", *[F.col(f"s.{name}").alias(name) for name in STATISTICS])
    vectors = VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(flat)
    forest = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, seed=11, weightCol="weight", subsamplingRate=0.7, cacheNodeIds=False
    ).fit(vectors)
    rules = sorted({r for tree in forest.trees for r in tree_paths(tree.toDebugString)}, key=lambda r: r.bounds)
    if not rules:
        share = seen[1] / (seen[0] + seen[1])
        return RuleModel([], [], math.log(share / (1 - share)))
    tested = measured.select(
        "label",
        "weight",
        *[F.expr(f"IF({r.condition(STATISTICS, 's')}, 1D, 0D)").alias(f"r{i}") for i, r in enumerate(rules)],
    )
    vectors = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="features").transform(tested)
    fitted = LogisticRegression(
        elasticNetParam=1.0, regParam=lasso, maxIter=60, weightCol="weight", standardization=False
    ).fit(vectors.select("label", "weight", "features"))
    return RuleModel(rules, [float(w) for w in fitted.coefficients], float(fitted.intercept))


def score_quality(df: DataFrame, model: RuleModel, text_col: str = "text") -> DataFrame:
    """The frame with ``score``: how likely a good text (label 1), from 0 to 1.

    One Arrow function measures the text, and the rules are one built-in expression over that. Row by
    row, no shuffle. NULL and empty text are scored too, with 0 for every statistic. A column called
    score is replaced.
    """
    rows = with_statistics(df.drop("score"), text_col, FOUND)
    return rows.withColumn("score", model.score(FOUND)).drop(FOUND)
