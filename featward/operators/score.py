"""Score rows with a model, bin the probability and shape the scored output. No shuffle anywhere."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featward.functions.bins import DECISION_BINS, Bin, bin_of, class_of
from featward.functions.names import as_list, named, refuse_taken
from featward.functions.text import day_month_year
from featward.operators.models import MAX_MODEL_BYTES, LogisticModel, MlClassifier, TreeEnsemble, model_bytes

PROBA = "PREDICTED_PROBA"
SCENARIO = "71621"  # fixed value: the scenario id of the output


def _sigmoid(margin: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def _logistic(model: LogisticModel) -> Column:
    terms = [F.lit(float(model.intercept))]
    terms += [F.lit(w) * named(f).cast("double") for f, w in zip(model.features, model.weights)]
    while len(terms) > 1:  # add in pairs: a plain chain of many features nests too deep
        terms = [sum(terms[i + 1 : i + 2], terms[i]) for i in range(0, len(terms), 2)]
    return _sigmoid(terms[0])


def _tree_case(node: dict, single: bool) -> Column:
    if "leaf" in node:
        return F.lit(float(node["leaf"]))
    branch = {c["nodeid"]: _tree_case(c, single) for c in node["children"]}
    kind = "float" if single else "double"
    value = named(node["split"]).cast(kind)
    missing = value.isNull() | F.isnan(value)
    below = value < F.lit(float(node["split_condition"])).cast(kind)
    if node["missing"] == node["yes"]:
        return F.when(missing | below, branch[node["yes"]]).otherwise(branch[node["no"]])
    return F.when(~missing & below, branch[node["yes"]]).otherwise(branch[node["no"]])


def _trees_native(model: TreeEnsemble) -> Column:
    margin = F.lit(float(model.base_margin))
    for tree in model.trees:
        margin = margin + _tree_case(tree, model.single_precision)
    return margin


TREES_AT_ONCE = 8  # trees whose leaves a row crosses out together
ROWS_AT_ONCE = 4096
MANY_TREES = 32  # from so many on, rows that fall into the same cell of all thresholds are scored once
CELLS = 1 << 17  # that a task remembers, 16 bytes each
MOST_LEAVES = 512  # of a tree that is scored by its leaves; a larger one is walked down


def _leaves(node: dict) -> int:
    waiting, found = [node], 0
    while waiting:
        node = waiting.pop()
        found += "leaf" in node
        waiting.extend(node.get("children", ()))
    return found


def _leaf_table(trees: Sequence[dict], order: dict[str, int], thresholds: list[np.ndarray], words: int) -> dict:
    """A few trees as masks of leaves, ``words`` 64-bit words each, sorted by feature and threshold.

    Leaves are numbered from the yes side to the no side. A split whose condition is false rules out all leaves on its
    yes side; a row lands on the first leaf that is left. The splits of one feature that are false for a value are those with
    thresholds up to it, so one row of masks per stretch between thresholds says what they rule out together,
    in all these trees. The last row of masks is that of a missing value.
    """
    splits: list[list[tuple]] = [[] for _ in order]  # per feature (threshold, tree, mask, false if missing)
    values = np.zeros((len(trees), 64 * words))

    def place(tree: int, node: dict, first: int) -> int:
        """Number the leaves below from ``first`` on; returns the number after the last."""
        if "leaf" in node:
            values[tree, first] = float(node["leaf"])
            return first + 1
        below = {c["nodeid"]: c for c in node["children"]}
        middle = place(tree, below[node["yes"]], first)
        ruled_out = ((1 << middle) - 1) ^ ((1 << first) - 1)
        mask = [~(ruled_out >> 64 * w) & (1 << 64) - 1 for w in range(words)]
        feature = order[node["split"]]
        splits[feature].append((float(node["split_condition"]), tree, mask, node["missing"] != node["yes"]))
        return place(tree, below[node["no"]], middle)

    for number, tree in enumerate(trees):
        place(number, tree, 0)
    parts = []
    for feature, found in enumerate(splits):
        if not found:
            continue
        every = thresholds[feature]
        # a condition that compares with NaN is never true
        own = np.array([-np.inf if np.isnan(t) else t for t, *_ in found]).astype(every.dtype)
        steps = np.unique(own)
        masks = np.full((len(steps) + 2, len(trees), words), ~np.uint64(0))
        for at, (_, tree, mask, if_missing) in zip(np.searchsorted(steps, own), found):
            masks[at + 1, tree] &= np.array(mask, np.uint64)
            if if_missing:
                masks[-1, tree] &= np.array(mask, np.uint64)
        np.bitwise_and.accumulate(masks[:-1], axis=0, out=masks[:-1])
        stretch = np.concatenate([[0], np.searchsorted(steps, every, "right"), [len(steps) + 1]])
        parts.append((feature, stretch.astype(np.int32), masks.reshape(len(masks), -1)))
    return {"parts": parts, "values": values, "words": words}


def _walk_table(root: dict, order: dict[str, int], kind: np.dtype) -> dict:
    """A tree as flat arrays; a leaf points to itself, so walking on from it changes nothing."""
    feature, threshold, yes, no, missing, value = [], [], [], [], [], []

    def place(node: dict) -> tuple[int, int]:
        at = len(value)
        for column in (feature, threshold, yes, no, missing, value):
            column.append(0)
        if "leaf" in node:
            yes[at] = no[at] = missing[at] = at
            value[at] = float(node["leaf"])
            return at, 0
        below = {c["nodeid"]: place(c) for c in node["children"]}
        feature[at], threshold[at] = order[node["split"]], float(node["split_condition"])
        yes[at], no[at], missing[at] = (below[node[k]][0] for k in ("yes", "no", "missing"))
        return at, 1 + max(depth for _, depth in below.values())

    _, depth = place(root)
    columns = {"feature": feature, "yes": yes, "no": no, "missing": missing}
    table = {name: np.array(column, np.int32) for name, column in columns.items()}
    return table | {"depth": depth, "threshold": np.array(threshold, kind), "value": np.array(value, np.float64)}


def _tree_tables(model: TreeEnsemble, order: dict[str, int], kind: np.dtype) -> tuple[list[np.ndarray], list[dict]]:
    """All thresholds of each feature, rising, and the trees in their order as tables."""
    every: list[set[float]] = [set() for _ in order]
    for node in model.nodes():
        if "leaf" not in node:
            t = float(node["split_condition"])
            every[order[node["split"]]].add(-np.inf if np.isnan(t) else t)
    thresholds = [np.unique(np.array(sorted(t), kind)) for t in every]
    tables: list[dict] = []
    held: list[dict] = []
    words = 0

    def flush() -> None:
        if held:
            tables.append(_leaf_table(held, order, thresholds, words))
        held.clear()

    for tree in model.trees:
        leaves = _leaves(tree)
        own = -(-leaves // 64)
        if leaves > MOST_LEAVES or own != words or len(held) * own >= TREES_AT_ONCE:
            flush()
        words = own
        if leaves > MOST_LEAVES:
            tables.append(_walk_table(tree, order, kind))
        else:
            held.append(tree)
    flush()
    return thresholds, tables


def _trees_udf(model: TreeEnsemble) -> Column:
    """The margin, its trees added up in the same order and over the same casts as in generated code."""
    splits = {n["split"] for n in model.nodes() if "leaf" not in n}
    used = [f for f in model.features if f in splits]
    if not used:
        return _trees_native(model)
    kind = np.dtype(np.float32 if model.single_precision else np.float64)
    # Part of the function, and not a broadcast of ours that somebody would have to release; Spark sends
    # a large function as a broadcast of its own.
    thresholds, tables = _tree_tables(model, {name: i for i, name in enumerate(used)}, kind)
    base, rows_at_once = float(model.base_margin), ROWS_AT_ONCE

    # What follows uses only its own names, so that executors need no copy of this package.
    def add_landed(table: dict, ranks: list[np.ndarray], total: np.ndarray) -> None:
        """Add the value of the leaf that each row lands on, one tree after the other."""
        values, words = table["values"], table["words"]
        left = None
        for feature, stretch, masks in table["parts"]:
            mine = masks.take(stretch.take(ranks[feature]), 0, mode="clip")
            left = mine if left is None else np.bitwise_and(left, mine, out=left)
        if left is None:
            for leaf in values[:, 0]:
                total += leaf
            return
        word = 0
        if words > 1:
            left = left.reshape(len(left), len(values), words)
            word = (left != 0).argmax(2)
            left = np.take_along_axis(left, word[:, :, None], 2)[:, :, 0]
        np.bitwise_and(left, np.negative(left), out=left)
        np.subtract(left, np.uint64(1), out=left)
        leaf = (np.bitwise_count(left) + 64 * word).T.astype(np.intp)
        for own, at in zip(values, leaf):
            total += own.take(at, mode="clip")

    def walked(table: dict, x: np.ndarray, absent: np.ndarray) -> np.ndarray:
        rows, node = np.arange(len(x)), np.zeros(len(x), np.int32)
        for _ in range(table["depth"]):
            at = table["feature"][node]
            side = np.where(x[rows, at] < table["threshold"][node], table["yes"][node], table["no"][node])
            node = np.where(absent[rows, at], table["missing"][node], side)
        return table["value"][node]

    def margins(x: list[np.ndarray], ranks: list[np.ndarray]) -> np.ndarray:
        margin = np.full(len(x[0]), base)
        for start in range(0, len(margin), rows_at_once):
            part = slice(start, start + rows_at_once)
            mine, total = [r[part] for r in ranks], margin[part]
            for table in tables:
                if "parts" in table:
                    add_landed(table, mine, total)
                else:
                    stacked = np.column_stack([c[part] for c in x])
                    total += walked(table, stacked, np.isnan(stacked))
        return margin

    # rows between the same thresholds land on the same leaves: a cell is scored when it first comes up
    sizes = [len(t) + 2 for t in thresholds]
    by_cell = len(model.trees) >= MANY_TREES and math.prod(sizes) < 1 << 62
    strides = [math.prod(sizes[:i]) for i in range(len(sizes))] if by_cell else []
    most_cells = CELLS

    @F.pandas_udf("double")
    def margin_of(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        known, known_margin = np.zeros(0, np.int64), np.zeros(0)
        for columns in batches:
            columns = (columns,) if isinstance(columns, pd.Series) else columns  # one column comes on its own
            x = [c.to_numpy(kind) for c in columns]
            ranks = [np.where(np.isnan(c), len(t) + 1, np.searchsorted(t, c, "right")) for c, t in zip(x, thresholds)]
            if not by_cell:
                yield pd.Series(margins(x, ranks))
                continue
            cells, first, back = np.unique(sum(r * s for r, s in zip(ranks, strides)), return_index=True, return_inverse=True)
            margin = np.zeros(len(cells))
            place = np.searchsorted(known, cells)
            held = np.append(known, -1)[place] == cells
            margin[held] = known_margin[place[held]]
            new = first[~held]
            margin[~held] = margins([c[new] for c in x], [r[new] for r in ranks])
            if len(new) and len(known) + len(new) <= most_cells:
                known, known_margin = (np.concatenate(c) for c in ((known, cells[~held]), (known_margin, margin[~held])))
                order = np.argsort(known)
                known, known_margin = known[order], known_margin[order]
            yield pd.Series(margin[back])

    return margin_of(*[named(f).cast("float" if model.single_precision else "double") for f in used])


def _ml_scored(df: DataFrame, model: MlClassifier, kept: list[str]) -> DataFrame:
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    # internal names throughout: the model adds columns of its own, whose names may be taken
    passed = [f"_kept{i}" for i in range(len(kept))]
    given = [f"_feature{i}" for i in range(len(model.features))]
    assembler = VectorAssembler(
        inputCols=given, outputCol=model.model.getFeaturesCol(), handleInvalid="keep"
    )
    inputs = df.select(
        *[named(c).alias(p) for c, p in zip(kept, passed)],
        *[named(f).cast("double").alias(g) for f, g in zip(model.features, given)],
    )
    scored = model.model.transform(assembler.transform(inputs))
    complete = F.expr(" AND ".join(f"{g} IS NOT NULL" for g in given))
    proba = F.when(complete, vector_to_array(F.col(model.model.getProbabilityCol()))[1])
    return scored.select(*passed, proba).toDF(*kept, PROBA)


def score(
    df: DataFrame,
    model: LogisticModel | TreeEnsemble | MlClassifier,
    feature_cols: Sequence[str] | None = None,
    keep: str | Iterable[str] = (),
    engine: str = "udf",
    max_model_bytes: int = MAX_MODEL_BYTES,
) -> DataFrame:
    """``keep`` columns, the model's features in its own order, and ``PREDICTED_PROBA``.

    ``feature_cols`` names the frame's columns for the model's features, in that order, where
    they are called differently; a kept column may then not have the name of a feature that comes
    from another one. A NULL feature gives a NULL probability; trees send it down their missing
    branch. ``engine`` for trees: a vectorised ``udf``, for ensembles of any size, or ``native`` expressions inside
    generated code, for a handful of small trees where no Python worker is wanted; they give the same bits. A model whose
    parameters take more than ``max_model_bytes`` (:func:`model_bytes`) is refused.
    """
    if engine not in ("native", "udf"):
        raise ValueError("engine is 'native' or 'udf'")
    if (size := model_bytes(model)) > max_model_bytes:
        raise ValueError(f"the model takes {size} bytes; max_model_bytes is {max_model_bytes}")
    keep = as_list(keep)
    if feature_cols is not None:
        if len(feature_cols) != len(model.features):
            raise ValueError(f"the model has features {list(model.features)}")
        moved = {f for c, f in zip(feature_cols, model.features) if c != f}
        if lost := sorted(moved & set(keep)):
            raise ValueError(f"kept columns {lost} have the names of features that come from other columns")
        kept = [named(c) for c in keep if c not in model.features]
        df = df.select(*kept, *[named(c).alias(f) for c, f in zip(feature_cols, model.features)])
    kept = [*[c for c in keep if c not in model.features], *model.features]
    refuse_taken(kept, [PROBA])
    if isinstance(model, MlClassifier):
        return _ml_scored(df, model, kept)
    if isinstance(model, LogisticModel):
        proba = _logistic(model)
    else:
        proba = _sigmoid(_trees_native(model) if engine == "native" else _trees_udf(model))
    return df.select(*[named(c) for c in kept], proba.alias(PROBA))


def assign_bin(
    df: DataFrame,
    proba_col: str = PROBA,
    table: Sequence[Bin] = tuple(DECISION_BINS),
    default: int | Column = 1,
) -> DataFrame:
    """Add ``BIN``: the last bin of the table, both ends included, that holds the probability.

    Outside all bins, NULL or NaN: ``default``, which may be a column such as the old ``BIN``.
    """
    return df.withColumn("BIN", bin_of(named(proba_col), table, default))


def class_id(df: DataFrame) -> DataFrame:
    """Add ``CLASS_ID``: ``C`` and the bin number; NULL for a NULL bin."""
    return df.withColumn("CLASS_ID", class_of(F.col("BIN")))


def scored_output(
    df: DataFrame,
    run_dt: str | Column,
    scenario_id: str = SCENARIO,
    cust_col: str | None = None,
) -> DataFrame:
    """The eight output columns from a frame with ``PREDICTED_PROBA`` and ``BIN``.

    ``run_dt`` is ``YYYYMMDD`` and comes out as ``DD-Mon-YYYY``; a bad date is an error.
    ``CUST_ID`` is ``cust_col`` as text, or ''.
    """
    blank = F.lit("")
    return df.select(
        (named(cust_col).cast("string") if cust_col else blank).alias("CUST_ID"),
        blank.alias("AA_NODE_PATH_ATTR_CHAR"),
        F.col(PROBA),
        F.col("BIN").cast("double").alias("BIN"),
        class_of(F.col("BIN")).alias("CLASS_ID"),
        day_month_year(run_dt).alias("PRCSNG_DT"),
        F.lit(scenario_id).alias("SCNRO_ID"),
        blank.alias("DECISION_PATH_FEATURE_LIST"),
    )
