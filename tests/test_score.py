"""Models, bins, the scored output, numeric text, look-back."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from featward import (
    LogisticModel,
    MlClassifier,
    TreeEnsemble,
    assign_bin,
    class_id,
    load_model,
    load_tree_dump,
    lookback_dates,
    lookback_select,
    non_numeric_values,
    save_model,
    score,
    scored_output,
)
from featward.functions.bins import Bin
from featward.operators import score as scoring
from featward.plans.inputs import TREES

NAN = float("nan")


def sigmoid(z):
    return 1 / (1 + math.exp(-z))


def test_logistic(spark):
    model = LogisticModel(("b", "a"), (2.0, -1.0), 0.5)
    frame = spark.createDataFrame([(1, 1.0, 2.0), (2, None, 2.0), (3, 0.0, 0.0)], "id int, a double, b double")
    got = score(frame, model, keep="id")
    assert got.columns == ["id", "b", "a", "PREDICTED_PROBA"]
    proba = {r.id: r.PREDICTED_PROBA for r in got.collect()}
    assert proba[2] is None
    assert proba[1] == pytest.approx(sigmoid(3.5)) and proba[3] == pytest.approx(sigmoid(0.5))


def test_feature_columns_under_other_names(spark):
    model = LogisticModel(("b", "a"), (2.0, -1.0))
    frame = spark.createDataFrame([(1, 1.0, 2.0)], "id int, x double, y double")
    (row,) = score(frame, model, feature_cols=["y", "x"], keep=["id"]).collect()
    assert (row.id, row.b, row.a) == (1, 2.0, 1.0)
    assert row.PREDICTED_PROBA == pytest.approx(sigmoid(3.0))
    with pytest.raises(ValueError):
        score(frame, model, feature_cols=["y"])
    with pytest.raises(ValueError):
        LogisticModel(("a",), (1.0, 2.0))


def test_many_features(spark):
    names = [f"f{i}" for i in range(1500)]
    frame = spark.range(1).selectExpr("id", *[f"cast({i} as double) AS {n}" for i, n in enumerate(names)])
    model = LogisticModel(names, [1e-6] * len(names))
    (row,) = score(frame, model).select("PREDICTED_PROBA").collect()
    assert row[0] == pytest.approx(sigmoid(1e-6 * sum(range(1500))))


def random_tree(draw, features, depth):
    """A tree of the dumped form, its ids numbered through."""
    ids = iter(range(10**6))

    def node(level):
        at = next(ids)
        if level == 0 or draw.random() < 0.2:
            return {"nodeid": at, "leaf": draw.uniform(-1, 1)}
        yes, no = node(level - 1), node(level - 1)
        missing = draw.choice([yes, no])["nodeid"]
        return {
            "nodeid": at, "split": draw.choice(features), "split_condition": draw.choice([0.1, 0.5, 2.0]),
            "yes": yes["nodeid"], "no": no["nodeid"], "missing": missing, "children": [no, yes],
        }

    return node(depth)


def walk(node, row):
    while "leaf" not in node:
        x = row[node["split"]]
        if x is None or math.isnan(x):
            target = node["missing"]
        else:
            target = node["yes"] if x < node["split_condition"] else node["no"]
        node = next(c for c in node["children"] if c["nodeid"] == target)
    return node["leaf"]


def test_trees_native_and_udf_against_brute_force(spark):
    draw = random.Random(1)
    features = ["a", "b", "c"]
    model = TreeEnsemble(features, [random_tree(draw, features, 4) for _ in range(12)], base_margin=0.25)
    values = [
        (i, *[draw.choice([None, NAN, 0.0, 0.1, 0.5, 0.49, 2.0, -3.0]) for _ in features]) for i in range(400)
    ]
    frame = spark.createDataFrame(values, "id int, a double, b double, c double").repartition(3)
    expected = {
        i: sigmoid(0.25 + sum(walk(t, dict(zip(features, row))) for t in model.trees)) for i, *row in values
    }
    for engine in ("native", "udf"):
        got = {r.id: r.PREDICTED_PROBA for r in score(frame, model, keep="id", engine=engine).collect()}
        assert got == pytest.approx(expected, abs=1e-12)


def test_single_precision_split(spark):
    """0.1 equals the 32-bit threshold as a 32-bit float, but is below it as a double."""
    leaf = lambda at, v: {"nodeid": at, "leaf": v}
    tree = {
        "nodeid": 0, "split": "a", "split_condition": 0.100000001490116, "yes": 1, "no": 2, "missing": 1,
        "children": [leaf(1, 1.0), leaf(2, -1.0)],
    }
    frame = spark.createDataFrame([(0.1,)], "a double")
    for single, margin in ((False, 1.0), (True, -1.0)):
        model = TreeEnsemble(("a",), (tree,), single_precision=single)
        for engine in ("native", "udf"):
            assert score(frame, model, engine=engine).first()[1] == pytest.approx(sigmoid(margin))


@pytest.mark.parametrize("most_leaves", [512, 40, 1])
def test_trees_of_all_sizes_are_added_up_in_their_order(spark, monkeypatch, most_leaves):
    """Lone leaves, small trees, trees of several words of leaves, chains, and trees that are walked."""
    monkeypatch.setattr(scoring, "MOST_LEAVES", most_leaves)
    monkeypatch.setattr(scoring, "MANY_TREES", 5 if most_leaves == 40 else 10**6)
    monkeypatch.setattr(scoring, "CELLS", 300)
    draw = random.Random(6)
    features = ["a", "b", "c"]

    def chain(depth, at=0):
        if not depth:
            return {"nodeid": at, "leaf": draw.uniform(-1, 1)}
        below = [{"nodeid": at + 1, "leaf": draw.uniform(-1, 1)}, chain(depth - 1, at + 2)]
        yes, no = draw.sample(below, 2)
        return {
            "nodeid": at, "split": draw.choice(features), "split_condition": draw.choice([draw.uniform(-1, 1), NAN, 1e9, -1e9, 0.5]),
            "yes": yes["nodeid"], "no": no["nodeid"], "missing": draw.choice(below)["nodeid"], "children": below,
        }

    trees = [random_tree(draw, features, d) for d in (1, 7, 7, 3, 8, 2, 9, 5, 6)] + [chain(150), chain(3)]
    trees += [{"nodeid": 0, "leaf": 0.125}, random_tree(draw, features, 4), {"nodeid": 0, "leaf": 1e-9}]
    draw.shuffle(trees)
    model = TreeEnsemble(features, trees, base_margin=0.3)
    values = [(i, *[draw.choice([None, NAN, 0.5, 1e9, -1e9, math.inf, -math.inf, draw.uniform(-1.2, 1.2)]) for _ in features]) for i in range(500)]
    frame = spark.createDataFrame(values, "id int, a double, b double, c double").coalesce(1)
    got = {r.id: r.PREDICTED_PROBA for r in score(frame, model, keep="id").collect()}
    expected = {}
    for i, *row in values:
        margin = 0.3
        for tree in trees:
            margin += walk(tree, dict(zip(features, row)))
        expected[i] = sigmoid(margin)
    assert got == pytest.approx(expected, abs=1e-15)


@pytest.mark.parametrize("single", [False, True])
def test_both_engines_give_the_same_bits(spark, plan, single):
    draw = random.Random(2)
    features = ["a", "b", "c", "never_split_on"]
    model = TreeEnsemble(features, [random_tree(draw, features[:3], 5) for _ in range(60)], 0.1, single)
    rows = spark.range(0, 200_000, 1, 4).selectExpr(
        "id",
        "IF(id % 11 = 0, NULL, (id * 7919 % 1000) / 400D) AS a",
        "CAST((id * 104729 % 1000) / 300D AS DECIMAL(12, 8)) AS b",
        "IF(id % 13 = 0, double('NaN'), (id * 1299709 % 1000) / 2000D) AS c",
        "'text' AS never_split_on",
    )
    native, udf = (score(rows, model, keep="id", engine=e) for e in ("native", "udf"))
    assert "Python" not in plan(native) and "ArrowEvalPython" in plan(udf)
    other = udf.select("id", F.col("PREDICTED_PROBA").alias("other"))
    both = native.join(other, "id")
    assert both.count() == 200_000
    assert both.filter("PREDICTED_PROBA IS DISTINCT FROM other").count() == 0


def test_score_refuses(spark):
    draw = random.Random(2)
    frame = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    model = TreeEnsemble(("a", "b"), [random_tree(draw, ["a", "b"], 6) for _ in range(60)])
    with pytest.raises(ValueError, match="engine"):
        score(frame, model, engine="auto")
    with pytest.raises(ValueError, match="max_model_bytes"):
        score(frame, model, max_model_bytes=1000)
    with pytest.raises(ValueError, match="unknown features"):
        TreeEnsemble(("a",), model.trees)
    logistic = LogisticModel(("a",), (1.0,))
    with pytest.raises(ValueError, match=r"\['a'\]"):
        score(frame, logistic, feature_cols=["b"], keep=["a"])
    assert score(frame, logistic, feature_cols=["a"], keep=["a", "b"]).columns == ["b", "a", "PREDICTED_PROBA"]


def test_tree_dump(spark, tmp_path):
    leaf = lambda at, v: {"nodeid": at, "leaf": v}
    split = {"nodeid": 0, "depth": 0, "split_condition": 0.5, "yes": 1, "no": 2, "missing": 1}
    trees = [{**split, "split": s, "children": [leaf(1, v), leaf(2, -v)]} for s, v in (("b", 1.0), ("f0", 0.25))]
    (tmp_path / "dump.json").write_text(json.dumps(trees))
    model = load_tree_dump(spark, f"{tmp_path}/dump.json", ["a", "b"], base_margin=0.5)
    frame = spark.createDataFrame([(0.0, 1.0), (1.0, None)], "a double, b double")
    got = [r.PREDICTED_PROBA for r in score(frame, model).collect()]
    assert got == pytest.approx([sigmoid(0.5 - 1 + 0.25), sigmoid(0.5 + 1 - 0.25)])
    (tmp_path / "other.json").write_text("{}")
    with pytest.raises(ValueError, match="not a list"):
        load_tree_dump(spark, f"{tmp_path}/other.json", ["a"])


def test_model_files(spark, tmp_path):
    for model in (TREES, LogisticModel(("a", "b"), (1.0, 2.0), 3.0)):
        save_model(spark, model, f"{tmp_path}/model")
        assert load_model(spark, f"{tmp_path}/model") == model
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        load_model(spark, f"{tmp_path}/none")
    (tmp_path / "bad").write_text("not a model")
    with pytest.raises(ValueError):
        load_model(spark, f"{tmp_path}/bad")


def test_ml_classifier(spark):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    train = spark.createDataFrame(
        [(0.0, 0.0, 0), (1.0, 0.2, 0), (0.1, 1.0, 1), (1.2, 2.0, 1)], "a double, b double, label int"
    )
    assembled = VectorAssembler(inputCols=["b", "a"], outputCol="features").transform(train)
    fitted = LogisticRegression(regParam=0.1).fit(assembled)
    frame = spark.createDataFrame(
        [(1, 0.5, 0.25, "p"), (2, None, 1.0, "q")], "id int, a double, b double, features string"
    )
    scored = score(frame, MlClassifier(("b", "a"), fitted), keep=["id", "features"])
    assert scored.columns == ["id", "features", "b", "a", "PREDICTED_PROBA"]
    got = {r.id: r.PREDICTED_PROBA for r in scored.collect()}
    weight_b, weight_a = fitted.coefficients
    assert got[1] == pytest.approx(sigmoid(fitted.intercept + weight_b * 0.25 + weight_a * 0.5))
    assert got[2] is None


EDGES = [
    (-0.1, 1), (0.0, 1), (0.0999, 1), (0.10, 2), (0.15, 3), (0.26, 4), (0.40, 5), (0.55, 6), (0.66, 7),
    (0.75, 8), (0.83, 9), (0.91, 10), (1.0, 10), (1.1, 1), (NAN, 1), (None, 1),
]


def test_bins(spark, rows, plan):
    frame = spark.createDataFrame([(i, p) for i, (p, _) in enumerate(EDGES)], "i int, PREDICTED_PROBA double")
    got = assign_bin(frame)
    assert rows(got, "i", "BIN") == sorted(((i, b) for i, (_, b) in enumerate(EDGES)), key=repr)
    assert dict(got.dtypes)["BIN"] == "int"
    assert "Join" not in plan(got) and "Exchange" not in plan(got)


def test_bins_keep_the_old_value(spark, rows):
    frame = spark.createDataFrame([(0.5, 99), (2.0, 99), (None, 99)], "PREDICTED_PROBA double, BIN int")
    assert rows(assign_bin(frame, default=F.col("BIN")), "BIN") == [(5,), (99,), (99,)]
    overlap = [Bin(0, 1, 1), Bin(0.4, 0.6, 2), Bin(0.5, 0.5, 3)]
    assert rows(assign_bin(frame, table=overlap, default=0), "BIN") == [(0,), (0,), (3,)]
    assert rows(assign_bin(frame, table=[], default=7), "BIN") == [(7,)] * 3


def test_class_id(spark, rows):
    frame = spark.createDataFrame([(3.0,), (None,), (10.0,)], "BIN double")
    assert rows(class_id(frame), "CLASS_ID") == [("C10",), ("C3",), (None,)]


def test_scored_output(spark):
    frame = spark.createDataFrame([(7, 0.2, 3)], "id int, PREDICTED_PROBA double, BIN int")
    got = scored_output(frame, "20240305", cust_col="id")
    assert got.dtypes == [
        ("CUST_ID", "string"), ("AA_NODE_PATH_ATTR_CHAR", "string"), ("PREDICTED_PROBA", "double"),
        ("BIN", "double"), ("CLASS_ID", "string"), ("PRCSNG_DT", "string"), ("SCNRO_ID", "string"),
        ("DECISION_PATH_FEATURE_LIST", "string"),
    ]
    assert got.first()[:] == ("7", "", 0.2, 3.0, "C3", "05-Mar-2024", "71621", "")
    assert scored_output(frame, F.lit("20231224"), "9").first()[:] == (
        "", "", 0.2, 3.0, "C3", "24-Dec-2023", "9", "",
    )
    with pytest.raises(ValueError):
        scored_output(frame, "20240230")
    with pytest.raises(Exception, match="PARSE|CAST_INVALID"):
        scored_output(frame.withColumn("d", F.lit("2024xx01")), F.col("d")).collect()


NUMERIC = ["12", " 12 ", "1e3", "-1.5", ".5", "5.", "+7", "1E-4", "9" * 45, "", None]
OTHER = ["1,000", "NaN", "Infinity", "1d", "0x1F", "1e", ".", "-", "12a", "1 2", "   ", "12\n", "1\n2"]


def test_non_numeric(spark, rows):
    frame = spark.createDataFrame([(v,) for v in NUMERIC + OTHER + ["1d"]], "t string")
    got = non_numeric_values(frame, "t")
    assert got.columns == ["t", "value", "message"]
    expected = [(v, v, f"Non-numeric value found: {v}") for v in [*OTHER, "1d"]]
    assert rows(got) == sorted(expected, key=repr)


def test_lookback(spark, rows):
    days = [("20240108", 1), ("20240109", 1), ("20240115", 1), ("20240115", 2), ("20240116", 1), ("20240115", None)]
    txns = spark.createDataFrame(days, "d string, account int")
    accounts = spark.createDataFrame([(1,), (1,), (None,)], "account int")
    expected = [("20240109", 1), ("20240115", 1)]
    for column in (
        F.col("d"),
        F.to_date("d", "yyyyMMdd"),
        F.to_timestamp("d", "yyyyMMdd") + F.expr("interval 23 hours"),
        (F.to_timestamp("d", "yyyyMMdd") + F.expr("interval 23 hours")).cast("timestamp_ntz"),
    ):
        typed = txns.withColumn("when", column)
        for run_dt in ("20240115", "2024-01-15"):
            got = lookback_select(typed, accounts, run_dt, 7, date_col="when", account_col="account")
            assert rows(got, "d", "account") == expected


def test_lookback_dates():
    assert lookback_dates("20240302", 4) == ["20240228", "20240229", "20240301", "20240302"]
    assert lookback_dates("2024-01-01", 1, "%Y-%m-%d") == ["2024-01-01"]
