"""Quality, toxicity and language: held-out accuracy, fits against plain versions, edge cases."""

import math
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from featward.llm.langid import BUCKETS, LanguageModel, fit_languages, identify_languages, mixture
from featward.llm.queries import op4_quality, op5_toxicity, op10_langid, remainder_is, toxic_from
from featward.llm.quality import STATISTICS, Rule, RuleModel, fit_rules, score_quality, tree_paths, with_statistics
from featward.llm.sample import labelled_sample
from featward.llm.toxicity import (
    GRAM_BITS,
    SeverityModel,
    _times,
    fit_cumulative_link,
    fit_severity,
    parts_of,
    predict_severity,
)
from featward.llm.words import chunks

from conftest import DATA

from .conftest import SF

LARGER = str(DATA / "sf0.01")
EDGES = [None, "", " \n", "123 !?", "same text", "same text", "é", "word " * 50_000]


@pytest.fixture
def edge_frame(spark):
    frame = spark.createDataFrame(list(enumerate(EDGES)), "doc_id int, text string")
    clash = ["severity", "grade", "p_toxic", "score", "lang_pred", "languages", "s", "label", "weight", "id"]
    return frame.selectExpr("*", *[f"'clash' AS {c}" for c in clash])


def labels_of(spark, name):
    return spark.read.parquet(f"{LARGER}/labels.parquet").select("doc_id", F.col(name).alias("truth"))


def test_quality_on_held_out_labels(spark):
    scored = op4_quality(spark, LARGER).join(labels_of(spark, "quality"), "doc_id").filter("held_out").toPandas()
    good, bad = scored[scored.truth == 1], scored[scored.truth == 0]
    assert len(scored) > 60 and good.score.min() >= 0 and good.score.max() <= 1
    assert (scored.predicted == scored.truth).mean() > 0.95
    assert np.mean(good.score.values[:, None] > bad.score.values[None, :]) > 0.97
    rows = op4_quality(spark, str(SF)).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows) and len(rows) == 200
    assert all(r.predicted == (r.score >= 0.7) for r in rows)


def test_statistics(spark):
    texts = ["Ab, ab ab!|", "x x x", None]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [r.s.asDict() for r in with_statistics(frame, "text", "s").collect()]
    assert got[0]["upper"] == pytest.approx(1 / 11) and got[0]["bang"] == pytest.approx(1 / 11)
    assert got[0]["distinct_words"] == pytest.approx(1.0) and got[1]["distinct_words"] == pytest.approx(1 / 3)
    assert got[1]["repeated_next"] == pytest.approx(2 / 3) and got[1]["log_words"] == pytest.approx(math.log(4))
    assert set(got[2].values()) == {0.0}


DUMP = """DecisionTreeClassificationModel: uid=x, depth=2, numNodes=5
  If (feature 3 <= 0.25)
   If (feature 0 <= 1.5E-4)
    Predict: 1.0
   Else (feature 0 > 1.5E-4)
    Predict: 0.0
  Else (feature 3 > 0.25)
   If (feature 3 <= 0.5)
    Predict: 0.0
   Else (feature 3 > 0.5)
    Predict: 1.0
"""


def test_tree_paths():
    inf = math.inf
    assert tree_paths(DUMP) == {
        Rule(((3, -inf, 0.25),)),
        Rule(((3, 0.25, inf),)),
        Rule(((0, -inf, 1.5e-4), (3, -inf, 0.25))),
        Rule(((0, 1.5e-4, inf), (3, -inf, 0.25))),
        Rule(((3, 0.25, 0.5),)),
        Rule(((3, 0.5, inf),)),
    }
    assert Rule(((3, 0.25, 0.5),)).condition(STATISTICS, "s") == "s.upper > 0.25D AND s.upper <= 0.5D"


def test_rules_as_an_expression(spark):
    model = RuleModel([Rule(((3, 0.5, math.inf),)), Rule(((3, -math.inf, 0.2), (0, 0.0, 9.0)))], [2.0, -3.0], 0.5)
    frame = spark.createDataFrame([("ABCD",), ("abcd",), ("Ab c",)], "text string")
    got = [r.score for r in score_quality(frame, model).collect()]
    assert got == pytest.approx([1 / (1 + math.exp(-z)) for z in (2.5, -2.5, 0.5)])


def test_quality_edges(spark, edge_frame):
    model = fit_rules(spark.read.parquet(f"{LARGER}/documents.parquet"), spark.read.parquet(f"{LARGER}/labels.parquet"))
    assert 0 < sum(w != 0 for w in model.weights) < len(model.rules)  # sparse
    got = {r.doc_id: r for r in score_quality(edge_frame, model).collect()}
    assert len(got) == len(EDGES) and all(0 <= r.score <= 1 for r in got.values())
    assert got[0].score == got[1].score and got[4].score == got[5].score and got[0].grade == "clash"
    none = spark.createDataFrame([], "doc_id long, quality int")
    empty = fit_rules(edge_frame.select("doc_id", "text"), none)
    assert {r.score for r in score_quality(edge_frame, empty).collect()} == {0.5}
    assert score_quality(edge_frame.limit(0), model).count() == 0


def test_labelled_sample(spark):
    docs = spark.range(30_000).selectExpr("id AS doc_id", "concat('t', id) AS text", "1 AS label", "2 AS weight")
    labels = spark.range(30_000).selectExpr("id AS doc_id", "CAST(id % 10 = 0 AS INT) AS y")
    odd = spark.createDataFrame([(1, 1), (None, 1), (2, None), (3, 7)], "doc_id long, y int")
    sample = labelled_sample(docs, labels.union(odd), "y", limit=8_000)
    n = {r["label"]: (r["n"], r["w"]) for r in sample.groupBy("label").agg(F.count("*").alias("n"), F.sum("weight").alias("w")).collect()}
    assert 3_500 < n[0][0] <= 4_000 and n[1] == (3_000, 3_000.0)
    assert n[0][1] == pytest.approx(26_999, rel=0.05)
    assert sample.filter("id = 1").isEmpty()  # labelled both ways


def test_toxicity_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{LARGER}/{t}.parquet") for t in ("documents", "labels"))
    held_out = remainder_is("doc_id", 4, 2)
    model = fit_severity(docs, labels.filter(~held_out))
    assert len(model.thresholds) == 2 and model.thresholds[0] < model.thresholds[1]
    scored = predict_severity(docs, model).join(labels.filter(held_out).select("doc_id", "toxic"), "doc_id").toPandas()
    toxic, clean = scored[scored.toxic == 1], scored[scored.toxic == 0]
    # about forty toxic texts to learn from, with words of four languages: many have no known word
    above = np.sign(toxic.severity.values[:, None] - clean.severity.values[None, :])
    assert (above + 1).mean() / 2 > 0.8
    assert (clean.p_toxic >= toxic_from(model)).mean() < 0.02
    assert len(op5_toxicity(spark, str(SF)).collect()) == 200


def test_toxicity_recall_by_language(spark):
    """Learned from the four hundred labels of the smaller table, on all labels of the larger one."""
    docs, labels = (spark.read.parquet(f"{LARGER}/{t}.parquet") for t in ("documents", "labels"))
    model = fit_severity(docs, labels)
    docs, labels = (spark.read.parquet(str(DATA / f"sf0.1/{t}.parquet")) for t in ("documents", "labels"))
    truth = docs.select("doc_id", "lang", "text").join(labels.select("doc_id", F.col("toxic").alias("truth")), "doc_id")
    scored = predict_severity(truth, model).select("lang", "truth", "p_toxic").toPandas()
    found = scored.p_toxic >= toxic_from(model)
    assert found[scored.truth == 0].mean() < 0.005
    recall = found[scored.truth == 1].groupby(scored.lang).mean()
    assert set(recall.index) == {"de", "en", "es", "fr"} and recall.min() > 0.8


def test_parts_of_words():
    texts = next(chunks(pa.array(["Réeuxon RÉEUXEUX réeuxon", "", "ab réeuxon", "réeux"])))
    text, part, numbers = parts_of(texts)
    assert numbers.tolist() == [2, 0, 2, 1]
    shared = set(part[text == 0]) & set(part[text == 3])
    assert shared >= set(part[text == 2]) & set(part[text == 3]) and len(shared) >= 2
    where, place, times = _times(text, part, 1 << GRAM_BITS)
    assert set(where) == {0} and set(times) == {2}  # the repeated word counts once


def test_cumulative_link_finds_the_weights():
    draw = np.random.default_rng(5)
    n, truth, cuts = 20_000, np.array([2.0, 0.0, 0.5]), np.array([-0.5, 1.5])
    x = draw.normal(size=(n, 3))
    grade = (x @ truth + draw.logistic(size=n) > cuts[:, None]).sum(0)
    text, place = np.repeat(np.arange(n), 3), np.tile(np.arange(3), n)
    w, t = fit_cumulative_link(text, place, x.ravel(), grade, np.ones(n), 3, 3)
    assert w == pytest.approx(truth, abs=0.12) and t == pytest.approx(cuts, abs=0.12)


def test_severity_is_the_expected_grade(spark, edge_frame):
    docs, labels = (spark.read.parquet(f"{LARGER}/{t}.parquet") for t in ("documents", "labels"))
    model = fit_severity(docs, labels)
    got = {r.doc_id: r for r in predict_severity(edge_frame, model).collect()}
    assert len(got) == len(EDGES) and got[0].severity == got[1].severity == got[2].severity
    base = 1 / (1 + np.exp(model.thresholds))
    assert got[0].severity == pytest.approx(base.sum()) and got[0].p_toxic == pytest.approx(base[0])
    assert all(0 <= r.severity <= 2 and r.grade in (0, 1, 2) for r in got.values())
    assert predict_severity(edge_frame.limit(0), model).count() == 0
    assert base[0] < toxic_from(model) < 0.5 and toxic_from(SeverityModel()) > 1
    none = fit_severity(docs, labels.limit(0))
    assert none.words.size == 0
    assert {(r.severity, r.grade, r.p_toxic) for r in predict_severity(edge_frame, SeverityModel()).collect()} == {(0, 0, 0)}


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", F.col("lang").alias("truth"))
    found = op10_langid(spark, LARGER).join(docs, "doc_id").toPandas()
    held = found[found.held_out]
    assert len(found) == 1000 and (held.lang_pred == held.truth).mean() > 0.97
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in zip(found.doc_id, found.held_out))
    assert found.score.between(0, 1).all()


def test_language_edges(spark, edge_frame):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    model = fit_languages(docs.union(docs.limit(3).withColumn("lang", F.lit(None).cast("string"))))
    assert model.languages == ["de", "en", "es", "fr"]
    assert model.grams.sum(1) == pytest.approx(np.ones(4), abs=1e-3)
    got = {r.doc_id: r for r in identify_languages(edge_frame, model).collect()}
    for i in (0, 1, 2, 3):
        assert (got[i].lang_pred, got[i].score, got[i].languages) == ("und", 0.0, [])
    assert got[4].languages == got[5].languages and got[4].lang_pred in model.languages
    assert got[6].lang_pred == "fr" and len(got[7].languages) >= 1
    assert identify_languages(edge_frame.limit(0), model).count() == 0
    empty = fit_languages(docs.limit(0))
    assert {r.lang_pred for r in identify_languages(edge_frame, empty).collect()} == {"und"}


def test_mixture_shares(spark):
    """Texts put together from two languages: both are found, in their proportions."""
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    model = fit_languages(docs)
    long = docs.filter("length(text) > 1500")
    half = {r["lang"]: r["t"] for r in long.groupBy("lang").agg(F.min_by(F.substring("text", 1, 1000), "doc_id").alias("t")).collect()}
    frame = spark.createDataFrame([("a", half["de"] + " " + half["es"]), ("b", half["fr"])], "k string, text string")
    got = {r.k: {x.lang: x.share for x in r.languages} for r in identify_languages(frame, model).collect()}
    assert set(got["a"]) == {"de", "es"} and got["a"]["de"] == pytest.approx(0.5, abs=0.12)
    assert max(got["b"], key=got["b"].get) == "fr"


def test_mixture_of_four_languages(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    model = fit_languages(docs)
    long = docs.filter("length(text) > 1500").groupBy("lang").agg(F.min_by(F.substring("text", 1, 1000), "doc_id"))
    text = " ".join(t for _, t in sorted(long.collect()))
    frame = spark.createDataFrame([(text,)], "text string")
    got = {x.lang: x.share for x in identify_languages(frame, model).first().languages}
    assert got == {lang: pytest.approx(0.25, abs=0.1) for lang in ("de", "en", "es", "fr")}
    assert len(identify_languages(frame, model, max_set=3).first().languages) == 3


def test_sets_that_are_not_tried_could_not_win():
    """The chosen set is the best of all sizes, for mixtures of one to seven of seven languages."""
    draw = np.random.default_rng(4)
    grams = draw.dirichlet(np.full(60, 0.5), 7).astype(np.float32)
    model = LanguageModel(list("abcdefg"), grams)
    counts = np.array(
        [draw.multinomial(draw.integers(1, 3000), grams[: 1 + i % 7].mean(0) / grams[: 1 + i % 7].mean(0).sum()) for i in range(70)]
    ).astype(np.float32)
    full, chosen = mixture(counts, model, 1.0)
    each = 0.5 * np.log(counts.sum(1))

    def value(shares):
        return (counts * np.log(np.maximum(shares @ grams, 1e-30))).sum(1) - each * ((shares > 0).sum(1) - 1)

    assert set((chosen > 1e-4).sum(1)) >= {1, 2, 3, 4, 5}
    for size in range(1, 8):
        some = mixture(counts, model, 1.0, size)[1]
        assert (value(chosen) >= value(some) - 0.01).all()


def test_em_against_a_plain_loop():
    draw = np.random.default_rng(2)
    grams = draw.dirichlet(np.ones(40), 3)
    counts = np.zeros((2, BUCKETS), np.float32)
    counts[:, :40] = draw.integers(0, 9, (2, 40))
    wide = np.full((3, BUCKETS), 1e-9)
    wide[:, :40] = grams
    full, chosen = mixture(counts, LanguageModel(["a", "b", "c"], wide.astype(np.float32)), 0.0, 3)
    for row, found in zip(counts[:, :40], full):
        shares = np.full(3, 1 / 3)
        for _ in range(12):
            each = shares[:, None] * grams
            shares = (each / each.sum(0) * row).sum(1) / row.sum()
        assert found == pytest.approx(shares, abs=1e-3)
    _, single = mixture(counts, LanguageModel(["a", "b", "c"], wide.astype(np.float32)), 1e9, 3)
    assert (single.max(1) == 1).all()  # a heavy penalty leaves one language


def test_sample_is_bounded_where_documents_share_an_id(spark):
    rows = [(1, f"text {i % 7}") for i in range(3000)] + [(i, "other") for i in range(2, 12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 12)], "doc_id long, toxic int")
    found = [tuple(r) for _ in range(2) for r in labelled_sample(docs, labels, "toxic", limit=10_000).collect()]
    assert len(found) == 22 and sorted(found[:11]) == sorted(found[11:])
    assert {i: w for i, _, _, w in found} == {1: 3000.0} | {i: 1.0 for i in range(2, 12)}
