"""Digests before rows: diffs that shuffle only what changed, and equality settled without a shuffle."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featward import diff_cells, diff_report, frames_equal
from featward.functions.compare import digested
from featward.operators import diff as module
from featward.operators import rowmatch

KINDS = (
    "k int, j string, n int, x double, s string, a array<string>, b array<array<int>>, "
    "r struct<p:string,q:string>, m map<string,int>, t timestamp, y binary, d decimal(30,4)"
)


def _row(draw, k):
    some = lambda *values: draw.choice([None, *values])
    return (
        draw.choice([k, k, k, None]), some("u", "v"), some(1, 2), some(0.0, -0.0, float("nan"), 1.5), some("", "ab", "a"),
        some([], [None], ["a", None], [None, "a"]), some([[1, 2], [3]], [[1], [2, 3]], [[]], []),
        some((None, "a"), ("a", None), (None, None)), some({"x": 1, "y": 2}, {"y": 2, "x": 1}, {}),
        None, some(bytearray(b""), bytearray(b"a")), None,
    )


@pytest.fixture
def many_kinds(spark):
    draw = random.Random(5)
    original = [_row(draw, k) for k in range(300)]
    new = [r if draw.random() < 0.6 else (*r[:2], *_row(draw, 0)[2:]) for r in original if draw.random() < 0.95]
    return spark.createDataFrame(original, KINDS), spark.createDataFrame([*new, _row(draw, 1000)], KINDS)


@pytest.mark.parametrize("null_safe", [False, True])
def test_same_rows_as_whole_rows_compared(many_kinds, rows, null_safe):
    for make in (diff_cells, diff_report):
        plain = make(*many_kinds, ["k", "j"], null_safe=null_safe)
        found = make(*many_kinds, ["k", "j"], null_safe=null_safe, digest_first=True)
        assert found.dtypes == plain.dtypes
        assert rows(found) == rows(plain) and found.count() > 50


@pytest.mark.parametrize("null_safe", [False, True])
def test_keys_that_repeat(spark, rows, null_safe):
    one = spark.createDataFrame([(1, "a"), (2, "a"), (3, "a"), (4, None)], "k int, s string")
    many = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (2, "b"), (3, "c"), (5, "a"), (5, "b")], "k int, s string")
    for pair in ((one, many), (many, one)):
        how = {"key": "k", "null_safe": null_safe}
        assert rows(diff_cells(*pair, **how, digest_first=True)) == rows(diff_cells(*pair, **how))
    # a key with one digest is still refused, or paired
    twice = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (2, "c")], "k int, s string")
    with pytest.raises(ValueError, match="pass duplicates='multiply'"):
        diff_cells(twice, twice, "k", null_safe=null_safe, digest_first=True)
    with pytest.raises(ValueError, match="pass duplicates='multiply'"):
        diff_cells(twice.filter("k = 1"), twice.filter("k = 1"), "k", null_safe=null_safe, digest_first=True)
    how = {"key": "k", "null_safe": null_safe, "duplicates": "multiply"}
    found = rows(diff_cells(twice, twice, **how, digest_first=True))
    assert found == rows(diff_cells(twice, twice, **how)) and len(found) == 2


def test_types_without_a_digest_are_compared_whole(spark, rows):
    a = spark.createDataFrame([(1, "1", 1.0), (2, "2", 2.0)], "k int, s string, x double")
    b = a.selectExpr("k", "CAST(s AS int) + IF(k = 2, 1, 0) AS s", "CAST(x AS decimal(10,2)) AS x")
    assert rows(diff_cells(a, b, "k", digest_first=True)) == [(2, "s", "2", "3")]
    wide_key = a.selectExpr("CAST(k AS string) AS k", "s", "x + 1 AS x")
    assert rows(diff_cells(a, wide_key, "k", digest_first=True)) == rows(diff_cells(a, wide_key, "k"))
    assert digested("c", T.ArrayType(T.TimestampType())) is None
    assert digested("c", T.MapType(T.DoubleType(), T.StringType())) is None


def test_odd_frames(spark, rows):
    a = spark.createDataFrame([(1, "x"), (None, "y"), (None, None)], "k int, s string")
    none = a.limit(0)
    for pair in ((a, none), (none, a), (none, none), (a, a)):
        for null_safe in (False, True):
            found = rows(diff_cells(*pair, "k", null_safe=null_safe, digest_first=True))
            assert found == rows(diff_cells(*pair, "k", null_safe=null_safe))
    keys = a.select("k")
    assert rows(diff_cells(keys, keys.filter("k = 1"), "k", null_safe=True, digest_first=True)) == [
        (None, None, None, None, "removed"), (None, None, None, None, "removed"),
    ]


def test_only_keys_and_digests_are_shuffled_first(spark, setting, monkeypatch):
    """The grouping carries no value; the joins after it see the rows of the keys that differ."""
    setting(spark__sql__autoBroadcastJoinThreshold="-1")
    columns = [(F.col("id") * i).alias(f"c{i}") for i in range(1, 60)]
    a = spark.range(2000).select(F.col("id").alias("k"), *columns)
    b = a.withColumn("c7", F.when(F.col("k") % 100 == 0, -1).otherwise(F.col("c7")))
    seen = []
    kept = module._Pair.differing
    monkeypatch.setattr(module._Pair, "differing", lambda pair, safe: seen.append(kept(pair, safe)) or seen[-1])
    found = diff_cells(a, b, "k", digest_first=True)
    assert found.count() == 20
    assert seen[0].original.count() == seen[0].new.count() == 20
    assert seen[0].repeats is None


def test_unequal_frames_need_no_shuffle_of_rows(spark, rows, plan, monkeypatch):
    grouped = []
    counted = rowmatch._counted
    monkeypatch.setattr(rowmatch, "_counted", lambda a, b: grouped.append(1) or counted(a, b))
    a = spark.range(1000).selectExpr("id", "id % 7 AS v", "CAST(id AS string) AS s")
    one_off = a.withColumn("v", F.when(F.col("id") == 500, 9).otherwise(F.col("v")))
    for order in (None, "id"):
        answer = frames_equal(a, one_off, order)
        assert rows(answer) == [(False,)] and "Exchange" not in plan(answer)
    assert rows(frames_equal(a, a.limit(999))) == [(False,)]
    assert not grouped
    assert rows(frames_equal(a, a.orderBy("v"))) == [(True,)] and grouped


def test_equal_digests_prove_nothing(spark, rows):
    """A hash passes over NULL, so these rows have the same one."""
    a = spark.createDataFrame([(None, "a"), ("b", None)], "x string, y string")
    b = spark.createDataFrame([("a", None), (None, "b")], "x string, y string")
    assert rowmatch._summed(a, b) == (2, 2, True)
    assert rows(frames_equal(a, b)) == [(False,)]


def test_digest_follows_equality(spark, rows):
    nan = float("nan")
    a = spark.createDataFrame([(0.0, [nan], (0.0,)), (nan, [], None)], "x double, a array<double>, r struct<v:double>")
    b = spark.createDataFrame([(nan, [], None), (-0.0, [nan], (-0.0,))], a.schema)
    assert rows(frames_equal(a, b)) == [(True,)]
    maps = spark.createDataFrame([({"x": 1, "y": 2},)], "m map<string,int>")
    turned = spark.createDataFrame([({"y": 2, "x": 1},)], "m map<string,int>")
    assert rows(frames_equal(maps, turned)) == [(True,)]
    folded = spark.sql("SELECT 'A' COLLATE UTF8_LCASE AS s")
    assert rows(frames_equal(folded, spark.sql("SELECT 'a' COLLATE UTF8_LCASE AS s"))) == [(True,)]
    assert rows(frames_equal(spark.range(3), spark.range(3).selectExpr("CAST(id AS int) AS id"))) == [(True,)]
