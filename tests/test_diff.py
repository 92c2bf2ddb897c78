"""Keyed diffs: the equality rules, keys, names, types, and a brute-force comparison."""

import math
import random

import pytest
from pyspark.sql import functions as F

from featward import (
    align_columns,
    diff_cells,
    diff_flags,
    diff_report,
    non_numeric_values,
    row_multiset_diff,
    sanitize_names,
    with_ordinal,
)

NAN = float("nan")


@pytest.fixture
def versions(spark):
    schema = "id int, x double, s string"
    original = [
        (1, 1.0, "a"), (2, 2.0, "a"), (3, None, "a"), (4, 3.0, "a"), (5, None, "a"),
        (6, NAN, "a"), (7, 0.0, "a"), (8, NAN, "a"), (9, 9.0, "gone"), (10, None, None),
    ]
    new = [
        (1, 1.0, "a"), (2, 2.5, "b"), (3, 3.0, "a"), (4, None, "a"), (5, None, "a"),
        (6, NAN, "a"), (7, -0.0, "a"), (8, 1.0, "a"), (11, 11.0, None), (12, None, None),
    ]
    return spark.createDataFrame(original, schema), spark.createDataFrame(new, schema)


def test_strict_cells(versions, rows):
    assert rows(diff_cells(*versions, key="id")) == [
        (2, "s", "a", "b"),
        (2, "x", "2.0", "2.5"),
        (8, "x", "NaN", "1.0"),
    ]


def test_null_safe_cells(versions, rows):
    assert rows(diff_cells(*versions, key="id", null_safe=True)) == sorted(
        [
            (2, "s", "a", "b", "changed"),
            (2, "x", "2.0", "2.5", "changed"),
            (3, "x", None, "3.0", "changed"),
            (4, "x", "3.0", None, "changed"),
            (8, "x", "NaN", "1.0", "changed"),
            (9, "x", "9.0", None, "removed"),
            (9, "s", "gone", None, "removed"),
            (10, None, None, None, "removed"),
            (11, "x", None, "11.0", "added"),
            (12, None, None, None, "added"),
        ],
        key=repr,
    )


def test_flags_give_every_key(versions, rows):
    flags = diff_flags(*versions, key="id", column="s")
    assert flags.columns == ["id", "original_value", "new_value", "diff"]
    assert rows(flags) == sorted(
        [(i, "a", "a", "SAME") for i in (1, 3, 4, 5, 6, 7, 8)]
        + [(2, "a", "b", "DIFFERENT"), (9, "gone", None, "SAME"), (10, None, None, "SAME")]
        + [(11, None, None, "SAME"), (12, None, None, "SAME")],
        key=repr,
    )


def test_report(versions, rows):
    assert rows(diff_report(*versions, key="id")) == [
        (2, "s: a -> b, x: 2.0 -> 2.5"),
        (8, "x: NaN -> 1.0"),
    ]
    assert diff_report(*versions, key="id", include_key=False).columns == ["differences"]


def test_null_safe_report(versions, rows):
    assert rows(diff_report(*versions, key="id", null_safe=True)) == sorted(
        [
            (2, "s: a -> b, x: 2.0 -> 2.5", "changed"),
            (3, "x: NULL -> 3.0", "changed"),
            (4, "x: 3.0 -> NULL", "changed"),
            (8, "x: NaN -> 1.0", "changed"),
            (9, "s: gone -> NULL, x: 9.0 -> NULL", "removed"),
            (10, "", "removed"),
            (11, "x: NULL -> 11.0", "added"),
            (12, "", "added"),
        ],
        key=repr,
    )


def test_key_repeated_on_one_side_multiplies(spark, rows):
    original = spark.createDataFrame([(1, "a"), (2, "a")], "id int, v string")
    new = spark.createDataFrame([(1, "b"), (1, "c"), (1, "a"), (2, "a")], "id int, v string")
    assert rows(diff_cells(original, new, "id")) == [(1, "v", "a", "b"), (1, "v", "a", "c")]
    assert rows(diff_cells(new, original, "id")) == [(1, "v", "b", "a"), (1, "v", "c", "a")]


def test_key_repeated_on_both_sides_is_refused_or_multiplied(spark, rows):
    frame = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "id int, v string")
    with pytest.raises(ValueError, match="occurs 2 times in the original and 2 times"):
        diff_cells(frame, frame, "id")
    assert rows(diff_cells(frame, frame, "id", duplicates="multiply")) == [
        (1, "v", "a", "b"),
        (1, "v", "b", "a"),
    ]
    with pytest.raises(ValueError, match="refuse"):
        diff_cells(frame, frame, "id", duplicates="pair")


def test_null_keys_match_nothing(spark, rows):
    original = spark.createDataFrame([(None, "a"), (None, "b"), (1, "a")], "id int, v string")
    new = spark.createDataFrame([(None, "c"), (1, "a")], "id int, v string")
    assert rows(diff_cells(original, new, "id")) == []
    assert rows(diff_cells(original, new, "id", null_safe=True)) == [
        (None, "v", "a", None, "removed"),
        (None, "v", "b", None, "removed"),
        (None, "v", None, "c", "added"),
    ]
    assert diff_flags(original, new, "id", "v").count() == 4


def test_composite_key_with_partial_null(spark, rows):
    original = spark.createDataFrame([(1, "x", 1), (1, None, 2)], "a int, b string, v int")
    new = spark.createDataFrame([(1, "x", 3), (1, None, 2)], "a int, b string, v int")
    assert rows(diff_cells(original, new, ["a", "b"], null_safe=True)) == [
        (1, "x", "v", "1", "3", "changed"),
        (1, None, "v", "2", None, "removed"),
        (1, None, "v", None, "2", "added"),
    ]


def test_column_sets(spark, rows):
    original = spark.createDataFrame([(1, 1)], "id int, a int")
    wider = spark.createDataFrame([(5, 1, 2)], "b int, id int, a int")
    assert rows(diff_cells(original, wider, "id")) == [(1, "a", "1", "2")]
    with pytest.raises(ValueError, match="'b' is missing from the new"):
        diff_cells(wider, original, "id")
    assert rows(diff_cells(original.select("id"), wider, "id")) == []


def test_awkward_names(spark, rows):
    schema = "id int, `a.b` int, `a-b` int, `it's` int, `o.x` int, `back\\slash` int"
    original = spark.createDataFrame([(1, 1, 1, 1, 1, 1)], schema)
    new = spark.createDataFrame([(1, 2, 2, 2, 2, 2)], schema)
    assert [r[1] for r in rows(diff_cells(original, new, "id"))] == sorted(
        ["a.b", "a-b", "it's", "o.x", "back\\slash"], key=repr
    )
    (line,) = rows(diff_report(original, new, "id"))
    assert line == (1, "a.b: 1 -> 2, a_b: 1 -> 2, back\\slash: 1 -> 2, it's: 1 -> 2, o.x: 1 -> 2")


def test_result_columns_must_be_free(spark):
    frame = spark.createDataFrame([(1, 1, "a")], "change int, side int, Value string")
    for call in (
        lambda: diff_cells(frame, frame, "change"),
        lambda: diff_report(frame, frame, "change"),
        lambda: row_multiset_diff(frame, frame),
        lambda: with_ordinal(frame, "side", name="VALUE"),
        lambda: non_numeric_values(frame, "side"),
    ):
        with pytest.raises(ValueError, match="rename"):
            call()
    assert non_numeric_values(frame, "Value").columns == ["change", "side", "value", "message"]


def test_names_that_differ_in_case(spark, rows):
    original = spark.createDataFrame([(1, 1, 1)], ["id", "a", "A"])
    new = spark.createDataFrame([(1, 1, 2)], ["ID", "a", "A"])
    assert rows(diff_cells(original, new, "id")) == [(1, "A", "1", "2")]


def test_types(spark, rows):
    original = spark.createDataFrame(
        [(1, 1, [1, None], {"a": 1, "b": 2}, {"p": 1, "q": "x"})],
        "id int, n int, l array<int>, m map<string,int>, r struct<p:int,q:string>",
    )
    new = spark.createDataFrame(
        [(1, 1.0, [1, None], {"b": 2, "a": 1}, {"p": 1, "q": "y"})],
        "id int, n double, l array<int>, m map<string,int>, r struct<p:int,q:string>",
    )
    for null_safe in (False, True):
        assert rows(diff_cells(original, new, "id", null_safe), "id", "column_name") == [(1, "r")]
    nested = spark.createDataFrame([(1, [{"a": 1}])], "id int, m array<map<string,int>>")
    with pytest.raises(TypeError, match="cannot be compared"):
        diff_cells(nested, nested, "id")


def test_text_against_number(spark, rows):
    text = spark.createDataFrame([(1, "abc"), (2, "7"), (3, None)], "id int, v string")
    number = spark.createDataFrame([(1, 5), (2, 7), (3, None)], "id int, v int")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        diff_cells(text, number, "id").collect()
    assert rows(diff_cells(text, number, "id", null_safe=True)) == [
        (1, "v", "abc", "5", "changed"),
        (2, "v", "7", "7", "changed"),
    ]


def test_align(spark, rows):
    a = spark.createDataFrame([(1, 2, 3)], ["z", "a-b", "mine"])
    b = spark.createDataFrame([(5, 6, 7)], ["a_b", "Z", "z"])
    left, right = align_columns(a, b)
    assert left.columns == right.columns == ["a_b", "z"]
    assert (rows(left), rows(right)) == ([(2, 1)], [(5, 7)])
    with pytest.raises(ValueError, match="no common columns"):
        align_columns(a.select("mine"), b)
    with pytest.raises(ValueError, match=r"\['a_b'\]"):
        sanitize_names(spark.createDataFrame([(1, 2)], ["a-b", "a_b"]))
    assert align_columns(a, b, sanitize=False)[0].columns == ["z"]


def test_wide_tables(spark, rows):
    wide = spark.range(50).select("id", *[(F.col("id") + i).alias(f"f{i}") for i in range(1200)])
    changed = wide.withColumn("f700", F.when(F.col("id") == 7, -1).otherwise(F.col("f700")))
    assert rows(diff_cells(wide, changed, "id")) == [(7, "f700", "707", "-1")]


def _same(a, b):
    if a is None or b is None:
        return a is b
    return a == b or (isinstance(a, float) and math.isnan(a) and math.isnan(b))


def test_against_brute_force(spark, rows):
    """Random versions with repeated keys, NULL keys, NULL, NaN and signed zero."""
    draw = random.Random(7)

    def version():
        return [
            (
                draw.choice([None, *range(12)]),
                draw.choice([None, NAN, 0.0, -0.0, 1.5, 2.0]),
                draw.choice([None, "", "a", "b"]),
            )
            for _ in range(40)
        ]

    old, now = version(), version()
    schema = "k int, x double, s string"
    original, new = spark.createDataFrame(old, schema), spark.createDataFrame(now, schema)

    def text(v):
        if isinstance(v, float):
            return "NaN" if math.isnan(v) else str(v)
        return v

    strict, safe = [], []
    for o in old:
        for n in now:
            if o[0] is None or o[0] != n[0]:
                continue
            for name, a, b in (("x", o[1], n[1]), ("s", o[2], n[2])):
                if not _same(a, b):
                    safe.append((o[0], name, text(a), text(b), "changed"))
                    if a is not None and b is not None:
                        strict.append((o[0], name, text(a), text(b)))
    for mine, others, change in ((old, now, "removed"), (now, old, "added")):
        keys = {r[0] for r in others} - {None}
        for k, x, s in mine:
            if k in keys:
                continue
            cells = [(n, text(v)) for n, v in (("x", x), ("s", s)) if v is not None]
            for name, value in cells or [(None, None)]:
                pair = (value, None) if change == "removed" else (None, value)
                safe.append((k, name, *pair, change))
    assert rows(diff_cells(original, new, "k", duplicates="multiply")) == sorted(strict, key=repr)
    assert rows(diff_cells(original, new, "k", True, duplicates="multiply")) == sorted(safe, key=repr)


def test_the_key_is_no_difference_whatever_its_case(spark, rows):
    original = spark.createDataFrame([(1, 5), (2, 6)], "id int, v int")
    new = spark.createDataFrame([(1, 7)], "id int, v int")
    got = rows(diff_report(original, new, key="ID", null_safe=True), "differences", "change")
    assert got == [("v: 5 -> 7", "changed"), ("v: 6 -> NULL", "removed")]
