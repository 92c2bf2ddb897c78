"""Row matching, multiset differences, positions."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from featward import (
    compare_csv,
    compare_positional,
    frames_equal,
    match_rows,
    row_multiset_diff,
    with_ordinal,
)
from featward.operators.ordinal import number_file_rows, number_rows
from featward.sources.delimited import read_typed_csv

NAN = float("nan")


@pytest.fixture
def pair(spark):
    schema = "a int, b string"
    left = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (3, "y"), (3, "y"), (3, "y")], schema)
    right = spark.createDataFrame([(1, "x"), (2, None), (3, "y"), (3, "y"), (3, "y"), (4, "z")], schema)
    return left, right


def test_match_rows_strict(pair, rows):
    matched = match_rows(*pair)
    assert matched.columns == [
        "a_original", "a_new", "a_is_different", "b_original", "b_new", "b_is_different",
        "n_original", "n_new",
    ]
    assert rows(matched.drop("a_is_different", "b_is_different")) == sorted(
        [
            (1, 1, "x", "x", 2, 1),
            (2, None, None, None, 1, 0),
            (None, 2, None, None, 0, 1),
            (3, 3, "y", "y", 3, 3),
            (None, 4, None, "z", 0, 1),
        ],
        key=repr,
    )
    assert matched.filter("a_is_different OR b_is_different").count() == 0


def test_match_rows_null_safe_and_unmatched(pair, rows):
    names = ["a_original", "a_new", "n_original", "n_new"]
    assert (2, 2, 1, 1) in rows(match_rows(*pair, null_safe=True), *names)
    assert rows(match_rows(*pair, unmatched_only=True), *names) == sorted(
        [(2, None, 1, 0), (None, 2, 0, 1), (None, 4, 0, 1)], key=repr
    )
    assert rows(match_rows(*pair, null_safe=True, unmatched_only=True), *names) == [(None, 4, 0, 1)]


def test_match_rows_uses_common_columns(spark, rows):
    a = spark.createDataFrame([(1, 2)], ["x-y", "mine"])
    b = spark.createDataFrame([(3, 1)], ["yours", "x_y"])
    assert rows(match_rows(a, b)) == [(1, 1, False, 1, 1)]


def test_multiset_diff_counts_surplus_copies(pair, rows):
    assert rows(row_multiset_diff(*pair)) == [(1, "x", "original", 1), (4, "z", "new", 1)]


def test_multiset_diff_against_brute_force(spark, rows):
    draw = random.Random(3)
    make = lambda: [(draw.choice([None, 1, 2]), draw.choice(["a", None, "b"])) for _ in range(60)]
    left, right = make(), make()
    a, b = Counter(left), Counter(right)
    expected = [(*r, "original", n) for r, n in (a - b).items()]
    expected += [(*r, "new", n) for r, n in (b - a).items()]
    schema = "a int, b string"
    found = row_multiset_diff(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema))
    assert rows(found) == sorted(expected, key=repr)


def test_hot_copies_stay_one_row(spark, rows):
    """A third of a million rows in one copy group: counted before the shuffle, reported once."""
    left = spark.range(1_000_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("v"))
    right = left.filter("v <> 4 AND v <> 5").unionAll(left.filter("v = 7"))
    assert rows(row_multiset_diff(left, right)) == [(4, "original", 1), (5, "original", 1), (7, "new", 1)]
    hot = match_rows(left, right).filter("v_original = -1").select("n_original", "n_new")
    assert rows(hot) == [(333_334, 333_334)]


def test_frames_equal(pair, spark, rows):
    left, right = pair
    assert rows(frames_equal(left, right)) == [(False,)]
    shuffled = left.orderBy(F.rand(3)).select("b", "a").select("a", "b")
    assert rows(frames_equal(left, shuffled)) == [(True,)]
    assert rows(frames_equal(left.limit(0), right.limit(0))) == [(True,)]
    zero = spark.createDataFrame([(0.0,), (NAN,)], "v double")
    assert rows(frames_equal(zero, spark.createDataFrame([(NAN,), (-0.0,)], "v double"))) == [(True,)]
    with pytest.raises(ValueError, match="different columns"):
        frames_equal(left, right.select("a"))
    with pytest.raises(ValueError, match="'a' is text on one side"):
        frames_equal(left, right.withColumn("a", F.col("a").cast("string")))


def test_frames_equal_in_order(spark, rows, plan):
    frame = spark.createDataFrame([(1, 5, "x"), (1, 4, "y"), (2, 3, None)], "g int, v int, t string")
    assert rows(frames_equal(frame, frame.orderBy("v"), "g")) == [(True,)]
    assert rows(frames_equal(frame, frame.withColumn("v", F.col("v").cast("long")), "g")) == [(True,)]
    assert rows(frames_equal(frame, frame.withColumn("t", F.lit("x")), "g")) == [(False,)]
    with_map = frame.withColumn("m", F.create_map("t", "v")) .filter("t IS NOT NULL")
    assert rows(frames_equal(with_map, with_map.orderBy("v"), "g")) == [(True,)]
    with pytest.raises(Exception, match="row counts: 3 and 2"):
        frames_equal(frame, frame.limit(2), "g").collect()
    with pytest.raises(ValueError, match="columns"):
        frames_equal(frame, frame.select("v", "g", "t"), "g")
    with pytest.raises(ValueError, match="missing"):
        frames_equal(frame, frame, "nothing")
    text = plan(frames_equal(frame, frame, "g"))
    assert text.count("Exchange hashpartitioning") == 1 and "Sort " not in text


@pytest.mark.parametrize("merge", ["true", "false"])
def test_ordinal_equals_place_in_sorted_order(spark, rows, setting, merge):
    setting(spark__sql__adaptive__coalescePartitions__enabled=merge)
    draw = random.Random(5)
    values = [(draw.randrange(50), i) for i in range(5000)]
    frame = spark.createDataFrame(values, "a int, b int").repartition(7)
    expected = [(a, b, i) for i, (a, b) in enumerate(sorted(values))]
    assert rows(with_ordinal(frame, ["a", "b"])) == sorted(expected, key=repr)
    from_one = with_ordinal(frame, ["a", "b"], name="nr", start=1)
    assert from_one.agg(F.min("nr"), F.max("nr")).first()[:] == (1, 5000)


def test_ordinal_with_a_hot_order_value(spark):
    """Ties spread over the partitions and still get distinct, consecutive numbers."""
    frame = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("v"), "id")
    numbered = with_ordinal(frame, "v")
    got = numbered.agg(F.countDistinct("pos"), F.min("pos"), F.max("pos")).first()[:]
    assert got == (30_000, 0, 29_999)
    ties = numbered.filter("v = 1").agg(F.count("pos"), F.min("pos"), F.max("pos")).first()[:]
    assert ties == (10_001, 0, 10_000)


def test_hot_copies_are_numbered_in_several_tasks(spark, setting):
    setting(spark__sql__adaptive__coalescePartitions__enabled="false")
    frame = spark.range(0, 30_000, 1, 8).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("v"))
    numbered, total = number_rows(frame, "v")
    hot = numbered.filter("c0 = 1")
    assert total == 30_000 and hot.select(F.input_file_name()).distinct().count() > 2
    assert hot.agg(F.countDistinct("pos"), F.min("pos"), F.max("pos")).first()[:] == (10_001, 0, 10_000)


def test_ordinal_of_an_empty_frame(spark, rows):
    assert rows(with_ordinal(spark.createDataFrame([], "a int"), "a")) == []


def test_compare_positional(spark, rows):
    schema = "k int, x double, s string"
    a = spark.createDataFrame([(1, 1.0, "a"), (2, NAN, None), (3, None, "c"), (4, 4.0, "d")], schema)
    b = spark.createDataFrame([(1, 1.0, "a"), (2, NAN, None), (3, 3.0, None), (9, 4.0, "d")], schema)
    assert rows(compare_positional(a, b, "k")) == [
        (2, "s", "c", None),
        (2, "x", None, "3.0"),
        (3, "k", "4", "9"),
    ]
    assert rows(compare_positional(a, b, "k", ignore=["k"]), "pos", "column_name") == [(2, "s"), (2, "x")]
    assert rows(frames_equal(a, b, order_by="k")) == [(False,)]
    assert rows(frames_equal(a, a, order_by="k")) == [(True,)]


def test_compare_positional_errors(spark):
    a = spark.createDataFrame([(1, 2)], ["x", "y"])
    with pytest.raises(ValueError, match="columns"):
        compare_positional(a, a.select("y", "x"), "x")
    with pytest.raises(ValueError, match="row counts: 1 and 2"):
        compare_positional(a, a.unionAll(a), "x")


def _csv(path, lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_compare_csv_goes_by_line(spark, tmp_path, rows):
    a = _csv(tmp_path / "a.csv", ["k,v,t", "3,1.0,x", "1,NA,y", '2,5,"say ""hi"""'])
    b = _csv(tmp_path / "b.csv", ["k,v,t", "3,1,x", "1,2,y", "2,5,null"])
    assert rows(compare_csv(spark, a, b, "k int, v double, t string")) == [
        (1, "v", None, "2.0"),
        (2, "t", 'say "hi"', None),
    ]
    assert rows(compare_csv(spark, a, b)) == [(1, "v", None, "2.0"), (2, "t", 'say "hi"', None)]
    assert (0, "v", "1.0", "1") in rows(compare_csv(spark, a, b, infer_types=False))
    with pytest.raises(ValueError, match="inferSchema"):
        compare_csv(spark, a, b, inferSchema=True)
    other = _csv(tmp_path / "c.csv", ["k,w,t", "3,1,x", "1,2,y", "2,5,null"])
    with pytest.raises(ValueError, match="columns"):
        compare_csv(spark, a, other)
    with pytest.raises(Exception, match="header"):
        compare_csv(spark, a, other, "k int, v double, t string")


def test_inferred_types_are_the_narrowest_of_both_sides(spark, tmp_path, rows):
    a = _csv(tmp_path / "a.csv", ["i,d,b,t,e,big", "1,1,true,1,NA,1", "007,2.50,FALSE,x,,99999999999999999999"])
    b = _csv(tmp_path / "b.csv", ["i,d,b,t,e,big", "01,1e0,True,01,null,1.0", "7,2.5,false,x,NaN,1e20"])
    assert rows(compare_csv(spark, a, b)) == [(0, "t", "1", "01")]


def test_part_files_go_by_number(spark, tmp_path, rows):
    for side, names in (("a", ("part-99999", "part-100000")), ("b", ("part-00000", "part-00001"))):
        (tmp_path / side).mkdir()
        for name, lines in zip(names, (["v", "1", "2"], ["v", "3", "4"])):
            _csv(tmp_path / side / f"{name}-x.csv", lines)
    assert rows(compare_csv(spark, f"{tmp_path}/a", f"{tmp_path}/b")) == []


def test_lines_are_numbered_without_paths_or_one_window(spark, tmp_path, plan, setting):
    setting(spark__sql__autoBroadcastJoinThreshold="-1")
    path = _csv(tmp_path / "a.csv", ["v", *map(str, range(100))])
    numbered, total = number_file_rows(read_typed_csv(spark, path, "v int"))
    text = plan(numbered)
    assert total == 100 and "Window" not in text and "file" not in text.split("ReadSchema")[1].split(">")[0]
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_ties_with_differing_types_and_maps(spark, rows):
    left = spark.createDataFrame([(1, i, {"k": i, "j": 1}) for i in range(50)], "g int, v int, m map<string,int>")
    right = left.orderBy(F.desc("v")).select("g", F.col("v").cast("long").alias("v"), "m")
    assert rows(compare_positional(left, right, "g")) == []


def test_compare_csv_over_many_splits(spark, tmp_path, rows, setting):
    """Lines keep their order when tasks read a file in small pieces."""
    setting(spark__sql__files__maxPartitionBytes="4096")
    draw = random.Random(11)
    values = [draw.randrange(10**6) for _ in range(8000)]
    changed = list(values)
    for at in (0, 17, 4000, 7999):
        changed[at] = -1
    a = _csv(tmp_path / "a.csv", ["v", *map(str, values)])
    b = _csv(tmp_path / "b.csv", ["v", *map(str, changed)])
    assert spark.read.csv(a).rdd.getNumPartitions() > 5
    expected = [(at, "v", str(values[at]), "-1") for at in (0, 17, 4000, 7999)]
    assert rows(compare_csv(spark, a, b, "v int")) == sorted(expected, key=repr)
