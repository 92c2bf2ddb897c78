"""Dated files, delimited files, tables."""

import os

import pytest
from pyspark.sql import functions as F

from featward import (
    diff_cells,
    drop_table,
    ingest_dated_csv,
    list_dated_files,
    overwrite_table,
    read_date_list,
    read_delimited,
    recover_table,
    write_delimited,
)
from featward.session import clear_scratch, new_scratch, new_table, scratch_base
from featward.sinks.tables import _table_base
from featward.sources.delimited import read_typed_csv


def _file(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return path


@pytest.fixture
def flat(tmp_path):
    _file(tmp_path / "feat_final_20240101.csv", "a,b\n1,x\n2,\n")
    _file(tmp_path / "feat_final_20240102.csv", "a,b\n3,z\n")
    _file(tmp_path / "feat_final_latest.csv", "a,b\n4,w\n")
    _file(tmp_path / "unrelated.csv", "a,b\n5,v\n")
    return tmp_path


def _files_read(df):
    """Files the scans of an executed frame have read."""
    df.collect()
    total, waiting = 0, [df._jdf.queryExecution().executedPlan()]
    while waiting:
        node = waiting.pop()
        if node.metrics().contains("numFiles"):
            total += node.metrics().apply("numFiles").value()
        children = node.children()
        waiting += [children.apply(i) for i in range(children.size())]
    return total


def test_ingest(spark, flat, rows):
    got = ingest_dated_csv(spark, f"{flat}/feat_final_*.csv")
    assert got.dtypes == [("a", "string"), ("b", "string"), ("prcsng_dt", "string")]
    assert rows(got) == sorted(
        [("1", "x", "20240101"), ("2", None, "20240101"), ("3", "z", "20240102"), ("4", "w", "")], key=repr
    )
    assert rows(ingest_dated_csv(spark, f"{flat}/feat_final_*.csv", columns=["a", "b"])) == rows(got)


def test_a_date_filter_reads_only_its_files(spark, flat):
    got = ingest_dated_csv(spark, f"{flat}/feat_final_*.csv").filter("prcsng_dt = '20240102'")
    assert _files_read(got) == 1


def test_ingest_with_a_column_called_filename(spark, tmp_path, rows):
    _file(tmp_path / "feat_final_20240101.csv", "filename,prcsng_dt\nkeep,19990101\n")
    got = ingest_dated_csv(spark, f"{tmp_path}/*.csv")
    assert rows(got) == [("keep", "20240101")]


def test_ingest_with_differing_headers(spark, tmp_path, rows):
    _file(tmp_path / "feat_final_20240101.csv", "a,b\n1,2\n")
    _file(tmp_path / "feat_final_20240102.csv", "b,a\n3,4\n")
    by_position = ingest_dated_csv(spark, f"{tmp_path}/*.csv", columns=["a", "b"], strict_header=False)
    assert rows(by_position, "a", "b") == [("1", "2"), ("3", "4")]
    with pytest.raises(Exception, match="header"):
        ingest_dated_csv(spark, f"{tmp_path}/*.csv").collect()


def test_files_with_differing_headers_are_read_by_name(spark, tmp_path, rows):
    texts = {
        "feat_final_20240101.csv": "a,b\n1,x\n2,\n",
        "feat_final_20240102.csv": "b,a\ny,3\n",
        "feat_final_20240103.csv": 'B,"c,d",extra\nz,q,"1,2"\n',
        "feat_final_20240104.csv": "a,b\n",
        "feat_final_20240105.csv": "",
        "feat_final_{odd} name.csv": "a,b\n4,w\n",
    }
    for name, text in texts.items():
        _file(tmp_path / name, text)
    got = ingest_dated_csv(spark, str(tmp_path), by_name=True)
    assert got.columns == ["a", "b", "c,d", "extra", "prcsng_dt"]
    expected = [
        ("1", "x", None, None, "20240101"), ("2", None, None, None, "20240101"), ("3", "y", None, None, "20240102"),
        (None, "z", "q", "1,2", "20240103"), ("4", "w", None, None, ""),
    ]
    assert rows(got) == sorted(expected, key=repr)
    chosen = ingest_dated_csv(spark, str(tmp_path), columns=["extra", "A", "none"], by_name=True)
    assert rows(chosen) == sorted([(e, a, None, d) for a, _, _, e, d in expected], key=repr)
    one_day = got.filter("prcsng_dt = '20240102'").select("a")
    assert _files_read(one_day) == 1 and rows(one_day) == [("3",)]
    (tmp_path / "feat_final_20240106.csv").write_text("a,A\n1,2\n")
    with pytest.raises(ValueError, match="repeated names"):
        ingest_dated_csv(spark, str(tmp_path), by_name=True)
    only = str(tmp_path / "feat_final_20240105.csv")
    assert ingest_dated_csv(spark, only, columns=["a"], by_name=True).columns == ["a", "prcsng_dt"]
    with pytest.raises(ValueError, match="no file with a header"):
        ingest_dated_csv(spark, only, by_name=True)


def test_list_dated_files(spark, tmp_path, rows):
    _file(tmp_path / "f/20240101/feat_final.csv", "a\n1\n")
    _file(tmp_path / "f/20240102/feat_final.csv", "a\n22\n")
    _file(tmp_path / "f/deep/er/day=20240103/feat_final.csv", "a\n")
    _file(tmp_path / "f/20240104/other_feat_final.csv", "a\n")
    _file(tmp_path / "f/20240105/feat_finalXcsv", "a\n")
    got = list_dated_files(spark, str(tmp_path / "f"), "feat_final.csv")
    assert got.columns == ["path", "prcsng_dt", "length", "modified"]
    assert rows(got, "prcsng_dt", "length") == [("20240101", 4), ("20240102", 5), ("20240103", 2)]
    assert "content" not in got._jdf.queryExecution().executedPlan().toString()


def test_list_part_files(spark, tmp_path, rows):
    spark.range(4).repartition(2).write.csv(f"{tmp_path}/20240101/feat_final.csv")
    got = list_dated_files(spark, str(tmp_path), "feat_final.csv", part_files=True)
    assert rows(got, "prcsng_dt") == [("20240101",), ("20240101",)]


@pytest.mark.parametrize("form", ["{date}/feat_final.csv", "feat_final_{date}.csv", "a b/x_{date}+1.csv"])
def test_date_list(spark, tmp_path, rows, form):
    for day in ("20240101", "20240102", "20240103"):
        _file(tmp_path / form.format(date=day), f"a\n{day[-1]}\n")
    template = f"{tmp_path}/{form}"
    expected = [("1", "20240101"), ("3", "20240103")]
    assert rows(read_date_list(spark, template, ["20240101", "20240103", "20240101"])) == expected
    missing = ["20240103", "20240109", "20240101"]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_date_list(spark, template, missing)
    assert rows(read_date_list(spark, template, missing, on_missing="skip")) == expected


def test_date_list_arguments(spark, tmp_path):
    for template, dates, kind in (
        ("x/{date}/{date}.csv", ["20240101"], "error"),
        ("x/y.csv", ["20240101"], "error"),
        ("x/{date}.csv", ["*"], "error"),
        ("x/{date}.csv", [], "error"),
        ("x/{date}.csv", ["20240101"], "ignore"),
    ):
        with pytest.raises(ValueError):
            read_date_list(spark, f"{tmp_path}/{template}", dates, on_missing=kind)


TEXTS = ["plain", "a~b", 'say "hi"', "", None, "back\\slash", "comma, and 'quote'", " padded ", "\\N?",
         "~ends\\", 'quote\\"~', "two\nlines", "\t"]


def test_delimited_roundtrip(spark, tmp_path, rows):
    frame = spark.createDataFrame(list(enumerate(TEXTS)), "id int, note string")
    write_delimited(frame, f"{tmp_path}/out", null_value="\\N")
    back = read_delimited(spark, f"{tmp_path}/out", schema="id int, note string", null_value="\\N", multiLine=True)
    assert rows(back) == rows(frame)


def test_delimited_defaults_join_empty_and_null(spark, tmp_path, rows):
    frame = spark.createDataFrame([(1, "a~b"), (2, ""), (3, None)], "id int, note string")
    write_delimited(frame, f"{tmp_path}/out")
    text = sorted(r.value for r in spark.read.text(f"{tmp_path}/out").distinct().collect())
    assert text == ['1~"a~b"', '2~""', "3~", "id~note"]
    assert rows(read_delimited(spark, f"{tmp_path}/out")) == [("1", "a~b"), ("2", None), ("3", None)]
    write_delimited(frame.limit(1), f"{tmp_path}/out", sep=",")
    assert rows(read_delimited(spark, f"{tmp_path}/out", sep=",")) == [("1", "a~b")]


def test_missing_value_tokens(spark, tmp_path, rows):
    _file(tmp_path / "a.csv", "v,w\n1,NA\nnull,x\nNaN,\n,None\n")
    got = read_typed_csv(spark, str(tmp_path / "a.csv"), "v int, w string")
    assert rows(got, "v", "w") == sorted([(1, None), (None, "x"), (None, None), (None, None)], key=repr)


def test_overwrite_table(spark, rows):
    first = spark.createDataFrame([(1, "a"), (2, "b")], "id int, d string")
    second = spark.createDataFrame([(3, "a", 1.5)], "id int, d string, x double")
    overwrite_table(first, "feature_table")
    overwrite_table(second, "feature_table", partition_by="d", rebalance=True)
    assert rows(spark.table("feature_table"), "id", "d", "x") == [(3, "a", 1.5)]
    pruned = spark.table("feature_table").filter("d = 'zzz'")
    assert _files_read(pruned) == 0
    drop_table(spark, "feature_table")
    assert not spark.catalog.tableExists("feature_table")


@pytest.fixture(params=["managed place", "own path"])
def place(request, tmp_path):
    return str(tmp_path / "kept") if request.param == "own path" else None


def _versions(spark, name, path):
    base = path or _table_base(spark, name)
    return [f for f in os.listdir(base.removeprefix("file:"))]


def test_a_failed_overwrite_leaves_the_old_rows(spark, rows, place):
    name = new_table("kept")
    frame = spark.range(5).selectExpr("id", "CAST(id % 2 AS STRING) AS v")
    overwrite_table(frame, name, partition_by="v", path=place)
    before = rows(spark.table(name), "id", "v")

    def refuse(new):
        assert new.count() == 9
        raise ValueError("too few rows")

    failing = [
        (frame.selectExpr("id", "IF(id = 3, raise_error('no'), 'x') AS v"), {}),
        (frame.selectExpr("id", "'' AS v"), {"partition_by": "v"}),
        (spark.range(9), {"check": refuse}),
    ]
    for new, options in failing:
        with pytest.raises(Exception, match="no|read back as NULL|too few"):
            overwrite_table(new, name, path=place, **options)
        assert rows(spark.table(name), "id", "v") == before
        assert len(_versions(spark, name, place)) == 1
    assert not spark.sql(f"SHOW TABLES LIKE '{name}_*'").collect()
    drop_table(spark, name, place)
    assert _versions(spark, name, place) == []


def test_a_frame_may_read_the_table_that_it_replaces(spark, rows, place):
    name = new_table("own")
    for partition_by in (None, "p"):
        overwrite_table(spark.range(10).selectExpr("id", "id % 3 AS p"), name, path=place, partition_by=partition_by)
        old = spark.table(name)
        overwrite_table(old.filter("p > 0").unionAll(old.filter("id = 9")), name, path=place, partition_by=partition_by)
        assert rows(spark.table(name).select("id")) == [(i,) for i in (1, 2, 4, 5, 7, 8, 9)]
        assert spark.table(name).filter("p = 0").count() == 1
        assert len(_versions(spark, name, place)) == 1
    drop_table(spark, name, place)


def test_a_switch_that_a_driver_died_in(spark, rows):
    name = new_table("dead")
    overwrite_table(spark.range(3), name)
    spark.sql(f"ALTER TABLE {name} RENAME TO {name}__replaced_abc")  # before the second rename
    assert recover_table(spark, name) and spark.table(name).count() == 3
    spark.range(4).write.saveAsTable(f"{name}__replaced_abd")  # after it
    overwrite_table(spark.range(6), name)
    assert spark.table(name).count() == 6 and not spark.sql(f"SHOW TABLES LIKE '{name}__*'").collect()
    spark.sql("CREATE DATABASE IF NOT EXISTS other")
    overwrite_table(spark.range(2), "other.t")
    overwrite_table(spark.range(7), "`other`.`t`", bucket_by=(2, "id"))
    assert spark.table("other.t").count() == 7
    drop_table(spark, "other.t")
    drop_table(spark, name)
    drop_table(spark, name)


def test_bucketed_tables_are_compared_without_a_shuffle(spark, rows, plan, setting):
    setting(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    frame = spark.range(100).withColumn("v", F.col("id") * 2)
    overwrite_table(frame, "bucketed_a", bucket_by=(4, "id"))
    changed = frame.withColumn("v", F.when(F.col("id") == 5, 0).otherwise(F.col("v")))
    overwrite_table(changed, "bucketed_b", bucket_by=(4, "id"))
    cells = diff_cells(spark.table("bucketed_a"), spark.table("bucketed_b"), "id")
    assert "Exchange" not in plan(cells)
    assert rows(cells) == [(5, "v", "10", "0")]
    for name in ("bucketed_a", "bucketed_b"):
        spark.sql(f"DROP TABLE {name}")


def test_scratch_must_be_shared_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "yarn"}.get(key, default)

    class Session:
        conf = Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_base(Session())


def test_scratch_is_the_sessions_shared_folder(spark, setting):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch_base(spark) == shared
    one, two = new_scratch(spark, "x"), new_scratch(spark, "x")
    assert one != two and one.startswith(shared)


def test_no_file_for_any_date(spark, tmp_path, rows):
    template = f"{tmp_path}/day={{date}}/x.csv"
    empty = read_date_list(spark, template, ["20240101"], on_missing="skip", columns=["a"])
    assert empty.columns == ["a", "prcsng_dt"] and rows(empty) == []
    with pytest.raises(ValueError, match="no file for any date"):
        read_date_list(spark, template, ["20240101"], on_missing="skip")


def test_files_per_bucket_and_empty_partition_values(spark, tmp_path):
    frame = spark.range(0, 1000, 1, 16).selectExpr("id", "CAST(id % 3 AS STRING) AS v")
    overwrite_table(frame, new_table("bucketed"), bucket_by=(8, "id"), path=f"{tmp_path}/t")
    assert len(list((tmp_path / "t").glob("*/part-*.parquet"))) == 8
    with pytest.raises(Exception, match="partition column 'v'"):
        overwrite_table(frame.selectExpr("id", "'' AS v"), new_table("parts"), partition_by="v")
    with pytest.raises(Exception, match="null_value"):
        write_delimited(frame.selectExpr("'-' AS v"), f"{tmp_path}/d", null_value="-")


def test_scratch_tables_are_dropped(spark):
    name = new_table("leftover")
    overwrite_table(spark.range(3), name)
    assert spark.catalog.tableExists(name)
    clear_scratch(spark)
    assert not spark.catalog.tableExists(name)
