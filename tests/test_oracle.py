"""Every registered query against its SQL, and the blueprint's row counts."""

import importlib.util

import duckdb
import pytest

from conftest import DATA, ROOT
from featward import (
    compare_positional,
    diff_cells,
    diff_flags,
    diff_report,
    match_rows,
    row_multiset_diff,
)
from featward.plans.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()

spec = importlib.util.spec_from_file_location("spark_entry", ROOT / "__spark_entry__.py")
spark_entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(spark_entry)


def duck(sf):
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{DATA / sf / name}.parquet'")
    return connection


def in_order(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, name):
    df = spark_entry.queries()[name](spark, str(DATA / "sf0.001"))
    sql = spark_entry.oracle_sql()[name]
    connection = duck("sf0.001")
    columns = sorted(connection.sql(sql).columns)
    assert sorted(df.columns) == columns
    expected = connection.sql(f"SELECT {', '.join(f'"{c}"' for c in columns)} FROM ({sql})").fetchall()
    found = in_order(df.select(*columns).collect())
    assert found == in_order(expected)
    assert found


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0


ORIG = """
SELECT o_orderkey AS id,
       CAST(CASE WHEN o_orderkey % 83 = 0 THEN NULL ELSE o_orderstatus END AS VARCHAR(10)) AS status,
       CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR(20)) AS price
FROM orders"""
NEW = """
SELECT o_orderkey AS id,
       CAST(CASE WHEN o_orderkey % 79 = 0 THEN 'X' ELSE o_orderstatus END AS VARCHAR(10)) AS status,
       CAST(CAST(CASE WHEN o_orderkey % 97 = 0 THEN CAST(o_totalprice AS DECIMAL(15,2)) + 1
                      WHEN o_orderkey % 89 = 0 THEN NULL
                      ELSE CAST(o_totalprice AS DECIMAL(15,2)) END AS DECIMAL(15,2)) AS VARCHAR(20)) AS price
FROM orders WHERE o_orderkey % 101 <> 0
UNION ALL
SELECT o_orderkey + 10000000, CAST(o_orderstatus AS VARCHAR(10)),
       CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR(20))
FROM orders WHERE o_orderkey % 103 = 0"""
STATUS = """
SELECT o_orderkey AS id,
       CAST(CASE WHEN o_orderkey % 79 = 0 THEN 'X' ELSE o_orderstatus END AS VARCHAR(10)) AS status
FROM orders"""


def test_blueprint_counts(spark):
    """The fixture definitions of the blueprint give the row counts it lists for sf0.01."""
    spark.read.parquet(str(DATA / "sf0.01" / "orders.parquet")).createOrReplaceTempView("orders")
    orig, new, status = (spark.sql(q) for q in (ORIG, NEW, STATUS))
    counts = {
        "diff_cells": diff_cells(orig, new, "id"),
        "diff_cells_nullsafe": diff_cells(orig, new, "id", null_safe=True),
        "diff_flags_price": diff_flags(orig, new, "id", "price"),
        "diff_report": diff_report(orig, new, "id"),
        "match_rows_unmatched": match_rows(orig, new, unmatched_only=True),
        "match_rows_unmatched_self": match_rows(orig, orig, unmatched_only=True),
        "row_multiset_diff": row_multiset_diff(orig, new),
        "compare_positional": compare_positional(orig.select("id", "status"), status, "id"),
    }
    assert {name: df.count() for name, df in counts.items()} == {
        "diff_cells": 339,
        "diff_cells_nullsafe": 1272,
        "diff_flags_price": 15146,
        "diff_report": 338,
        "match_rows_unmatched": 1651,
        "match_rows_unmatched_self": 362,
        "row_multiset_diff": 1651,
        "compare_positional": 368,
    }
