"""Inputs the registered queries derive from the given tables, each over a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featward.operators.models import LogisticModel, TreeEnsemble
from featward.session import new_scratch

RUN_DT = "20240305"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _every(n: int):
    return F.col("o_orderkey") % n == 0


def _price():
    return F.col("o_totalprice").cast("decimal(15,2)")


def original_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders as id, status, price; some statuses are NULL."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.when(~_every(83), F.col("o_orderstatus")).alias("status"),
        _price().cast("string").alias("price"),
    )


def restated_orders(spark: SparkSession, sf_dir: str, rekeyed: bool = True) -> DataFrame:
    """All orders again with some statuses and prices changed and some prices NULL.

    ``rekeyed`` also gives some orders a new, negative id: to a keyed diff the old id is removed
    and the new one added.
    """
    key = F.col("o_orderkey")
    price = F.when(_every(97), _price() + 1).when(~_every(89), _price())
    return table(spark, sf_dir, "orders").select(
        (F.when(_every(101), -key - 1).otherwise(key) if rekeyed else key).alias("id"),
        F.when(_every(79), "X").otherwise(F.col("o_orderstatus")).alias("status"),
        price.cast("decimal(15,2)").cast("string").alias("price"),
    )


def mixed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All parts with a text that is a number, or nearly one, or a word."""

    def every(n: int):
        return F.col("p_partkey") % n == 0

    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(every(5), F.col("p_brand"))
        .when(every(7), "")
        .when(every(11), " 12 ")
        .when(every(13), "1e3")
        .when(every(17), F.lit(None))
        .when(every(19), "1,000")
        .when(every(23), "NaN")
        .otherwise(F.col("p_size").cast("string"))
        .alias("v"),
    )


LOGISTIC = LogisticModel(("l_quantity", "l_discount", "l_tax"), (0.04, -12.0, 5.0), -1.0)


def _split(nodeid: int, feature: str, below: float, yes: dict, no: dict) -> dict:
    return {
        "nodeid": nodeid, "split": feature, "split_condition": below,
        "yes": yes["nodeid"], "no": no["nodeid"], "missing": yes["nodeid"], "children": [yes, no],
    }


def _leaf(nodeid: int, value: float) -> dict:
    return {"nodeid": nodeid, "leaf": value}


TREES = TreeEnsemble(
    ("l_quantity", "l_discount", "l_tax"),
    (
        _split(
            0, "l_quantity", 25.0,
            _split(1, "l_discount", 0.05, _leaf(3, -0.75), _leaf(4, 0.5)),
            _leaf(2, 1.25),
        ),
        _split(0, "l_tax", 0.04, _leaf(1, -0.5), _leaf(2, 0.25)),
    ),
)


MANY_TREES, MANY_DEPTH = 500, 6


def many_trees(count: int = MANY_TREES, depth: int = MANY_DEPTH) -> TreeEnsemble:
    """Full trees over the line features, by a rule from the numbers of tree and node.

    Node ``i`` has the children ``2 i`` and ``2 i + 1``. Leaf values are whole 1024ths, so that their sum does not
    depend on its order.
    """
    features = ("l_quantity", "l_discount", "l_tax")

    def node(t: int, i: int) -> dict:
        if i >> depth:
            return _leaf(i, ((t * 31 + i * 57) % 257 - 128) / 1024)
        which = (t * 7 + i * 3 + i // 4) % 3
        below = (1 + (t * 13 + i * 17) % 50, (t * 5 + i * 11) % 11 / 100, (t * 3 + i * 7) % 9 / 100)[which]
        return _split(i, features[which], float(below), node(t, 2 * i), node(t, 2 * i + 1))

    return TreeEnsemble(features, tuple(node(t, 1) for t in range(count)))


def _event_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("user_id").cast("string").alias("user_id"),
        "event_type",
        "props",
        F.date_format(F.col("ts").cast("date"), "yyyyMMdd").alias("day"),
    )


def dated_files(spark: SparkSession, sf_dir: str) -> str:
    """All events as CSV in ``…/file=feat_final_<day>.csv/``; returns the root.

    The rebalance hint lets adaptive execution split a large day over several part files.
    """
    root = new_scratch(spark, "dated-files")
    rows = _event_text(spark, sf_dir)
    name = F.concat(F.lit("feat_final_"), F.col("day"), F.lit(".csv")).alias("file")
    (
        rows.select("event_id", "user_id", "event_type", "props", name)
        .hint("rebalance", "file")
        .write.partitionBy("file")
        .option("header", True)
        .csv(root)
    )
    return root


def drifting_files(spark: SparkSession, sf_dir: str) -> str:
    """As :func:`dated_files`, but the columns' order and number change over the days."""
    root = new_scratch(spark, "drifting-files")
    rows = _event_text(spark, sf_dir).withColumn("length", F.length("props").cast("string"))
    name = F.concat(F.lit("feat_final_"), F.col("day"), F.lit(".csv")).alias("file")
    third = F.substring("day", 7, 2).cast("int") % 3
    shapes = [
        ["event_id", "user_id", "event_type", "props"],
        ["props", "event_id", "event_type", "user_id"],
        ["event_type", "length", "event_id"],
    ]
    for i, columns in enumerate(shapes):
        part = rows.filter(third == i).select(*columns, name).hint("rebalance", "file")
        part.write.mode("append").partitionBy("file").option("header", True).csv(root)
    return root


def dated_tree(spark: SparkSession, sf_dir: str) -> str:
    """All events as CSV in ``…/day=<day>/name=feat_final.csv/``; returns the root."""
    root = new_scratch(spark, "dated-tree")
    (
        _event_text(spark, sf_dir)
        .withColumn("name", F.lit("feat_final.csv"))
        .hint("rebalance", "day")
        .write.partitionBy("day", "name")
        .option("header", True)
        .csv(root)
    )
    return root


def ordered_csv(df: DataFrame, order_by: str) -> str:
    """The frame as CSV whose lines, part file after part file, are in the given order."""
    path = new_scratch(df.sparkSession, "ordered-csv")
    df.orderBy(order_by).write.option("header", True).csv(path)
    return path
