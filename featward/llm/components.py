"""Connected components of a table of links, by contracting it until no link is left."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featward.session import new_scratch


def written(df: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the shared scratch folder: lineage ends there, and a lost executor
    costs nothing that has been written."""
    path = new_scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node reachable, for every node of links (a, b).

    Each round every node that has a smaller neighbour joins the smallest of them, links are
    relabelled, and those within one node go. A round is a map-side combined minimum and two
    equi-joins against a written table with one row per node, so adaptive execution can split a
    node with very many links. Rounds grow with the logarithm of the longest chain.
    """
    spark = links.sparkSession
    left = written(
        links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    steps = []
    while not left.isEmpty():
        parent = written(left.groupBy("a").agg(F.min("b").alias("up")), "parents")
        steps.append(parent)

        def raised(df: DataFrame, column: str, parent: DataFrame = parent) -> DataFrame:
            up = parent.select(F.col("a").alias(column), F.col("up"))
            return df.join(up, column, "left").withColumn(column, F.coalesce("up", column)).drop("up")

        ends = raised(raised(left, "a"), "b").filter("a <> b")
        left = written(
            ends.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
        )
    nodes = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    found = nodes.withColumn("component", F.col("node"))
    for parent in steps:
        up = parent.select(F.col("a").alias("component"), "up")
        found = found.join(up, "component", "left").select("node", F.coalesce("up", "component").alias("component"))
    return written(found, "components") if steps else found
