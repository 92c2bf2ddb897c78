"""Row numbers over a whole table without putting it into one task."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featward.functions.compare import comparable
from featward.functions.names import as_list, named, positional, positions, refuse_taken
from featward.session import new_scratch
from featward.sources.delimited import FILE_ORDER

# monotonically_increasing_id() keeps the partition in its upper bits and the row in the lower 33.
ROW_BITS = 33


def _hashable(dtype: T.DataType) -> bool:
    try:
        comparable("c", dtype)
    except TypeError:
        return False
    return True


def number_rows(df: DataFrame, order_by: str | Iterable[str], start: int = 0) -> tuple[DataFrame, int]:
    """Columns c0… and ``pos`` for a frame, and its number of rows.

    Two steps run at once. The rows are sorted, which partitions them by range, and written to the
    scratch folder, each with its partition and place in it: a written table has the same
    partitions for every reader, also after an executor was lost. Then the rows per partition are
    counted. The counts and the broadcast offsets hold one row per range partition, at most
    ``spark.sql.shuffle.partitions``, not per data row.
    Ties in ``order_by`` are broken by a hash of the row and, among exact copies, by the input
    partition, so that neither a hot order value nor a hot group of copies stays in one task.
    """
    spark = df.sparkSession
    order = [f"c{i}" for i in positions(df.columns, as_list(order_by), "ordered")]
    row = positional(df, "c")
    tie = F.xxhash64(*[F.expr(f"xxhash64({comparable(f.name, f.dataType)})") for f in row.schema.fields if _hashable(f.dataType)])
    sort = [*[F.col(c) for c in order], tie, F.col("at_partition")]
    path = new_scratch(spark, "ordered-rows")
    (
        row.withColumn("at_partition", F.spark_partition_id())
        .orderBy(*sort)
        .withColumn("place", F.monotonically_increasing_id())
        .drop("at_partition")
        .write.parquet(path)
    )
    stored = T.StructType([*row.schema.fields, T.StructField("place", T.LongType())])
    written = spark.read.schema(stored).parquet(path)
    part = F.shiftright("place", ROW_BITS)
    counts = dict(written.groupBy(part.alias("part")).count().collect())
    offsets, total = [], 0
    for number in sorted(counts):
        offsets.append((number, total + start))
        total += counts[number]
    before = spark.createDataFrame(offsets, "part long, before long")
    numbered = (
        written.join(F.broadcast(before), part == F.col("part"))
        .withColumn("pos", F.col("before") + F.col("place").bitwiseAND(F.lit((1 << ROW_BITS) - 1)))
        .select(*row.columns, "pos")
    )
    return numbered, total


# Splits of a scan whose starts are broadcast, 24 bytes each; more are joined by a shuffle.
BROADCAST_SPLITS = 2_000_000


def _running_totals(spark: SparkSession, sizes: DataFrame, order: list[str], size: str) -> DataFrame:
    """The frame with ``before``, the sum of ``size`` over all rows that come earlier in the order.

    Rows are sorted, which partitions them by range, and written; the sum runs within each range, and
    the ranges' own totals, one per partition, say where each starts.
    """
    path = new_scratch(spark, "running-totals")
    sizes.orderBy(*order).withColumn("place", F.monotonically_increasing_id()).write.parquet(path)
    written = spark.read.parquet(path).withColumn("part", F.shiftright("place", ROW_BITS))
    totals = sorted(written.groupBy("part").agg(F.sum(size).alias("total")).collect())
    starts, total = [], 0
    for row in totals:
        starts.append((row["part"], total))
        total += row["total"]
    within = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return (
        written.withColumn("within", F.coalesce(F.sum(size).over(within), F.lit(0)))
        .join(F.broadcast(spark.createDataFrame(starts, "part long, start long")), "part")
        .withColumn("before", F.col("start") + F.col("within"))
        .drop("part", "place", "within", "start")
    )


def number_file_rows(df: DataFrame) -> tuple[DataFrame, int]:
    """As :func:`number_rows` for a frame fresh from a file scan, in the order of its lines.

    The splits of a scan are pieces of that order already, so the rows are written as they are
    read, once and without a shuffle. The rows of each split are counted from the written table, and
    running totals over the splits say where each starts. A row finds its split by the partition
    that read it, which the upper bits of its number hold, and the first number of the split.
    """
    spark = df.sparkSession
    order, columns = F.col(FILE_ORDER), [c for c in df.columns if c != FILE_ORDER]
    place = [f for f in df.schema[FILE_ORDER].dataType.names if f != "row"]
    names = [f"c{i}" for i in range(len(columns))]
    rows, starts = new_scratch(spark, "file-rows"), new_scratch(spark, "split-starts")
    (
        df.select(*[named(c) for c in columns], *[order[f] for f in place], order["row"])
        .toDF(*names, *place, "row")
        .write.parquet(rows)
    )
    written = spark.read.parquet(rows)
    splits = written.groupBy(*place).agg(F.count("row").alias("size"), F.min("row").alias("first"))
    (
        _running_totals(spark, splits, place, "size")
        .groupBy(F.shiftright("first", ROW_BITS).alias("task"))
        .agg(
            F.sort_array(F.collect_list(F.struct("first", (F.col("before") - F.col("first")).alias("shift")))).alias("splits"),
            F.sum("size").alias("size"),
        )
        .write.parquet(starts)
    )
    by_task = spark.read.parquet(starts)
    number, total = by_task.agg(F.coalesce(F.sum(F.size("splits")), F.lit(0)), F.coalesce(F.sum("size"), F.lit(0))).first()
    shift = F.aggregate(
        "splits", F.lit(0).cast("long"), lambda found, s: F.when(s["first"] <= F.col("row"), s["shift"]).otherwise(found)
    )
    known = by_task.select("task", "splits")
    numbered = (
        written.select(*names, "row", F.shiftright("row", ROW_BITS).alias("task"))
        .join(F.broadcast(known) if number <= BROADCAST_SPLITS else known, "task")
        .withColumn("pos", F.col("row") + shift)
        .select(*names, "pos")
    )
    return numbered, total


def with_ordinal(
    df: DataFrame, order_by: str | Iterable[str], name: str = "pos", start: int = 0
) -> DataFrame:
    """The frame with each row's place in the order of ``order_by``, counted from ``start``.

    ``order_by`` should be unique: rows that tie get consecutive numbers in an order of their own.
    """
    refuse_taken(df.columns, [name])
    numbered, _ = number_rows(df, order_by, start)
    return numbered.toDF(*df.columns, name)
