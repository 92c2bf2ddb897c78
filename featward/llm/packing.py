"""Integer arrays as bytes, for columns that carry a task's share of a count as one value."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKET_TEXT = 4 << 20  # bytes of text that a bucket is meant for
MOST_BUCKETS = 1 << 14


def pack(values: np.ndarray) -> bytes:
    """Non-negative integers in the fewest bytes each that hold the largest."""
    most = int(values.max(initial=0))
    kind = next(k for k in ("u1", "u2", "u4", "u8") if most < 1 << 8 * int(k[1]))
    return kind[1].encode() + np.ascontiguousarray(values.astype("<" + kind)).tobytes()


def unpack(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, "<u" + chr(packed[0]), offset=1)


def pack_sorted(values: np.ndarray) -> bytes:
    """Rising integers by their differences."""
    return pack(np.diff(values, prepend=np.zeros(1, values.dtype)))


def unpack_sorted(packed: bytes) -> np.ndarray:
    return np.cumsum(unpack(packed).astype(np.uint64), dtype=np.uint64)


def buckets_of(rows: DataFrame, text_col: str = "text") -> int:
    """How many buckets the counts of these texts are dealt into: one per 4 MB of text, so that a bucket stays as large
    as it is however much there is, but at least the session's shuffle partitions. Beyond 64 GB of text buckets
    grow, unless there are more shuffle partitions."""
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = rows.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return max(least, min(MOST_BUCKETS, -(-size // BUCKET_TEXT)))


def dealt(packed: DataFrame, buckets: int) -> DataFrame:
    """Each bucket in a task of its own, its rows one after the other, sorted by Spark, which spills.

    Dealt by its number, a bucket would share its task with some others; so each goes by a number that Spark's hash
    sends to the task of the bucket's number.
    """
    numbers = packed.sparkSession.range(40 * buckets).select(F.col("id").cast("int").alias("slot"))
    slots = numbers.groupBy(F.pmod(F.hash("slot"), F.lit(buckets)).alias("bucket")).agg(F.min("slot").alias("slot"))
    by_slot = packed.join(F.broadcast(slots), "bucket", "left").withColumn("slot", F.coalesce("slot", "bucket"))
    return by_slot.repartition(buckets, "slot").sortWithinPartitions("bucket").drop("slot")


def by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[dict]]]:
    """The buckets of a partition in which their rows follow each other; one is held at a time."""
    bucket, found = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row["bucket"] != bucket:
                if found:
                    yield bucket, found
                bucket, found = row["bucket"], []
            found.append(row)
    if found:
        yield bucket, found
