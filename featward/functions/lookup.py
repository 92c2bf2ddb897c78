"""Keys to look up in a semi or anti join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_keys(keys: DataFrame) -> DataFrame:
    """The keys with at most one copy of each per input partition.

    Copies of a hot key are dropped before they are shuffled. Going by partition, and not making
    the keys distinct outright, leaves the join its own shuffle on this side: adaptive execution
    splits a hot key of the other side only if both inputs come straight from one.
    """
    names = keys.columns
    return keys.withColumn("at_partition", F.spark_partition_id()).distinct().select(*names)
