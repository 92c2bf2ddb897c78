"""What Python workers need: this package, and batches of a bounded size."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import SparkSession

from featward.session import ship_package

BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 8 << 20


def prepare(spark: SparkSession) -> None:
    """Make the session ready for the operators; may be called any number of times.

    Functions that run in workers are pickled by reference, so the package's source goes to the
    executors once, as one small archive. Texts go to Python in batches of at most 8 MB, unless the
    session says less: a batch is held by the JVM and by the worker, for every task of an
    executor, so the usual 64 MB would take half a gigabyte beside the heap.
    """
    ship_package(spark)
    now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(BATCH))
    if now > BATCH_BYTES:
        spark.conf.set(BATCH, f"{BATCH_BYTES}b")


def give_back() -> None:
    """Return freed memory to the system, so that a worker that Spark uses again starts small."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the C library, where it has one
    if trim:
        trim(0)
