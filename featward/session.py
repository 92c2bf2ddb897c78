"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_own_base: str | None = None
_issued: list[str] = []
_tables: list[str] = []
_shipped: set[str] = set()


def get_spark(app: str = "featward", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators are planned for.

    AQE does the run-time work: it sizes shuffle partitions, turns joins with a small
    side into broadcasts and splits hot join partitions. Where every partition of one side came
    out below the threshold, it hashes that side and neither side is sorted.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package's source, once, as one small archive: functions that run in Python workers are
    pickled by reference."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="featward-")), "featward.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def scratch_base(spark: SparkSession) -> str:
    """Folder all executors can reach: the session's ``spark.checkpoint.dir``.

    A folder of our own is used only in local mode with the setting absent.
    """
    global _own_base
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if _own_base is None:
        _own_base = tempfile.mkdtemp(prefix="featward-")
        atexit.register(shutil.rmtree, _own_base, ignore_errors=True)
    return _own_base


def new_scratch(spark: SparkSession, label: str) -> str:
    """A fresh path below the scratch folder."""
    path = f"{scratch_base(spark)}/{label}-{uuid.uuid4().hex}"
    _issued.append(path)
    return path


def new_table(label: str) -> str:
    """A fresh table name, dropped with the scratch paths."""
    name = f"{label}_{uuid.uuid4().hex}"
    _tables.append(name)
    return name


def clear_scratch(spark: SparkSession) -> None:
    """Delete every scratch path and table that this process was given.

    Frames still to be evaluated may read from them, so call it after the last action. A driver that
    dies leaves its paths; they are below ``spark.checkpoint.dir`` and named after their use.
    """
    while _tables:
        spark.sql(f"DROP TABLE IF EXISTS {_tables.pop()}")
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    while _issued:
        path = jvm.org.apache.hadoop.fs.Path(_issued.pop())
        path.getFileSystem(conf).delete(path, True)
