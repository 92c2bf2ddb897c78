"""Table sink: a table is replaced by writing beside it and switching over."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featward.functions.names import as_list, named, positions

REPLACED = "__replaced_"


def _suffixed(name: str, suffix: str) -> str:
    """The table name with a suffix; ``db.t`` and back-ticked names too."""
    return f"{name[:-1]}{suffix}`" if name.endswith("`") else name + suffix


def _bare(name: str) -> tuple[str, str]:
    """Database ('' for the current one) and plain name of a table."""
    db, _, table = name.replace("`", "").rpartition(".")
    return db, table


def _table_base(spark: SparkSession, name: str) -> str:
    """Where versions of a table without a path go: beside the managed tables of its database."""
    db, table = _bare(name)
    location = spark.catalog.getDatabase(db or spark.catalog.currentDatabase()).locationUri
    return f"{location.rstrip('/')}/{table}.versions"


def _detail(spark: SparkSession, name: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name IN ('Location', 'Type')")
    return {r["col_name"]: r["data_type"] for r in rows.collect()}


def _delete(spark: SparkSession, path: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _below(spark: SparkSession, path: str, base: str) -> bool:
    """Is the path a direct child of the base, whichever way either is written?"""

    def full(text: str):
        path = spark._jvm.org.apache.hadoop.fs.Path(text)
        return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path)

    parent = full(path).getParent()
    return parent is not None and parent.equals(full(base))


def _drop(spark: SparkSession, name: str, base: str) -> None:
    """Drop a table, and its rows too if they are one of our versions (a managed table loses them anyway)."""
    location = _detail(spark, name).get("Location")
    spark.sql(f"DROP TABLE {name}")
    if location and _below(spark, location, base):
        _delete(spark, location)


def recover_table(spark: SparkSession, name: str, path: str | None = None) -> bool:
    """Finish or undo a replacement that a driver died in; True if the table had to be put back.

    Between the two renames of a switch the table has another name. If it is still there and the table itself is
    not, it gets its name back; if both are there the switch was complete, and the old one goes.
    :func:`overwrite_table` does this first.
    """
    db, table = _bare(name)
    where = f" IN `{db}`" if db else ""
    found = spark.sql(f"SHOW TABLES{where} LIKE '{table}{REPLACED}*'").filter("NOT isTemporary")
    others = sorted(r["tableName"] for r in found.collect())
    put_back = False
    for other in others:
        other = ".".join(f"`{part}`" for part in (db, other) if part)
        if spark.catalog.tableExists(name):
            _drop(spark, other, path or _table_base(spark, name))
        else:
            spark.sql(f"ALTER TABLE {other} RENAME TO {name}")
            put_back = True
    return put_back


def _switch(spark: SparkSession, name: str, staged: str, base: str, version: str) -> None:
    """Give the staged table the name of the one that it replaces."""
    replaced = _suffixed(name, REPLACED + version)
    before = spark.catalog.tableExists(name)
    if before:
        spark.sql(f"ALTER TABLE {name} RENAME TO {replaced}")
    try:
        spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")
    except Exception:
        if before:
            spark.sql(f"ALTER TABLE {replaced} RENAME TO {name}")
        raise
    if before:
        _drop(spark, replaced, base)
    spark.catalog.refreshTable(name)


def overwrite_table(
    df: DataFrame,
    name: str,
    partition_by: str | Sequence[str] | None = None,
    bucket_by: tuple[int, str | Sequence[str]] | None = None,
    fmt: str = "parquet",
    path: str | None = None,
    rebalance: bool = False,
    check: Callable[[DataFrame], None] | None = None,
) -> None:
    """Replace the table by the frame. ``fmt='delta'`` needs that package on the class path, and leaves
    the replacement to it.

    The rows are written as a new version, a directory of its own below ``path`` (or beside the
    managed tables of the database), then ``check`` may look at them and raise, and only then the table's name goes to
    the new version and the old one is deleted. Until then the old rows stay as they are: a write that fails, a
    check that raises, or a driver that dies (:func:`recover_table`) loses nothing, and the frame may
    read the table that it replaces. No file is moved. The table is an external one, read by its
    name; :func:`drop_table` deletes its rows with it. A reader that began with the old version may find its files
    gone.

    ``partition_by`` gives later reads partition pruning. Partition values are directory names, which
    cannot tell '' from NULL: an empty text in such a column stops the write. ``bucket_by=(n, key)``
    lets keyed diffs of two such tables join without a shuffle; the rows are dealt out by the key
    first, so that there is one sorted file per bucket (with ``partition_by``, per partition and
    bucket). Such a join sorts nothing either if
    ``spark.sql.legacy.bucketedTableScan.outputOrdering`` is true. ``rebalance`` shuffles by the
    partition columns first, so that files come out evenly sized and a large partition is split
    over tasks; it does nothing beside ``bucket_by``.
    """
    spark = df.sparkSession
    parts = as_list(partition_by or [])
    for i in positions(df.columns, parts, "written"):
        if isinstance(df.schema[i].dataType, T.StringType):
            column = df.columns[i]
            message = f"'' in partition column {column!r} would be read back as NULL; replace it first"
            checked = F.when(named(column) == "", F.raise_error(F.lit(message))).otherwise(named(column))
            df = df.withColumn(column, checked)
    if bucket_by:
        df = df.repartition(bucket_by[0], *[named(c) for c in as_list(bucket_by[1])])
    elif rebalance:
        df = df.hint("rebalance", *parts)
    writer = df.write.format(fmt)
    if parts:
        writer = writer.partitionBy(*parts)
    if bucket_by:
        buckets, key = bucket_by
        key = as_list(key)
        writer = writer.bucketBy(buckets, *key).sortBy(*key)
    if fmt == "delta":
        writer = writer.option("path", path) if path else writer
        writer.mode("overwrite").saveAsTable(name)
        return
    recover_table(spark, name, path)
    version = uuid.uuid4().hex
    base = (path or _table_base(spark, name)).rstrip("/")
    staged, location = _suffixed(name, f"__staged_{version}"), f"{base}/{version}"
    try:
        writer.mode("errorifexists").option("path", location).saveAsTable(staged)
        if check:
            check(spark.table(staged))
        _switch(spark, name, staged, base, version)
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {staged}")
        _delete(spark, location)
        raise


def drop_table(spark: SparkSession, name: str, path: str | None = None) -> None:
    """Drop a table written by :func:`overwrite_table`, with its rows; nothing if there is none."""
    recover_table(spark, name, path)
    if spark.catalog.tableExists(name):
        _drop(spark, name, path or _table_base(spark, name))
