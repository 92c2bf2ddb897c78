"""Header CSVs whose headers differ from file to file, read by name."""

from __future__ import annotations

import csv
import re
from collections.abc import Callable
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featward.functions.names import quoted, repeated
from featward.session import new_scratch
from featward.sources.delimited import text_schema


def header_census(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``path`` and ``header``, the first line, of every file that has one: one pass over the text, unparsed."""
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        "value",
    )
    first = F.min_by("value", "row").alias("header")
    return lines.filter("block = 0").groupBy("path").agg(first).filter("trim(header) <> ''")


def _names(header: str, sep: str, path: str) -> list[str]:
    names = next(csv.reader([header.removeprefix("﻿")], delimiter=sep, strict=True))
    low = [n.lower() for n in names]
    if not all(names) or repeated(low):
        raise ValueError(f"the header of {path} has empty or repeated names: {names}")
    return names


def _as_glob(path: str) -> str:
    """A path as Spark reports it, as one that it reads: not encoded, and without a pattern's characters."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", unquote(path))


def read_csv_by_name(
    spark: SparkSession,
    paths: str | list[str],
    columns: list[str] | None = None,
    extra: dict[str, Callable[[], Column]] | None = None,
    **options,
) -> DataFrame:
    """All header CSVs as text, every value under its own file's name for it, NULL where a file lacks the column.

    A census of the headers groups the files; each group is one scan with its own header, which is checked again as
    it is read, and the groups are put together by name. Columns are ``columns``, others being left out, or all
    names in the order in which files, sorted by path, bring them up. Names that differ only in case are one. ``extra`` gives
    further text columns by their names, made within each scan from what is known of a file. A header with empty or repeated names is an
    error; files without any line have no rows. There is one scan per distinct header; the driver holds the paths, as
    it does for any scan.
    """
    sep = options.get("sep", ",")
    extra = extra or {}
    path = new_scratch(spark, "headers")
    header_census(spark, paths).write.parquet(path)
    census = spark.read.parquet(path)
    headers = [r["header"] for r in census.groupBy("header").agg(F.min("path").alias("path")).orderBy("path").toLocalIterator()]
    groups = []
    for header in headers:
        mine = census.filter(F.col("header") == header).select("path").toLocalIterator()
        groups.append((sorted(r["path"] for r in mine), header))
    known = [_names(header, sep, files[0]) for files, header in groups]
    order: dict[str, str] = {}
    for name in columns or [n for names in known for n in names]:
        if name.lower() not in {e.lower() for e in extra}:  # as a column of that name is replaced elsewhere
            order.setdefault(name.lower(), name)
    if not order:
        raise ValueError(f"no file with a header in {paths}; give columns to get an empty frame")
    scans = []
    for (files, _), names in zip(groups, known):
        reader = spark.read.options(**options).option("header", True).option("enforceSchema", False)
        rows = reader.schema(text_schema(names)).csv([_as_glob(f) for f in files])
        at = {n.lower(): n for n in names}
        found = [
            F.col(quoted(at[low])).alias(name) if low in at else F.lit(None).cast("string").alias(name)
            for low, name in order.items()
        ]
        scans.append(rows.select(*found, *[column().alias(name) for name, column in extra.items()]))
    if not scans:
        return spark.createDataFrame([], text_schema([*order.values(), *extra]))
    return reduce(DataFrame.unionAll, scans)
