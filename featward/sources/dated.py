"""Files whose date is part of their path.

The date is computed from ``_metadata.file_path``, a constant per file, so a filter on it drops
whole files before they are read.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featward.sources.delimited import read_header_csv, text_schema
from featward.sources.headers import read_csv_by_name

# Fixed value: the file-name form of a dated feature file; group 1 is the date.
DATED_FILE = r"feat_final_(\d{8})\.csv"
DATE_COLUMN = "prcsng_dt"


def ingest_dated_csv(
    spark: SparkSession,
    path_glob: str | list[str],
    date_pattern: str = DATED_FILE,
    columns: list[str] | None = None,
    strict_header: bool = True,
    by_name: bool = False,
    **options,
) -> DataFrame:
    """All header CSVs of a glob, every column as text, with ``prcsng_dt`` from the file name.

    A path the pattern does not match gets ''; its rows are kept (a table partitioned by the date
    cannot hold ''). A file whose header names other columns, or the same in another order, is an
    error. ``by_name=True`` reads each file by its own header (:func:`featward.sources.headers.read_csv_by_name`):
    values land under their names, NULL where a file lacks the column; a filter on the date drops files from
    every group of like headers. ``strict_header=False`` reads all files by position, whatever their headers say.
    """
    if by_name:

        def date() -> Column:
            return F.regexp_extract(F.col("_metadata.file_path"), date_pattern, 1)

        return read_csv_by_name(spark, path_glob, columns, {DATE_COLUMN: date}, **options)
    rows = read_header_csv(spark, path_glob, columns, strict_header, **options)
    return rows.withColumn(
        DATE_COLUMN, F.regexp_extract(F.col("_metadata.file_path"), date_pattern, 1)
    )


def list_dated_files(
    spark: SparkSession, root: str, name: str, part_files: bool = False
) -> DataFrame:
    """Files called ``name`` at any depth below ``root``: path, prcsng_dt, length, modified.

    The date is the directory above the file, plain or written ``column=date``. With
    ``part_files`` the name is a directory of part files, as Spark writes them, and each part is
    listed. No content is read.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    above = r"(?:[^/=]+=)?([^/]+)"
    if part_files:
        shape = rf"/{above}/{re.escape(name)}/[^/]+$"
    else:
        files = files.option("pathGlobFilter", re.sub(r"([\\*?\[\]{}])", r"\\\1", name))
        shape = rf"/{above}/[^/]+$"
    return (
        files.load(root)
        .filter(F.col("path").rlike(shape))
        .select(
            "path",
            F.regexp_extract("path", shape, 1).alias(DATE_COLUMN),
            "length",
            F.col("modificationTime").alias("modified"),
        )
    )


def _in_uri(text: str) -> str:
    return re.escape(quote(text, safe="/:=,+@!$&'()*;~-._"))


def _any_file(spark: SparkSession, glob: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(glob)
    return bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path))


def read_date_list(
    spark: SparkSession,
    template: str,
    dates: Sequence[str],
    on_missing: str = "error",
    columns: list[str] | None = None,
    **options,
) -> DataFrame:
    """The header CSVs of the listed dates only, as text, tagged with ``prcsng_dt``.

    ``template`` is a path with one ``{date}``. A date without a file is an error, or is passed
    over with ``on_missing='skip'``: the paths then go out as one glob of alternatives. If there is no
    file for any date, that gives an empty frame of ``columns``, which have to be given then.
    """
    if on_missing not in ("error", "skip"):
        raise ValueError("on_missing is 'error' or 'skip'")
    if template.count("{date}") != 1:
        raise ValueError("the template needs one {date}")
    wanted = list(dict.fromkeys(dates))
    odd = [d for d in wanted if not re.fullmatch(r"[0-9A-Za-z_-]+", d)]
    if odd or not wanted:
        raise ValueError(f"not dates: {odd}" if odd else "no dates given")
    head, tail = template.split("{date}")
    if on_missing == "skip":
        glob = head + "{" + ",".join(wanted) + "}" + tail
        if not _any_file(spark, glob):
            if columns is None:
                raise ValueError(f"no file for any date: {glob}; give columns to get an empty frame")
            return spark.createDataFrame([], text_schema([*columns, DATE_COLUMN]))
        paths = [head + "{" + ",".join(wanted) + "}" + tail]
    else:
        paths = [head + d + tail for d in wanted]
    lead = head.rsplit("/", 1)[-1]
    shape = rf"/{_in_uri(lead)}([^/]+){_in_uri(tail)}(?:/[^/]+)?$"
    rows = read_header_csv(spark, paths, columns, **options)
    return rows.withColumn(DATE_COLUMN, F.regexp_extract(F.col("_metadata.file_path"), shape, 1))
