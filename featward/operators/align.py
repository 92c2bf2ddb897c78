"""Bring two frames to the same columns."""

from __future__ import annotations

from pyspark.sql import DataFrame

from featward.functions.names import positional, repeated


def sanitize_names(df: DataFrame) -> DataFrame:
    """Replace ``-`` by ``_`` in the column names; two names that become one are an error."""
    renamed = [name.replace("-", "_") for name in df.columns]
    clashes = repeated(renamed)
    if clashes:
        raise ValueError(f"names collide once '-' is '_': {clashes} in {df.columns}")
    return df.toDF(*renamed)


def _pick(df: DataFrame, names: list[str]) -> DataFrame:
    where = {name: i for i, name in enumerate(df.columns)}
    return positional(df, "c").selectExpr(*[f"c{where[n]}" for n in names]).toDF(*names)


def align_columns(a: DataFrame, b: DataFrame, sanitize: bool = True) -> tuple[DataFrame, DataFrame]:
    """Both frames reduced to their common columns, in sorted order.

    Names match exactly, case included. Only names are looked at, so no data is read.
    """
    if sanitize:
        a, b = sanitize_names(a), sanitize_names(b)
    common = sorted(set(a.columns) & set(b.columns))
    if not common:
        raise ValueError(f"no common columns: {a.columns} and {b.columns}")
    return _pick(a, common), _pick(b, common)
