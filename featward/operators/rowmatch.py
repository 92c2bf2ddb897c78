"""Match whole rows of two frames, without a key.

Equal rows are brought together by grouping, not by joining: copies are counted before the shuffle
and never multiply, and each distinct row is reported once with its number of copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featward.functions.compare import any_of
from featward.functions.names import as_list, positional, positions, quoted, refuse_taken
from featward.operators.align import align_columns


# a row's hash is added up in parts of so many bits, so 2**41 rows cannot overflow a sum
HASH_PARTS = ((0, 22), (22, 21), (43, 21))


def _both(a: DataFrame, b: DataFrame) -> DataFrame:
    """The rows c0… of both frames, with ``original`` and ``new``: 1 and 0, or 0 and 1."""
    for mine, other in zip(a.schema, b.schema):
        if isinstance(mine.dataType, T.StringType) != isinstance(other.dataType, T.StringType):
            raise ValueError(f"column {mine.name!r} is text on one side only; cast it first")
    one, none = F.lit(1), F.lit(0)
    original = positional(a, "c").select("*", one.alias("original"), none.alias("new"))
    new = positional(b, "c").select("*", none.alias("original"), one.alias("new"))
    return original.unionAll(new)


def _counted(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows c0… of both frames with n_original and n_new, their copies on either side."""
    return (
        _both(a, b)
        .groupBy(*[f"c{i}" for i in range(len(a.columns))])
        .agg(F.sum("original").alias("n_original"), F.sum("new").alias("n_new"))
    )


def _summed(a: DataFrame, b: DataFrame) -> tuple[int, int, bool]:
    """Rows of either frame, and whether their digests agree: the sums of a hash of every row.

    Added up within the tasks, so no row is shuffled. Rows that are equal have equal hashes; that only columns
    with a hash that follows equality take part makes the digest weaker, never wrong.
    """
    both = _both(a, b)

    def hashes_as_equal(dtype: T.DataType) -> bool:
        if isinstance(dtype, T.ArrayType):
            return hashes_as_equal(dtype.elementType)
        if isinstance(dtype, T.StructType):
            return all(hashes_as_equal(f.dataType) for f in dtype.fields)
        if isinstance(dtype, T.StringType):
            return dtype == T.StringType()  # a collation may call different bytes equal
        return not isinstance(dtype, (T.MapType, T.VariantType, T.CalendarIntervalType))

    usable = [f.name for f in both.schema if f.name not in ("original", "new") and hashes_as_equal(f.dataType)]
    value = f"xxhash64({', '.join(['1', *usable])})"
    parts = [
        f"sum((original - new) * (shiftrightunsigned(row_hash, {first}) & {(1 << bits) - 1}L))"
        for first, bits in HASH_PARTS
    ]
    n_original, n_new, *sums = (
        both.selectExpr("original", "new", f"{value} AS row_hash")
        .selectExpr("sum(original)", "sum(new)", *parts)
        .first()
    )
    return n_original or 0, n_new or 0, not any(sums)


def match_rows(
    a: DataFrame,
    b: DataFrame,
    null_safe: bool = False,
    unmatched_only: bool = False,
    sanitize: bool = True,
) -> DataFrame:
    """Equal rows paired, all others one-sided: c_original, c_new, c_is_different per common column.

    Strict mode lets NULL equal nothing, so a row holding a NULL matches no row, its twin
    included; ``null_safe`` lets it match. One line per distinct row and side, with its copies
    counted in ``n_original`` and ``n_new`` (a join on all columns would give their product).
    The flags are false throughout: paired rows are equal, and a missing row differs from nothing.
    """
    a, b = align_columns(a, b, sanitize)
    ids = [f"c{i}" for i in range(len(a.columns))]
    has_null = "false" if null_safe else any_of(f"{i} IS NULL" for i in ids)
    paired = f"(n_original > 0 AND n_new > 0 AND NOT ({has_null}))"

    def line_if(condition: str, n_original: str, n_new: str) -> str:
        return f"IF({condition}, struct({n_original} AS in_original, {n_new} AS in_new), NULL)"

    lines = [
        line_if(f"NOT {paired} AND n_original > 0", "n_original", "0L"),
        line_if(f"NOT {paired} AND n_new > 0", "0L", "n_new"),
    ]
    rows = _counted(a, b)
    if unmatched_only:
        rows = rows.filter(f"NOT {paired}")
    else:
        lines.append(line_if(paired, "n_original", "n_new"))
    placed = rows.selectExpr(*ids, f"inline(array({', '.join(lines)}))").filter("in_original IS NOT NULL")
    shown = []
    for i, name in zip(ids, a.columns):
        shown += [
            f"IF(in_original > 0, {i}, NULL) AS {quoted(name + '_original')}",
            f"IF(in_new > 0, {i}, NULL) AS {quoted(name + '_new')}",
            f"false AS {quoted(name + '_is_different')}",
        ]
    return placed.selectExpr(*shown, "in_original AS n_original", "in_new AS n_new")


def row_multiset_diff(a: DataFrame, b: DataFrame, sanitize: bool = True) -> DataFrame:
    """Rows one side has more copies of: the common columns, ``side`` and ``n_rows``.

    Null-safe; ``side`` is ``original`` or ``new`` and ``n_rows`` the number of surplus copies.
    """
    a, b = align_columns(a, b, sanitize)
    refuse_taken(a.columns, ["side", "n_rows"])
    columns = [f"c{i} AS {quoted(name)}" for i, name in enumerate(a.columns)]
    return (
        _counted(a, b)
        .filter("n_original <> n_new")
        .selectExpr(
            *columns,
            "IF(n_original > n_new, 'original', 'new') AS side",
            "abs(n_original - n_new) AS n_rows",
        )
    )


def frames_equal(a: DataFrame, b: DataFrame, order_by: str | list[str] | None = None) -> DataFrame:
    """One row, ``is_same``: do the frames hold the same rows?

    With ``order_by``, are the n-th rows equal as well, ties taken in an order of the whole row? That
    order is a function of the rows, so frames with the same rows have the same sequence, and one
    grouping answers both questions. In order, columns have to have the same places and a different
    number of rows is an error when the result is evaluated; without it columns may be in any
    order. Frames with different columns are an error in either case.

    One job over both frames adds up the rows' hashes first, without a shuffle: where the sums differ the
    frames do, and that is the answer. Equal sums prove nothing; the rows are then grouped.
    """
    if order_by is not None:
        if a.columns != b.columns:
            raise ValueError(f"the frames differ in their columns: {a.columns} and {b.columns}")
        positions(a.columns, as_list(order_by), "ordered")
    elif sorted(a.columns) != sorted(b.columns):
        raise ValueError(f"different columns: {a.columns} and {b.columns}")
    else:
        a, b = align_columns(a, b, sanitize=False)
    n_original, n_new, agree = _summed(a, b)
    one_row = a.sparkSession.range(1)
    if order_by is not None and n_original != n_new:
        message = F.lit(f"the frames differ in their row counts: {n_original} and {n_new}")
        return one_row.select(F.raise_error(message).cast("boolean").alias("is_same"))
    if n_original != n_new or not agree:
        return one_row.select(F.lit(False).alias("is_same"))
    surplus = F.sum(F.abs(F.col("n_original") - F.col("n_new")))
    return _counted(a, b).agg((F.coalesce(surplus, F.lit(0)) == 0).alias("is_same"))
