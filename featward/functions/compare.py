"""Equality of two columns, in the strict SQL sense or with NULL as a value.

The tests are SQL text over plain internal column names: a feature table has hundreds of columns,
and one text is analysed far faster than as many nested Column calls.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T


def _holds_map(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.MapType):
        return True
    if isinstance(dtype, T.ArrayType):
        return _holds_map(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(_holds_map(f.dataType) for f in dtype.fields)
    return False


def comparable(column: str, dtype: T.DataType) -> str:
    """A form of the column that ``=`` accepts: a map becomes its entries sorted by key."""
    if isinstance(dtype, T.MapType):
        if _holds_map(dtype.keyType) or _holds_map(dtype.valueType):
            raise TypeError(f"maps inside maps cannot be compared: {dtype.simpleString()}")
        return f"array_sort(map_entries({column}))"
    if _holds_map(dtype) or isinstance(dtype, (T.VariantType, T.CalendarIntervalType)):
        raise TypeError(f"columns of type {dtype.simpleString()} cannot be compared")
    return column


_PLAIN = (T.StringType, T.IntegralType, T.FractionalType, T.BooleanType, T.DateType, T.BinaryType)


def _written_apart(dtype: T.DataType) -> bool:
    """Are different values of the type different as JSON?"""
    if isinstance(dtype, T.ArrayType):
        return _written_apart(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(_written_apart(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.MapType):
        return isinstance(dtype.keyType, (T.StringType, T.IntegralType)) and _written_apart(dtype.valueType)
    return isinstance(dtype, _PLAIN)


def digested(column: str, dtype: T.DataType) -> str | None:
    """What a row digest hashes of the column, NULL apart; None for types that it cannot tell apart.

    Values that are not equal come out different. Nested values are written as JSON, since a hash would run
    through them as if they were flat.
    """
    if isinstance(dtype, (*_PLAIN, T.TimestampType, T.TimestampNTZType)):
        return column
    if isinstance(dtype, (T.ArrayType, T.StructType, T.MapType)) and _written_apart(dtype):
        return f"to_json(named_struct('v', {column}), map('ignoreNullFields', 'false'))"
    return None


def differs(
    left: str, right: str, left_type: T.DataType, right_type: T.DataType, null_safe: bool
) -> str:
    """True where the values differ.

    Strict: NULL on either side gives NULL, which a filter drops. Null-safe: NULL equals only
    NULL, and text never equals a value of another type, so nothing is cast to compare them.
    """
    if not null_safe:
        return f"{comparable(left, left_type)} <> {comparable(right, right_type)}"
    if isinstance(left_type, T.StringType) != isinstance(right_type, T.StringType):
        return f"({left} IS NOT NULL OR {right} IS NOT NULL)"
    return f"NOT ({comparable(left, left_type)} <=> {comparable(right, right_type)})"


def any_of(conditions: Iterable[str]) -> str:
    return " OR ".join(conditions) or "false"


def sql_text(value: str) -> str:
    """The value as a SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
