"""Differences between two versions of a keyed table.

All of it rests on equi joins over the key: an inner join where only rows on both sides matter, and
otherwise all rows of both sides. For those, keys found to be unique allow one full outer join. A key
that repeats may be hot, and adaptive execution splits it in a left or anti join but never in a full
outer one: the side with the repeats then left-joins the other, whose unmatched rows an anti join
adds. Rows without a key match nothing; a hash of the row spreads them over the tasks.

Wide tables of which little changed need not be shuffled whole: ``digest_first`` groups keys and row digests,
and only rows whose key came out with differing digests go on to the joins.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featward.functions.compare import any_of, differs, digested, sql_text
from featward.functions.lookup import lookup_keys
from featward.functions.names import as_list, positional, positions, quoted, refuse_taken
from featward.operators.align import align_columns
from featward.session import new_scratch

# a row digest is two 64-bit hashes, chained over the values from different starts
CHAINS = (1, 2)
CELL = "struct<present:boolean,column_name:string,original_value:string,new_value:string>"


@dataclass
class _Pair:
    """Two frames with key columns k0…, original values o0… and new values n0…."""

    key: list[str]
    columns: list[str]
    original: DataFrame
    new: DataFrame
    original_types: list[T.DataType]
    new_types: list[T.DataType]
    duplicates: str
    repeats: str | None = "unknown"  # the side on which a key repeats, once that is known

    @property
    def key_ids(self) -> list[str]:
        return [f"k{i}" for i in range(len(self.key))]

    @property
    def key_out(self) -> list[str]:
        return [f"{i} AS {quoted(name)}" for i, name in zip(self.key_ids, self.key)]

    @property
    def _has_key(self) -> str:
        return " AND ".join(f"{k} IS NOT NULL" for k in self.key_ids)

    def changes(self, null_safe: bool) -> list[str]:
        """Per compared column: does it differ?"""
        return [
            differs(f"o{i}", f"n{i}", old, new, null_safe)
            for i, (old, new) in enumerate(zip(self.original_types, self.new_types))
        ]

    def matched(self) -> DataFrame:
        """The pairs of rows with the same key: k…, o…, n…."""
        self._repeated()
        original, new = self.original.filter(self._has_key), self.new.filter(self._has_key)
        return original.join(new, self.key_ids)

    def sided(self) -> DataFrame:
        """All rows of both sides: k…, o…, n…, and ``in_original``, ``in_new``: true or NULL."""
        original = self._spread(self.original.withColumn("in_original", F.lit(True)))
        new = self._spread(self.new.withColumn("in_new", F.lit(True)))
        on = [*self.key_ids, "spread"]
        repeated = self._repeated()
        if self.duplicates == "multiply" or repeated == "both":
            parts = [original.join(new, on), _without(original, new, on), _without(new, original, on)]
        elif repeated == "original":
            parts = [original.join(new, on, "left"), _without(new, original, on)]
        elif repeated == "new":
            parts = [new.join(original, on, "left"), _without(original, new, on)]
        else:
            parts = [original.join(new, on, "full")]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).drop("spread")

    def _spread(self, side: DataFrame) -> DataFrame:
        """With a column that rows with a key share; rows without one match nothing and go anywhere."""
        values = ", ".join(c for c, kind in side.dtypes if "map<" not in kind and kind != "variant")
        return side.withColumn("spread", F.expr(f"IF({self._has_key}, 0L, xxhash64({values}))"))

    def _repeated(self) -> str | None:
        """The side on which a key repeats. On both sides it is an error: a join would pair every copy
        with every copy.

        One job over the key columns of both sides; copies are counted before the shuffle.
        """
        if self.repeats != "unknown":
            return self.repeats
        if self.duplicates == "multiply":
            return None

        def keys(side: DataFrame, original: int) -> DataFrame:
            mark = [F.lit(original).alias("original"), F.lit(1 - original).alias("new")]
            return side.filter(self._has_key).select(*self.key_ids, *mark)

        counted = (
            keys(self.original, 1)
            .unionAll(keys(self.new, 0))
            .groupBy(*self.key_ids)
            .agg(F.sum("original").alias("original"), F.sum("new").alias("new"))
        )
        most = counted.agg(
            F.max("original").alias("original"),
            F.max("new").alias("new"),
            F.max_by(F.struct(*self.key_ids, "original", "new"), F.least("original", "new")).alias("worst"),
        ).first()
        return self._repeats_in(most, refuse=True)

    def _repeats_in(self, most: Row, refuse: bool) -> str | None:
        worst = most["worst"]
        if refuse and worst and min(worst["original"], worst["new"]) > 1:
            raise ValueError(
                f"key {dict(zip(self.key, worst))} occurs {worst['original']} times in the original "
                f"and {worst['new']} times in the new frame; pass duplicates='multiply' to pair them all"
            )
        if (most["original"] or 0) > 1 and (most["new"] or 0) > 1:
            return "both"
        return "original" if (most["original"] or 0) > 1 else "new" if (most["new"] or 0) > 1 else None

    def differing(self, null_safe: bool) -> _Pair:
        """The rows that may differ: those whose key has rows of different digests, or (null-safe) rows on one side
        only, or no key.

        One grouping of keys and digests, with map-side sums, so a hot key is one row per task. Rows with equal
        digests are taken for equal; unequal digests only say that the rows are to be compared. Columns without a
        digest, and columns or keys of different types on the two sides, leave the pair as it is.
        """
        columns = range(len(self.columns))
        old = [digested(f"o{i}", kind) for i, kind in enumerate(self.original_types)]
        new = [digested(f"n{i}", kind) for i, kind in enumerate(self.new_types)]
        if None in old or self.original_types != self.new_types:
            return self
        if any(self.original.schema[k].dataType != self.new.schema[k].dataType for k in self.key_ids):
            return self

        def marks(side: DataFrame, values: list[str], prefix: str, original: int) -> DataFrame:
            nulls = [f"{prefix}{i} IS NULL" for i in columns]
            row = ", ".join(x for both in zip(values, nulls) for x in both)
            chains = [f"xxhash64({', '.join([str(start), row] if row else [str(start)])}) AS d{start}" for start in CHAINS]
            sides = [f"{original} AS original", f"{1 - original} AS new"]
            return side.filter(self._has_key).selectExpr(*self.key_ids, *chains, *sides)

        same = " AND ".join(["original > 0 AND new > 0", *[f"low{d} = high{d}" for d in CHAINS]])
        counted = (
            marks(self.original, old, "o", 1)
            .unionAll(marks(self.new, new, "n", 0))
            .groupBy(*self.key_ids)
            .agg(
                F.sum("original").alias("original"),
                F.sum("new").alias("new"),
                *[F.min(f"d{d}").alias(f"low{d}") for d in CHAINS],
                *[F.max(f"d{d}").alias(f"high{d}") for d in CHAINS],
            )
        )
        wanted = f"NOT ({same})" if null_safe else f"original > 0 AND new > 0 AND NOT ({same})"
        found = counted.selectExpr(*self.key_ids, "original", "new", f"{wanted} AS wanted")
        spark = self.original.sparkSession
        path = new_scratch(spark, "differing-keys")
        found.filter("wanted OR (original > 1 AND new > 1)").write.parquet(path)
        keys = spark.read.parquet(path)
        most = keys.agg(
            F.max(F.when(F.col("wanted"), F.col("original"))).alias("original"),
            F.max(F.when(F.col("wanted"), F.col("new"))).alias("new"),
            F.max_by(F.struct(*self.key_ids, "original", "new"), F.least("original", "new")).alias("worst"),
        ).first()
        repeats = self._repeats_in(most, refuse=self.duplicates == "refuse")
        looked_up = keys.filter("wanted").select(*self.key_ids)

        def few(side: DataFrame) -> DataFrame:
            rows = side.join(looked_up, self.key_ids, "left_semi")
            return rows.unionAll(side.filter(f"NOT ({self._has_key})")) if null_safe else rows

        return replace(self, original=few(self.original), new=few(self.new), repeats=repeats)


def _without(rows: DataFrame, others: DataFrame, on: list[str]) -> DataFrame:
    """The rows that have no partner; copies of the keys to look up go before they are shuffled."""
    return rows.join(lookup_keys(others.select(*on)), on, "left_anti")


def _pair(
    original: DataFrame, new: DataFrame, key: str | Iterable[str], columns: list[str] | None, duplicates: str
) -> _Pair:
    if duplicates not in ("refuse", "multiply"):
        raise ValueError("duplicates is 'refuse' or 'multiply'")
    key = as_list(key)
    key_at = positions(original.columns, key, "original")
    if columns is None:
        columns = [c for i, c in enumerate(original.columns) if i not in key_at]
    old_at = positions(original.columns, columns, "original")
    new_key_at = positions(new.columns, key, "new")
    new_at = positions(new.columns, columns, "new")

    def side(df: DataFrame, keys: list[int], values: list[int], prefix: str) -> DataFrame:
        names = [f"k{i}" for i in range(len(keys))] + [f"{prefix}{i}" for i in range(len(values))]
        return positional(df, "c").selectExpr(*[f"c{p}" for p in [*keys, *values]]).toDF(*names)

    return _Pair(
        key,
        columns,
        side(original, key_at, old_at, "o"),
        side(new, new_key_at, new_at, "n"),
        [original.schema[p].dataType for p in old_at],
        [new.schema[p].dataType for p in new_at],
        duplicates,
    )


ONE_SIDED = "(in_original IS NULL OR in_new IS NULL)"
CHANGE = "CASE WHEN in_original IS NULL THEN 'added' WHEN in_new IS NULL THEN 'removed' ELSE 'changed' END"


def _text(column: str) -> str:
    return f"CAST({column} AS STRING)"


def _cell_if(condition: str, name: str, old: str, new: str) -> str:
    cell = f"'column_name', {name}, 'original_value', {old}, 'new_value', {new}"
    return f"IF({condition}, named_struct('present', true, {cell}), NULL)"


def diff_cells(
    original: DataFrame,
    new: DataFrame,
    key: str | Iterable[str],
    null_safe: bool = False,
    duplicates: str = "refuse",
    digest_first: bool = False,
) -> DataFrame:
    """One row per cell that differs: key…, column_name, original_value, new_value.

    The compared columns are the original's, key excluded; ``new`` must have them all and may
    have more. Values are compared in their own type and reported as text.

    Strict mode reports cells with two unequal values; a NULL or a missing row differs from
    nothing. ``null_safe`` also reports NULL against a value and the rows of one side, and adds
    ``change``: changed, added or removed. A one-sided row gives its non-null cells, or one line
    with a NULL column_name if it has none.

    A key may repeat on one side. Repeated on both it would pair every copy with every copy:
    refused, unless ``duplicates='multiply'``.

    ``digest_first`` is for wide tables of which little changed: a first job shuffles only keys and 128-bit row
    digests, and rows whose key has one digest on both sides are not shuffled. The rows are the same but for
    a chance of 2**-128 per changed row (the hash is not a cryptographic one: not for data made up to collide).
    The differing keys are looked up by a semi join, broadcast where they are few.
    """
    refuse_taken(as_list(key), ["column_name", "original_value", "new_value", "change"])
    pair = _pair(original, new, key, None, duplicates)
    if digest_first:
        pair = pair.differing(null_safe)
    changes = pair.changes(null_safe)
    cells = [
        _cell_if(change, sql_text(name), _text(f"o{i}"), _text(f"n{i}"))
        for i, (name, change) in enumerate(zip(pair.columns, changes))
    ]
    shown = [*pair.key_out, "column_name", "original_value", "new_value"]
    if null_safe:
        # no cell differs in a row of one side: none has a value
        empty = f"{ONE_SIDED} AND NOT ({any_of(changes)})"
        cells.append(_cell_if(empty, "NULL", "NULL", "NULL"))
        rows = pair.sided().filter(f"{any_of(changes)} OR {ONE_SIDED}")
        passed = [*pair.key_ids, f"{CHANGE} AS change"]
        shown.append("change")
    else:
        rows = pair.matched().filter(any_of(changes))
        passed = pair.key_ids
    return (
        rows.selectExpr(*passed, f"inline(CAST(array({', '.join(cells)}) AS array<{CELL}>))")
        .filter("present")
        .selectExpr(*shown)
    )


def diff_flags(
    original: DataFrame,
    new: DataFrame,
    key: str | Iterable[str],
    column: str,
    duplicates: str = "refuse",
) -> DataFrame:
    """Every key of either side with one column's two values and ``diff``: DIFFERENT or SAME.

    A NULL on either side, or a missing row, reads SAME.
    """
    refuse_taken(as_list(key), ["original_value", "new_value", "diff"])
    pair = _pair(original, new, key, [column], duplicates)
    (different,) = pair.changes(null_safe=False)
    return pair.sided().selectExpr(
        *pair.key_out,
        "o0 AS original_value",
        "n0 AS new_value",
        f"IF({different}, 'DIFFERENT', 'SAME') AS diff",
    )


def diff_report(
    original: DataFrame,
    new: DataFrame,
    key: str | Iterable[str],
    null_safe: bool = False,
    include_key: bool = True,
    sanitize: bool = True,
    duplicates: str = "refuse",
    digest_first: bool = False,
) -> DataFrame:
    """One line per differing row: ``differences`` = ``c1: old -> new, c2: old -> new``.

    Compares the sorted common columns, after ``-`` became ``_`` in the names (the key is given
    by its new name); only differing columns are listed. ``null_safe`` prints NULL as ``NULL``
    and adds the rows of one side and ``change``, as in :func:`diff_cells`, as is ``digest_first``.
    """
    original, new = align_columns(original, new, sanitize)
    key = as_list(key)
    refuse_taken(key, ["differences", "change"])
    pair = _pair(original, new, key, None, duplicates)
    if digest_first:
        pair = pair.differing(null_safe)
    head = pair.key_out if include_key else []

    def shown(column: str) -> str:
        return f"coalesce({_text(column)}, 'NULL')"

    changes = pair.changes(null_safe)
    entries = [
        f"IF({change}, concat({sql_text(name + ': ')}, {shown(f'o{i}')}, ' -> ', {shown(f'n{i}')}), NULL)"
        for i, (name, change) in enumerate(zip(pair.columns, changes))
    ]
    line = f"concat_ws({', '.join([sql_text(', '), *entries])}) AS differences"
    if null_safe:
        rows = pair.sided().filter(f"{any_of(changes)} OR {ONE_SIDED}")
        return rows.selectExpr(*head, line, f"{CHANGE} AS change")
    return pair.matched().filter(any_of(changes)).selectExpr(*head, line)
