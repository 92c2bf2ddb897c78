"""Decision bins that differ by segment, given as rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featward.functions.names import as_list, positional, positions
from featward.operators.score import PROBA
from featward.session import new_scratch


def _steps(bins: DataFrame, keys: list[str]) -> DataFrame:
    """One row per segment: its sorted ``edges``, the last bin ``at`` each, and the last one ``after`` each, up to the
    next edge. A bin covers the stretch between two neighbouring edges as a whole or not at all."""
    found = "get(filter(bins, x -> x.low <= e AND x.high >= {high}), 0).bin"
    return (
        bins.groupBy(*keys)
        .agg(
            F.reverse(F.array_sort(F.collect_list(F.struct("place", "bin", "low", "high")))).alias("bins"),
            F.array_sort(F.array_union(F.collect_set("low"), F.collect_set("high"))).alias("edges"),
        )
        .selectExpr(
            *keys,
            "edges",
            f"transform(edges, e -> {found.format(high='e')}) AS at",
            f"transform(edges, (e, i) -> {found.format(high='get(edges, i + 1)')}) AS after",
        )
    )


def assign_segment_bin(
    df: DataFrame,
    bins: DataFrame,
    segment: str | Iterable[str],
    proba_col: str = PROBA,
    order_by: str | Iterable[str] = (),
    low_col: str = "LOW_P",
    high_col: str = "HIGH_P",
    bin_col: str = "BIN",
    default: int | Column = 1,
) -> DataFrame:
    """Add ``bin_col``: the last bin of the row's segment, both ends included, that holds the probability.

    ``bins`` has the columns ``segment``, ``low_col``, ``high_col`` and ``bin_col``, a row per bin; bins may overlap,
    touch or leave gaps. The last one is that with the greatest ``order_by``, of equals that with the greatest
    number. A bin with a NULL or NaN end, or whose ends are the wrong way round, holds nothing.

    A probability in no bin, NULL or NaN, and a segment that is NULL or has no bins, get ``default``, which may be a
    column. A column of ``df`` called ``bin_col`` is replaced.

    Each segment's bins become one row, written once: sorted edges with the last bin at and after each. One equi-join
    by segment brings them to the rows (broadcast if they are small; otherwise a hot segment is split, as in any left
    join), and a binary search in generated code, one step per power of two, finds the edge. Making that row takes the
    square of a segment's bins.
    """
    segment = as_list(segment)
    at = [*positions(df.columns, segment, "scored"), *positions(df.columns, [proba_col], "scored")]
    wanted = [*segment, low_col, high_col, bin_col, *as_list(order_by)]
    from_bins = positions(bins.columns, wanted, "bins")
    keys = [f"s{i}" for i in range(len(segment))]

    given = positional(bins, "c").selectExpr(
        *[f"c{p} AS {k}" for p, k in zip(from_bins, keys)],
        *[f"CAST(c{p} AS double) AS {end}" for p, end in zip(from_bins[len(keys) :], ("low", "high"))],
        f"c{from_bins[len(keys) + 2]} AS bin",
        f"struct({', '.join(['0', *[f'c{p}' for p in from_bins[len(keys) + 3 :]]])}) AS place",
    )
    usable = " AND ".join([*[f"{k} IS NOT NULL" for k in keys], "NOT isnan(low)", "NOT isnan(high)", "low <= high"])
    path = new_scratch(df.sparkSession, "segment-bins")
    _steps(given.filter(usable), keys).write.parquet(path)
    steps = df.sparkSession.read.parquet(path)
    most = steps.agg(F.max(F.size("edges"))).first()[0] or 0

    kept = [i for i, c in enumerate(df.columns) if c.lower() != bin_col.lower()]
    other = default if isinstance(default, Column) else F.lit(default)
    rows = positional(df.select("*", other.alias("other")), "c")
    columns = [f"c{i}" for i in kept]
    rows = rows.selectExpr(
        *columns,
        f"c{len(df.columns)} AS other",
        f"CAST(c{at[-1]} AS double) AS p",
        *[f"c{p} AS {k}" for p, k in zip(at, keys)],
    )
    found = rows.join(steps, keys, "left").selectExpr(*columns, "other", "p", "edges", "at", "after", "0 AS below")
    # the number of edges that are not above the probability, from its highest bit on
    for bit in reversed(range(most.bit_length())):
        more = f"below + IF(get(edges, below + {(1 << bit) - 1}) <= p, {1 << bit}, 0) AS below"
        found = found.selectExpr(*columns, "other", "p", "edges", "at", "after", more)
    held = "IF(get(edges, below - 1) = p, get(at, below - 1), get(after, below - 1))"
    number = f"coalesce(IF(below > 0 AND NOT isnan(p), {held}, NULL), other)"
    return found.selectExpr(*columns, number).toDF(*[df.columns[i] for i in kept], bin_col)
