"""Column-name helpers."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """Back-ticked name, safe for dots, hyphens and back-ticks."""
    return "`" + name.replace("`", "``") + "`"


def named(name: str) -> Column:
    return F.col(quoted(name))


def as_list(names: str | Iterable[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def positions(columns: Sequence[str], wanted: Sequence[str], side: str) -> list[int]:
    """Index of each wanted name: the exact name, else the one name equal to it but for case."""
    found = []
    for name in wanted:
        hits = [i for i, c in enumerate(columns) if c == name]
        hits = hits or [i for i, c in enumerate(columns) if c.lower() == name.lower()]
        if len(hits) != 1:
            problem = "is missing from" if not hits else "is ambiguous in"
            raise ValueError(f"column {name!r} {problem} the {side} frame {list(columns)}")
        found.append(hits[0])
    return found


def repeated(names: Iterable[str]) -> list[str]:
    return sorted(n for n, count in Counter(names).items() if count > 1)


def refuse_taken(columns: Iterable[str], added: Iterable[str]) -> None:
    """Raise if the input already has a column that an operator is about to add."""
    taken = sorted({c.lower() for c in columns} & {a.lower() for a in added})
    if taken:
        raise ValueError(f"the result has its own columns {taken}; rename those of the input")


def positional(df: DataFrame, prefix: str) -> DataFrame:
    """Columns renamed to prefix0, prefix1, …, so that no name can clash or need quoting."""
    return df.toDF(*[f"{prefix}{i}" for i in range(len(df.columns))])
