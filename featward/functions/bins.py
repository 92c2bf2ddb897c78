"""Decision bins of a probability."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Bin(NamedTuple):
    low: float
    high: float
    number: int


# The edges of the ten decision bins; bin n runs from edge n-1 to edge n, both ends
# included.
DECISION_EDGES = [0.0, 0.10, 0.15, 0.26, 0.40, 0.55, 0.66, 0.75, 0.83, 0.91, 1.0]

DECISION_BINS = [
    Bin(low, high, number)
    for number, (low, high) in enumerate(zip(DECISION_EDGES, DECISION_EDGES[1:]), start=1)
]


def bin_of(proba: Column, table: Sequence[Bin], default: int | Column) -> Column:
    """Number of the last bin in the table that holds the probability, else the default.

    One CASE tested from the last bin to the first. NULL and NaN are in no bin.
    """
    case = F
    for low, high, number in reversed(table):
        case = case.when((proba >= F.lit(float(low))) & (proba <= F.lit(float(high))), F.lit(number))
    other = default if isinstance(default, Column) else F.lit(default)
    return other if case is F else case.otherwise(other)


def class_of(bin_number: Column) -> Column:
    """``C`` followed by the whole bin number; NULL stays NULL."""
    return F.concat(F.lit("C"), bin_number.cast("int").cast("string"))
