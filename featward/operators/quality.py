"""Data-quality reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featward.functions.names import named, refuse_taken
from featward.functions.text import is_non_numeric


MESSAGE = "Non-numeric value found: "  # fixed value: the wording of the finding


def non_numeric_values(df: DataFrame, column: str) -> DataFrame:
    """Rows whose text does not convert to a number, with ``value`` and ``message`` added.

    Duplicates are kept; NULL and '' are not reported.
    """
    refuse_taken([c for c in df.columns if c != column], ["value", "message"])
    text = named(column).cast("string")
    return df.filter(is_non_numeric(text)).withColumns(
        {"value": text, "message": F.concat(F.lit(MESSAGE), text)}
    )
