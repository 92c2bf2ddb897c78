"""Recent transactions of selected accounts. Bounds and keys are this project's own definition."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featward.functions.lookup import lookup_keys
from featward.functions.names import named


# date formats whose texts sort like their dates
SORTING_FORMATS = {"yyyyMMdd": "%Y%m%d", "yyyy-MM-dd": "%Y-%m-%d"}


def _day(run_dt: str | date) -> date:
    if isinstance(run_dt, str):
        return datetime.strptime(run_dt.replace("-", ""), "%Y%m%d").date()
    return run_dt


def lookback_dates(run_dt: str | date, days: int = 7, date_format: str = "%Y%m%d") -> list[str]:
    """The ``days`` days up to and including ``run_dt``, oldest first, as a list for
    :func:`featward.sources.dated.read_date_list`."""
    last = _day(run_dt)
    return [(last - timedelta(days=n)).strftime(date_format) for n in reversed(range(days))]


def lookback_select(
    txns: DataFrame,
    accounts: DataFrame,
    run_dt: str | date,
    days: int = 7,
    date_col: str = "date",
    account_col: str = "account",
    account_key: str | None = None,
    date_format: str = "yyyyMMdd",
) -> DataFrame:
    """Transactions of the given accounts in the ``days`` days up to and including ``run_dt``.

    The date column may be a date, a timestamp or text in ``date_format``. A date or timestamp is
    compared as it is stored, so the range reaches the file scan; so does a range of text for the
    formats that sort like their dates, before the text is parsed. ``run_dt`` as text is
    ``YYYYMMDD`` or ``YYYY-MM-DD``.
    """
    run_dt = _day(run_dt)
    first, after = run_dt - timedelta(days=days - 1), run_dt + timedelta(days=1)
    when, kind = named(date_col), txns.schema[date_col].dataType
    if isinstance(kind, T.StringType):
        if date_format in SORTING_FORMATS:
            ends = [d.strftime(SORTING_FORMATS[date_format]) for d in (first, run_dt)]
            txns = txns.filter((when >= ends[0]) & (when <= ends[1]))
        when, kind = F.to_date(when, date_format), T.DateType()
    recent = txns.filter((when >= F.lit(first).cast(kind)) & (when < F.lit(after).cast(kind)))
    chosen = lookup_keys(accounts.select(named(account_key or account_col).alias("chosen_account")))
    return recent.join(chosen, recent[f"`{account_col}`"] == chosen["chosen_account"], "left_semi")
