"""Row filters.

Plain column predicates, so Catalyst pushes them into a Parquet scan
(``PushedFilters``) and prunes row groups by their min/max statistics.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctflow.functions.columns import type_of


def by_value(df: DataFrame, column: str, value) -> DataFrame:
    """Exact match on one column (F1 transaction type, F5 item type)."""
    return df.filter(F.col(column) == F.lit(value))


def not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows where ``column`` is present (F2: cheque transactions)."""
    return df.filter(F.col(column).isNotNull())


def _as_date(value: dt.date | str):
    if isinstance(value, dt.datetime):
        return F.lit(value.date())
    if isinstance(value, dt.date):
        return F.lit(value)
    return F.to_date(F.lit(value))


def _bounds(df: DataFrame, column: str, start, end):
    """Range bounds matching the column: dates for a DATE column, ISO text
    for a text column (no implicit cast of the column, which would fail on
    malformed values), the values as given otherwise."""
    dtype = type_of(df, column)
    if dtype == "date":
        return _as_date(start), _as_date(end)
    if dtype == "string":
        return tuple(F.lit(v.isoformat() if isinstance(v, dt.date) else str(v)) for v in (start, end))
    return F.lit(start), F.lit(end)


def date_between(df: DataFrame, column: str, start: dt.date | str, end: dt.date | str) -> DataFrame:
    """Inclusive date range (F3). Bounds are typed values, never pasted text."""
    lo, hi = _bounds(df, column, start, end)
    return df.filter(F.col(column).between(lo, hi))


def at_least(df: DataFrame, column: str, threshold) -> DataFrame:
    """``column >= threshold``; nulls drop out (F4). Text thresholds are cast."""
    value = float(threshold) if isinstance(threshold, str) else threshold
    return df.filter(F.col(column) >= F.lit(value))


def value_and_range(
    df: DataFrame,
    column: str,
    value,
    range_column: str,
    start,
    end,
) -> DataFrame:
    """Equality plus an inclusive range (F6). A DATE column gets date bounds;
    a text column is compared as text, with date bounds written as ISO text
    (no implicit cast of the column, which would fail on malformed values)."""
    lo, hi = _bounds(df, range_column, start, end)
    return df.filter((F.col(column) == F.lit(value)) & F.col(range_column).between(lo, hi))
