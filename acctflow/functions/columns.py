"""Projections and derived columns.

All of these are single narrow projections: no shuffle, and each compiles into
the surrounding whole-stage-codegen span.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The renames the reference applies to its two raw layouts.
SALES_COLUMNS = {
    "Region": "Region",
    "Country": "Country",
    "Item Type": "Item_Type",
    "Sales Channel": "Sales_Channel",
    "Order Priority": "Order_Priority",
    "Order Date": "Order_Date",
    "Order ID": "Order_ID",
    "Units Sold": "Units_Sold",
    "Unit Price": "Unit_Price",
    "Total Revenue": "Total_Revenue",
    "Total Profit": "Total_Profit",
}

BANK_COLUMNS = {
    "Account No": "Account_No",
    "DATE": "DATE",
    "TRANSACTION DETAILS": "TRANSACTION_DETAILS",
    "CHQ NO": "CHQ_NO",
    "VALUE DATE": "VALUE_DATE",
    "WITHDRAWAL AMT": "WITHDRAWAL_AMT",
    "DEPOSIT AMT": "DEPOSIT_AMT",
    "BALANCE AMT": "BALANCE_AMT",
}

BANK_KEEP = list(BANK_COLUMNS.values())

# The two date layouts of the sales file, day-month-year with
# dashes first, then month/day/year; one-digit days and months are allowed.
SALES_DATE_FORMATS = ("d-M-yyyy", "M/d/yyyy")


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Select the mapped columns under their new names, in mapping order.

    Columns not in the mapping are dropped (P1, P2).
    """
    return df.select(*[_quoted(src).alias(dst) for src, dst in mapping.items()])


def keep_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Keep the listed columns in the order given."""
    return df.select(*[_quoted(n) for n in names])


def date_from_formats(col: str | Column, formats: Iterable[str]) -> Column:
    """First format that parses wins; text no format parses becomes null.

    ``try_to_date`` keeps this safe under ANSI mode without touching the
    session-wide legacy parser setting.
    """
    c = _quoted(col) if isinstance(col, str) else col
    return F.coalesce(*[F.try_to_date(c, fmt) for fmt in formats])


def type_of(df: DataFrame, name: str) -> str:
    """The type of a column, its name compared as the session compares names;
    empty if there is none."""
    if df.sparkSession.conf.get("spark.sql.caseSensitive") == "true":
        return dict(df.dtypes).get(name, "")
    return {c.lower(): t for c, t in df.dtypes}.get(name.lower(), "")


def _as_date_column(df: DataFrame, name: str, formats: Iterable[str]) -> Column:
    # A DATE column is kept, a timestamp is cut to its date, text is parsed.
    dtype = type_of(df, name) or "string"
    if dtype == "date":
        return _quoted(name)
    if dtype.startswith("timestamp"):
        return F.to_date(_quoted(name))
    return date_from_formats(name, formats)


def parse_dates(
    df: DataFrame,
    target: str,
    source: str | None = None,
    formats: Iterable[str] = SALES_DATE_FORMATS,
) -> DataFrame:
    """Normalise a mixed-format text date column into a DATE column (P5)."""
    return df.withColumn(target, _as_date_column(df, source or target, formats))


def parse_date(df: DataFrame, name: str, fmt: str = "dd-MM-yyyy") -> DataFrame:
    """Parse one text column in place with a single format."""
    return df.withColumn(name, _as_date_column(df, name, [fmt]))


def transaction_amount(withdrawal: str = "WITHDRAWAL_AMT", deposit: str = "DEPOSIT_AMT") -> Column:
    """Deposit when the withdrawal is missing, else the withdrawal."""
    return F.coalesce(F.col(withdrawal), F.col(deposit))


def transaction_type(withdrawal: str = "WITHDRAWAL_AMT") -> Column:
    """'CR' when there is no withdrawal (also when both are missing), else 'DR' (P8)."""
    return F.when(F.col(withdrawal).isNull(), F.lit("CR")).otherwise(F.lit("DR"))


def add_transaction_type_amount(df: DataFrame) -> DataFrame:
    """Append ``TransactionAmount`` and ``TransactionType`` in one projection."""
    return df.withColumns(
        {"TransactionAmount": transaction_amount(), "TransactionType": transaction_type()}
    )


def copy_when_present(
    df: DataFrame, pairs: Mapping[str, str], guard: str = "Alert_Key"
) -> DataFrame:
    """``new = old`` where ``guard`` is not null, else null, for each pair.

    One projection for all pairs instead of a chain of ``withColumn`` calls.
    """
    present = F.col(guard).isNotNull()
    return df.withColumns({new: F.when(present, F.col(old)) for new, old in pairs.items()})
