"""Composite jobs (C1-C6): the reference's pipelines as functions that take
DataFrames and an output folder.

Each output is one action that reads only the columns and rows it needs;
nothing is cached, so filters and column selection reach the files. Rows that
several outputs share are stored once, by the column that they select.
"""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from acctflow.operators import accounts as acc
from acctflow.operators import bank, sales
from acctflow.operators.alerts import alert_report
from acctflow.sources.io import read_table, write_table


def _write_all(outputs: Mapping[str, DataFrame], out_dir: str | None, fmt: str) -> None:
    if out_dir is None:
        return
    for name, df in outputs.items():
        write_table(df, os.path.join(out_dir, name), fmt=fmt, mode="overwrite")


def accounts_job(
    accounts: DataFrame,
    customers: DataFrame,
    out_dir: str | None = None,
    threshold: int = 2,
    n: int = 5,
    fmt: str = "csv",
) -> dict[str, DataFrame]:
    """Accounts per customer, customers with more than ``threshold``
    accounts, top ``n`` balances."""
    outputs = {
        "AccountsPerCustomer": acc.accounts_per_customer(accounts),
        "CustomersWithMultipleAccounts": acc.customers_with_many_accounts(accounts, customers, threshold),
        "HighestBalances": acc.top_balances(accounts, n),
    }
    _write_all(outputs, out_dir, fmt)
    return outputs


def _stored(df: DataFrame, out_dir: str | None, name: str, column: str) -> DataFrame:
    """``df`` written once as Parquet, split into folders by ``column``, and read
    back, so that several outputs read only the folders and columns they need; as it
    is without ``out_dir``. An empty text in ``column`` comes back as null."""
    if out_dir is None:
        return df
    path = os.path.join(out_dir, name)
    write_table(df, path, fmt="parquet", mode="overwrite", partition_by=[column])
    return read_table(df.sparkSession, path, fmt="parquet", schema=df.schema).select(*df.columns)


def sales_job(
    sales_df: DataFrame,
    out_dir: str | None = None,
    item_type: str = "Household",
    region: str = "Asia",
    start: dt.date = dt.date(2011, 1, 1),
    end: dt.date = dt.date(2015, 12, 31),
    tie_break: Sequence[str] | None = None,
    decimals: int | None = None,
    fmt: str = "csv",
) -> dict[str, DataFrame]:
    """Revenue per region, top units for one item type, one region's
    orders in a date range. With ``out_dir`` the sales rows, which may be a join of
    many tables, are computed once and stored by region."""
    ties = tuple(c for c in ("Order_ID",) if c in sales_df.columns) if tie_break is None else tuple(tie_break)
    stored = _stored(sales_df, out_dir, "Sales", "Region")
    outputs = {
        "TotalRevenuePerRegion": sales.revenue_by_region(stored, decimals=decimals),
        "HighestUnitsSold": sales.top_units(stored, item_type, tie_break=ties),
        "TotalProfitByRegion": sales.region_orders_in_range(stored, region, start, end, tie_break=ties),
    }
    _write_all(outputs, out_dir, fmt)
    return outputs


def customer_feature_job(
    features: DataFrame,
    out_dir: str | None = None,
    score_column: str = "TOTAL_Score",
    threshold: float = 15,
    fill_key: bool = False,
    fmt: str = "parquet",
) -> dict[str, DataFrame]:
    """The payment-alert report, sorted by REF_ID at the output."""
    report = alert_report(features, score_column, threshold, fill_key).orderBy("REF_ID")
    outputs = {"AlertReport": report}
    _write_all(outputs, out_dir, fmt)
    return outputs


def bank_job(
    raw: DataFrame,
    start,
    end,
    totals_start=None,
    totals_end=None,
    out_dir: str | None = None,
    fmt: str = "parquet",
) -> dict[str, DataFrame]:
    """C4: typed statement -> debit, credit and cheque files; date range,
    duplicates, per-account totals. Credits are written under their own name.

    With ``out_dir`` the statement is read once and stored typed, by type
    (``Transactions``); all outputs are written from there, and those of one type
    read its folder alone."""
    typed = _stored(bank.prepare(raw), out_dir, "Transactions", "TransactionType")
    outputs = {
        "Debit_Transaction": bank.of_type(typed, "DR"),
        "Credit_Transaction": bank.of_type(typed, "CR"),
        "Cheque_Transaction": bank.cheques(typed),
        "DateRange": bank.in_range(typed, start, end),
        "Duplicates": bank.duplicates(typed),
        "Totals": bank.totals(typed, totals_start or start, totals_end or end),
    }
    _write_all(outputs, out_dir, fmt)
    return outputs


def accounts_and_sales_job(
    accounts: DataFrame, customers: DataFrame, sales_df: DataFrame, out_dir: str | None = None
) -> dict[str, DataFrame]:
    """C1 then C2."""
    return {**accounts_job(accounts, customers, out_dir), **sales_job(sales_df, out_dir)}
