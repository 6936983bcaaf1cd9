"""Bank statement job: clean-up, debit/credit typing, filters, duplicates and
per-account totals (P2, P3, P6-P8, F1-F3, A4-A6), as DataFrame operators; their
results can be listed by a parameterised SQL statement over temp views (S7, S8).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acctflow.functions.columns import (
    BANK_COLUMNS,
    BANK_KEEP,
    add_transaction_type_amount,
    keep_columns,
    parse_date,
    rename_columns,
)
from acctflow.operators.filters import by_value, date_between, not_null
from acctflow.sources.io import register_views, run_sql

DUPLICATE_KEYS = ["Account_No", "DATE", "TransactionType", "TransactionAmount"]
SINGLE_KEYS = ["Account_No", "DATE", "WITHDRAWAL_AMT", "DEPOSIT_AMT"]


def prepare(raw: DataFrame, date_format: str = "dd-MM-yyyy", renamed: bool = False) -> DataFrame:
    """Raw statement -> typed transactions.

    Renames the eight columns (P2; skipped when ``renamed``), parses DATE in
    place (P6), keeps the eight columns (P3) and appends TransactionAmount and
    TransactionType (P7, P8). One narrow projection in the plan.
    """
    df = raw if renamed else rename_columns(raw, BANK_COLUMNS)
    df = keep_columns(parse_date(df, "DATE", date_format), BANK_KEEP)
    return add_transaction_type_amount(df)


def of_type(typed: DataFrame, trn_type: str) -> DataFrame:
    """Transactions of one type, 'DR' or 'CR' (F1)."""
    return by_value(typed, "TransactionType", trn_type)


def cheques(typed: DataFrame) -> DataFrame:
    """Transactions with a cheque number (F2)."""
    return not_null(typed, "CHQ_NO")


def in_range(typed: DataFrame, start, end) -> DataFrame:
    """Transactions dated within [start, end]."""
    return date_between(typed, "DATE", start, end)


def _counted(df: DataFrame, keys: list[str]) -> DataFrame:
    # count(1) counts rows whatever their nulls; null keys form one group.
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("CNT"))


def duplicates(typed: DataFrame) -> DataFrame:
    """(account, date, type, amount) groups seen more than once, with CNT (A4)."""
    return _counted(typed, DUPLICATE_KEYS).filter(F.col("CNT") > 1)


def singles(typed: DataFrame) -> DataFrame:
    """(account, date, withdrawal, deposit) groups seen exactly once (A5).

    Every copy of a repeated row is removed; this is not dropDuplicates.
    """
    return _counted(typed, SINGLE_KEYS).filter(F.col("CNT") == 1)


def totals(typed: DataFrame, start, end) -> DataFrame:
    """Per-account withdrawal and deposit totals over the single transactions
    in [start, end] (A6).

    Amounts are text: values that do not parse as numbers (``1,000.00``) are
    skipped; an account with no parsable value gets null, not 0. Both
    aggregations combine map-side, and the first is keyed on four columns, so
    a hot account is spread out before its final, already-reduced sum.
    """
    single = singles(in_range(typed, start, end))
    return single.groupBy("Account_No").agg(
        F.sum(F.col("WITHDRAWAL_AMT").try_cast("double")).alias("Total_Withdraw"),
        F.sum(F.col("DEPOSIT_AMT").try_cast("double")).alias("Total_Deposit"),
    )


def listing(spark: SparkSession, view: str, rows: DataFrame, account: str | None = None) -> DataFrame:
    """``rows`` registered as the view ``view`` and listed by SQL, for one account
    or for all; the view's name and the account are bound as parameters."""
    register_views({view: rows})
    return run_sql(
        spark, "SELECT * FROM IDENTIFIER(:view) AS t WHERE :account IS NULL OR t.Account_No = :account",
        {"view": view, "account": account},
    )
