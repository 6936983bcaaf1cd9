"""Accounts per customer, multi-account customers, top balances (A1, A2, O1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctflow.operators.ranking import top_n


def accounts_per_customer(
    accounts: DataFrame,
    customer: str = "customerId",
    account: str = "accountId",
    name: str = "Account_Count",
) -> DataFrame:
    """Distinct accounts per customer; null account ids are not counted (A1).

    Spark plans a single distinct aggregate in two hash-aggregate rounds, the
    first keyed on (customer, account), so one customer with a huge number of
    accounts is spread over many tasks before its final count.
    """
    return accounts.groupBy(customer).agg(F.countDistinct(account).alias(name))


def customers_with_many_accounts(
    accounts: DataFrame,
    customers: DataFrame,
    threshold: int = 2,
    key: str = "customerId",
    account: str = "accountId",
    name: str = "NoOfAccounts",
) -> DataFrame:
    """Customers (inner-joined to their details) with more than ``threshold``
    distinct accounts (J2 + A2).

    Same result as join-then-group-by (key, details): the accounts are counted
    per key *before* the join, so the join sees one row per customer rather
    than one per account, and the filter runs before it too. The closing
    group-by folds identical customer rows together as the reference's grouping
    would; it reuses the join's partitioning on the key, so it adds no shuffle.
    """
    counts = accounts_per_customer(accounts, key, account, name).filter(F.col(name) > threshold)
    detail_cols = [c for c in customers.columns if c != key]
    joined = customers.join(counts, key, "inner")
    return joined.groupBy(key, *detail_cols).agg(F.max(name).alias(name))


def top_balances(
    accounts: DataFrame,
    n: int = 5,
    balance: str = "balance",
    tie_break: str = "accountId",
) -> DataFrame:
    """The ``n`` account rows with the highest balance, nulls last (O1)."""
    return top_n(accounts, [F.col(balance).desc_nulls_last(), F.col(tie_break).asc()], n)
