"""Registered queries: one per operator of the survey, over the driver's tables.

Each entry takes (spark, sf_dir) and returns a DataFrame that reads whole
tables; nothing is sampled or capped except where the cap is the operator
(top-n listings). Every computed column is aliased to the name used in the
matching oracle SQL (``acctflow.plans.oracle``).
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acctflow.functions import bands, rowwise
from acctflow.operators import accounts as acc
from acctflow.operators import alerts, bank, graph, ranking, sales
from acctflow.operators.filters import at_least
from acctflow.operators.joins import join_on
from acctflow.plans import jobs
from acctflow.session import ensure_checkpoint_dir, materialize
from acctflow.sources import testmap as tm
from acctflow.sources.io import read_table, read_with_rejects, write_table

Query = Callable[[SparkSession, str], DataFrame]

# Fixed parameters of the registered queries.
ITEM_TYPE = "ECONOMY"
REGION = "ASIA"
SALES_START, SALES_END = dt.date(1996, 1, 1), dt.date(1997, 12, 31)
TXN_START, TXN_END = dt.date(2024, 1, 5), dt.date(2024, 1, 20)
ALERT_THRESHOLD = 99000.0


# --- accounts and joins ------------------------------------------------------

def accounts_per_customer(spark, d):
    return acc.accounts_per_customer(tm.accounts(spark, d))


def customers_multi_accounts(spark, d):
    return acc.customers_with_many_accounts(tm.accounts(spark, d), tm.customers(spark, d), 2)


def customers_many_accounts_15(spark, d):
    return acc.customers_with_many_accounts(tm.accounts(spark, d), tm.customers(spark, d), 15)


def top_balances(spark, d):
    return acc.top_balances(tm.accounts(spark, d), 5)


def top_n_per_customer(spark, d):
    return ranking.top_n_per_group(
        tm.accounts(spark, d),
        ["customerId"],
        [F.col("balance").desc_nulls_last(), F.col("accountId")],
        3,
        rank_col="rn",
    )


def _join(how: str, left: str, right: str) -> Query:
    def run(spark, d):
        frames = {"accounts": tm.accounts(spark, d), "customers": tm.customers(spark, d)}
        return join_on(frames[left], frames[right], "customerId", how)

    run.__name__ = f"join_{how}"
    return run


def _visits_join(how: str) -> Query:
    def run(spark, d):
        return join_on(tm.customers(spark, d), tm.visits(spark, d), "customerId", how)

    run.__name__ = f"join_{how}_unmatched"
    return run


def join_right_filled(spark, d):
    return join_on(tm.visits(spark, d), tm.customers(spark, d), "customerId", "right")


def join_full_filled(spark, d):
    return join_on(tm.customers(spark, d), tm.graded(spark, d), "customerId", "full")


# --- sales -------------------------------------------------------------------

def revenue_by_region(spark, d):
    return sales.revenue_by_region(tm.sales(spark, d), decimals=2)


SALES_TIE_BREAK = ("Order_ID", "Country", "Total_Revenue", "Unit_Price", "Total_Profit",
                   "Order_Date", "Region", "Sales_Channel", "Order_Priority")


def top_units(spark, d):
    return sales.top_units(tm.sales(spark, d), ITEM_TYPE, 5, tie_break=SALES_TIE_BREAK)


def region_orders_range(spark, d):
    return sales.region_orders_in_range(tm.sales(spark, d), REGION, SALES_START, SALES_END, tie_break=("Order_ID",))


def region_orders_ranked(spark, d):
    """The listing with the position that its order gives (O3)."""
    listed = sales.region_orders_in_range(tm.sales(spark, d), REGION, SALES_START, SALES_END)
    return ranking.ordinal(listed, ["Order_Date", "Order_ID", *SALES_TIE_BREAK[1:5]], "position")


# --- bank --------------------------------------------------------------------

def _typed(spark, d):
    return bank.prepare(tm.bank_raw(spark, d))


def txn_typed(spark, d):
    return _typed(spark, d)


def txn_debits(spark, d):
    return bank.of_type(_typed(spark, d), "DR")


def txn_credits(spark, d):
    return bank.of_type(_typed(spark, d), "CR")


def txn_cheques(spark, d):
    return bank.cheques(_typed(spark, d))


def txn_range(spark, d):
    return bank.in_range(_typed(spark, d), TXN_START, TXN_END)


def txn_duplicates(spark, d):
    return bank.duplicates(_typed(spark, d))


def txn_single(spark, d):
    return bank.singles(bank.in_range(_typed(spark, d), TXN_START, TXN_END))


def txn_totals(spark, d):
    return bank.totals(_typed(spark, d), TXN_START, TXN_END)


def _by_sql(step: Query) -> Query:
    """A bank step as a view, read by the library's own statement."""

    def run(spark, d):
        return bank.listing(spark, step.__name__, step(spark, d))

    run.__name__ = f"{step.__name__}_sql"
    return run


# --- row-wise features and bands ---------------------------------------------

def row_top3(spark, d):
    return rowwise.with_top_features(tm.payments(spark, d), 3).select(
        "REF_ID", "ORIG", "BENEF", *rowwise.top_columns(3)
    )


def row_top3_int(spark, d):
    return rowwise.with_top_features(tm.payments(spark, d), 3, value_type="int").select(
        "REF_ID", "ORIG", "BENEF", *rowwise.top_columns(3)
    )


def row_topk_values(spark, d):
    return rowwise.with_top_values(tm.payments(spark, d), 3).select(
        "REF_ID", "ORIG", "BENEF", "top1_val", "top2_val", "top3_val"
    )


def features_long(spark, d):
    return rowwise.features_long(tm.payments(spark, d), ["REF_ID", "ORIG", "BENEF"])


def columns_matching(spark, d):
    pay = rowwise.with_top_values(tm.payments(spark, d), 3)
    out = rowwise.with_matching_names(pay, {"top1": "top1_val", "top2": "top2_val", "top3": "top3_val"})
    return out.select(
        "REF_ID", "ORIG", "BENEF",
        *[F.array_join(c, ",").alias(c) for c in ("top1", "top2", "top3")],
    )


def score_bands(spark, d):
    ev = tm.table(spark, d, "events").select("event_id", "user_id", "value")
    return bands.with_band(ev, "value", "rank")


def score_filter(spark, d):
    return at_least(tm.payments(spark, d), "TOTAL_Score", ALERT_THRESHOLD).select(
        "REF_ID", "ORIG", "BENEF", "TOTAL_Score"
    )


# --- graph and alerts ----------------------------------------------------------

def components(spark, d):
    pay = tm.payments(spark, d).select("REF_ID", "ORIG", "BENEF")
    return graph.with_components(pay, "ORIG", "BENEF", order_by="REF_ID", name="Group")


ALERT_INPUT = ["REF_ID", "ORIG", "BENEF", "TOTAL_Score", "PAYMENT_DATE"]


def _alert_input(spark, d, threshold=None):
    # Only the columns the alert queries use: the component step writes its
    # rows, so columns dropped later would still be written and read back.
    pay = tm.payments(spark, d).select(*ALERT_INPUT)
    if threshold is not None:
        pay = at_least(pay, "TOTAL_Score", threshold)
    return materialize(graph.with_components(pay, "ORIG", "BENEF", order_by="REF_ID", name="Group"), "alert-groups")


def alert_keys(spark, d):
    df = alerts.with_alert_key(_alert_input(spark, d))
    return df.select("REF_ID", "ORIG", "BENEF", "Group", "TOTAL_Score", "PAYMENT_DATE", "Alert_Key")


def alert_keys_filled(spark, d):
    df = alerts.with_alert_key(_alert_input(spark, d), fill=True)
    return df.select("REF_ID", "ORIG", "BENEF", "Group", "TOTAL_Score", "PAYMENT_DATE", "Alert_Key")


def group_best_orig(spark, d):
    df = _alert_input(spark, d)
    return ranking.arg_max_over(
        df, ["Group"], "ORIG", ["TOTAL_Score", "ORIG", "BENEF"], "best_orig"
    ).select(
        "REF_ID", "ORIG", "BENEF", "Group", "best_orig"
    )


def alert_report(spark, d):
    return alerts.alert_report(tm.payments(spark, d), "TOTAL_Score", ALERT_THRESHOLD)


def _transfer_groups(spark, d):
    return materialize(graph.with_components(tm.transfers(spark, d), "ORIG", "BENEF", order_by="REF_ID", name="Group"), "alert-groups")


REPORT_THRESHOLD = 1.0


def transfer_report(spark, d):
    return alerts.alert_report(tm.transfer_features(spark, d), "TOTAL_Score", REPORT_THRESHOLD)


def transfer_report_ranked(spark, d):
    """The report with the position that sorting by REF_ID gives a row."""
    return ranking.ordinal(transfer_report(spark, d).select("REF_ID", "Group", "Alert_Key"), ["REF_ID"], "position")


def transfer_components(spark, d):
    return _transfer_groups(spark, d).select("REF_ID", "ORIG", "BENEF", "Group")


ALERT_COLUMNS = ("REF_ID", "ORIG", "BENEF", "Group", "TOTAL_Score", "PAYMENT_DATE", "Alert_Key")


def transfer_alert_keys(spark, d):
    return alerts.with_alert_key(_transfer_groups(spark, d)).select(*ALERT_COLUMNS)


def transfer_alert_keys_filled(spark, d):
    return alerts.with_alert_key(_transfer_groups(spark, d), fill=True).select(*ALERT_COLUMNS)


def transfer_best_orig(spark, d):
    df = ranking.arg_max_over(_transfer_groups(spark, d), ["Group"], "ORIG", ["TOTAL_Score", "ORIG", "BENEF"], "best_orig")
    return df.select("REF_ID", "ORIG", "BENEF", "Group", "best_orig")


# --- jobs: every output written, one read back ---------------------------------

def _folder(spark) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/acctflow/job-{uuid.uuid4().hex}"


def _read_back(spark, folder, outputs, name, fmt):
    return read_table(spark, f"{folder}/{name}", fmt=fmt, schema=outputs[name].schema)


def _accounts_job(name: str) -> Query:
    def run(spark, d):
        folder = _folder(spark)
        out = jobs.accounts_job(tm.accounts(spark, d), tm.customers(spark, d), folder)
        return _read_back(spark, folder, out, name, "csv")

    run.__name__ = f"job_accounts_{name}"
    return run


def _sales_job(name: str) -> Query:
    def run(spark, d):
        folder = _folder(spark)
        out = jobs.sales_job(tm.sales(spark, d), folder, ITEM_TYPE, REGION, SALES_START, SALES_END, SALES_TIE_BREAK, decimals=2)
        return _read_back(spark, folder, out, name, "csv")

    run.__name__ = f"job_sales_{name}"
    return run


def _bank_job(name: str) -> Query:
    def run(spark, d):
        return jobs.bank_job(tm.bank_raw(spark, d), TXN_START, TXN_END, out_dir=_folder(spark))[name]

    run.__name__ = f"job_bank_{name}"
    return run


def job_features(spark, d):
    folder = _folder(spark)
    out = jobs.customer_feature_job(tm.payments(spark, d), folder, threshold=ALERT_THRESHOLD)
    return _read_back(spark, folder, out, "AlertReport", "parquet")


def job_accounts_sales(spark, d):
    folder = _folder(spark)
    out = jobs.accounts_and_sales_job(tm.accounts(spark, d), tm.customers(spark, d), tm.sales(spark, d), folder)
    return _read_back(spark, folder, out, "CustomersWithMultipleAccounts", "csv")


def accounts_semicolon(spark, d):
    folder, rows = _folder(spark), tm.accounts(spark, d)
    write_table(rows, folder, fmt="csv", sep=";")
    return read_table(spark, folder, fmt="csv", schema=rows.schema, sep=";")


def accounts_inferred(spark, d):
    """Accounts written as CSV and read with inferred types."""
    folder = _folder(spark)
    write_table(tm.accounts(spark, d), folder, fmt="csv")
    return read_table(spark, folder).select(
        F.col("customerId").cast("long").alias("customerId"), F.col("accountId").cast("long").alias("accountId"), "balance"
    )


def accounts_with_rejects(spark, d):
    """Accounts written as CSV lines, some of which are no account (a balance
    that is no number, a value too few or too many), read as good rows and rejects."""
    folder, rows = _folder(spark), tm.accounts(spark, d)
    account, balance = F.col("accountId"), F.col("balance").cast("decimal(20,2)").cast("string")
    line = F.when(account % 97 == 0, F.concat_ws(",", "customerId", "accountId", F.lit("none"))).when(
        account % 89 == 0, F.concat_ws(",", "customerId", "accountId")
    ).when(account % 83 == 0, F.concat_ws(",", "customerId", "accountId", balance, F.lit("more"))).otherwise(
        F.concat_ws(",", "customerId", "accountId", balance)
    )
    write_table(rows.select(line.alias("value")), folder, fmt="text")
    good, rejects = read_with_rejects(spark, folder, rows.schema, header=False)
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields]
    return good.withColumn("line", F.lit(None).cast("string")).unionByName(rejects.select(*none, "line"))


QUERIES: dict[str, Query] = {
    "job_accounts": _accounts_job("AccountsPerCustomer"),
    "job_accounts_many": _accounts_job("CustomersWithMultipleAccounts"),
    "job_accounts_top": _accounts_job("HighestBalances"),
    "job_sales": _sales_job("TotalProfitByRegion"),
    "job_sales_revenue": _sales_job("TotalRevenuePerRegion"),
    "job_sales_units": _sales_job("HighestUnitsSold"),
    "job_accounts_sales": job_accounts_sales,
    "job_bank": _bank_job("Debit_Transaction"),
    "job_bank_credits": _bank_job("Credit_Transaction"),
    "job_bank_cheques": _bank_job("Cheque_Transaction"),
    "job_bank_range": _bank_job("DateRange"),
    "job_bank_duplicates": _bank_job("Duplicates"),
    "job_bank_totals": _bank_job("Totals"),
    "accounts_with_rejects": accounts_with_rejects,
    "accounts_inferred": accounts_inferred,
    "region_orders_ranked": region_orders_ranked,
    "transfer_report": transfer_report,
    "transfer_report_ranked": transfer_report_ranked,
    "join_right_filled": join_right_filled,
    "join_full_filled": join_full_filled,
    "job_features": job_features,
    "accounts_semicolon": accounts_semicolon,
    "transfer_components": transfer_components,
    "transfer_alert_keys": transfer_alert_keys,
    "transfer_alert_keys_filled": transfer_alert_keys_filled,
    "transfer_best_orig": transfer_best_orig,
    **{f"join_{how}_unmatched": _visits_join(how) for how in ("left", "right", "full", "left_semi", "left_anti")},
    "accounts_per_customer": accounts_per_customer,
    "customers_multi_accounts": customers_multi_accounts,
    "customers_many_accounts_15": customers_many_accounts_15,
    "top_balances": top_balances,
    "top_n_per_customer": top_n_per_customer,
    "join_inner": _join("inner", "accounts", "customers"),
    "join_left": _join("left", "customers", "accounts"),
    "join_right": _join("right", "accounts", "customers"),
    "join_full": _join("full", "customers", "accounts"),
    "join_semi": _join("left_semi", "customers", "accounts"),
    "join_anti": _join("left_anti", "customers", "accounts"),
    "revenue_by_region": revenue_by_region,
    "top_units": top_units,
    "region_orders_range": region_orders_range,
    "txn_typed": txn_typed,
    "txn_debits": txn_debits,
    "txn_credits": txn_credits,
    "txn_cheques": txn_cheques,
    "txn_range": txn_range,
    "txn_duplicates": txn_duplicates,
    "txn_single": txn_single,
    "txn_totals": txn_totals,
    **{f"{q.__name__}_sql": _by_sql(q) for q in (txn_totals, txn_duplicates, txn_debits, txn_range, txn_cheques, txn_single)},
    "row_top3": row_top3,
    "row_top3_int": row_top3_int,
    "row_topk_values": row_topk_values,
    "features_long": features_long,
    "columns_matching": columns_matching,
    "score_bands": score_bands,
    "score_filter": score_filter,
    "components": components,
    "alert_keys": alert_keys,
    "alert_keys_filled": alert_keys_filled,
    "group_best_orig": group_best_orig,
    "alert_report": alert_report,
}
