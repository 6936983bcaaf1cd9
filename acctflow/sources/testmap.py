"""The reference's five table shapes, derived from the driver's parquet tables.

Each function reads whole tables under ``sf_dir`` and returns a DataFrame in
the layout the reference's operators expect. Raw layouts (``sales_raw``,
``bank_raw``) keep the spaced column names and text dates of the reference's
CSV files, so the rename and date-parsing steps run on every query.

Joins carry no hints: the planner broadcasts a side only when its measured
size (file statistics, then AQE's run-time statistics) is under the broadcast
threshold, and sort-merges otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from acctflow.functions.columns import SALES_COLUMNS, parse_dates, rename_columns
from acctflow.sources.io import read_table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet", fmt="parquet")


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One account per order: (customerId, accountId, balance)."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customerId"),
        F.col("o_orderkey").alias("accountId"),
        F.col("o_totalprice").alias("balance"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(customerId, forename, surname) from the customer table."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customerId"),
        F.col("c_name").alias("forename"),
        F.col("c_mktsegment").alias("surname"),
    )


def _geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "n_name", "r_name"
    )


def sales_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sales row per line item, in the raw layout (spaced names, text dates).

    Order dates are written as ``M/d/yyyy`` for even order keys and
    ``d-M-yyyy`` for odd ones, the two layouts of the reference's file.
    """
    li = table(spark, sf_dir, "lineitem")
    od = table(spark, sf_dir, "orders")
    cu = table(spark, sf_dir, "customer")
    pa = table(spark, sf_dir, "part")
    text_date = F.when(
        F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "M/d/yyyy")
    ).otherwise(F.date_format("o_orderdate", "d-M-yyyy"))
    joined = (
        li.join(od, li.l_orderkey == od.o_orderkey)
        .join(cu, od.o_custkey == cu.c_custkey)
        .join(_geo(spark, sf_dir), cu.c_nationkey == F.col("n_nationkey"))
        .join(pa, li.l_partkey == pa.p_partkey)
    )
    return joined.select(
        F.col("r_name").alias("Region"),
        F.col("n_name").alias("Country"),
        F.col("p_type").alias("Item Type"),
        F.col("c_mktsegment").alias("Sales Channel"),
        F.col("o_orderpriority").alias("Order Priority"),
        text_date.alias("Order Date"),
        F.col("o_orderkey").alias("Order ID"),
        F.col("l_quantity").alias("Units Sold"),
        F.col("p_retailprice").alias("Unit Price"),
        F.col("l_extendedprice").alias("Total Revenue"),
        (F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))).alias("Total Profit"),
    )


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``sales_raw`` renamed (P1) with Order_Date parsed to a DATE (P5)."""
    renamed = rename_columns(sales_raw(spark, sf_dir), SALES_COLUMNS)
    return parse_dates(renamed, "Order_Date")


def bank_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bank statement from the events table, in the reference's raw layout.

    All eight columns are text, as an inferred statement file would be.
    Purchases and errors are withdrawals, other events deposits; amounts are
    the event value floored to tens. Purchases carry a cheque number. Error
    amounts have a ``DR`` suffix, so they do not parse as numbers.
    """
    ev = table(spark, sf_dir, "events")
    amount = (F.floor(F.col("value") / 10) * 10).cast("bigint").cast("string")
    is_withdrawal = F.col("event_type").isin("purchase", "error")
    day = F.date_format("ts", "dd-MM-yyyy")
    withdrawal = F.when(F.col("event_type") == "error", F.concat(amount, F.lit(" DR"))).otherwise(amount)
    return ev.select(
        F.col("user_id").cast("string").alias("Account No"),
        day.alias("DATE"),
        F.col("event_type").alias("TRANSACTION DETAILS"),
        F.when(F.col("event_type") == "purchase", F.col("event_id").cast("string")).alias("CHQ NO"),
        day.alias("VALUE DATE"),
        F.when(is_withdrawal, withdrawal).alias("WITHDRAWAL AMT"),
        F.when(~is_withdrawal, amount).alias("DEPOSIT AMT"),
        F.floor(F.col("value") * 100).cast("bigint").cast("string").alias("BALANCE AMT"),
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A payment graph from line items: one row per (part, supplier) edge.

    ORIG is ``p<partkey>``, BENEF ``s<suppkey>``; REF_ID is the smallest
    ``orderkey*10 + linenumber`` of the edge. Five named scores per row, with
    FEATURE3 named like FEATURE2 when the edge has a returned item, so names
    can repeat within a row as in the reference's second features file.
    """
    li = table(spark, sf_dir, "lineitem")
    agg = li.groupBy("l_partkey", "l_suppkey").agg(
        F.min(F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("REF_ID"),
        F.max("l_quantity").alias("q"),
        F.max("l_discount").alias("d"),
        F.max("l_tax").alias("t"),
        F.max("l_linenumber").alias("ln"),
        F.count(F.lit(1)).alias("n"),
        F.max(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("returned"),
        F.max("l_extendedprice").alias("TOTAL_Score"),
        F.min("l_shipdate").alias("PAYMENT_DATE"),
    )
    return agg.select(
        F.col("REF_ID"),
        F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("ORIG"),
        F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("BENEF"),
        F.lit("Quantity").alias("FEATURE1"),
        F.ceil(F.col("q") / 10).cast("double").alias("FEATURE1_Score"),
        F.lit("Discount").alias("FEATURE2"),
        F.round(F.col("d") * 100).cast("double").alias("FEATURE2_Score"),
        F.when(F.col("returned") == 1, F.lit("Discount")).otherwise(F.lit("Tax")).alias("FEATURE3"),
        F.round(F.col("t") * 100).cast("double").alias("FEATURE3_Score"),
        F.lit("Line").alias("FEATURE4"),
        F.col("ln").cast("double").alias("FEATURE4_Score"),
        F.lit("Count").alias("FEATURE5"),
        F.col("n").cast("double").alias("FEATURE5_Score"),
        F.col("TOTAL_Score"),
        F.col("PAYMENT_DATE"),
        F.month("PAYMENT_DATE").alias("MONTH"),
    )


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(customerId, event, value) of every event; many customers have none."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("long").alias("customerId"), F.col("event_id").alias("event"), "value"
    )


def transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A payment graph with one component per customer with orders: each order
    is linked to the same customer's order before; the first has no BENEF.

    Scores are order totals in steps of 100,000, so ties occur; customers whose
    number ends in 7 have none, so their groups have no key.
    """
    before = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    score = F.when(F.col("o_custkey") % 10 != 7, F.floor(F.col("o_totalprice") / 100000).cast("double"))
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("REF_ID"),
        F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("ORIG"),
        F.concat(F.lit("o"), F.lag("o_orderkey").over(before).cast("string")).alias("BENEF"),
        score.alias("TOTAL_Score"),
        F.col("o_orderdate").alias("PAYMENT_DATE"),
    )


def transfer_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``transfers`` in the layout of the features file: one component per run of
    a customer's orders above a threshold, tied scores, names that repeat within
    a row, and groups without a key (customers whose number ends in 7 have no dates).
    """
    before = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    price, day = F.col("o_totalprice"), F.dayofmonth("o_orderdate")
    scores = {
        "Price": F.floor(price / 50000) % 6,
        "Day": day % 6,
        "Priority": F.substring("o_orderpriority", 1, 1).cast("int"),
        "Month": F.month("o_orderdate") % 5,
        "Key": F.col("o_orderkey") % 7,
    }
    third = F.when(F.col("o_orderkey") % 3 == 0, "Price").otherwise("Priority")
    named = [(third if n == "Priority" else F.lit(n), s) for n, s in scores.items()]
    dated = F.when(F.col("o_custkey") % 10 != 7, F.col("o_orderdate"))
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("REF_ID"),
        F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("ORIG"),
        F.concat(F.lit("o"), F.lag("o_orderkey").over(before).cast("string")).alias("BENEF"),
        *[c for i, (n, s) in enumerate(named, 1) for c in (n.alias(f"FEATURE{i}"), s.cast("double").alias(f"FEATURE{i}_Score"))],
        F.floor(price / 100000).cast("double").alias("TOTAL_Score"),
        dated.alias("PAYMENT_DATE"),
        F.month(dated).alias("MONTH"),
    )


def graded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(customerId, grade) of the labelled documents, their number taken for a
    customer's: many have no customer, and many customers no row."""
    return table(spark, sf_dir, "labels").select(F.col("doc_id").alias("customerId"), F.col("quality").alias("grade"))
