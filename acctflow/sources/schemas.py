"""Explicit schemas of the reference's input files, and loaders using them.

Explicit schemas avoid the extra pass that ``inferSchema`` makes over a file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from acctflow.functions.columns import SALES_COLUMNS, parse_dates, rename_columns
from acctflow.sources.io import read_table


def _schema(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


ACCOUNT = _schema(("customerId", StringType()), ("accountId", StringType()), ("balance", DoubleType()))
CUSTOMER = _schema(("customerId", StringType()), ("forename", StringType()), ("surname", StringType()))

SALES = _schema(
    ("Region", StringType()),
    ("Country", StringType()),
    ("Item Type", StringType()),
    ("Sales Channel", StringType()),
    ("Order Priority", StringType()),
    ("Order Date", StringType()),
    ("Order ID", LongType()),
    ("Units Sold", DoubleType()),
    ("Unit Price", DoubleType()),
    ("Total Revenue", DoubleType()),
    ("Total Profit", DoubleType()),
)

FEATURES = _schema(
    ("REF_ID", IntegerType()),
    ("ORIG", StringType()),
    ("BENEF", StringType()),
    *[
        field
        for i in range(1, 6)
        for field in ((f"FEATURE{i}", StringType()), (f"FEATURE{i}_Score", DoubleType()))
    ],
    ("TOTAL_Score", DoubleType()),
    ("PAYMENT_DATE", TimestampType()),
    ("MONTH", IntegerType()),
)

BANK = _schema(
    *[(name, StringType()) for name in (
        "Account No", "DATE", "TRANSACTION DETAILS", "CHQ NO",
        "VALUE DATE", "WITHDRAWAL AMT", "DEPOSIT AMT", "BALANCE AMT",
    )]
)


def load_sales(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """Sales file -> renamed columns (P1) with Order_Date as a DATE (P5)."""
    raw = read_table(spark, path, "csv", SALES, sep=sep)
    return parse_dates(rename_columns(raw, SALES_COLUMNS), "Order_Date")


def load_features(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    return read_table(spark, path, "csv", FEATURES, sep=sep)


def load_accounts(spark: SparkSession, path: str, infer: bool = False) -> DataFrame:
    return read_table(spark, path, "csv", None if infer else ACCOUNT)


def load_customers(spark: SparkSession, path: str, infer: bool = False) -> DataFrame:
    return read_table(spark, path, "csv", None if infer else CUSTOMER)


def load_bank(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return read_table(spark, path, fmt, BANK if fmt == "csv" else None)
