"""Bank job (P2, P3, P6-P8, F1-F3, A4-A6), API form and SQL form."""

from __future__ import annotations

import datetime as dt

from acctflow.functions.columns import BANK_KEEP
from acctflow.operators import bank
from acctflow.sources.schemas import BANK

# (Account No, DATE, CHQ NO, WITHDRAWAL AMT, DEPOSIT AMT)
ROWS = [
    ("A", "01-02-2017", None, None, "100.0"),
    ("A", "01-02-2017", None, None, "100.0"),
    ("A", "02-02-2017", "77", "40.0", None),
    ("A", "03-02-2017", None, "1,000.00", None),
    ("B", "02-02-2017", None, None, " 25.0 "),
    ("B", "05-03-2017", "78", "5.0", None),
    ("C", "06-02-2017", None, None, None),
]
FEB = (dt.date(2017, 2, 1), dt.date(2017, 2, 28))


def _raw(spark):
    full = [(a, d, "detail", c, d, w, dep, "0") for a, d, c, w, dep in ROWS]
    return spark.createDataFrame(full, BANK)


def test_prepare_types_and_amounts(spark):
    typed = bank.prepare(_raw(spark))
    assert typed.columns == BANK_KEEP + ["TransactionAmount", "TransactionType"]
    got = sorted((r.Account_No, r.DATE, r.TransactionType, r.TransactionAmount) for r in typed.collect())
    assert ("C", dt.date(2017, 2, 6), "CR", None) in got
    assert ("A", dt.date(2017, 2, 2), "DR", "40.0") in got
    assert ("B", dt.date(2017, 2, 2), "CR", " 25.0 ") in got


def test_filters(spark):
    typed = bank.prepare(_raw(spark))
    assert bank.of_type(typed, "DR").count() == 3
    assert bank.of_type(typed, "CR").count() == 4
    assert bank.cheques(typed).count() == 2
    assert bank.in_range(typed, *FEB).count() == 6
    assert bank.in_range(typed, "2017-02-01", "2017-02-28").count() == 6


def test_duplicates_singles_totals(spark):
    typed = bank.prepare(_raw(spark))
    dups = [tuple(r) for r in bank.duplicates(typed).collect()]
    assert dups == [("A", dt.date(2017, 2, 1), "CR", "100.0", 2)]
    assert bank.singles(bank.in_range(typed, *FEB)).count() == 4
    totals = {r.Account_No: (r.Total_Withdraw, r.Total_Deposit) for r in bank.totals(typed, *FEB).collect()}
    assert totals == {"A": (40.0, None), "B": (None, 25.0), "C": (None, None)}


def test_listing_by_sql(spark):
    typed = bank.prepare(_raw(spark))
    for step in (bank.totals(typed, *FEB), bank.duplicates(typed)):
        found = bank.listing(spark, "bank_step", step)
        assert found.columns == step.columns
        assert sorted(map(str, found.collect())) == sorted(map(str, step.collect()))
    assert bank.listing(spark, "bank_step", typed, account="B").count() == 2
    # A quote in a bound parameter is data, not SQL.
    assert bank.listing(spark, "bank_step", typed, account="B' OR '1'='1").count() == 0


def test_typing_runs_on_a_stream(spark, tmp_out):
    import os

    src = os.path.join(tmp_out, "stream_in")
    os.makedirs(src)
    with open(os.path.join(src, "part1.csv"), "w") as fh:
        fh.write("Account No,DATE,TRANSACTION DETAILS,CHQ NO,VALUE DATE,WITHDRAWAL AMT,DEPOSIT AMT,BALANCE AMT\n")
        fh.write("A,01-02-2017,x,,01-02-2017,,100,0\nA,02-02-2017,x,7,02-02-2017,40,,0\n")
    stream = spark.readStream.schema(BANK).option("header", True).csv(src)
    debits = bank.of_type(bank.prepare(stream), "DR")
    query = (debits.writeStream.format("memory").queryName("acctflow_debits")
             .option("checkpointLocation", os.path.join(tmp_out, "stream_ckpt"))
             .trigger(availableNow=True).start())
    query.awaitTermination(120)
    rows = spark.sql("SELECT Account_No, TransactionAmount FROM acctflow_debits").collect()
    assert [(r.Account_No, r.TransactionAmount) for r in rows] == [("A", "40")]
