"""Sources and sinks (S1-S8) and the composite jobs."""

from __future__ import annotations

import datetime as dt
import os

import pytest

from acctflow.plans import jobs
from acctflow.sources import io, schemas


def _write(path, text):
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)
    return path


def test_read_inferred_and_with_schema(spark, tmp_out):
    path = _write(os.path.join(tmp_out, "acc.csv"),
                  "customerId,accountId,balance\nIND0325,ACC0001,687\nIND0221,ACC0002,589\n")
    inferred = io.read_table(spark, path)
    assert inferred.columns == ["customerId", "accountId", "balance"]
    assert dict(inferred.dtypes)["balance"] == "int"
    typed = io.read_table(spark, path, schema=schemas.ACCOUNT)
    assert sorted(r.balance for r in typed.collect()) == [589.0, 687.0]
    semi = _write(os.path.join(tmp_out, "s.csv"), "a;b\n x ;2\n")
    row = io.read_table(spark, semi, schema="a string, b int", sep=";").collect()[0]
    assert (row.a, row.b) == (" x ", 2)


def test_write_round_trip_and_views(spark, tmp_out):
    df = io.from_rows(spark, [("a", 1), ("b", 2)], "k string, v int")
    for fmt in ("csv", "parquet"):
        target = os.path.join(tmp_out, f"out_{fmt}")
        io.write_table(df, target, fmt=fmt)
        io.write_table(df, target, fmt=fmt, mode="overwrite")
        back = io.read_table(spark, target, fmt, schema="k string, v int")
        assert sorted(map(tuple, back.collect())) == [("a", 1), ("b", 2)]
    io.register_views({"kv": df})
    got = io.run_sql(spark, "SELECT k FROM kv WHERE v >= :lo", {"lo": 2}).collect()
    assert [r.k for r in got] == ["b"]


def test_jobs_write_outputs(spark, tmp_out):
    acc = io.from_rows(spark, [("C1", "A1", 10.0), ("C1", "A2", 20.0), ("C1", "A3", 5.0), ("C2", "A4", 7.0)],
                       schemas.ACCOUNT)
    cst = io.from_rows(spark, [("C1", "Ann", "Lee"), ("C2", "Bo", "Kim")], schemas.CUSTOMER)
    sales_path = _write(
        os.path.join(tmp_out, "sales.csv"),
        "Region;Country;Item Type;Sales Channel;Order Priority;Order Date;Order ID;Units Sold;"
        "Unit Price;Total Revenue;Total Profit\n"
        "Asia;India;Household;Online;H;2/5/2011;1;5210;1;100.5;1\n"
        "Asia;Nepal;Household;Online;H;5-9-2011;2;4187;1;50;1\n"
        "Europe;Spain;Household;Online;H;3-3-2012;3;3830;1;7;1\n",
    )
    sales_df = schemas.load_sales(spark, sales_path)
    out = jobs.accounts_and_sales_job(acc, cst, sales_df, tmp_out)
    for name in ("AccountsPerCustomer", "CustomersWithMultipleAccounts", "HighestBalances",
                 "TotalRevenuePerRegion", "HighestUnitsSold", "TotalProfitByRegion"):
        assert os.path.isdir(os.path.join(tmp_out, name)), name
    back = io.read_table(spark, os.path.join(tmp_out, "TotalProfitByRegion"), "csv")
    assert back.count() == 2
    assert out["CustomersWithMultipleAccounts"].count() == 1

    bank_raw = io.from_rows(
        spark,
        [("A", "01-02-2017", "x", None, "01-02-2017", None, "100", "0"),
         ("A", "02-02-2017", "x", "9", "02-02-2017", "40", None, "0")],
        schemas.BANK,
    )
    res = jobs.bank_job(bank_raw, dt.date(2017, 2, 1), dt.date(2017, 2, 28), out_dir=tmp_out)
    assert io.read_table(spark, os.path.join(tmp_out, "Credit_Transaction"), "parquet").count() == 1
    assert io.read_table(spark, os.path.join(tmp_out, "Debit_Transaction"), "parquet").count() == 1
    assert res["Totals"].collect()[0].Total_Withdraw == 40.0


def test_materialize_and_release(spark):
    from acctflow.session import ensure_checkpoint_dir, materialize, release

    base = ensure_checkpoint_dir(spark)
    df = materialize(spark.range(10), "probe")
    path = df._acctflow_path
    assert path.startswith(base.rstrip("/"))
    local = path.replace("file:", "")
    assert os.path.isdir(local) and df.count() == 10
    release(df)
    assert not os.path.exists(local)


@pytest.mark.parametrize("fmt", ["json", "orc"])
def test_other_formats_round_trip(spark, tmp_out, fmt):
    df = io.from_rows(spark, [("a", 1), ("b", 2)], "k string, v int")
    target = os.path.join(tmp_out, f"out_{fmt}")
    io.write_table(df, target, fmt=fmt)
    back = io.read_table(spark, target, fmt, schema="k string, v int")
    assert sorted(map(tuple, back.collect())) == [("a", 1), ("b", 2)]


def test_command_line_jobs(spark, tmp_out):
    from acctflow.plans import cli

    bank = _write(os.path.join(tmp_out, "bank.csv"),
                  "Account No,DATE,TRANSACTION DETAILS,CHQ NO,VALUE DATE,WITHDRAWAL AMT,DEPOSIT AMT,BALANCE AMT\n"
                  "A,01-02-2017,x,,01-02-2017,,100,0\nA,02-02-2017,x,7,02-02-2017,40,,0\n")
    out = cli.main(["bank", "--statement", bank, "--out", os.path.join(tmp_out, "b"),
                    "--start", "2017-02-01", "--end", "2017-02-28"], spark=spark)
    assert out["Totals"].collect()[0].Total_Withdraw == 40.0
    assert os.path.isdir(os.path.join(tmp_out, "b", "Cheque_Transaction"))
    feats = _write(os.path.join(tmp_out, "f.csv"),
                   "REF_ID;ORIG;BENEF;F1;1;F2;2;F3;3;F4;4;F5;5;T;P;M\n"
                   "1;A;B;Credit;5;Lease;4;Deposit;3;Risk;2;Transfer;1;17;2021-01-05 00:00:00;1\n")
    rep = cli.main(["customer-features", "--features", feats, "--out", os.path.join(tmp_out, "c")], spark=spark)
    row = rep["AlertReport"].collect()[0]
    assert (row.Group, row.Alert_Key, row.Top1_Feature) == ("G1", "A", "Credit")


def test_rejects_are_told_from_good_rows(spark, tmp_out):
    from pyspark.sql.types import StructType

    from acctflow.sources.io import read_with_rejects

    path = f"{tmp_out}/lines.csv"
    with open(path, "w") as fh:
        fh.write("who;n\nann;1\nbo;x\ncy\ndee;2;3\n;4\n")
    schema = StructType.fromDDL("who string, n int")
    good, rejects = read_with_rejects(spark, path, schema, sep=";")
    assert sorted(map(str, map(tuple, good.collect()))) == ["('ann', 1)", "(None, 4)"]
    assert good.select("who").count() == 2  # also when the bad column is not read
    assert sorted(r.line for r in rejects.select("line").collect()) == ["bo;x", "cy", "dee;2;3"]
