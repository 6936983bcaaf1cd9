"""Command line for the composite jobs, the way the reference's scripts run them.

    python -m acctflow.plans.cli accounts-sales --accounts A.csv --customers C.csv --sales S.csv --out DIR
    python -m acctflow.plans.cli customer-features --features F.csv --out DIR [--threshold 15] [--fill-key]
    python -m acctflow.plans.cli bank --statement B.csv --out DIR --start 2017-01-01 --end 2017-12-31

Parameters the reference read from INI files are flags here. The session is
the one the platform provides (``getOrCreate``); run it with spark-submit on a
cluster.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import SparkSession

from acctflow.plans import jobs
from acctflow.sources import schemas


def _date(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="acctflow", description=__doc__.split("\n\n")[0])
    sub = p.add_subparsers(dest="job", required=True)

    a = sub.add_parser("accounts-sales", help="C5: accounts (C1) then sales (C2)")
    a.add_argument("--accounts", required=True)
    a.add_argument("--customers", required=True)
    a.add_argument("--sales", required=True)
    a.add_argument("--out", required=True)
    a.add_argument("--infer", action="store_true", help="infer the account/customer schemas")

    c = sub.add_parser("customer-features", help="C6: the payment-alert report (C3)")
    c.add_argument("--features", required=True)
    c.add_argument("--out", required=True)
    c.add_argument("--threshold", type=float, default=15)
    c.add_argument("--fill-key", action="store_true")

    b = sub.add_parser("bank", help="C4: the bank statement job")
    b.add_argument("--statement", required=True)
    b.add_argument("--out", required=True)
    b.add_argument("--start", type=_date, required=True)
    b.add_argument("--end", type=_date, required=True)
    b.add_argument("--totals-start", type=_date)
    b.add_argument("--totals-end", type=_date)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"acctflow-{args.job}").getOrCreate()
    if args.job == "accounts-sales":
        return jobs.accounts_and_sales_job(
            schemas.load_accounts(spark, args.accounts, infer=args.infer),
            schemas.load_customers(spark, args.customers, infer=args.infer),
            schemas.load_sales(spark, args.sales),
            args.out,
        )
    if args.job == "customer-features":
        return jobs.customer_feature_job(
            schemas.load_features(spark, args.features), args.out,
            threshold=args.threshold, fill_key=args.fill_key,
        )
    outputs = jobs.bank_job(
        schemas.load_bank(spark, args.statement), args.start, args.end,
        args.totals_start, args.totals_end, out_dir=args.out,
    )
    outputs["Totals"].show(truncate=False)
    return outputs


if __name__ == "__main__":
    main(sys.argv[1:])
