"""Accounts and sales operators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from acctflow.functions.columns import SALES_COLUMNS, parse_dates, rename_columns
from acctflow.operators import accounts as acc
from acctflow.operators import ranking, sales
from acctflow.operators.joins import join_on

ACC_SCHEMA = "customerId string, accountId string, balance double"
CST_SCHEMA = "customerId string, forename string, surname string"


def _accounts(spark, **held):
    """One account row per letter: _accounts(spark, ann="xyz") gives ann three."""
    rows = [(who, f"{who}-{x}", float(ord(x))) for who, xs in held.items() for x in xs]
    return spark.createDataFrame(rows, ACC_SCHEMA)


def _customers(spark, *names):
    return spark.createDataFrame([(n, n.title(), n[::-1]) for n in names], CST_SCHEMA)


def test_accounts_per_customer(spark):
    no_account = spark.createDataFrame([("bo", None, 1.0)], ACC_SCHEMA)
    out = acc.accounts_per_customer(_accounts(spark, ann="xyzzy", bo="q").union(no_account))
    assert dict(map(tuple, out.collect())) == {"ann": 3, "bo": 1}


def test_customers_with_many_accounts(spark):
    held = _accounts(spark, ann="xyz", bo="q", unknown="abc")
    out = acc.customers_with_many_accounts(held, _customers(spark, "ann", "bo", "ann"), 2)
    assert out.columns == ["customerId", "forename", "surname", "NoOfAccounts"]
    assert [tuple(r) for r in out.collect()] == [("ann", "Ann", "nna", 3)]


def test_top_balances_order_and_ties(spark):
    df = spark.createDataFrame([(f"c{i}", f"acc{i}", float(i * 7 % 11)) for i in range(11)], ACC_SCHEMA)
    assert [r.balance for r in acc.top_balances(df).collect()] == [10, 9, 8, 7, 6]
    tied = spark.createDataFrame([("a", "acc9", 2.5), ("b", "acc3", 2.5), ("c", "acc1", None)], ACC_SCHEMA)
    assert [r.accountId for r in acc.top_balances(tied, 2).collect()] == ["acc3", "acc9"]


def test_join_types(spark):
    held, known = _accounts(spark, ann="xy", ghost="g"), _customers(spark, "ann", "bo")

    def rows(how, a=held, c=known):
        return sorted((tuple(r) for r in join_on(a, c, "customerId", how).collect()), key=str)

    ann = [("ann", f"ann-{x}", float(ord(x)), "Ann", "nna") for x in "xy"]
    ghost, bo = ("ghost", "ghost-g", 103.0, None, None), ("bo", None, None, "Bo", "ob")
    assert join_on(held, known, "customerId").columns == ["customerId", "accountId", "balance", "forename", "surname"]
    assert rows("inner") == ann
    assert rows("left") == sorted([*ann, ghost], key=str)
    assert rows("right") == sorted([*ann, bo], key=str)
    assert rows("full") == sorted([*ann, ghost, bo], key=str)
    assert rows("left_semi") == [r[:3] for r in ann] and rows("left_anti") == [ghost[:3]]
    nulls = spark.createDataFrame([(None, "n", 1.0)], ACC_SCHEMA)
    assert rows("left", nulls) == [(None, "n", 1.0, None, None)] and rows("full", nulls, known.limit(0)) == rows("left", nulls)
    clash = known.withColumnRenamed("forename", "accountId")
    assert join_on(held, clash, "customerId", "full").columns == ["customerId", "accountId", "balance", "accountId", "surname"]
    assert rows("full", held, clash) == rows("full")


def test_outer_joins_equal_sparks_own(spark):
    from itertools import product

    keys = [*product((1, 2, None), ("x", "y", None)), (3, "x"), (3, "x")]
    left = spark.createDataFrame([(a, b, i) for i, (a, b) in enumerate(keys[::2] * 2)], "a int, b string, l int")
    right = spark.createDataFrame([(a, b, i) for i, (a, b) in enumerate(keys[::3] * 3)], "a long, b string, r int")
    for how in ("left", "right", "full", "left_semi", "left_anti"):
        got = join_on(left, right, ["a", "b"], how)
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, left.join(right, ["a", "b"], how).collect())))


def test_hot_and_null_keys_are_split_in_every_join(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id"))  # a third hot, a third null
        rows = spark.range(0, 30000, 1, 8).select(key.alias("k"), "id")
        few = spark.createDataFrame([(7, "a"), (7, "b"), (10, "c"), (-1, "d")], "k long, v string")
        sizes = {"left_semi": 10002, "left_anti": 19998, "left": 40001, "full": 40002}
        for how, n in sizes.items():
            out = join_on(rows, few, "k", how)
            tasks = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
            assert sum(tasks) == n and max(tasks) <= 0.65 * n, (how, tasks)
            out.collect()
            assert "skew=true" in out._jdf.queryExecution().executedPlan().toString(), how
        assert join_on(few, rows, "k", "right").count() == 40001
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_outer_joins_read_each_wide_side_once(spark, tmp_out):
    for name in ("a", "b"):
        spark.range(100).selectExpr("id AS k", f"repeat('{name}', 50) AS wide_{name}").write.parquet(f"{tmp_out}/{name}")
    left, right = (spark.read.parquet(f"{tmp_out}/{n}") for n in ("a", "b"))
    for how in ("left", "right", "full"):
        plan = join_on(left, right, "k", how)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("wide_a") and sum("wide_a" in line for line in plan.splitlines() if "Relation" in line) == 1
        assert sum("wide_b" in line for line in plan.splitlines() if "Relation" in line) == 1


def test_listings_need_no_order_id(spark):
    rows = [("Toys", 5, "North", dt.date(2020, 1, 2)), ("Toys", 9, "North", dt.date(2020, 1, 1)), ("Food", 99, "South", dt.date(2020, 1, 1))]
    df = spark.createDataFrame(rows, "Item_Type string, Units_Sold int, Region string, Order_Date date")
    assert [r.Units_Sold for r in sales.top_units(df, "Toys").collect()] == [9, 5]
    found = sales.region_orders_in_range(df, "North", "2020-01-01", "2020-12-31").collect()
    assert [r.Units_Sold for r in found] == [9, 5]


def test_range_on_text_column_in_any_case(spark):
    from acctflow.operators.filters import date_between

    df = spark.createDataFrame([("2020-05-05",), ("junk",), (None,)], "DATE string")
    for name in ("DATE", "date"):
        assert [r[0] for r in date_between(df, name, "2020-01-01", "2020-12-31").collect()] == ["2020-05-05"]


def test_top_n_per_group_keeps_n_per_key(spark):
    rows = [("k1", f"a{i}", float(i)) for i in range(10)] + [("k2", "b0", 5.0)]
    df = spark.createDataFrame(rows, ACC_SCHEMA)
    out = ranking.top_n_per_group(df, ["customerId"], [F.col("balance").desc(), "accountId"], 3, "rn")
    got = sorted((r.customerId, r.accountId, r.rn) for r in out.collect())
    assert got == [("k1", "a7", 3), ("k1", "a8", 2), ("k1", "a9", 1), ("k2", "b0", 1)]


def test_ordinal_is_dense_across_partitions(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7 % 5000).alias("k")).repartition(13)
    out = ranking.ordinal(df, ["k"], "n")
    got = sorted((r.k, r.n) for r in out.collect())
    assert got == [(k, k + 1) for k in range(5000)]


def test_arg_max_over_breaks_ties(spark):
    df = spark.createDataFrame(
        [("G1", "x", 5.0), ("G1", "y", 5.0), ("G1", "z", 1.0), ("G2", "w", None)],
        "g string, o string, s double",
    )
    out = ranking.arg_max_over(df, ["g"], "o", ["s", "o"], "best")
    assert sorted((r.o, r.best) for r in out.collect()) == [("w", "w"), ("x", "y"), ("y", "y"), ("z", "y")]


def _raw_sales(spark, rows):
    cols = list(SALES_COLUMNS)
    schema = ", ".join(
        f"`{c}` {'bigint' if c == 'Order ID' else 'double' if c in ('Units Sold', 'Unit Price', 'Total Revenue', 'Total Profit') else 'string'}"
        for c in cols
    )
    return spark.createDataFrame(rows, schema)


def test_rename_and_mixed_dates(spark):
    texts = {"12/31/1999": dt.date(1999, 12, 31), "31-12-1999": dt.date(1999, 12, 31), "1-2-2003": dt.date(2003, 2, 1), "13/1/2003": None, "?": None}
    out = parse_dates(spark.createDataFrame([(t, t) for t in texts], "t string, Date string"), "Date")
    assert {r.t: r.Date for r in out.collect()} == texts
    raw = _raw_sales(spark, [("North", "N1", "Toys", "shop", "x", "3/4/2005", 1, 10.0, 1.0, 10.0, 2.0)])
    renamed = rename_columns(raw, SALES_COLUMNS)
    assert renamed.columns == ["Region", "Country", "Item_Type", "Sales_Channel", "Order_Priority",
                               "Order_Date", "Order_ID", "Units_Sold", "Unit_Price", "Total_Revenue",
                               "Total_Profit"]


def _sales(spark):
    """Six days of one month, sold alternately in two regions, dates in both layouts."""
    rows = [
        (("North", "South")[i % 2], f"N{i}", "Toys" if i < 5 else "Food", "shop", "x", f"6/{i + 1}/2020" if i % 3 else f"{i + 1}-6-2020",
         i, 10.0 * (i * 5 % 6), 1.0, 0.25 + i, 1.0)
        for i in range(6)
    ]
    return parse_dates(rename_columns(_raw_sales(spark, rows), SALES_COLUMNS), "Order_Date")


def test_revenue_by_region(spark):
    out = sales.revenue_by_region(_sales(spark))
    assert sorted(map(tuple, out.collect())) == [("North", 6.75), ("South", 9.75)]
    exact = sales.revenue_by_region(_sales(spark), decimals=2)
    assert dict(exact.dtypes)["Total_Revenue"] == "decimal(38,2)"


def test_top_units_and_region_range(spark):
    df = _sales(spark)
    assert [r.Units_Sold for r in sales.top_units(df, "Toys", 4).collect()] == [50.0, 40.0, 30.0, 20.0]
    got = sales.region_orders_in_range(df, "North", dt.date(2020, 6, 2), dt.date(2020, 6, 5)).collect()
    assert [(r.Order_Date, r.Order_ID) for r in got] == [(dt.date(2020, 6, 3), 2), (dt.date(2020, 6, 5), 4)]


def test_sales_job_stores_once_and_prunes(spark, tmp_out):
    from acctflow.plans import jobs

    out = jobs.sales_job(_sales(spark), tmp_out, "Toys", "North", dt.date(2020, 6, 2), dt.date(2020, 6, 5))
    listed = out["TotalProfitByRegion"]
    plan = spark.sparkContext._jvm.PythonSQLUtils.explainString(listed._jdf.queryExecution(), "formatted")
    assert "PartitionFilters: [isnotnull(Region" in plan
    assert [r.Order_ID for r in listed.collect()] == [2, 4] and listed.columns == _sales(spark).columns
    written = spark.read.option("header", True).csv(f"{tmp_out}/TotalProfitByRegion")
    assert [r["Order_ID"] for r in written.collect()] == ["2", "4"]


def test_bank_job_reads_types_by_folder(spark, tmp_out):
    from acctflow.plans import jobs
    from tests.test_bank import FEB, _raw

    stored, plain = jobs.bank_job(_raw(spark), *FEB, out_dir=tmp_out), jobs.bank_job(_raw(spark), *FEB)
    for name, df in plain.items():
        assert sorted(map(str, stored[name].collect())) == sorted(map(str, df.collect())), name
        assert spark.read.parquet(f"{tmp_out}/{name}").count() == df.count()
    plan = spark.sparkContext._jvm.PythonSQLUtils.explainString(stored["Debit_Transaction"]._jdf.queryExecution(), "formatted")
    assert "PartitionFilters: [isnotnull(TransactionType" in plan


def test_value_and_range_on_text_dates(spark):
    from acctflow.operators.filters import value_and_range

    df = spark.createDataFrame(
        [("Asia", "2011-02-05"), ("Asia", "junk"), ("Asia", "2016-01-01"), ("Europe", "2012-01-01")],
        "Region string, Order_Date string",
    )
    got = value_and_range(df, "Region", "Asia", "Order_Date", dt.date(2011, 1, 1), dt.date(2015, 12, 31))
    assert [r.Order_Date for r in got.collect()] == ["2011-02-05"]
    same = value_and_range(df, "Region", "Asia", "Order_Date", "2011-01-01", "2015-12-31")
    assert same.count() == 1


def test_parse_dates_keeps_typed_columns(spark):
    df = spark.createDataFrame(
        [(dt.date(2020, 1, 2), dt.datetime(2020, 1, 3, 10, 0))], "d date, t timestamp"
    )
    out = parse_dates(parse_dates(df, "d"), "t").collect()[0]
    assert (out.d, out.t) == (dt.date(2020, 1, 2), dt.date(2020, 1, 3))
