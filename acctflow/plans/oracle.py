"""Oracle SQL: for each registered query, the same result in plain SQL that
DuckDB runs over the raw tables (``region nation customer supplier part orders
lineitem events ...`` registered as views).

The derived shapes of ``acctflow.sources.testmap`` are restated here as CTEs.
Column names and types follow the Spark side (e.g. INTEGER row numbers).
"""

from __future__ import annotations

from acctflow.plans import queries as q

ACCOUNTS = """accounts AS (
  SELECT o_custkey AS customerId, o_orderkey AS accountId, o_totalprice AS balance FROM orders)"""

CUSTOMERS = """customers AS (
  SELECT c_custkey AS customerId, c_name AS forename, c_mktsegment AS surname FROM customer)"""

SALES = """sales AS (
  SELECT r_name AS Region, n_name AS Country, p_type AS Item_Type, c_mktsegment AS Sales_Channel,
         o_orderpriority AS Order_Priority,
         CAST(coalesce(try_strptime(txt, '%d-%m-%Y'), try_strptime(txt, '%m/%d/%Y')) AS DATE) AS Order_Date,
         o_orderkey AS Order_ID, l_quantity AS Units_Sold, p_retailprice AS Unit_Price,
         l_extendedprice AS Total_Revenue, l_extendedprice * (1.0 - l_discount) AS Total_Profit
  FROM (SELECT *, CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%-m/%-d/%Y')
                       ELSE strftime(o_orderdate, '%-d-%-m-%Y') END AS txt
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
                      JOIN customer ON o_custkey = c_custkey
                      JOIN nation ON c_nationkey = n_nationkey
                      JOIN region ON n_regionkey = r_regionkey
                      JOIN part ON l_partkey = p_partkey) s)"""

TYPED = """txn AS (
  SELECT CAST(user_id AS VARCHAR) AS Account_No,
         CAST(ts AS DATE) AS "DATE",
         event_type AS TRANSACTION_DETAILS,
         CASE WHEN event_type = 'purchase' THEN CAST(event_id AS VARCHAR) END AS CHQ_NO,
         strftime(ts, '%d-%m-%Y') AS VALUE_DATE,
         CASE WHEN event_type IN ('purchase', 'error')
              THEN CASE WHEN event_type = 'error' THEN amt || ' DR' ELSE amt END END AS WITHDRAWAL_AMT,
         CASE WHEN NOT (event_type IN ('purchase', 'error')) THEN amt END AS DEPOSIT_AMT,
         CAST(CAST(floor(value * 100) AS BIGINT) AS VARCHAR) AS BALANCE_AMT
  FROM (SELECT *, CAST(CAST(floor(value / 10) * 10 AS BIGINT) AS VARCHAR) AS amt FROM events) e),
typed AS (
  SELECT *, coalesce(WITHDRAWAL_AMT, DEPOSIT_AMT) AS TransactionAmount,
         CASE WHEN WITHDRAWAL_AMT IS NULL THEN 'CR' ELSE 'DR' END AS TransactionType
  FROM txn)"""

PAY = """pay AS (
  SELECT REF_ID, 'p' || CAST(l_partkey AS VARCHAR) AS ORIG, 's' || CAST(l_suppkey AS VARCHAR) AS BENEF,
         'Quantity' AS FEATURE1, CAST(ceil(q / 10) AS DOUBLE) AS FEATURE1_Score,
         'Discount' AS FEATURE2, CAST(round(d * 100) AS DOUBLE) AS FEATURE2_Score,
         CASE WHEN rf = 'R' THEN 'Discount' ELSE 'Tax' END AS FEATURE3,
         CAST(round(t * 100) AS DOUBLE) AS FEATURE3_Score,
         'Line' AS FEATURE4, CAST(ln AS DOUBLE) AS FEATURE4_Score,
         'Count' AS FEATURE5, CAST(n AS DOUBLE) AS FEATURE5_Score,
         TOTAL_Score, PAYMENT_DATE, CAST(month(PAYMENT_DATE) AS INTEGER) AS MONTH
  FROM (SELECT l_partkey, l_suppkey, min(l_orderkey * 10 + l_linenumber) AS REF_ID,
               max(l_quantity) AS q, max(l_discount) AS d, max(l_tax) AS t,
               max(l_linenumber) AS ln, count(*) AS n, max(l_returnflag) AS rf,
               max(l_extendedprice) AS TOTAL_Score, min(l_shipdate) AS PAYMENT_DATE
        FROM lineitem GROUP BY l_partkey, l_suppkey) g)"""


TRANSFERS = """pay AS (
  SELECT o_orderkey AS REF_ID, 'o' || CAST(o_orderkey AS VARCHAR) AS ORIG,
         'o' || CAST(lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS VARCHAR) AS BENEF,
         CASE WHEN o_custkey % 10 <> 7 THEN CAST(floor(o_totalprice / 100000) AS DOUBLE) END AS TOTAL_Score,
         o_orderdate AS PAYMENT_DATE
  FROM orders)"""

TRANSFER_FEATURES = """pay AS (
  SELECT o_orderkey AS REF_ID, 'o' || CAST(o_orderkey AS VARCHAR) AS ORIG,
         'o' || CAST(lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS VARCHAR) AS BENEF,
         'Price' AS FEATURE1, CAST(floor(o_totalprice / 50000) % 6 AS DOUBLE) AS FEATURE1_Score,
         'Day' AS FEATURE2, CAST(day(o_orderdate) % 6 AS DOUBLE) AS FEATURE2_Score,
         CASE WHEN o_orderkey % 3 = 0 THEN 'Price' ELSE 'Priority' END AS FEATURE3,
         CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS FEATURE3_Score,
         'Month' AS FEATURE4, CAST(month(o_orderdate) % 5 AS DOUBLE) AS FEATURE4_Score,
         'Key' AS FEATURE5, CAST(o_orderkey % 7 AS DOUBLE) AS FEATURE5_Score,
         CAST(floor(o_totalprice / 100000) AS DOUBLE) AS TOTAL_Score,
         CASE WHEN o_custkey % 10 <> 7 THEN o_orderdate END AS PAYMENT_DATE,
         CAST(CASE WHEN o_custkey % 10 <> 7 THEN month(o_orderdate) END AS INTEGER) AS MONTH
  FROM orders)"""

GRADED = "graded AS (SELECT doc_id AS customerId, quality AS grade FROM labels)"

VISITS = "visits AS (SELECT CAST(user_id AS BIGINT) AS customerId, event_id AS event, value FROM events)"


def _with(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"


def components_ctes(src: str, out: str) -> list[str]:
    """CTEs labelling every row of ``src`` (REF_ID, ORIG, BENEF, ...) with its
    component ``G<k>`` in relation ``out``: min-label propagation to a fixed
    point, then components numbered by their smallest REF_ID (then smallest
    ORIG)."""
    return [
        f"""{out}_edges AS (
  SELECT ORIG AS a, BENEF AS b FROM {src} WHERE ORIG IS NOT NULL AND BENEF IS NOT NULL AND ORIG <> BENEF
  UNION SELECT BENEF, ORIG FROM {src} WHERE ORIG IS NOT NULL AND BENEF IS NOT NULL AND ORIG <> BENEF)""",
        f"""{out}_nodes AS (
  SELECT ORIG AS n FROM {src} WHERE ORIG IS NOT NULL UNION SELECT a FROM {out}_edges)""",
        f"""{out}_lab(n, l) USING KEY (n) AS (
  SELECT n, n FROM {out}_nodes
  UNION
  SELECT e.b, min(w.l) FROM {out}_lab w JOIN {out}_edges e ON e.a = w.n
  JOIN recurring.{out}_lab cur ON cur.n = e.b
  GROUP BY e.b HAVING min(w.l) < min(cur.l))""",
        f"""{out}_rows AS (
  SELECT s.*, CASE WHEN s.ORIG IS NOT NULL THEN lab.l END AS __root
  FROM {src} s LEFT JOIN {out}_lab lab ON s.ORIG = lab.n)""",
        f"""{out}_num AS (
  SELECT __root, 'G' || CAST(row_number() OVER (ORDER BY first_ref, first_node) AS VARCHAR) AS "Group"
  FROM (SELECT __root, min(REF_ID) AS first_ref, min(ORIG) AS first_node
        FROM {out}_rows WHERE __root IS NOT NULL GROUP BY __root) c)""",
        f"""{out} AS (
  SELECT r.* EXCLUDE (__root), n."Group" FROM {out}_rows r LEFT JOIN {out}_num n USING (__root))""",
    ]


def _pairs_union(src: str) -> str:
    parts = [
        f"SELECT ORIG, BENEF, {i} AS pos, FEATURE{i} AS name, FEATURE{i}_Score AS score FROM {src}"
        for i in range(1, 6)
    ]
    return "\n  UNION ALL ".join(parts)


def top3_ctes(src: str, out: str, keys: tuple[str, ...] = ("ORIG", "BENEF")) -> list[str]:
    """``out`` = ``src`` plus Top{i}_Feature / top{i}_val, i = 1..3; ``keys``
    tell the rows of ``src`` apart."""
    key = ", ".join(keys)
    picks = ",\n         ".join(
        f"max(CASE WHEN rn = {i} THEN name END) AS Top{i}_Feature, "
        f"max(CASE WHEN rn = {i} THEN score END) AS top{i}_val"
        for i in range(1, 4)
    )
    return [
        f"""{out}_pairs AS (
  {_pairs_union(src)})""",
        f"""{out}_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY score DESC NULLS LAST, pos) AS rn
  FROM (SELECT {key}, name, min(pos) AS pos, arg_max(score, pos) AS score
        FROM {out}_pairs GROUP BY {key}, name) c)""",
        f"""{out}_top AS (
  SELECT {key},
         {picks}
  FROM {out}_ranked GROUP BY {key})""",
        f"""{out} AS (
  SELECT s.*, t.* EXCLUDE ({key}) FROM {src} s JOIN {out}_top t USING ({key}))""",
    ]


def alert_ctes(src: str, out: str) -> list[str]:
    """``out`` = ``src`` (with "Group") plus the unfilled Alert_Key."""
    return [
        f"""{out}_mx AS (
  SELECT *, max(TOTAL_Score) OVER (PARTITION BY "Group") AS __mx FROM {src})""",
        f"""{out} AS (
  SELECT * EXCLUDE (__mx, __md),
         CASE WHEN TOTAL_Score = __mx AND PAYMENT_DATE = __md THEN ORIG END AS Alert_Key
  FROM (SELECT *, min(CASE WHEN TOTAL_Score = __mx THEN PAYMENT_DATE END)
                    OVER (PARTITION BY "Group") AS __md FROM {out}_mx) m)""",
    ]


def winner_cte(src: str, out: str, cols: list[str]) -> str:
    """Per group, ``cols`` of the keyed row with the smallest (REF_ID, ORIG, BENEF)."""
    picked = ", ".join(cols)
    return f"""{out} AS (
  SELECT "Group", {picked} FROM (
    SELECT *, row_number() OVER (PARTITION BY "Group" ORDER BY REF_ID, ORIG, BENEF) AS __rn
    FROM {src} WHERE Alert_Key IS NOT NULL) k WHERE __rn = 1)"""


ALERT_COLS = ["REF_ID", "ORIG", "BENEF", '"Group"', "TOTAL_Score", "PAYMENT_DATE", "Alert_Key"]


def _sql() -> dict[str, str]:
    a, c = ACCOUNTS, CUSTOMERS
    typed_range = (
        f'SELECT * FROM typed WHERE "DATE" BETWEEN DATE \'{q.TXN_START}\' AND DATE \'{q.TXN_END}\''
    )
    single = (
        'SELECT Account_No, "DATE", WITHDRAWAL_AMT, DEPOSIT_AMT, count(*) AS CNT '
        f"FROM ({typed_range}) r GROUP BY Account_No, \"DATE\", WITHDRAWAL_AMT, DEPOSIT_AMT "
        "HAVING count(*) = 1"
    )
    totals = (
        _with(TYPED)
        + "SELECT Account_No, sum(TRY_CAST(WITHDRAWAL_AMT AS DOUBLE)) AS Total_Withdraw, "
        + f"sum(TRY_CAST(DEPOSIT_AMT AS DOUBLE)) AS Total_Deposit FROM ({single}) s GROUP BY Account_No"
    )
    duplicates = (
        _with(TYPED)
        + 'SELECT Account_No, "DATE", TransactionType, TransactionAmount, count(*) AS CNT FROM typed '
        + 'GROUP BY Account_No, "DATE", TransactionType, TransactionAmount HAVING count(*) > 1'
    )
    debits = _with(TYPED) + "SELECT * FROM typed WHERE TransactionType = 'DR'"
    tie = ", ".join(q.SALES_TIE_BREAK)
    top3_cols = "Top1_Feature, top1_val, Top2_Feature, top2_val, Top3_Feature, top3_val"
    sorted_scores = (
        "list_reverse_sort([FEATURE1_Score, FEATURE2_Score, FEATURE3_Score, FEATURE4_Score, "
        "FEATURE5_Score], 'NULLS LAST')"
    )

    def matching(v: str) -> str:
        parts = ", ".join(
            f"CASE WHEN FEATURE{i}_Score = {v} THEN 'FEATURE{i}_Score' END" for i in range(1, 6)
        )
        return f"concat_ws(',', {parts})"

    report_cols = ", ".join(
        f'"{x}"' if x == "Group" else x
        for x in [
            "REF_ID", "ORIG", "BENEF", "Top1_Feature", "top1_val", "Top2_Feature", "top2_val",
            "Top3_Feature", "top3_val", "TOTAL_Score", "PAYMENT_DATE", "MONTH", "Group",
            "Alert_Key",
        ]
    )

    def report_of(pay: str, threshold: float, keys: tuple[str, ...]) -> str:
        return (
            _with(
                pay,
                f"kept AS (SELECT * FROM pay WHERE TOTAL_Score >= {threshold})",
                *components_ctes("kept", "grp"),
                *top3_ctes("grp", "top", keys),
                *alert_ctes("top", "keyed"),
                winner_cte("keyed", "win", [f"{x} AS alert_{x}" for x in top3_cols.split(", ")]),
            )
            + f"SELECT {', '.join('k.' + x for x in report_cols.split(', '))}, "
            + "w.alert_Top1_Feature, w.alert_top1_val, w.alert_Top2_Feature, w.alert_top2_val, "
            + "w.alert_Top3_Feature, w.alert_top3_val "
            + 'FROM keyed k LEFT JOIN win w USING ("Group")'
        )

    report = report_of(PAY, q.ALERT_THRESHOLD, ("ORIG", "BENEF"))
    transfer_report = report_of(TRANSFER_FEATURES, q.REPORT_THRESHOLD, ("ORIG",))
    whole_keys = _with(PAY, *components_ctes("pay", "grp"), *alert_ctes("grp", "keyed"))
    return {
        "accounts_per_customer": _with(a)
        + "SELECT customerId, count(DISTINCT accountId) AS Account_Count FROM accounts GROUP BY customerId",
        "customers_multi_accounts": _with(a, c)
        + "SELECT c.customerId, c.forename, c.surname, count(DISTINCT a.accountId) AS NoOfAccounts "
        + "FROM customers c JOIN accounts a ON c.customerId = a.customerId "
        + "GROUP BY c.customerId, c.forename, c.surname HAVING count(DISTINCT a.accountId) > 2",
        "customers_many_accounts_15": _with(a, c)
        + "SELECT c.customerId, c.forename, c.surname, count(DISTINCT a.accountId) AS NoOfAccounts "
        + "FROM customers c JOIN accounts a ON c.customerId = a.customerId "
        + "GROUP BY c.customerId, c.forename, c.surname HAVING count(DISTINCT a.accountId) > 15",
        "top_balances": _with(a)
        + "SELECT * FROM accounts ORDER BY balance DESC NULLS LAST, accountId LIMIT 5",
        "top_n_per_customer": _with(a)
        + "SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY customerId "
        + "ORDER BY balance DESC NULLS LAST, accountId) AS INTEGER) AS rn FROM accounts) r WHERE rn <= 3",
        "join_inner": _with(a, c)
        + "SELECT a.customerId, a.accountId, a.balance, c.forename, c.surname "
        + "FROM accounts a JOIN customers c ON a.customerId = c.customerId",
        "join_left": _with(a, c)
        + "SELECT c.customerId, c.forename, c.surname, a.accountId, a.balance "
        + "FROM customers c LEFT JOIN accounts a ON c.customerId = a.customerId",
        "join_right": _with(a, c)
        + "SELECT c.customerId, a.accountId, a.balance, c.forename, c.surname "
        + "FROM accounts a RIGHT JOIN customers c ON a.customerId = c.customerId",
        "join_full": _with(a, c)
        + "SELECT coalesce(c.customerId, a.customerId) AS customerId, c.forename, c.surname, "
        + "a.accountId, a.balance FROM customers c FULL JOIN accounts a ON c.customerId = a.customerId",
        "join_semi": _with(a, c)
        + "SELECT * FROM customers c WHERE EXISTS (SELECT 1 FROM accounts a WHERE a.customerId = c.customerId)",
        "join_anti": _with(a, c)
        + "SELECT * FROM customers c WHERE NOT EXISTS "
        + "(SELECT 1 FROM accounts a WHERE a.customerId = c.customerId)",
        "revenue_by_region": _with(SALES)
        + "SELECT Region, CAST(sum(CAST(Total_Revenue AS DECIMAL(28,2))) AS DECIMAL(38,2)) AS Total_Revenue "
        + "FROM sales GROUP BY Region",
        "top_units": _with(SALES)
        + f"SELECT * FROM sales WHERE Item_Type = '{q.ITEM_TYPE}' "
        + f"ORDER BY Units_Sold DESC NULLS LAST, {tie} LIMIT 5",
        "region_orders_range": _with(SALES)
        + f"SELECT * FROM sales WHERE Region = '{q.REGION}' AND Order_Date BETWEEN "
        + f"DATE '{q.SALES_START}' AND DATE '{q.SALES_END}'",
        "txn_typed": _with(TYPED) + "SELECT * FROM typed",
        "txn_debits": debits,
        "txn_credits": _with(TYPED) + "SELECT * FROM typed WHERE TransactionType = 'CR'",
        "txn_cheques": _with(TYPED) + "SELECT * FROM typed WHERE CHQ_NO IS NOT NULL",
        "txn_range": _with(TYPED) + typed_range,
        "txn_duplicates": duplicates,
        "txn_single": _with(TYPED) + single,
        "txn_totals": totals,
        "txn_totals_sql": totals,
        "txn_duplicates_sql": duplicates,
        "txn_debits_sql": debits,
        "txn_range_sql": _with(TYPED) + typed_range,
        "txn_cheques_sql": _with(TYPED) + "SELECT * FROM typed WHERE CHQ_NO IS NOT NULL",
        "txn_single_sql": _with(TYPED) + single,
        "row_top3": _with(PAY, *top3_ctes("pay", "top")) + f"SELECT REF_ID, ORIG, BENEF, {top3_cols} FROM top",
        "row_top3_int": _with(PAY, *top3_ctes("pay", "top"))
        + "SELECT REF_ID, ORIG, BENEF, Top1_Feature, CAST(top1_val AS INTEGER) AS top1_val, "
        + "Top2_Feature, CAST(top2_val AS INTEGER) AS top2_val, "
        + "Top3_Feature, CAST(top3_val AS INTEGER) AS top3_val FROM top",
        "row_topk_values": _with(PAY)
        + f"SELECT REF_ID, ORIG, BENEF, {sorted_scores}[1] AS top1_val, {sorted_scores}[2] AS top2_val, "
        + f"{sorted_scores}[3] AS top3_val FROM pay",
        "features_long": _with(PAY)
        + "SELECT REF_ID, ORIG, BENEF, pos, name, score FROM ("
        + " UNION ALL ".join(
            f"SELECT REF_ID, ORIG, BENEF, {i} AS pos, FEATURE{i} AS name, FEATURE{i}_Score AS score FROM pay"
            for i in range(1, 6)
        )
        + ") f",
        "columns_matching": _with(PAY)
        + f"SELECT REF_ID, ORIG, BENEF, {matching('v1')} AS top1, {matching('v2')} AS top2, "
        + f"{matching('v3')} AS top3 FROM (SELECT *, {sorted_scores}[1] AS v1, {sorted_scores}[2] AS v2, "
        + f"{sorted_scores}[3] AS v3 FROM pay) p",
        "score_bands": "SELECT event_id, user_id, value, CASE WHEN value <= 30 THEN '1' "
        + "WHEN value <= 45 THEN '2' WHEN value <= 60 THEN '2' WHEN value <= 75 THEN '3' "
        + "WHEN value <= 100 THEN '4' END AS \"rank\" FROM events",
        "score_filter": _with(PAY)
        + f"SELECT REF_ID, ORIG, BENEF, TOTAL_Score FROM pay WHERE TOTAL_Score >= {q.ALERT_THRESHOLD}",
        **{
            f"join_{how}_unmatched": _with(c, VISITS)
            + f"SELECT {key} AS customerId, c.forename, c.surname, v.event, v.value "
            + f"FROM customers c {how.upper()} JOIN visits v ON c.customerId = v.customerId"
            for how, key in (("left", "c.customerId"), ("right", "v.customerId"), ("full", "coalesce(c.customerId, v.customerId)"))
        },
        "join_left_semi_unmatched": _with(c, VISITS)
        + "SELECT * FROM customers WHERE customerId IN (SELECT customerId FROM visits)",
        "join_left_anti_unmatched": _with(c, VISITS)
        + "SELECT * FROM customers c WHERE NOT EXISTS (SELECT 1 FROM visits v WHERE v.customerId = c.customerId)",
        "transfer_components": _with(TRANSFERS, *components_ctes("pay", "grp")) + 'SELECT REF_ID, ORIG, BENEF, "Group" FROM grp',
        "transfer_alert_keys": _with(TRANSFERS, *components_ctes("pay", "grp"), *alert_ctes("grp", "keyed"))
        + f"SELECT {', '.join(ALERT_COLS)} FROM keyed",
        "transfer_alert_keys_filled": _with(
            TRANSFERS, *components_ctes("pay", "grp"), *alert_ctes("grp", "keyed"),
            winner_cte("keyed", "win", ["Alert_Key AS win_key"]),
        )
        + 'SELECT k.REF_ID, k.ORIG, k.BENEF, k."Group", k.TOTAL_Score, k.PAYMENT_DATE, '
        + 'w.win_key AS Alert_Key FROM keyed k LEFT JOIN win w USING ("Group")',
        "transfer_best_orig": _with(TRANSFERS, *components_ctes("pay", "grp"))
        + 'SELECT REF_ID, ORIG, BENEF, "Group", first_value(ORIG) OVER (PARTITION BY "Group" '
        + "ORDER BY TOTAL_Score DESC NULLS LAST, ORIG DESC, BENEF DESC NULLS LAST) AS best_orig FROM grp",
        "components": _with(PAY, *components_ctes("pay", "grp"))
        + 'SELECT REF_ID, ORIG, BENEF, "Group" FROM grp',
        "alert_keys": whole_keys + f"SELECT {', '.join(ALERT_COLS)} FROM keyed",
        "alert_keys_filled": _with(
            PAY, *components_ctes("pay", "grp"), *alert_ctes("grp", "keyed"),
            winner_cte("keyed", "win", ["Alert_Key AS win_key"]),
        )
        + "SELECT k.REF_ID, k.ORIG, k.BENEF, k.\"Group\", k.TOTAL_Score, k.PAYMENT_DATE, "
        + 'w.win_key AS Alert_Key FROM keyed k LEFT JOIN win w USING ("Group")',
        "group_best_orig": _with(PAY, *components_ctes("pay", "grp"))
        + 'SELECT REF_ID, ORIG, BENEF, "Group", first_value(ORIG) OVER (PARTITION BY "Group" '
        + "ORDER BY TOTAL_Score DESC NULLS LAST, ORIG DESC, BENEF DESC) AS best_orig FROM grp",
        "alert_report": report,
        "transfer_report": transfer_report,
        "transfer_report_ranked": 'SELECT REF_ID, "Group", Alert_Key, row_number() OVER (ORDER BY REF_ID) AS position '
        + f"FROM ({transfer_report}) r",
        "region_orders_ranked": _with(SALES)
        + "SELECT *, row_number() OVER (ORDER BY Order_Date, Order_ID, Country, Total_Revenue, Unit_Price, Total_Profit) AS position "
        + f"FROM sales WHERE Region = '{q.REGION}' AND Order_Date BETWEEN DATE '{q.SALES_START}' AND DATE '{q.SALES_END}'",
        "join_right_filled": _with(c, VISITS)
        + "SELECT c.customerId, v.event, v.value, c.forename, c.surname "
        + "FROM visits v RIGHT JOIN customers c ON v.customerId = c.customerId",
        "join_full_filled": _with(c, GRADED)
        + "SELECT coalesce(c.customerId, g.customerId) AS customerId, c.forename, c.surname, g.grade "
        + "FROM customers c FULL JOIN graded g ON c.customerId = g.customerId",
        "accounts_with_rejects": _with(a) + """, lines AS (
  SELECT *, CAST(CAST(balance AS DECIMAL(20,2)) AS VARCHAR) AS txt,
         CASE WHEN accountId % 97 = 0 THEN 1 WHEN accountId % 89 = 0 THEN 2 WHEN accountId % 83 = 0 THEN 3 ELSE 0 END AS bad
  FROM accounts)
SELECT CASE WHEN bad = 0 THEN customerId END AS customerId, CASE WHEN bad = 0 THEN accountId END AS accountId,
       CASE WHEN bad = 0 THEN CAST(txt AS DOUBLE) END AS balance,
       CASE bad WHEN 1 THEN concat_ws(',', customerId, accountId, 'none') WHEN 2 THEN concat_ws(',', customerId, accountId)
                WHEN 3 THEN concat_ws(',', customerId, accountId, txt, 'more') END AS line
FROM lines""",
    }


ORACLE_SQL: dict[str, str] = _sql()
ORACLE_SQL |= {
    "job_accounts": ORACLE_SQL["accounts_per_customer"],
    "job_accounts_many": ORACLE_SQL["customers_multi_accounts"],
    "job_accounts_top": ORACLE_SQL["top_balances"],
    "job_sales": ORACLE_SQL["region_orders_range"],
    "job_sales_revenue": ORACLE_SQL["revenue_by_region"],
    "job_sales_units": ORACLE_SQL["top_units"],
    "job_accounts_sales": ORACLE_SQL["customers_multi_accounts"],
    "job_bank": ORACLE_SQL["txn_debits"],
    "job_bank_credits": ORACLE_SQL["txn_credits"],
    "job_bank_cheques": ORACLE_SQL["txn_cheques"],
    "job_bank_range": ORACLE_SQL["txn_range"],
    "job_bank_duplicates": ORACLE_SQL["txn_duplicates"],
    "job_bank_totals": ORACLE_SQL["txn_totals"],
    "accounts_inferred": _with(ACCOUNTS) + "SELECT * FROM accounts",
    "job_features": ORACLE_SQL["alert_report"],
    "accounts_semicolon": _with(ACCOUNTS) + "SELECT * FROM accounts",
}
