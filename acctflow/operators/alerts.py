"""Alert keys per payment group and the alert report.

The reference uses whole-partition windows over ``Group``; a window puts a
whole group into one task, and a graph component can hold a large share of
all rows. Here each step is a combinable aggregate per group (one small row
per group per task before the shuffle), written and joined back to the rows,
hot groups split by the skew-join (``acctflow.operators.skew``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acctflow.functions.columns import keep_columns
from acctflow.functions.rowwise import top_columns, with_top_features
from acctflow.operators.filters import at_least
from acctflow.operators.graph import with_components
from acctflow.operators.skew import join_by_key
from acctflow.session import materialize


def _winner_struct(score: str, date: str, order: Sequence[str], carry: Sequence[str]) -> Column:
    """Orders rows so that the smallest is the group's keyed row: highest
    score, then earliest date (a missing date last), then smallest ``order``;
    rows without a score never qualify."""
    s, d = F.col(score), F.col(date)
    return F.when(
        s.isNotNull(),
        F.struct(
            # NaN is the greatest score, as in Spark's own maximum.
            (~F.isnan(s.cast("double"))).alias("number"),
            (-s).alias("neg"),
            d.isNull().alias("nodate"),
            d.alias("d"),
            *[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)],
            *[F.col(c).alias(f"__c{i}") for i, c in enumerate(carry)],
        ),
    )


def with_alert_key(
    df: DataFrame,
    group: str = "Group",
    score: str = "TOTAL_Score",
    date: str = "PAYMENT_DATE",
    orig: str = "ORIG",
    key: str = "Alert_Key",
    fill: bool = False,
    order: Sequence[str] = ("REF_ID", "ORIG", "BENEF"),
    carry: Mapping[str, str] | None = None,
) -> DataFrame:
    """``key = orig`` on the rows of each group that have the group's highest
    score and, among those, the earliest date; null elsewhere (W1, W2).

    Ties on both score and date key several rows, as in the reference. Null
    scores never win; a null date loses to any date among the top scores.
    With ``fill`` every row of a group gets the key of its keyed row with the
    smallest ``order`` (W3 applied to the key itself). ``carry`` maps new
    column names to columns of that same keyed row, given to every row of the
    group (P9 copies spread by W3); a group without a keyed row gets nulls.

    One aggregate per group: the minimum of ``_winner_struct`` *is* the keyed
    row that wins the fill, so the key, the fill and the carried values need
    a single pass and a single join back (hot groups split).
    """
    carry = dict(carry or {})
    sources = list(carry.values())
    best = df.groupBy(group).agg(
        F.min(_winner_struct(score, date, [*order, orig], sources)).alias("__best"),
    )
    joined = join_by_key(df, best, [group])
    b = F.col("__best")
    has_key = b["d"].isNotNull()
    if fill:
        key_col = F.when(has_key, b[f"__o{len(order)}"])
    else:
        key_col = F.when((F.col(score) == -b["neg"]) & (F.col(date) == b["d"]), F.col(orig))
    added = {key: key_col}
    added.update({new: F.when(has_key, b[f"__c{i}"]) for i, new in enumerate(carry)})
    return joined.withColumns(added).select(*df.columns, *added)


# The report's alert columns and their sources, and the report
# layout.
ALERT_COPIES = {
    "alert_Top1_Feature": "Top1_Feature",
    "alert_top1_val": "top1_val",
    "alert_Top2_Feature": "Top2_Feature",
    "alert_top2_val": "top2_val",
    "alert_Top3_Feature": "Top3_Feature",
    "alert_top3_val": "top3_val",
}

REPORT_COLUMNS = [
    "REF_ID", "ORIG", "BENEF",
    "Top1_Feature", "top1_val", "Top2_Feature", "top2_val", "Top3_Feature", "top3_val",
    "TOTAL_Score", "PAYMENT_DATE", "MONTH", "Group", "Alert_Key",
    "alert_Top1_Feature", "alert_top1_val",
    "alert_Top2_Feature", "alert_top2_val",
    "alert_Top3_Feature", "alert_top3_val",
]


def alert_report(
    features: DataFrame,
    score_column: str = "TOTAL_Score",
    threshold: float = 15,
    fill_key: bool = False,
) -> DataFrame:
    """The payment-alert job (C3): score filter (F4) -> components (G1) ->
    in-row top-3 features (R1) -> alert key (W1, W2) -> the keyed row's top
    features copied (P9) to every row of its group (W3) -> the 20 report
    columns. ``fill_key`` also spreads Alert_Key itself.

    The key and all six alert columns come out of one aggregate per group and
    one join back (see ``with_alert_key``).
    """
    kept = at_least(features, score_column, threshold)
    # Written once: the key aggregate and the report rows both read it.
    grouped = materialize(with_components(kept, "ORIG", "BENEF", order_by="REF_ID", name="Group"), "alert-groups")
    topped = with_top_features(grouped, 3)
    assert top_columns(3) == REPORT_COLUMNS[3:9]
    keyed = with_alert_key(topped, score=score_column, fill=fill_key, carry=ALERT_COPIES)
    return keep_columns(keyed, REPORT_COLUMNS)
