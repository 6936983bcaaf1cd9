"""Sales roll-ups: revenue per region, top orders by units, region orders in a
date range (A3, O2, O3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctflow.operators.filters import by_value, value_and_range
from acctflow.operators.ranking import top_n


def money_sum(column: str, decimals: int | None) -> F.Column:
    """Sum a money column; with ``decimals`` the sum is exact decimal arithmetic.

    Double sums depend on the order rows arrive in; a decimal sum does not, so
    the same data gives the same cents on any cluster layout.
    """
    if decimals is None:
        return F.sum(column)
    # Summed as decimal(28, d), so the sum itself is decimal(38, d).
    return F.sum(F.col(column).cast(f"decimal(28,{decimals})")).cast(f"decimal(38,{decimals})")


def revenue_by_region(
    sales: DataFrame,
    region: str = "Region",
    revenue: str = "Total_Revenue",
    decimals: int | None = None,
) -> DataFrame:
    """Total revenue per region (A3); partial sums are combined map-side."""
    return sales.groupBy(region).agg(money_sum(revenue, decimals).alias(revenue))


def top_units(
    sales: DataFrame,
    item_type: str,
    n: int = 5,
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """The ``n`` rows of one item type with the most units sold (O2).

    Rows, not countries: nothing is aggregated. ``tie_break`` orders equal
    unit counts.
    """
    order = [F.col("Units_Sold").desc_nulls_last()] + [F.col(c).asc() for c in tie_break]
    return top_n(by_value(sales, "Item_Type", item_type), order, n)


def region_orders_in_range(
    sales: DataFrame,
    region: str,
    start,
    end,
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """Orders of one region with an order date in [start, end], by date (O3).

    Nothing is summed, whatever the reference's method name suggests. The
    sort continues on ``tie_break``: the order of equal dates becomes fixed,
    and the range partitioning of the global sort can cut inside one busy
    date instead of sending all of its rows to a single task.
    """
    filtered = value_and_range(sales, "Region", region, "Order_Date", start, end)
    return filtered.orderBy("Order_Date", *tie_break)
