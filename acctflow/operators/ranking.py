"""Top-n listings, per-group top-n, arg-max over a group, and a global ordinal.

``top_n`` is an ORDER BY + LIMIT, which Spark runs as TakeOrderedAndProject:
each task keeps its own n best rows and only n x tasks rows meet in the final
merge. ``top_n_per_group`` filters ``row_number() <= n``; Spark plans that as
a WindowGroupLimit *before* the shuffle, so a hot group sends at most n rows per
map task instead of all of its rows. ``ordinal`` numbers rows 1..N in a sort
order without a single-partition window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acctflow.operators.skew import join_by_key
from acctflow.session import materialize

ColumnLike = str | Column


def _cols(items: Sequence[ColumnLike]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in items]


def top_n(df: DataFrame, order: Sequence[ColumnLike], n: int) -> DataFrame:
    """First ``n`` rows in ``order`` (O1, O2). Put a key last to break ties."""
    return df.orderBy(*_cols(order)).limit(n)


def top_n_per_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[ColumnLike],
    n: int,
    rank_col: str | None = None,
) -> DataFrame:
    """The first ``n`` rows of each group in ``order``.

    ``rank_col`` keeps the 1-based position; by default it is dropped.
    """
    w = Window.partitionBy(*keys).orderBy(*_cols(order))
    name = rank_col or "__rank"
    out = df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= n)
    return out if rank_col else out.drop(name)


def arg_max_over(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    by: str | Sequence[str],
    name: str,
) -> DataFrame:
    """Each row gets ``value`` of its group's row with the largest ``by``.

    ``by`` may list several columns, compared in order, so ties can be broken
    deterministically. A ``max_by`` aggregate (combined map-side) joined back
    on the keys with hot keys split, instead of a window that would hold a
    whole group in one task.
    """
    by_cols = [by] if isinstance(by, str) else list(by)
    best = df.groupBy(*keys).agg(
        F.max_by(F.col(value), F.struct(*by_cols)).alias(name)
    )
    return join_by_key(df, best, keys)


def ordinal(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Number the rows 1..N in ``order`` (dense, gap-free) at any size.

    Range-partition and sort, stamp each row with its partition id and
    in-partition position, write them once so both stay fixed, then add the count of
    all earlier partitions. The offsets table has one row per partition, so its
    broadcast is bounded by the partition count, not by the data.
    """
    ranged = materialize(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("__ord_pid", F.spark_partition_id())
        .withColumn("__ord_pos", F.monotonically_increasing_id()),
        "ordinal",
    )
    before = Window.orderBy("__ord_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("__ord_pid")
        .agg(F.count(F.lit(1)).alias("__ord_n"), F.min("__ord_pos").alias("__ord_first"))
        .withColumn("__ord_before", F.coalesce(F.sum("__ord_n").over(before), F.lit(0)))
        .select("__ord_pid", "__ord_first", "__ord_before")
    )
    out = (
        ranged.join(F.broadcast(offsets), "__ord_pid")
        .withColumn(name, F.col("__ord_before") + F.col("__ord_pos") - F.col("__ord_first") + F.lit(1))
        .drop("__ord_pid", "__ord_pos", "__ord_first", "__ord_before")
    )
    out._acctflow_path = ranged._acctflow_path  # its files, for session.release
    return out
