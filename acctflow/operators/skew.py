"""Joining a per-key summary back to the rows it summarises, at any skew.

The pattern "aggregate per key, join the result back to the rows" appears in
component labels and alert keys. A window would hold a whole key in one task,
and AQE's skew-join does not split a join one of whose inputs is an aggregate.
So the summary, one small row per key, is written first: then both inputs of
the join are plain shuffles, and AQE splits the rows of every hot key by their
size at run time. There is no list of hot keys, no limit on their number and
one code path for all sizes.

Rows with a null key match nothing; they get a salt from a hash of the row, so
they spread over all partitions whether AQE is on or not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctflow.session import materialize


#: Rows of a table that may go through the driver for a broadcast.
SMALL = 10_000


def unless_small(table: DataFrame) -> DataFrame:
    """A written table to be joined: if it has more than ``SMALL`` rows, by a shuffle.
    (Spark broadcasts what has few bytes in its files, where a row may take a byte; in
    the driver, which collects it, it takes many times as much.)"""
    return table if table.limit(SMALL + 1).count() <= SMALL else table.hint("merge")


def join_by_key(rows: DataFrame, per_key: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """``rows`` joined to ``per_key`` (one row per key) on ``keys``, "left" or
    "inner"; the columns of ``rows``, then those of ``per_key``."""
    if how not in ("left", "inner"):
        raise ValueError("join_by_key supports left and inner joins")
    keys = list(keys)
    summary = unless_small(materialize(per_key, "per-key").withColumn("__salt", F.lit(0).cast("long")))
    no_key = F.coalesce(*[F.when(F.col(k).isNull(), F.xxhash64(*rows.columns)) for k in keys], F.lit(0).cast("long"))
    joined = rows.withColumn("__salt", no_key).join(summary, [*keys, "__salt"], how)
    return joined.select(*rows.columns, *[c for c in per_key.columns if c not in keys])
