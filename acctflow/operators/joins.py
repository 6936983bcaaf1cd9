"""Equi-joins.

No hints: with AQE on, Spark turns a side that is small *at run time* into a
broadcast and otherwise sort-merges. AQE splits a hot key on either side of an
inner join, on the left side of a semi or anti join, and on no side of a full
join; and it splits a side only where that side is a plain shuffle.

So an outer join is an inner join of completed sides: for every key that the other
side lacks, a side gets one row that holds the key and nothing else. Which keys
these are is found from the key columns alone and written first (``key_flags``),
so each wide side is read once. Semi and anti joins read the other side's distinct
keys from a written table. Rows whose key has a null match nothing: a flag column
beside the key keeps the two sides' null keys apart, so that they too can be split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acctflow.session import materialize

FLAG = "__null_key"


def _null_key(df: DataFrame, keys: Sequence[str], side: int) -> Column:
    missing = F.lit(False)
    for k in keys:
        missing = missing | df[k].isNull()
    return F.when(missing, side).otherwise(0)


def _keyed(df: DataFrame, keys: Sequence[str], side: int) -> DataFrame:
    """The distinct keys of a side with its null flag, as k0, k1, ..."""
    cols = [df[k].alias(f"k{i}") for i, k in enumerate(keys)]
    return df.select(*cols, _null_key(df, keys, side).alias(FLAG)).distinct()


def key_flags(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every key of either side once, with ``in_left`` and ``in_right``, written."""
    names = [f"k{i}" for i in range(len(keys))]
    both = _keyed(left, keys, 1).withColumn("s", F.lit(1)).unionByName(_keyed(right, keys, 2).withColumn("s", F.lit(2)))
    seen = both.groupBy(*names, FLAG).agg(F.max(F.col("s") == 1).alias("in_left"), F.max(F.col("s") == 2).alias("in_right"))
    return materialize(seen, "join-keys")


def _completed(side: DataFrame, keys: Sequence[str], number: int, lacking: DataFrame | None, prefix: str) -> DataFrame:
    """``side`` with columns renamed by place (keys k0, k1, ..., others
    ``prefix``0, ...), the null flag, and one row for each key in ``lacking``."""
    at = {k.lower(): i for i, k in enumerate(keys)}
    others = [c for c in side.columns if c.lower() not in at]
    rows = side.select(
        *[side[k].alias(f"k{i}") for i, k in enumerate(keys)], _null_key(side, keys, number).alias(FLAG),
        *[side[c].alias(f"{prefix}{i}") for i, c in enumerate(others)],
    )
    if lacking is None:
        return rows
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    blank = lacking.select(
        *[(F.col(c) if c in lacking.columns else F.lit(None)).cast(kinds[c]).alias(c) for c in rows.columns]
    )
    return rows.unionByName(blank)


def join_on(left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "inner") -> DataFrame:
    """USING-style join: each key column appears once, first, then the other
    columns of ``left`` and ``right``, also where both sides have one of the same
    name (J1). ``how`` is inner, left, right, full, left_semi or left_anti. All but
    inner joins read a table of keys in the checkpoint folder."""
    keys = [on] if isinstance(on, str) else list(on)
    if how == "inner":
        return left.join(right, keys, how)
    if how in ("left_semi", "left_anti"):
        known = materialize(right.select(*keys).dropna(how="any").distinct(), "join-keys")
        return left.join(known, keys, how)
    flags = key_flags(left, right, keys).drop("s")
    no_right = flags.where("in_left AND NOT in_right") if how in ("left", "full") else None
    no_left = flags.where("in_right AND NOT in_left") if how in ("right", "full") else None
    a, b = _completed(left, keys, 1, no_left, "l"), _completed(right, keys, 2, no_right, "r")
    names = [f"k{i}" for i in range(len(keys))]
    same = a[FLAG] == b[FLAG]
    for k in names:
        same = same & a[k].eqNullSafe(b[k])
    mine = [c for c in a.columns if c.startswith("l")]
    theirs = [c for c in b.columns if c.startswith("r")]
    joined = a.join(b, same).select(*[F.coalesce(a[k], b[k]) for k in names], *[a[c] for c in mine], *[b[c] for c in theirs])
    lower = {k.lower() for k in keys}
    rest = [c for side in (left, right) for c in side.columns if c.lower() not in lower]
    return joined.toDF(*keys, *rest)
