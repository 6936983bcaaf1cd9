"""Score banding (U1) as a native CASE expression instead of a Python UDF."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The upper bounds of the bands and their labels, as configured
# in the reference (the second and third band share the label "2").
BOUNDS = (30, 45, 60, 75, 100)
LABELS = ("1", "2", "2", "3", "4")


def band(score: Column, bounds: Sequence[float] = BOUNDS, labels: Sequence[str] = LABELS) -> Column:
    """Label of the first band whose upper bound is >= score; above the last
    bound, or a null score, gives null."""
    if len(bounds) != len(labels):
        raise ValueError("bounds and labels must have the same length")
    expr = None
    for bound, label in zip(bounds, labels):
        cond = score <= F.lit(bound)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def with_band(df: DataFrame, score: str = "Scores", name: str = "rank", **kw) -> DataFrame:
    return df.withColumn(name, band(F.col(score), **kw))
