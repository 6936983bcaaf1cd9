"""Row-wise work on the five (name, score) feature pairs of a row.

Everything is a column expression evaluated in the JVM inside the projection:
no collect, no Python, no positional join. The hot paths are plain
comparisons that compile into whole-stage codegen; the array form
(``top_features``) uses lambda functions and is kept for callers who want the
ranked array itself.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NEG_INF = float("-inf")


def feature_array(n: int = 5, name_fmt: str = "FEATURE{}", score_fmt: str = "FEATURE{}_Score") -> Column:
    """``array<struct<name, score, pos>>`` from the row's n name/score columns."""
    return F.array(
        *[
            F.struct(
                F.col(name_fmt.format(i)).alias("name"),
                F.col(score_fmt.format(i)).cast("double").alias("score"),
                F.lit(i).alias("pos"),
            )
            for i in range(1, n + 1)
        ]
    )


def _collapse_repeats(pairs: Column) -> Column:
    """One entry per distinct name: the score of its last occurrence and the
    position of its first, as a name-keyed dictionary built in order would
    hold them."""
    names = F.array_distinct(F.transform(pairs, lambda p: p["name"]))

    def entry(name: Column) -> Column:
        same = F.filter(pairs, lambda p: p["name"].eqNullSafe(name))
        return F.struct(
            F.element_at(same, -1)["score"].alias("score"),
            F.element_at(same, 1)["pos"].alias("pos"),
            name.alias("name"),
        )

    return F.transform(names, entry)


def _by_score_desc(left: Column, right: Column) -> Column:
    ls = F.coalesce(left["score"], F.lit(NEG_INF))
    rs = F.coalesce(right["score"], F.lit(NEG_INF))
    return (
        F.when(ls > rs, -1)
        .when(ls < rs, 1)
        .when(left["pos"] < right["pos"], -1)
        .when(left["pos"] > right["pos"], 1)
        .otherwise(0)
    )


def top_features(pairs: Column, k: int = 3) -> Column:
    """The k best (name, score) entries, score descending, earlier column first
    on a tie; null scores sort last; fewer than k entries leave nulls (R1)."""
    ranked = F.array_sort(_collapse_repeats(pairs), _by_score_desc)
    return F.slice(ranked, 1, k)


def top_columns(k: int = 3) -> list[str]:
    cols: list[str] = []
    for i in range(1, k + 1):
        cols += [f"Top{i}_Feature", f"top{i}_val"]
    return cols


def with_top_features(
    df: DataFrame,
    k: int = 3,
    n: int = 5,
    name_fmt: str = "FEATURE{}",
    score_fmt: str = "FEATURE{}_Score",
    value_type: str = "double",
) -> DataFrame:
    """Append ``Top{i}_Feature`` and ``top{i}_val`` for i = 1..k.

    ``value_type`` casts the top values (e.g. "int", R5); they stay numbers,
    never text.

    Same result as ``top_features`` but written out as plain comparisons over
    the n columns (n^2 of them), which compile into whole-stage codegen;
    lambda functions over arrays are evaluated row by row outside it. For
    each column i: it counts only if its name did not occur earlier; its
    score is that of the last column with the same name; its rank is one
    plus the number of counted columns that beat it (higher score, or equal
    score and earlier column; null scores lose).
    """
    names = [F.col(name_fmt.format(i)) for i in range(1, n + 1)]
    raw = [F.col(score_fmt.format(i)).cast("double") for i in range(1, n + 1)]
    # Stage 1: per column, "first occurrence of its name" and its effective score.
    stage1: dict[str, Column] = {}
    for i in range(n):
        stage1[f"__tf_first{i}"] = reduce(
            lambda a, b: a & b, [~names[j].eqNullSafe(names[i]) for j in range(i)], F.lit(True)
        )
        expr = None
        for j in range(n - 1, i, -1):
            cond = names[j].eqNullSafe(names[i])
            expr = F.when(cond, raw[j]) if expr is None else expr.when(cond, raw[j])
        stage1[f"__tf_score{i}"] = raw[i] if expr is None else expr.otherwise(raw[i])
    first = [F.col(f"__tf_first{i}") for i in range(n)]
    score = [F.col(f"__tf_score{i}") for i in range(n)]
    key = [F.coalesce(s, F.lit(NEG_INF)) for s in score]
    # Stage 2: rank of each column among the counted ones.
    stage2: dict[str, Column] = {}
    for i in range(n):
        beats = [
            F.when(first[j] & ((key[j] > key[i]) | ((key[j] == key[i]) & F.lit(j < i))), 1).otherwise(0)
            for j in range(n)
            if j != i
        ]
        rank = sum(beats[1:], beats[0]) + 1 if beats else F.lit(1)
        stage2[f"__tf_rank{i}"] = F.when(first[i], rank)
    # Stage 3: the column holding each of the first k ranks.
    added: dict[str, Column] = {}
    for r in range(1, k + 1):
        hit = [F.col(f"__tf_rank{i}") == r for i in range(n)]
        name_expr = score_expr = None
        for i in range(n):
            name_expr = F.when(hit[i], names[i]) if name_expr is None else name_expr.when(hit[i], names[i])
            score_expr = F.when(hit[i], score[i]) if score_expr is None else score_expr.when(hit[i], score[i])
        added[f"Top{r}_Feature"] = name_expr
        added[f"top{r}_val"] = score_expr if value_type == "double" else score_expr.cast(value_type)
    temps = [*stage1, *stage2]
    return df.withColumns(stage1).withColumns(stage2).withColumns(added).drop(*temps)


def with_top_features_array(df: DataFrame, k: int = 3, n: int = 5) -> DataFrame:
    """``with_top_features`` through the array form (``top_features``)."""
    top = top_features(feature_array(n), k)
    added: dict[str, Column] = {}
    for i in range(k):
        item = F.get(top, i)
        added[f"Top{i + 1}_Feature"] = item["name"]
        added[f"top{i + 1}_val"] = item["score"]
    return df.withColumns(added)


def with_top_values(
    df: DataFrame, k: int = 3, scores: Sequence[str] | None = None
) -> DataFrame:
    """``top{i}_val`` = i-th largest score of the row, repeats kept (R2)."""
    names = list(scores or [f"FEATURE{i}_Score" for i in range(1, 6)])
    ordered = F.sort_array(F.array(*[F.col(c) for c in names]), asc=False)
    return df.withColumns({f"top{i + 1}_val": F.get(ordered, i) for i in range(k)})


def matching_names(value: Column, scores: Sequence[str]) -> Column:
    """Names of the score columns whose value equals ``value``, in column
    order (R4). A CASE per column and ``array_compact`` to drop the misses:
    no lambda, so it stays inside whole-stage codegen."""
    return F.array_compact(F.array(*[F.when(F.col(c) == value, F.lit(c)) for c in scores]))


def with_matching_names(
    df: DataFrame, targets: Mapping[str, str], scores: Sequence[str] | None = None
) -> DataFrame:
    """For each ``new: value_col`` add the array of score columns equal to it."""
    names = list(scores or [f"FEATURE{i}_Score" for i in range(1, 6)])
    return df.withColumns({new: matching_names(F.col(v), names) for new, v in targets.items()})


def features_long(df: DataFrame, keys: Sequence[str], n: int = 5) -> DataFrame:
    """One row per feature pair: keys, pos, name, score."""
    return df.select(*keys, F.inline(feature_array(n))).select(*keys, "pos", "name", "score")
