"""Connected components over bigint nodes.

First every task contracts the edges it holds (union by hooking and pointer
jumping over arrays, at most ``CHUNK`` edges at a time) to stars: a row from each
node to the smallest node it can reach there, the center, which has a row to itself.
The stars connect what the edges connected, with at most one row a node and task, so
chains and dense parts are gone before anything is shuffled. If the stars are few
enough for one chunk, contracting them once more is the result.

Otherwise a level takes away the nodes that are the center of no star (``level_of``,
one shuffle): such a node is linked to its smallest center, and its other centers get
an edge to that one. What is left are edges among the centers. They are contracted
in tasks again, and so on, each level with fewer nodes, until the stars fit one
chunk. On the way back, every link takes the result of the center it names: one join
a level. The smallest node of a component is the center of each star it is in, so
it stays to the end and is the root.

Nodes numbered at random fall by a share each level. If a level keeps over
``SLOW`` of its nodes (a chain in the order of its numbers, dealt out over the tasks),
rounds run over what is left. Every node carries a label, at first the
smallest node beside it. A round lets each node see the smallest label among its
neighbours, moves the node *and* the node its label names down to it, and then
replaces each label by the label of the node it names, so that chains shorten by
half. Labels only fall and always name a node of the same component; when a whole
round changes none, neighbours agree and each label is the smallest node of its
component. There is no limit on levels or rounds.

All aggregates of a round are ``min`` over bigint (hash aggregates, combined before
the shuffle). The joins that can meet a hot key (the edges of a hub; the nodes
that name one label or center) read two written tables, which is the form that AQE's
skew-join splits; the other joins have one row per key on both sides. A level's
groups hold a row per task at most. Each level and round is written to the shared
checkpoint folder and deleted when it is read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acctflow.session import materialize, release

#: Edges that a task contracts at a time (about 20 MB).
CHUNK = 1 << 18

#: A level that keeps a larger share of its nodes is the last one.
SLOW = 0.8


def smallest_reached(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node it is connected with) for all nodes on the edges."""
    nodes = np.unique(np.concatenate([u, v]))
    a, b = (np.searchsorted(nodes, side).astype(np.int32) for side in (u, v))
    label = np.arange(len(nodes), dtype=np.int32)
    while len(a):
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        apart = low != high
        a, b = a[apart], b[apart]
        # Labels are roots here, so a root hangs itself on a smaller one only.
        np.minimum.at(label, high[apart], low[apart])
        while (label[label] != label).any():
            label = label[label]
    return nodes, nodes[label]


def stars(chunk: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For ``mapInArrow``: edges (u, v) to stars (node, smallest node); the smallest
    nodes have a row too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def contracted() -> tuple[np.ndarray, np.ndarray]:
            return smallest_reached(*[np.concatenate(side) for side in zip(*held)])

        def sent(forest: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c) for c in forest], names=["u", "v"])

        for batch in batches:
            held.append(tuple(c.to_numpy() for c in batch.columns))
            size += batch.num_rows
            if size > chunk:
                forest = contracted()
                held, size = [forest], len(forest[0])
                if size > chunk // 2:
                    yield sent(forest)
                    held, size = [], 0
        if size:
            yield sent(contracted())

    return run


def level_of(forest: DataFrame) -> DataFrame:
    """Stars (u, v) of all tasks to (a, b, link). A node that is the center of a star
    anywhere has a link to itself and keeps its edges; any other node has a link to its
    smallest center b, and edges from there to its other centers."""
    node = Window.partitionBy("u")
    low, center = F.min(F.when(F.col("u") != F.col("v"), F.col("v"))).over(node), F.max(F.col("u") == F.col("v")).over(node)
    rows = forest.repartition("u").distinct().select("u", "v", low.alias("low"), center.alias("center"))
    first = F.col("v") == F.col("low")
    return rows.select(
        F.when(F.col("center") | first, F.col("u")).otherwise(F.col("low")).alias("a"),
        F.col("v").alias("b"),
        F.when(F.col("center"), F.col("u") == F.col("v")).otherwise(first).alias("link"),
    )


def bigint_components(edges: DataFrame, u: str = "u", v: str = "v", chunk: int = CHUNK) -> DataFrame:
    """(node, root) for every node on an edge with two different ends; root is
    the smallest node of its component. Edges with a null end or equal ends are
    left out. The result is a written table; ``release`` deletes it."""
    a, b = F.col(u).cast("long"), F.col(v).cast("long")
    scratch: list[DataFrame] = []

    def kept(df: DataFrame, tag: str) -> DataFrame:
        scratch.append(materialize(df, tag))
        return scratch[-1]

    def dropped(df: DataFrame) -> None:
        release(df)
        scratch.remove(df)

    try:
        levels: list[DataFrame] = []
        forest = kept(edges.where(a != b).select(a.alias("u"), b.alias("v")).mapInArrow(stars(chunk), "u long, v long"), "cc-forest")
        slow = False
        while (left := forest.count()) > chunk and not slow:
            levels.append(kept(level_of(forest), "cc-level"))
            dropped(forest)
            nodes = levels[-1].where("link").agg(F.count(F.lit(1)).alias("all"), F.count_if(F.col("a") == F.col("b")).alias("left")).head()
            slow = nodes["left"] > SLOW * nodes["all"]
            core = levels[-1].where(~F.col("link")).select(F.col("a").alias("u"), F.col("b").alias("v"))
            forest = kept(core.mapInArrow(stars(chunk), "u long, v long"), "cc-forest")
        if left > chunk:
            roots = label_rounds(forest.where(F.col("u") != F.col("v")))
        elif left or not levels:
            # Bounded by the count just taken: one task's chunk.
            roots = materialize(forest.coalesce(1).mapInArrow(stars(chunk), "node long, root long"), "cc-labels")
        else:  # only links are left
            level = levels.pop()
            roots = level.where("link").select(F.col("a").alias("node"), F.col("b").alias("root"))
            roots._acctflow_path = level._acctflow_path
            scratch.remove(level)
        scratch.append(roots)
        dropped(forest)
        for level in reversed(levels):
            found = roots.withColumnRenamed("node", "b").hint("merge")
            linked = level.where("link").join(found, "b", "left")
            above = kept(linked.select(F.col("a").alias("node"), F.coalesce("root", "b").alias("root")), "cc-labels")
            dropped(roots)
            dropped(level)
            roots = above
        scratch.remove(roots)
        return roots
    finally:
        for df in scratch:
            release(df)


def label_rounds(forest: DataFrame) -> DataFrame:
    """The rounds over star edges (u, v), u above v, as a written table (node, root)."""
    both = labels = moved = None
    try:
        both = materialize(
            forest.distinct().select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e"))
            .select("e.u", "e.v"),
            "cc-edges",
        )
        labels = materialize(
            both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("low")).select(
                "node", F.least("node", "low").alias("root"), F.lit(1).alias("changed")
            ),
            "cc-labels",
        )
        while labels.agg(F.max("changed")).head()[0]:
            now = labels.select("node", "root")
            near = (
                both.join(now.withColumnRenamed("node", "v"), "v")
                .groupBy(F.col("u").alias("node"))
                .agg(F.min("root").alias("low"))
            )
            seen = now.join(near, "node").select("node", "root", F.least("root", "low").alias("best"))
            hooked = seen.groupBy(F.col("root").alias("node")).agg(F.min("best").alias("hook"))
            moved = materialize(
                seen.join(hooked, "node", "left").select(
                    "node", F.col("root").alias("old"), F.least("best", "hook").alias("root")
                ),
                "cc-moved",
            )
            named = moved.select(F.col("node").alias("root"), F.col("root").alias("next"))
            following = materialize(
                moved.join(named, "root").select(
                    "node", F.col("next").alias("root"), F.when(F.col("next") != F.col("old"), 1).otherwise(0).alias("changed")
                ),
                "cc-labels",
            )
            release(labels)
            release(moved)
            labels, moved = following, None
        out = labels.select("node", "root")
        out._acctflow_path = labels._acctflow_path
        return out
    except BaseException:
        if labels is not None:
            release(labels)
        raise
    finally:
        for scratch in (both, moved):
            if scratch is not None:
                release(scratch)
