"""Hard negatives by a vertical scan with bounds (BOND).

Vectors are scaled to integers, so every score is an exact inner product. Rows
are dealt into shards by their id; a shard holds its vectors column by column,
with the least and greatest component of each. An anchor reads the columns in
the descending order of its own components' magnitude. After every few columns
the columns not read yet can still add at least ``rest_low`` and at most
``rest_high`` to any score, so candidates whose score can no longer matter leave
the bitmap, and later columns are read for the rest alone.

Two scans run: one over rows of the anchor's label for its positives (a row goes
when it can't reach the weakest of the best found so far), one over rows of other
labels for the negatives, which have a score window for each positive (a row goes
when its score can't lie in any window, or when a window has enough better rows).

Anchors travel to the shards, one row each; a shard's vectors are sent once. A
task streams: it holds one shard and reads the anchors behind it in batches. The
anchors are copied once a shard, so ``shard_rows`` should grow with the memory.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acctflow.llm.common import shared_folder, written
from acctflow.operators.ranking import top_n_per_group

#: Scaled components beyond this are refused, so that sums of up to 8000 products stay in 64 bits.
LARGEST = 1 << 25
#: Columns read between two looks at the bounds.
STEP = 8


class Shard:
    """Vectors of one shard by column, with each column's range."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels = ids, labels
        self.columns = np.ascontiguousarray(vectors.T)
        self.low, self.high = self.columns.min(axis=1), self.columns.max(axis=1)

    def scan(self, anchor: np.ndarray, rows: np.ndarray, keep: Callable) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) of those of ``rows`` that ``keep(partial, rest_low,
        rest_high)``, a mask, left in to the end."""
        order = np.argsort(-np.abs(anchor), kind="stable")
        order = order[: np.count_nonzero(anchor)]
        ends = anchor[order] * self.low[order], anchor[order] * self.high[order]
        rest_low = np.append(np.minimum(*ends)[::-1].cumsum()[::-1], 0)
        rest_high = np.append(np.maximum(*ends)[::-1].cumsum()[::-1], 0)
        partial = np.zeros(len(rows), dtype=np.int64)
        for at in range(0, len(order), STEP):
            read = order[at : at + STEP]
            partial += (self.columns[read[:, None], rows] * anchor[read, None]).sum(axis=0)
            done = min(at + STEP, len(order))
            alive = keep(partial, rest_low[done], rest_high[done])
            rows, partial = rows[alive], partial[alive]
            if not len(rows):
                break
        return rows, partial

    def best(self, rows: np.ndarray, scores: np.ndarray, n: int) -> np.ndarray:
        """Places of the ``n`` first: higher scores, then smaller ids."""
        return np.lexsort((self.ids[rows], -scores))[:n]


def kth_largest(values: np.ndarray, k: int):
    return np.partition(values, len(values) - k)[len(values) - k]


def positives_in(shard: Shard, anchor_id: int, label: int, anchor: np.ndarray, n: int) -> list[tuple]:
    """(id, score) of the shard's ``n`` first rows of the anchor's label."""

    def keep(partial, rest_low, rest_high):
        if len(partial) <= n:
            return slice(None)
        return partial + rest_high >= kth_largest(partial, n) + rest_low

    rows = np.flatnonzero((shard.labels == label) & (shard.ids != anchor_id))
    rows, scores = shard.scan(anchor, rows, keep)
    first = shard.best(rows, scores, n)
    return list(zip(shard.ids[rows[first]].tolist(), scores[first].tolist()))


def negatives_in(shard: Shard, label: int, anchor: np.ndarray, windows: list[tuple[int, int]], n: int) -> list[list[tuple]]:
    """For each (lowest, highest) score window, (id, score) of the shard's ``n``
    first rows of other labels with a score inside."""

    def keep(partial, rest_low, rest_high):
        least, most = partial + rest_low, partial + rest_high
        alive = np.zeros(len(partial), dtype=bool)
        for low, high in windows:
            inside = (most >= low) & (least <= high)
            sure = least[(least >= low) & (most <= high)]
            if len(sure) > n:
                inside &= most >= kth_largest(sure, n)
            alive |= inside
        return alive

    rows, scores = shard.scan(anchor, np.flatnonzero(shard.labels != label), keep)
    found = []
    for low, high in windows:
        held = np.flatnonzero((scores >= low) & (scores <= high))
        first = held[shard.best(rows[held], scores[held], n)]
        found.append(list(zip(shard.ids[rows[first]].tolist(), scores[first].tolist())))
    return found


def over_shards(rows: DataFrame, anchors: DataFrame, dims: int, shards: int, of_anchor: Callable, added: str, schema: pa.Schema) -> DataFrame:
    """``of_anchor(shard, id, label, vector, targets)``, an iterator of tuples,
    for every anchor on every shard. ``rows``: shard, id, label, vector;
    ``anchors``: id, label, vector, targets (an array of longs)."""
    nothing = F.lit(None).cast("array<bigint>")
    held = rows.select("shard", F.lit(0).alias("kind"), "id", "label", "vector", nothing.alias("targets"))
    sent = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("kind"), "id", "label", "vector", "targets")
    dealt = held.unionByName(sent).repartition(shards, "shard").sortWithinPartitions("shard", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, parts, shard = None, [], None
        for batch in batches:
            number, kind = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            edges = np.flatnonzero((np.diff(number) != 0) | (np.diff(kind) != 0)) + 1
            for lo, hi in zip([0, *edges.tolist()], [*edges.tolist(), len(number)]):
                part = batch.slice(lo, hi - lo)
                ids, labels = part.column(2).to_numpy(), part.column(3).to_numpy()
                vectors = part.column(4).flatten().to_numpy().reshape(hi - lo, dims).astype(np.int64)
                if number[lo] != current:
                    current, parts, shard = number[lo], [], None
                if kind[lo] == 0:
                    parts.append((ids, labels, vectors))
                    continue
                if not parts and shard is None:
                    continue  # a shard without rows
                if shard is None:
                    shard, parts = Shard(*[np.concatenate(p) for p in zip(*parts)]), []
                out: list[tuple] = []
                for i, targets in enumerate(part.column(5).to_pylist()):
                    out += of_anchor(shard, int(ids[i]), int(labels[i]), vectors[i], targets)
                    if len(out) > 50_000:
                        yield as_batch(out)
                        out = []
                if out:
                    yield as_batch(out)

    def as_batch(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)

    return dealt.mapInArrow(run, added)


def scaled_rows(
    vectors: DataFrame, anchors: Column, scale: int = 256, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """id, label, is_anchor and vector (integers) of the rows that take part."""
    x = F.col(vec_col)
    odd = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double") * scale) > LARGEST))
    whole = F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("int"))
    parts = vectors.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & x.isNotNull() & ~odd).select(
        F.col(id_col).cast("long").alias("id"),
        F.struct(F.col(label_col).cast("long").alias("label"), whole.alias("vector"), F.coalesce(anchors, F.lit(False)).alias("is_anchor")).alias("row"),
    )
    return parts.groupBy("id").agg(F.min("row").alias("row")).select("id", "row.*")


def hard_negatives(
    vectors: DataFrame, anchors: Column, n_positives: int = 5, n_negatives: int = 10, low_pct: int = 30, high_pct: int = 90,
    scale: int = 256, shard_rows: int = 8192, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """Per anchor (rows where ``anchors``), positive and negative: ``anchor_id``,
    ``positive_id``, ``rank``, ``negative_id``, ``positive_score``,
    ``negative_score``.

    Components become floor(``scale`` * x); a score is the integer inner product
    with the anchor; higher scores come first, equal ones by smaller id. An
    anchor's positives are its first ``n_positives`` other rows of its label; a
    positive's negatives the first ``n_negatives`` rows of other labels whose
    score is ``low_pct`` to ``high_pct`` percent of the positive's (so none for a
    negative positive score). Anchors or positives without a row give none.

    Rows with a null id, label or vector, or a null, non-finite or very large
    component (over 2**25 after scaling), take no part. A shorter vector counts
    as ending in zeros. Of rows with one id the least (label, vector) takes part.
    Other columns are not read. The result reads tables in the checkpoint folder.
    """
    spark = vectors.sparkSession
    found = written(scaled_rows(vectors, anchors, scale, id_col, vec_col, label_col), shared_folder(spark, "negatives-rows"))
    size = found.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("dims")).head()
    dims, shards = max(size["dims"] or 0, 1), max(-(-size["n"] // shard_rows), 1)
    full = F.concat("vector", F.array_repeat(F.lit(0), F.lit(dims) - F.size("vector")))
    rows = found.select(F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard"), "id", "label", full.alias("vector"), "is_anchor")
    asked = rows.where("is_anchor").select("id", "label", "vector")

    def near(shard, anchor_id, label, vector, _):
        return [(anchor_id, i, s) for i, s in positives_in(shard, anchor_id, label, vector, n_positives)]

    def far(shard, anchor_id, label, vector, targets):
        ids, scores = targets[0::2], targets[1::2]
        windows = [(-(-low_pct * s // 100), high_pct * s // 100) for s in scores]
        per_window = negatives_in(shard, label, vector, windows, n_negatives)
        return [(anchor_id, p, ps, i, s) for p, ps, held in zip(ids, scores, per_window) for i, s in held]

    longs = [pa.field(c, pa.int64()) for c in ("anchor_id", "positive_id", "positive_score", "negative_id", "negative_score")]
    pairs = over_shards(
        rows, asked.withColumn("targets", F.array().cast("array<bigint>")), dims, shards, near,
        "anchor_id long, positive_id long, positive_score long", pa.schema(longs[:3]),
    )
    first = top_n_per_group(pairs, ["anchor_id"], [F.desc("positive_score"), F.asc("positive_id")], n_positives)
    positives = written(first, shared_folder(spark, "negatives-positives"))
    per_anchor = positives.groupBy(F.col("anchor_id").alias("id")).agg(
        F.flatten(F.sort_array(F.collect_list(F.array("positive_id", "positive_score")))).alias("targets")
    )
    triples = over_shards(
        rows, asked.join(per_anchor, "id"), dims, shards, far,
        "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long", pa.schema(longs),
    )
    order = [F.desc("negative_score"), F.asc("negative_id")]
    ranked = top_n_per_group(triples, ["anchor_id", "positive_id", "positive_score"], order, n_negatives, rank_col="rank")
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
