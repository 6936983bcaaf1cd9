"""Nearest neighbours by a hierarchical navigable small-world graph per shard.

Vectors are dealt to shards of about ``shard_size`` by hash. Each shard gets a
graph of layers: all its vectors are in layer 0, a falling share in each layer
above. The links of a layer join a vector to near ones in different directions
(a candidate is taken if it is nearer to the vector than to any link taken
before) and run both ways. As a shard is small, the candidates come from exact
blocks of inner products rather than from inserting one by one. The links are
flat arrays, -1 where a vector has fewer, and lie with the vectors in one row a
shard, written to the shared folder.

A search starts in the top layer, goes down, and explores layer 0 with a beam,
for a block of queries at a time. Every block meets every shard; the shard
results are merged by score. For the graph, vectors get one more component that
gives all the same length, which turns largest inner products into smallest
distances.

Equal vectors are one node that keeps its ``k`` + 1 smallest ids; no more can be
in any result of ``k``, as ties go to the smaller id. So a group of copies of
any size is one node, and its rows meet no pair by pair.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acctflow.llm.common import delete_folder, shared_folder, written

GRAPH = "shard int, n int, dim int, vectors binary, ids array<long>, id_ends array<int>, members array<binary>, links array<binary>"


def usable(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, vec) of the rows that take part: an id and a vector without
    null or non-finite components, not all zero, of the table's usual length
    (the most frequent; of several, the longest)."""
    vec = F.col(vec_col).cast("array<float>")
    sound = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(vec, lambda x: x != 0)
    found = rows.where(F.col(id_col).isNotNull() & sound).select(F.col(id_col).cast("long").alias("vec_id"), vec.alias("vec"))
    sizes = found.groupBy(F.size("vec").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).head()
    return found.where(F.size("vec") == (sizes.dim if sizes else 0))


def near_links(vectors: np.ndarray, most: int, candidates: int, block: int = 256) -> np.ndarray:
    """(n, 2 * most) links among the rows of ``vectors`` (all of one length),
    -1 where there are fewer."""
    n = len(vectors)
    out = np.full((n, 2 * most), -1, dtype=np.int32)
    if n < 2:
        return out
    c = min(candidates, n - 1)
    pairs = []
    for lo in range(0, n, block):
        mine = np.arange(lo, min(n, lo + block))
        sims = vectors[mine] @ vectors.T
        sims[np.arange(len(mine)), mine] = -np.inf
        near = np.argpartition(-sims, c - 1, axis=1)[:, :c]
        own = np.take_along_axis(sims, near, axis=1)
        order = np.argsort(-own, axis=1, kind="stable")
        near, own = np.take_along_axis(near, order, axis=1), np.take_along_axis(own, order, axis=1)
        between = np.einsum("bid,bjd->bij", vectors[near], vectors[near], optimize=True)
        taken = np.zeros(near.shape, dtype=bool)
        for j in range(c):
            blocked = (taken & (between[:, j, :] > own[:, j : j + 1])).any(axis=1)
            taken[:, j] = ~blocked & (taken.sum(axis=1) < most)
        # Room that is left goes to the nearest of the others.
        spare = (most - taken.sum(axis=1))[:, None]
        taken |= ~taken & (np.cumsum(~taken, axis=1) <= spare)
        a, b = np.nonzero(taken)
        pairs.append((mine[a], near[a, b], own[a, b]))
    a, b, s = (np.concatenate(x) for x in zip(*pairs))
    # Both ways; of a vector's links the nearest 2 * most stay.
    key, first = np.unique(np.concatenate([a * n + b, b * n + a]), return_index=True)
    s = np.concatenate([s, s])[first]
    a, b = key // n, key % n
    order = np.lexsort((-s, a))
    a, b = a[order], b[order]
    place = np.arange(len(a)) - np.searchsorted(a, a)
    fits = place < 2 * most
    out[a[fits], place[fits]] = b[fits]
    return out


def build(vectors: np.ndarray, ids: np.ndarray, most: int, candidates: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """(members, links) of each layer from 0; links are positions in the
    layer's members."""
    # In double precision: beside one long vector the added component is large,
    # and single products would lose what tells the others apart.
    exact = vectors.astype(np.float64)
    norms = (exact**2).sum(axis=1)
    level_vectors = np.concatenate([exact, np.sqrt(np.maximum(norms.max() - norms, 0))[:, None]], axis=1)
    # A fixed scramble of the id instead of a random number: repeatable.
    h = (ids.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(31)
    h = h * np.uint64(0x94D049BB133111EB)
    share = ((h >> np.uint64(11)).astype(np.float64) + 1) / float(1 << 53)
    levels = np.floor(-np.log(share) / math.log(most)).astype(int)
    levels[levels.argmax()] = levels.max()
    members, links = [], []
    for layer in range(int(levels.max()) + 1):
        chosen = np.flatnonzero(levels >= layer).astype(np.int32)
        members.append(chosen)
        links.append(near_links(level_vectors[chosen], most, candidates))
    return members, links


def beam(vectors: np.ndarray, links: np.ndarray, queries: np.ndarray, start: np.ndarray, ef: int, step: int = 4) -> np.ndarray:
    """(queries, ef) positions of the best found from ``start`` (queries, any),
    best first, -1 where fewer were reached."""
    q, n = len(queries), len(vectors)
    at = np.arange(q)[:, None]
    seen = np.zeros((q, n + 1), dtype=bool)  # the last column stands for "none"
    seen[:, n] = True
    pos = np.full((q, ef), n, dtype=np.int64)
    score = np.full((q, ef), -np.inf, dtype=np.float32)
    first = start[:, :ef]
    width = first.shape[1]
    pos[:, :width] = first
    score[:, :width] = np.einsum("qed,qd->qe", vectors[first], queries)
    seen[at, first] = True
    done = pos == n
    while True:
        waiting = np.where(done, -np.inf, score)
        pick = np.argpartition(-waiting, min(step, ef - 1), axis=1)[:, :step]
        alive = np.take_along_axis(waiting, pick, axis=1) > -np.inf
        if not alive.any():
            break
        np.put_along_axis(done, pick, True, axis=1)
        chosen = np.take_along_axis(pos, pick, axis=1)
        beside = links[np.where(alive, chosen, 0)].astype(np.int64)
        beside[(beside < 0) | ~alive[:, :, None]] = n
        beside = np.sort(beside.reshape(q, -1), axis=1)
        beside[:, 1:][beside[:, 1:] == beside[:, :-1]] = n
        beside[seen[at, beside]] = n
        seen[at, beside] = True
        new = np.einsum("qed,qd->qe", vectors[np.minimum(beside, n - 1)], queries)
        new[beside == n] = -np.inf
        pos = np.concatenate([pos, beside], axis=1)
        score = np.concatenate([score, new], axis=1)
        done = np.concatenate([done, beside == n], axis=1)
        keep = np.argpartition(-score, ef - 1, axis=1)[:, :ef]
        pos, score, done = (np.take_along_axis(x, keep, axis=1) for x in (pos, score, done))
    order = np.argsort(-score, axis=1, kind="stable")
    pos = np.take_along_axis(pos, order, axis=1)
    return np.where(pos == n, -1, pos)


def search(vectors, members, links, queries: np.ndarray, ef: int, block: int = 256) -> np.ndarray:
    """(queries, ef) positions in the shard, best first, -1 where fewer."""
    out = []
    for lo in range(0, len(queries), block):
        part = queries[lo : lo + block]
        found = np.zeros((len(part), 1), dtype=np.int64)
        for layer in range(len(members) - 1, -1, -1):
            own = vectors[members[layer]]
            width = ef if layer == 0 else min(8, len(own))
            found = beam(own, links[layer], part, found, width)
            found = np.where(found < 0, found[:, :1], found)  # a start may repeat
            found = members[layer][found].astype(np.int64)
            if layer:
                found = np.searchsorted(members[layer - 1], found)
        out.append(found)
    return np.concatenate(out) if out else np.zeros((0, ef), dtype=np.int64)


def build_index(
    rows: DataFrame, folder: str, k: int, shard_size: int = 8192, most: int = 16, candidates: int = 48,
) -> tuple[DataFrame, int]:
    """Graphs of (vec_id, vec) rows, one row a shard, written below ``folder``;
    and the number of shards, which grows with the number of distinct vectors."""
    hashed = rows.withColumn("h", F.xxhash64("vec"))
    rank = F.row_number().over(Window.partitionBy("h", "vec").orderBy("vec_id"))
    few = hashed.withColumn("rank", rank).where(F.col("rank") <= k + 1)  # bounded before the shuffle
    nodes = written(few.groupBy("h", "vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), f"{folder}/nodes")
    shards = max(1, math.ceil(nodes.count() / shard_size))

    def graph(table: pa.Table) -> pa.Table:
        ids = table.column("ids").to_pylist()
        order = sorted(range(len(ids)), key=lambda i: ids[i][0])
        vectors = np.array(table.column("vec").to_pylist(), dtype=np.float32)[order]
        ids = [ids[i] for i in order]
        members, links = build(vectors, np.array([x[0] for x in ids], dtype=np.int64), most, candidates)
        row = {
            "shard": table.column("shard")[0].as_py(), "n": len(ids), "dim": vectors.shape[1], "vectors": vectors.tobytes(),
            "ids": [i for x in ids for i in x], "id_ends": np.cumsum([len(x) for x in ids]).tolist(),
            "members": [m.tobytes() for m in members], "links": [x.tobytes() for x in links],
        }
        kinds = pa.schema(
            [("shard", pa.int32()), ("n", pa.int32()), ("dim", pa.int32()), ("vectors", pa.binary()), ("ids", pa.list_(pa.int64())),
             ("id_ends", pa.list_(pa.int32())), ("members", pa.list_(pa.binary())), ("links", pa.list_(pa.binary()))]
        )
        return pa.Table.from_pylist([row], schema=kinds)

    dealt = nodes.select(F.pmod("h", F.lit(shards)).cast("int").alias("shard"), "vec", "ids")
    return written(dealt.groupBy("shard").applyInArrow(graph, GRAPH), f"{folder}/graphs"), shards


def nearest(
    rows: DataFrame, is_query, k: int = 20, ef: int = 128, id_col: str = "vec_id", vec_col: str = "embedding",
    shard_size: int = 8192, block_size: int = 4096,
) -> DataFrame:
    """For each row that fulfils ``is_query`` (a condition on ``vec_id``) its
    ``k`` nearest other rows found: ``query_id``, ``rank`` from 1, ``vec_id`` and
    ``score``, the inner product in double precision.

    Rows whose vector is null, zero, of another length, or holds null or
    non-finite components take no part. Ties go to the smaller id; a repeated
    id counts once per row as a neighbour, never as its own. No rows give no
    result. Beam width ``ef`` trades time for recall.
    """
    spark = rows.sparkSession
    folder = shared_folder(spark, "hnsw")
    sound = written(usable(rows, id_col, vec_col), f"{folder}/rows")
    graphs, shards = build_index(sound, folder, k, shard_size)
    asked = sound.where(is_query).distinct()
    blocks = max(1, math.ceil(asked.count() / block_size))
    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    # Every query meets every shard, a block of queries at a time.
    sent = asked.select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), block.alias("block"), "vec_id", "vec"
    )
    held = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def answer(queries: pa.Table, graph: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if queries.num_rows and graph.num_rows:
            g = graph.to_pylist()[0]
            vectors = np.frombuffer(g["vectors"], dtype=np.float32).reshape(g["n"], g["dim"])
            members = [np.frombuffer(m, dtype=np.int32) for m in g["members"]]
            links = [np.frombuffer(x, dtype=np.int32).reshape(len(m), -1) for x, m in zip(g["links"], members)]
            ends = g["id_ends"]
            asked_ids = queries.column("vec_id").to_pylist()
            asked = np.array(queries.column("vec").to_pylist(), dtype=np.float32)
            found = search(vectors, members, links, asked, min(max(ef, k + 1), max(g["n"], 1)))
            for q, row, vector in zip(asked_ids, found, asked):
                row = np.unique(row)
                exact = (vectors[row].astype(np.float64) * vector.astype(np.float64)).sum(axis=1)
                best = row[np.argsort(-exact, kind="stable")]
                scores = np.sort(-exact, kind="stable")
                near = []
                for p, s in zip(best.tolist(), scores.tolist()):
                    if len(near) >= k and -s < near[k - 1][0]:
                        break
                    ids = g["ids"][(ends[p - 1] if p else 0) : ends[p]]
                    near += [(-s, i) for i in ids if i != q]
                near.sort(key=lambda x: (-x[0], x[1]))
                out += [(q, i, s) for s, i in near[:k]]
        columns = list(zip(*out)) or [(), (), ()]
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names=["query_id", "vec_id", "score"])

    found = (
        sent.groupBy("shard", "block").cogroup(held.groupBy("shard", "block"))
        .applyInArrow(answer, "query_id long, vec_id long, score double")
    )
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    merged = found.withColumn("rank", rank).where(F.col("rank") <= k)
    result = written(
        merged.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"), shared_folder(spark, "hnsw-result")
    )
    delete_folder(spark, folder)
    return result
