r"""Ranked lexical search by a dual-tree walk.

Documents become vectors over the items' terms: the coordinate of a term is what
one occurrence of it in an item adds to the score before the term's weight,
``(1000000000 * tf) div (1000 * tf + 12 * m)``. Items are vectors of weight times
repeats. A score is their inner product, in integers below 2**53, so that
float64 products are exact in any order.

Both sides get a hierarchy by halving along the widest of a few random
projections. A node holds the maximum of each coordinate below it; the product of
an item node's and a document node's maxima bounds every score between them. The
walk takes the node pair of the highest bound first and drops a pair whose bound is
below the weakest kth score of the items in it: whole batches go at once, and
exactly, as no score in them could enter a list. Pairs of leaves are scored.

Documents are read once into narrow vectors, written to the checkpoint folder;
a task walks the trees of ``shard_rows`` documents at a time against a block of
items, and only k rows per item and shard are merged. Items are taken in blocks
of a bounded number and a bounded number of terms (one longer item is a block of
its own); a block is what is sent to the tasks.
"""

from __future__ import annotations

import heapq
import itertools
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctflow.llm.common import arrow_rows, pieces, shared_folder, text_or_empty, written
from acctflow.operators.ranking import top_n_per_group

UNIT = 1_000_000_000
#: Bytes of text to terms: A-Z become a-z, other ASCII that is no letter or digit
#: becomes a space; all bytes of characters beyond ASCII stay.
TO_TERMS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
#: Bytes of document maxima that one task may hold.
MAXIMA_BYTES = 128 << 20


def terms(text: str | None) -> list[bytes]:
    """The terms of a text in order, in UTF-8, A-Z lower-cased."""
    return (text or "").encode().translate(TO_TERMS).split()


class Tree:
    """A hierarchy over sparse vectors, halved along the widest of the given
    directions. Node 0 is the root, ``children`` of a leaf are empty, ``rows``
    are the places of a node's vectors and ``highest`` its coordinate maxima."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], directions: np.ndarray, leaf: int, kind: type):
        self.vectors, self.width = vectors, len(directions)
        at = np.array([v @ directions[i] for i, v in vectors]).reshape(len(vectors), -1)
        self.children: list[tuple[int, ...]] = [()]
        self.rows: list[np.ndarray] = [np.arange(len(vectors))]
        for node in self.grow():
            rows = self.rows[node]
            if len(rows) > leaf:
                spread = at[rows]
                line = int(np.argmax(spread.max(axis=0) - spread.min(axis=0)))
                halves = rows[np.argsort(spread[:, line], kind="stable")]
                self.children[node] = (len(self.rows), len(self.rows) + 1)
                self.children += [(), ()]
                self.rows += [halves[: len(rows) // 2], halves[len(rows) // 2 :]]
        self.highest = np.zeros((len(self.rows), self.width), dtype=kind)
        for node in reversed(range(len(self.rows))):
            if self.children[node]:
                np.maximum(*self.highest[list(self.children[node])], out=self.highest[node])
            else:
                self.highest[node] = self.dense(self.rows[node]).max(axis=0)

    def grow(self) -> Iterator[int]:
        node = 0
        while node < len(self.rows):
            yield node
            node += 1

    def dense(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros((len(rows), self.width))
        for k, r in enumerate(rows.tolist()):
            i, v = self.vectors[r]
            out[k, i] = v
        return out


class Lists:
    """Each item's k best (score, id) so far, and its weakest kth score."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.weakest = np.zeros(n)  # a score must be above 0 even before k are found
        self.best: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0), np.empty(0, dtype=np.int64))] * n

    def add(self, item: int, scores: np.ndarray, ids: np.ndarray) -> None:
        hit = (scores >= self.weakest[item]) & (scores > 0)
        if hit.any():
            s, names = (np.append(a, b[hit]) for a, b in zip(self.best[item], (scores, ids)))
            first = np.lexsort((names, -s))[: self.k]
            self.best[item] = s[first], names[first]
            if len(first) == self.k:
                self.weakest[item] = s[first[-1]]

    def rows(self) -> list[tuple[int, int, int]]:
        return [(p, int(i), int(s)) for p, (ss, names) in enumerate(self.best) for s, i in zip(ss, names)]


def dual_tree_top(items: Tree, docs: Tree, ids: np.ndarray, k: int) -> tuple[list[tuple[int, int, int]], int]:
    """(item place, doc id, score) of each item's ``k`` best documents with a
    score above 0 (equal scores by smaller id), and how many pairs were scored.

    A step takes the document node of the highest bound with the item nodes that
    are still paired with it, and pairs its children with theirs."""
    lists, scored, count = Lists(len(items.vectors), k), 0, itertools.count()

    def alive(pairs: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        limits = np.array([lists.weakest[items.rows[i]].min() for i in pairs.tolist()])
        return (bounds >= limits) & (bounds > 0)

    def down(pairs: np.ndarray) -> np.ndarray:
        return np.array([c for i in pairs.tolist() for c in items.children[i] or (i,)], dtype=np.int64)

    root = items.highest[:1] @ docs.highest[0].astype(np.float64)
    queue = [(-root.max(), next(count), 0, np.zeros(1, dtype=np.int64), root)]
    while queue:
        _, _, d, pairs, bounds = heapq.heappop(queue)
        pairs = pairs[alive(pairs, bounds)]
        if not len(pairs):
            continue
        if docs.children[d]:
            pairs = down(pairs)
            children = list(docs.children[d])
            found = items.highest[pairs] @ docs.highest[children].astype(np.float64).T
            for c, top in zip(children, found.T):
                held = alive(pairs, top)
                if held.any():
                    heapq.heappush(queue, (-top.max(), next(count), c, pairs[held], top[held]))
            continue
        while any(items.children[i] for i in pairs.tolist()):
            pairs = down(pairs)
            pairs = pairs[alive(pairs, items.highest[pairs] @ docs.highest[d].astype(np.float64))]
        if not len(pairs):
            continue
        rows = docs.rows[d]
        wanted = np.concatenate([items.rows[i] for i in pairs.tolist()])
        scores = items.dense(wanted) @ docs.dense(rows).T
        scored += scores.size
        for item, row in zip(wanted.tolist(), scores):
            lists.add(item, row, ids[rows])
    return lists.rows(), scored


def term_vectors(docs: DataFrame, places: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """id, n (terms with repeats), places and counts of the given terms."""
    sent = docs.sparkSession.sparkContext.broadcast(places)
    kinds = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("places", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32()))])

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        known = sent.value
        for batch in pieces(batches):
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = terms(text)
                counts = Counter(filter(known.__contains__, found))
                yield {"id": i, "n": len(found), "places": [known[t] for t in counts], "counts": list(counts.values())}

    narrow = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    return narrow.mapInArrow(arrow_rows(rows_of, kinds), "id long, n long, places array<int>, counts array<int>")


def directions_of(items: list[tuple[np.ndarray, np.ndarray]], width: int, n: int = 8, seed: int = 7) -> np.ndarray:
    """``n`` random mixtures of the items' vectors: documents that are alike for
    the items lie together along them."""
    mixed = np.zeros((width, n))
    for (where, values), shares in zip(items, np.random.default_rng(seed).standard_normal((len(items), n))):
        mixed[where] += values[:, None] * shares
    return mixed


def item_blocks(items: list[tuple], block_items: int, block_terms: int) -> Iterator[list[tuple]]:
    """Runs of (key, terms) with bounded items and distinct terms."""
    held, known = [], set()
    for key, found in items:
        wider = known | set(found)
        if held and (len(held) >= block_items or len(wider) > block_terms):
            yield held
            held, wider = [], set(found)
        held.append((key, found))
        known = wider
    if held:
        yield held


def search_block(docs: DataFrame, block: list[tuple], k: int, shard_rows: int, id_col: str, text_col: str) -> DataFrame:
    """(place in the block, doc_id, score): each shard's best for each item."""
    spark = docs.sparkSession
    names = sorted({t for _, found in block for t in found})
    places = {t: p for p, t in enumerate(names)}
    vectors = written(term_vectors(docs, places, id_col, text_col), shared_folder(spark, "lexical-vectors"))
    size = vectors.agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).head()
    total, length = size["docs"], size["length"]
    frequency = dict(vectors.select(F.explode("places").alias("p")).groupBy("p").count().collect())
    weights = np.array([math.floor(1000 * math.log((2 * total + 2) / (2 * frequency.get(p, 0) + 1))) for p in range(len(names))], dtype=np.int64)
    wanted = []
    for _, found in block:
        counts = Counter(places[t] for t in found)
        where = np.array(sorted(counts), dtype=np.int64)
        wanted.append((where, np.array([counts[p] for p in where.tolist()], dtype=np.float64) * weights[where]))
    sent = spark.sparkContext.broadcast(wanted)
    # Two nodes for 8 documents, 4 bytes a term.
    shard_rows = max(8, min(shard_rows, MAXIMA_BYTES // len(names)))

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        parts, rows = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, shard_rows):
                part = batch.slice(at, shard_rows)
                if parts and rows + part.num_rows > shard_rows:
                    yield pa.Table.from_batches(parts)
                    parts, rows = [], 0
                parts.append(part)
                rows += part.num_rows
        if parts:
            yield pa.Table.from_batches(parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directions = directions_of(sent.value, len(names))
        items = Tree(sent.value, directions, 1, np.float64)
        for table in shards(batches):
            n = table.column("n").to_pylist()
            m = [75 + 25 * c * total // length for c in n]
            columns = [table.column(c).combine_chunks() for c in ("places", "counts")]
            edges = columns[0].offsets.to_numpy()
            where, counts = [c.flatten().to_numpy().astype(np.int64) for c in columns]
            edges = edges - edges[0]
            tf = counts.astype(np.int64)
            impact = (UNIT * tf) // (1000 * tf + 12 * np.repeat(np.array(m, dtype=np.int64), np.diff(edges)))
            pairs = [(where[a:b], impact[a:b].astype(np.float64)) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
            found, _ = dual_tree_top(items, Tree(pairs, directions, 8, np.float32), table.column("id").to_numpy(), k)
            if found:
                place, doc, score = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(place, pa.int32()), pa.array(doc, pa.int64()), pa.array(score, pa.int64())], names=["place", "doc_id", "score"])

    # A document without a wanted term, or without an id, is in no list.
    worth = vectors.where((F.size("places") > 0) & F.col("id").isNotNull()).select("id", "n", "places", "counts")
    return worth.mapInArrow(run, "place int, doc_id long, score long")


def ranked_search(
    docs: DataFrame, items: DataFrame, k: int = 20, block_items: int = 1024, block_terms: int = 16_384, shard_rows: int = 8192,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score``: each item's ``k`` documents of
    the highest score above 0 (all, if fewer), equal scores by smaller id.

    A null text has no terms; an item without a term gives no row, a document
    without one counts neither in N nor in L. Every row of ``items`` is an item of
    its own, also beside another of its id; a null item id stays null. A document
    without an id counts in the statistics but is in no list; rows of one id are
    documents of their own. Other columns are not read. The result reads tables
    in the checkpoint folder.
    """
    spark = docs.sparkSession
    rows = items.select(F.col(item_col).cast("long").alias("item"), text_or_empty(item_text_col).alias("text"))
    found = ((r["item"], terms(r["text"])) for r in rows.toLocalIterator())
    out = None
    for block in item_blocks(((i, t) for i, t in found if t), block_items, block_terms):
        best = search_block(docs, block, k, shard_rows, id_col, text_col)
        ranked = top_n_per_group(best, ["place"], [F.desc("score"), F.asc("doc_id")], k, rank_col="rank")
        keys = spark.createDataFrame([(p, i) for p, (i, _) in enumerate(block)], "place int, item_id long")
        part = ranked.join(keys, "place").select("item_id", "rank", "doc_id", "score")
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return out
