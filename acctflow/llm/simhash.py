"""SimHash near-duplicates by a byte-position inverted index.

A fingerprint has a bit set where over half of the text's shingle hashes have
it. Two fingerprints of at most ``bits`` differing bits differ in at most
``bits`` of their 8 bytes, so they share at least 8 - ``bits`` bytes at equal
positions: the guaranteed minimum of matches.

The inverted index lists fingerprints by positional bytes. Posting lists of one
single (position, byte) hold a 256th of the corpus each, and tallying their
pairs grows with its square; so a posting is keyed by each choice of 8 - ``bits``
positions together with their bytes (28 keys for two bits). Two fingerprints
meet in a posting list exactly if the tally of their shared positional bytes
reaches the minimum, and no pair below it is ever looked at. The members of a
list are then verified bit by bit.

A list has at most 256 ** ``bits`` distinct members (65,536 for two bits), as
all other bytes are equal; only a forest that spans its links leaves it, never
all pairs. Equal fingerprints are one node from the start, so groups of exact
copies, however large, cost one row. Components of the links are found by
``operators.components``.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctflow.llm.common import delete_folder, shared_folder, with_columns_of_text, written
from acctflow.operators.components import bigint_components
from acctflow.session import release


def fingerprint(text: str, words: int = 3, seed: int = 42) -> int:
    """The unsigned 64-bit SimHash of one text; 0 without a word."""
    found = text.encode().lower().split()  # bytes: ASCII letters and white space only
    if not found:
        return 0
    joined = b" ".join(found)
    if len(found) <= words:
        return xxhash.xxh64_intdigest(joined, seed)
    digest, at = xxhash.xxh64_intdigest, 0
    ends, starts = [], []
    for w in found:
        starts.append(at)
        at += len(w)
        ends.append(at)
        at += 1
    hashes = np.array([digest(joined[s:e], seed) for s, e in zip(starts, ends[words - 1 :])], dtype=">u8")
    counts = np.zeros(64, dtype=np.int64)
    for lo in range(0, len(hashes), 1 << 16):
        part = hashes[lo : lo + (1 << 16)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(
    docs: DataFrame, words: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``id_col`` (or the columns in ``keep``) and ``fp``, the fingerprint as a
    signed bigint. A null text counts as empty."""

    def arrays(texts: list[str]) -> list[pa.Array]:
        return [pa.array([signed(fingerprint(t, words, seed)) for t in texts], pa.int64())]

    return with_columns_of_text(docs, text_col, keep or (id_col,), "fp long", lambda: arrays)


def spanning_links(members: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """(member, smaller linked member of its group) for the links of at most
    ``bits`` differing bits among distinct unsigned 64-bit ``members``: every
    linked member but the first of its group once."""
    members = np.sort(members)
    n = len(members)
    label = np.arange(n)
    if n <= 512:
        near = np.bitwise_count(members[:, None] ^ members[None, :]) <= bits
        neighbours = [np.flatnonzero(row) for row in near]
        while True:
            before = label.copy()
            label = np.array([label[row].min() for row in neighbours])
            label = label[label]
            if (label == before).all():
                break
    else:
        # Only a few bytes vary: try each flip of up to ``bits`` of their bits.
        varying = int(np.bitwise_or.reduce(members ^ members[0]))
        places = [k for k in range(64) if varying >> k & 1]
        flips = [sum(1 << k for k in c) for m in range(1, bits + 1) for c in combinations(places, m)]
        beside = []
        for flip in flips:
            other = members ^ np.uint64(flip)
            at = np.searchsorted(members, other).clip(max=n - 1)
            hit = np.flatnonzero(members[at] == other)
            if len(hit):
                beside.append((hit, at[hit]))
        while True:
            before = label.copy()
            for a, b in beside:
                np.minimum.at(label, a, label[b])
            label = label[label]
            if (label == before).all():
                break
    moved = np.flatnonzero(label != np.arange(n))
    return list(zip(members[moved].tolist(), members[label[moved]].tolist()))


def links(nodes: DataFrame, bits: int = 2) -> DataFrame:
    """(u, v): signed fingerprints that link, enough of them to connect every
    group of links. ``nodes`` has distinct ``fp`` values."""
    minimum = 8 - bits
    masks = [signed(sum(0xFF << 8 * p for p in c)) for c in combinations(range(8), minimum)]
    postings = nodes.select(
        "fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("positions", "shared")
    )
    # A list's size has the proven bound 256 ** bits, whatever the corpus.
    lists = postings.groupBy("positions", "shared").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)

    def run(batches):
        for batch in batches:
            found: list[tuple[int, int]] = []
            for members in batch.column(0):
                values = members.values.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                found += spanning_links(np.unique(values), bits)
            pairs = np.array(found, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], names=["u", "v"])

    return lists.select("fps").mapInArrow(run, "u long, v long")


def near_duplicates(
    docs: DataFrame, words: int = 3, bits: int = 2, seed: int = 42, id_col: str = "doc_id", text_col: str = "text",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Per row: ``id_col`` (or the columns in ``keep``, which must hold it),
    ``fp``, ``root``, the fingerprint that stands for its component, and
    ``component_id``, the smallest id reachable over links of at most ``bits``
    differing bits.

    A text with no word has fingerprint 0 and links like any other. A null text
    counts as empty. Null ids take part in links; a component without an id has
    a null component_id. Repeated rows are rows of their own. The result reads
    written tables in the shared checkpoint folder.
    """
    rows = written(
        fingerprints(docs, words, seed, id_col, text_col, keep), shared_folder(docs.sparkSession, "simhash-fp")
    )
    return rows.join(components(rows, bits, id_col), "fp").select(*rows.columns, "root", "component_id")


def components(rows: DataFrame, bits: int = 2, id_col: str = "doc_id") -> DataFrame:
    """``fp``, ``root`` and ``component_id`` of each fingerprint of the written
    table ``rows`` (``id_col``, ``fp``), as a written table."""
    spark = rows.sparkSession
    folder = shared_folder(spark, "simhash-nodes")
    nodes = written(rows.groupBy("fp").agg(F.min(id_col).alias("first")), folder)
    # Written first: a task then runs one Python worker at a time, for links or for components.
    linked = shared_folder(spark, "simhash-links")
    roots = bigint_components(written(links(nodes, bits), linked))
    delete_folder(spark, linked)
    labelled = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    firsts = labelled.groupBy("root").agg(F.min("first").alias("component_id"))
    # Written, so that the join to the rows has two plain inputs: the rows of
    # a hot fingerprint are then split by the skew-join.
    by_root = written(firsts, shared_folder(spark, "simhash-firsts"))
    rooted = written(labelled.select("fp", "root"), shared_folder(spark, "simhash-roots"))
    by_fp = written(rooted.join(by_root, "root").select("fp", "root", "component_id"), shared_folder(spark, "simhash-labels"))
    release(roots)
    delete_folder(spark, folder)
    return by_fp
