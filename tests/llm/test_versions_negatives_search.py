"""Version sketches, hard negatives and lexical search against brute force, with
odd rows: nulls, empty and very long texts, ties, repeated rows, empty tables and
columns with clashing names."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from acctflow.llm import hard_negatives as hn
from acctflow.llm import lexical_search as ls
from acctflow.llm import sketches as sk

RNG = random.Random(5)


def words(n: int) -> str:
    return " ".join(RNG.choice(["alpha", "be", "Cat", "dög", "e9", "für", "gamma", "hé"]) + str(RNG.randrange(40)) for _ in range(n))


# --- version sketches ----------------------------------------------------------

def parts(text: str, size: int = 160) -> set[str]:
    return {line[i : i + size] for line in text.split("\n") for i in range(0, len(line), size)}


def dice(a: str, b: str) -> float:
    x, y = parts(a), parts(b)
    return 2 * len(x & y) / (len(x) + len(y)) if x or y else 1.0


def brute_versions(rows):
    ordered = sorted(rows, key=lambda r: r[0], reverse=True)
    out = []
    for at, (i, text) in enumerate(ordered):
        text, after = text or "", ordered[(at + 1) % len(ordered)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), dice(text, edited), dice(text, after)))
    return sorted(out)


def test_versions_match_brute_force(spark):
    lines = [words(12) for _ in range(60)]
    rows = [(i * 3, "\n".join(RNG.sample(lines, RNG.randrange(1, 30)))) for i in range(60)]
    rows += [(1, None), (4, ""), (7, "x"), (10, "\n\n"), (13, "ä" * 500), (16, "\n".join(words(9) for _ in range(4000)))]
    rows += [(19, rows[0][1]), (22, rows[0][1] + "\nmore")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit(1)).withColumn("own", F.lit("x"))
    got = sk.version_fingerprints(df).collect()
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in got) == brute_versions(rows)
    by_id = {r.doc_id: r.fingerprint for r in got}
    assert by_id[19] == by_id[0] != by_id[22] and by_id[1] == by_id[4]


def test_next_row_over_many_blocks(spark):
    rows = [(i, f"text {i}") for i in RNG.sample(range(100_000), 2000)] + [(None, "no id"), (None, "none")]
    got = sk.with_next(spark.createDataFrame(rows, "doc_id long, text string"), rows_per_block=7).collect()
    after = {(r.id, r.text): r.next_text for r in got}
    assert len(got) == len(rows)
    order = sorted((r for r in rows if r[0] is not None), reverse=True)
    assert all(after[a] == b[1] for a, b in zip(order, order[1:]))
    nameless = {after[order[-1]], *(t for (i, _), t in after.items() if i is None)}
    assert nameless == {"no id", "none", order[0][1]}


def test_versions_of_odd_tables(spark):
    empty = sk.version_fingerprints(spark.createDataFrame([], "doc_id long, text string"))
    assert empty.collect() == []
    (one,) = sk.version_fingerprints(spark.createDataFrame([(5, "a\nb\nc\nd")], "doc_id long, text string")).collect()
    assert (one.near_next, one.n_chars) == (1.0, 7)
    twice = spark.createDataFrame([("k", "a\nb"), ("k", "a\nb"), ("j", "c")], "doc_id string, text string")
    assert sorted((r.doc_id, r.near_next) for r in sk.version_fingerprints(twice).collect()) == [("j", 0.0), ("k", 0.0), ("k", 1.0)]


def test_peeling_recovers_the_digests_and_retries(spark):
    def some(n):
        return [RNG.randrange(1 << sk.BITS) for _ in range(n)]

    shared = some(300)
    sides = [(shared, shared), ([], []), ([], some(1)), (shared + some(3), shared + some(2)), (some(400), some(900)), (shared[:150], shared[100:])]
    # Digests that agree in the bits of all three places of small sketches.
    alike = [7 + (1 << 10) * i for i in range(40)]
    sides.append((alike[:25], alike[20:]))
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(sides)], "id long, left array<bigint>, right array<bigint>")
    got = {r.id: r for r in sk.differences(df, listed=True).collect()}
    for i, (a, b) in enumerate(sides):
        assert got[i].only_left == sorted(set(a) - set(b)) and got[i].only_right == sorted(set(b) - set(a))
        assert (got[i].n_left, got[i].n_right) == (len(got[i].only_left), len(got[i].only_right))
    assert got[0].size == got[3].size == sk.BASE and got[4].size > sk.BASE and got[6].size > 64


def test_sketch_has_no_python(spark):
    df = spark.createDataFrame([(1, "a\nb")], "doc_id long, text string")
    plan = sk.version_fingerprints(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- hard negatives --------------------------------------------------------------

def brute_negatives(rows, is_anchor, n_pos=5, n_neg=10):
    held: dict = {}
    for i, label, v in sorted((r for r in rows if None not in r and all(x is not None and math.isfinite(x) for x in r[2])), key=lambda r: (r[0], r[1])):
        held.setdefault(i, (label, [math.floor(256 * x) for x in v]))
    out = []
    for a, (label, v) in held.items():
        if not is_anchor(a):
            continue
        scores = sorted((-sum(x * y for x, y in zip(v, w)), i, other == label) for i, (other, w) in held.items() if i != a)
        for ps, p, _ in [s for s in scores if s[2]][:n_pos]:
            fit = [(-s, i) for s, i, same in scores if not same and 30 * -ps <= 100 * -s <= 90 * -ps]
            out += [(a, p, k + 1, i, -ps, s) for k, (s, i) in enumerate(fit[:n_neg])]
    return sorted(out)


VEC = "vec_id long, label int, embedding array<double>"


@pytest.mark.parametrize("shard_rows", [40, 8192])
def test_negatives_match_brute_force(spark, shard_rows):
    rng = np.random.default_rng(3)
    rows = [(i, int(rng.integers(4)), (rng.integers(-40, 40, 12) / 64).tolist()) for i in range(400)]
    rows += [(1000 + i, i % 3, rows[i % 20][2]) for i in range(60)]  # ties
    rows += [(2000, None, rows[0][2]), (2001, 1, None), (None, 1, rows[0][2]), (2002, 1, [None] + [1.0] * 11)]
    rows += [(2003, 1, [math.inf] * 12), (2004, 1, [math.nan] * 12), (2005, 2, [1e300] * 12), (2010, 1, [0.0] * 12), (2020, 2, [0.5, 0.25])]
    rows += [rows[10], rows[20], (30, 9, rows[31][2])]  # repeated rows, one id twice
    df = spark.createDataFrame(rows, VEC).withColumn("id", F.lit("x")).withColumn("score", F.lit(1))
    got = hn.hard_negatives(df, F.col("vec_id") % 10 == 0, shard_rows=shard_rows)
    fit = [r for r in rows if r[2] is None or not (r[2][0] and abs(r[2][0]) > 1e200)]
    assert sorted(map(tuple, got.collect())) == brute_negatives(fit, lambda a: a % 10 == 0)
    assert [f.dataType.simpleString() for f in got.schema.fields] == ["bigint", "bigint", "int", "bigint", "bigint", "bigint"]


def test_negatives_of_odd_tables(spark):
    assert hn.hard_negatives(spark.createDataFrame([], VEC), F.col("vec_id") % 10 == 0).collect() == []
    alone = spark.createDataFrame([(10, 1, [1.0]), (11, 2, [1.0])], VEC)
    assert hn.hard_negatives(alone, F.col("vec_id") == 10).collect() == []
    assert hn.hard_negatives(alone, F.col("vec_id") == 99).collect() == []
    same = spark.createDataFrame([(i, i % 2, [1.0, 1.0]) for i in range(300)], VEC)
    assert hn.hard_negatives(same, F.col("vec_id") == 0).collect() == []  # all scores equal: above 90 %


def test_vertical_scan_reads_less():
    rng = np.random.default_rng(1)
    base = rng.integers(10, 30, 64) * rng.choice([-1, 1], 64)
    vectors = np.where(np.arange(2000)[:, None] < 50, base, -base) + rng.integers(-2, 3, (2000, 64))
    shard = hn.Shard(np.arange(2000), np.zeros(2000, dtype=np.int64), vectors)
    sizes = []

    def keep(partial, rest_low, rest_high):
        sizes.append(len(partial))
        return partial + rest_high >= hn.kth_largest(partial, 5) + rest_low

    rows, scores = shard.scan(base, np.arange(2000), keep)
    assert sizes[0] == 2000 and sizes[-1] <= 50
    assert scores.max() == (vectors @ base).max()


# --- lexical search ----------------------------------------------------------------

def brute_search(docs, items, k=20):
    held = [(i, Counter(ls.terms(t)), len(ls.terms(t))) for i, t in docs]
    full = [h for h in held if h[2]]
    n_docs, length = len(full), sum(h[2] for h in full)
    df = Counter(t for _, c, _ in full for t in c)
    out = []
    for item, text in items:
        wanted, scores = Counter(ls.terms(text)), []
        for i, c, n in full:
            m = 75 + 25 * n * n_docs // length
            s = sum(
                r * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                for t, r in wanted.items() if c[t]
            )
            if s > 0 and i is not None:
                scores.append((-s, i))
        out += [(item, rank + 1, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def test_search_matches_brute_force(spark):
    docs = [(i, words(RNG.randrange(1, 60))) for i in range(300)]
    docs += [(1000 + i, docs[i % 5][1]) for i in range(50)]  # ties
    docs += [(2000, None), (2001, ""), (2002, "--- ?!"), (None, docs[0][1]), (7, docs[7][1]), (2003, "ALPHA1 alpha1 Ä ä" * 20_000), (2004, words(30_000))]
    items = [(i, words(RNG.randrange(1, 20))) for i in range(30)] + [(100, None), (101, "zzz"), (102, ""), (3, words(4)), (None, "be1 be2")]
    d = spark.createDataFrame(docs, DOCS).withColumn("item_id", F.lit(1)).withColumn("score", F.lit("x")).repartition(5)
    q = spark.createDataFrame(items, ITEMS).withColumn("doc_id", F.lit(1))
    for options in ({}, {"block_items": 7, "shard_rows": 40}, {"block_terms": 25}):
        got = ls.ranked_search(d, q, **options)
        assert sorted(map(tuple, got.collect()), key=str) == brute_search(docs, items)


def test_search_of_odd_tables(spark):
    none, one = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "a b")], ITEMS)
    assert ls.ranked_search(none, one).collect() == []
    assert ls.ranked_search(spark.createDataFrame([(1, "a")], DOCS), one.limit(0)).collect() == []
    assert ls.ranked_search(spark.createDataFrame([(1, None), (2, "!")], DOCS), one).collect() == []


def test_terms_are_ascii_words_and_all_else():
    assert [t.decode() for t in ls.terms("Ab-9c\tÀÉ x_y z \x7f`q")] == ["ab", "9c", "ÀÉ", "x", "y z", "q"]


def test_node_bounds_prune():
    rng = np.random.default_rng(2)
    docs = [(np.sort(rng.choice(60, 6, replace=False)) + 60 * (r % 8), rng.integers(1, 1000, 6).astype(float)) for r in range(800)]
    items = [(np.arange(5) + 60 * (i % 8), np.full(5, 3.0)) for i in range(16)]
    directions = ls.directions_of(items, 480)
    found, scored = ls.dual_tree_top(ls.Tree(items, directions, 1, np.float64), ls.Tree(docs, directions, 8, np.float32), np.arange(800), 3)
    dense = np.zeros((800, 480))
    for r, (i, v) in enumerate(docs):
        dense[r, i] = v
    for p, (i, v) in enumerate(items):
        scores = dense[:, i] @ v
        want = [(p, int(d), int(scores[d])) for d in np.lexsort((np.arange(800), -scores))[:3] if scores[d] > 0]
        assert [f for f in found if f[0] == p] == want
    assert scored < 800 * 16 / 2
