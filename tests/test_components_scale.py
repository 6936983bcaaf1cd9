"""Components in levels, ids by hash, and what the tasks and the driver hold."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from acctflow.operators import components, graph, skew


def _roots(pairs):
    parent: dict[int, int] = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        ra, rb = sorted((find(a), find(b)))
        parent[rb] = ra
    return {n: find(n) for n in parent}


def _pairs(kind, rng):
    if kind == "chains":  # as transfers: chains of ten
        name = rng.sample(range(10**9), 4000)
        return [(name[i], name[i + 1]) for i in range(3999) if i % 10 != 9]
    if kind == "dense":  # as payments: few centers, many links
        return [(rng.randrange(600), 10_000 + rng.randrange(60)) for _ in range(4000)]
    return [(i, i + 1) for i in range(1500)]  # in order: levels keep nearly all


@pytest.mark.parametrize("kind", ["chains", "dense", "ordered"])
def test_levels_find_the_components(spark, monkeypatch, kind):
    rounds = []
    plain = components.label_rounds
    monkeypatch.setattr(components, "label_rounds", lambda forest: rounds.append(1) or plain(forest))
    pairs = _pairs(kind, random.Random(5))
    edges = spark.createDataFrame(pairs, "u long, v long").repartition(8)
    got = components.bigint_components(edges, chunk=100).collect()
    assert {r.node: r.root for r in got} == _roots(pairs) and len(got) == len({r.node for r in got})
    if kind != "ordered":  # rounds write every node several times
        assert not rounds


def test_names_that_share_a_hash_stay_apart(spark, monkeypatch):
    plain, asked = graph.node_id, []

    def sharing(name, salt):
        asked.append(salt)
        return F.pmod(plain(name, salt), F.lit(3)) if salt < 2 else plain(name, salt)

    monkeypatch.setattr(graph, "node_id", sharing)
    rows = [(i, f"a{i}", f"b{i}") for i in range(20)] + [(50, "b3", "a4"), (51, "z", None)]
    out = graph.with_components(spark.createDataFrame(rows, "REF_ID long, ORIG string, BENEF string"))
    got = {r.REF_ID: r.Group for r in out.collect()}
    assert max(asked) == 2 and len(set(got.values())) == 20 and got[3] == got[4] == got[50]


def test_a_task_contracts_in_little_memory():
    rng = np.random.default_rng(1)
    sides = [rng.integers(0, 1 << 62, components.CHUNK) for _ in range(2)]
    tracemalloc.start()
    try:
        components.smallest_reached(*sides)
        assert tracemalloc.get_traced_memory()[1] < 40e6
    finally:
        tracemalloc.stop()


def test_a_long_summary_is_not_collected_for_a_broadcast(spark):
    rows = spark.range(40_000).withColumn("k", F.col("id") % 30_000)
    for n, joined_by in ((30_000, "SortMergeJoin"), (50, "BroadcastHashJoin")):
        per_key = spark.range(n).select(F.col("id").alias("k"), F.lit("x").alias("label"))
        out = skew.join_by_key(rows, per_key, ["k"])
        assert joined_by in out._jdf.queryExecution().executedPlan().toString()
        assert out.where("label IS NOT NULL").count() == sum(1 for i in range(40_000) if i % 30_000 < n)
