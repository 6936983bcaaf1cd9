"""Connected components (G1), alert keys (W1-W3, P9) and the alert report."""

from __future__ import annotations

import datetime as dt
import random

from acctflow.operators import alerts, graph

EDGE_SCHEMA = "REF_ID long, ORIG string, BENEF string"


def _python_labels(rows):
    """First-appearance component labels by union-find, rows read by REF_ID."""
    parent: dict[str, str] = {}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    ordered = sorted(rows, key=lambda r: r[0])
    for _, a, b in ordered:
        for n in (a, b):
            if n is not None:
                parent.setdefault(n, n)
        if a is not None and b is not None:
            ra, rb = find(a), find(b)
            if ra != rb:
                parent[ra] = rb
    labels: dict[str, str] = {}
    for _, a, _b in ordered:
        if a is not None:
            labels.setdefault(find(a), f"G{len(labels) + 1}")
    return labels, find


def test_components_chain_and_pair(spark):
    rows = [(10 + i, f"t{i}", f"t{i + 1}") for i in range(5)] + [(3, "pair", "other"), (40, "t5", "t0")]
    out = graph.with_components(spark.createDataFrame(rows, EDGE_SCHEMA))
    assert out.columns == ["REF_ID", "ORIG", "BENEF", "Group"]
    assert {r.REF_ID: r.Group for r in out.collect()} == {ref: "G1" if ref == 3 else "G2" for ref, _, _ in rows}


def test_components_untrimmed_nulls_and_self_loops(spark):
    rows = [(1, " Eric", "Eric"), (2, "Eric", "Lo"), (3, "Solo", None), (4, None, "Eric"),
            (5, "Loop", "Loop"), (6, " Eric", "Zed")]
    got = {r.REF_ID: r.Group for r in graph.with_components(spark.createDataFrame(rows, EDGE_SCHEMA)).collect()}
    assert got == {1: "G1", 2: "G1", 3: "G2", 4: None, 5: "G3", 6: "G1"}


def test_components_match_union_find(spark):
    rng = random.Random(11)
    nodes = [f"n{i}" for i in range(120)]
    rows = []
    for ref in range(150):
        a = rng.choice(nodes)
        b = None if rng.random() < 0.05 else rng.choice(nodes)
        rows.append((ref * 3 % 151, a, b))
    # a long chain forces several rounds
    rows += [(1000 + i, f"c{i}", f"c{i + 1}") for i in range(60)]
    out = graph.with_components(spark.createDataFrame(rows, EDGE_SCHEMA))
    labels, find = _python_labels(rows)
    got = {(r.REF_ID, r.ORIG, r.BENEF): r.Group for r in out.collect()}
    for ref, a, b in rows:
        if a is None:
            assert got[(ref, a, b)] is None
        else:
            # Labels follow the smallest REF_ID per component; equal REF_IDs are
            # not produced here, so the numbering must agree exactly.
            assert got[(ref, a, b)] == labels[find(a)], (ref, a, b)


ALERT_SCHEMA = "REF_ID long, ORIG string, BENEF string, Group string, TOTAL_Score long, PAYMENT_DATE string"


def _scored(spark, rows):
    """(ref, group, score, day) rows; ORIG is o<ref>, BENEF b<ref>."""
    made = [(ref, f"o{ref}", f"b{ref}", g, s, d) for ref, g, s, d in rows]
    return spark.createDataFrame(made, ALERT_SCHEMA.replace("Score long", "Score double"))


def test_alert_key_unfilled_and_filled(spark):
    df = _scored(spark, [(1, "A", 4.0, "2020-03-01"), (2, "A", 8.0, "2020-04-01"), (3, "A", 8.0, "2020-02-01"), (4, "B", 1.0, "2020-01-01")])
    unfilled = {r.REF_ID: r.Alert_Key for r in alerts.with_alert_key(df).collect()}
    assert unfilled == {1: None, 2: None, 3: "o3", 4: "o4"}
    filled = {r.REF_ID: r.Alert_Key for r in alerts.with_alert_key(df, fill=True).collect()}
    assert filled == {1: "o3", 2: "o3", 3: "o3", 4: "o4"}


def test_alert_key_nan_is_the_greatest_score(spark):
    df = _scored(spark, [(1, "A", float("nan"), "2020-03-01"), (2, "A", 5.0, "2020-01-01")])
    assert {r.REF_ID: r.Alert_Key for r in alerts.with_alert_key(df).collect()} == {1: "o1", 2: None}


def test_alert_key_full_ties_and_nulls(spark):
    rows = [(1, "a", "x", "G1", 9, "2020-01-01"), (2, "b", "x", "G1", 9, "2020-01-01"),
            (3, "c", "x", "G1", 9, None), (4, "d", "y", "G2", None, "2020-01-01"),
            (5, "e", "z", "G3", 7, None)]
    df = spark.createDataFrame(rows, ALERT_SCHEMA)
    got = {r.REF_ID: r.Alert_Key for r in alerts.with_alert_key(df).collect()}
    assert got == {1: "a", 2: "b", 3: None, 4: None, 5: None}
    filled = {r.REF_ID: r.Alert_Key for r in alerts.with_alert_key(df, fill=True).collect()}
    assert filled == {1: "a", 2: "a", 3: "a", 4: None, 5: None}


FEATURE_SCHEMA = (
    "REF_ID int, ORIG string, BENEF string, "
    + ", ".join(f"FEATURE{i} string, FEATURE{i}_Score double" for i in range(1, 6))
    + ", TOTAL_Score double, PAYMENT_DATE timestamp, MONTH int"
)


def _feat(ref, orig, benef, scores, total, day):
    names = ["Credit", "Transfer", "HighRisk", "Lease", "Deposit"]
    row = [ref, orig, benef]
    for n, s in zip(names, scores):
        row += [n, float(s)]
    return tuple(row + [float(total), dt.datetime(2021, 1, day), 1])


def test_alert_report(spark):
    rows = [
        _feat(1, "A", "B", [5, 4, 3, 2, 1], 17, 5),
        _feat(2, "B", "C", [1, 2, 3, 4, 5], 21, 9),
        _feat(3, "C", "D", [3, 3, 3, 3, 3], 21, 3),   # same top score, earlier date -> key
        _feat(4, "E", "F", [2, 2, 5, 5, 1], 16, 1),
        _feat(5, "X", "Y", [1, 1, 1, 1, 1], 10, 1),   # below the threshold
    ]
    report = alerts.alert_report(spark.createDataFrame(rows, FEATURE_SCHEMA), "TOTAL_Score", 15)
    assert report.columns == alerts.REPORT_COLUMNS
    got = {r.REF_ID: r for r in report.collect()}
    assert sorted(got) == [1, 2, 3, 4]
    assert {k: got[k].Group for k in got} == {1: "G1", 2: "G1", 3: "G1", 4: "G2"}
    assert {k: got[k].Alert_Key for k in got} == {1: None, 2: None, 3: "C", 4: "E"}
    assert (got[1].Top1_Feature, got[1].top1_val) == ("Credit", 5.0)
    for k in (1, 2, 3):
        assert (got[k].alert_Top1_Feature, got[k].alert_top1_val) == ("Credit", 3.0)
        assert (got[k].alert_Top3_Feature, got[k].alert_top3_val) == ("HighRisk", 3.0)
    assert (got[4].alert_Top1_Feature, got[4].alert_Top2_Feature, got[4].alert_Top3_Feature) == (
        "HighRisk", "Lease", "Credit")
    filled = alerts.alert_report(spark.createDataFrame(rows, FEATURE_SCHEMA), "TOTAL_Score", 15, fill_key=True)
    assert {r.REF_ID: r.Alert_Key for r in filled.collect()} == {1: "C", 2: "C", 3: "C", 4: "E"}


def test_copy_when_present(spark):
    from acctflow.functions.columns import copy_when_present

    df = spark.createDataFrame([(1, "k", "x", 2.0), (2, None, "y", 3.0)], "id int, Alert_Key string, f string, v double")
    out = copy_when_present(df, {"alert_f": "f", "alert_v": "v"})
    assert sorted((r.id, r.alert_f, r.alert_v) for r in out.collect()) == [(1, "x", 2.0), (2, None, None)]


def test_components_trim_option(spark):
    rows = [(1, " Ann", "Bo"), (2, "Ann", " Cy"), (3, "Cy ", "Dee"), (4, "Eve", " Fay")]
    df = spark.createDataFrame(rows, EDGE_SCHEMA)
    untrimmed = {r.REF_ID: r.Group for r in graph.with_components(df).collect()}
    trimmed = {r.REF_ID: r.Group for r in graph.with_components(df, trim=True).collect()}
    assert untrimmed == {1: "G1", 2: "G2", 3: "G3", 4: "G4"}
    assert trimmed == {1: "G1", 2: "G1", 3: "G1", 4: "G2"}
    # the rows keep their own spelling
    assert sorted(r.ORIG for r in graph.with_components(df, trim=True).collect()) == [" Ann", "Ann", "Cy ", "Eve"]


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_node = st.one_of(st.none(), st.sampled_from([f"x{i:02d}" for i in range(25)]))


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(_node, _node), min_size=1, max_size=40))
def test_components_property(spark, pairs):
    rows = [(i * 7 + 1, a, b) for i, (a, b) in enumerate(pairs)]
    out = graph.with_components(spark.createDataFrame(rows, EDGE_SCHEMA))
    labels, find = _python_labels(rows)
    got = {r.REF_ID: r.Group for r in out.collect()}
    assert len(got) == len(rows)
    for ref, a, _b in rows:
        assert got[ref] == (None if a is None else labels[find(a)])


def test_customer_feature_job_writes_sorted_report(spark, tmp_out):
    import os

    from acctflow.plans import jobs

    rows = [
        _feat(7, "A", "B", [5, 4, 3, 2, 1], 17, 5),
        _feat(3, "B", "C", [1, 2, 3, 4, 5], 21, 9),
        _feat(5, "X", "Y", [1, 1, 1, 1, 1], 10, 1),
    ]
    out = jobs.customer_feature_job(spark.createDataFrame(rows, FEATURE_SCHEMA), tmp_out, threshold=15)
    report = out["AlertReport"]
    assert [r.REF_ID for r in report.collect()] == [3, 7]
    written = spark.read.parquet(os.path.join(tmp_out, "AlertReport"))
    assert written.columns == alerts.REPORT_COLUMNS
    assert written.count() == 2


def test_contraction_and_rounds_match_union_find(spark):
    """The same roots from one chunk, from many small chunks and from rounds."""
    from acctflow.operators.components import bigint_components

    rng = random.Random(3)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)]
    pairs += [(1000 + i, 1001 + i) for i in range(300)] + [(5000, 5001 + i) for i in range(300)]  # a chain, a hub
    pairs += [(None, 3), (4, None), (7, 7), pairs[0], pairs[0][::-1]]
    parent: dict[int, int] = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None and a != b:
            ra, rb = sorted((find(a), find(b)))
            parent[rb] = ra
    want = {n: find(n) for n in parent}
    edges = spark.createDataFrame(pairs, "u long, v long").repartition(6)
    for chunk in (1 << 20, 2000, 20):
        assert {r.node: r.root for r in bigint_components(edges, chunk=chunk).collect()} == want
    assert bigint_components(edges.limit(0)).count() == 0


def test_components_take_few_jobs(spark):
    """A chain of 3000 nodes is contracted, not walked."""
    rows = spark.range(3000).selectExpr("id AS REF_ID", "concat('n', id) AS ORIG", "concat('n', id + 1) AS BENEF").repartition(8)
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    assert graph.with_components(rows).select("Group").distinct().count() == 1
    assert len(set(tracker.getJobIdsForGroup(None)) - before) <= 40


# The report of a 17-row file at threshold 15, spaces as in the
# file. REF_ID, ORIG, BENEF, score, day (ours, consistent with the keys), group, key,
# the three top features, and the REF_ID whose top features the group carries.
# C, D, H, L, T: Credit, Deposit, HighRisk, Lease, Transfer.
GOLDEN = [
    (1, " Meruem", "Eric", 17, 5, "G1", None, "C5 T4 H3", 3),
    (2, " Reiner", " Meruem", 15, 1, "G1", None, "H5 C4 D3", 3),
    (3, " Eric", " Elric", 21, 9, "G1", " Eric", "L5 C5 H5", 3),
    (4, " Elric", " Meruem", 15, 2, "G1", None, "C4 T4 L3", 3),
    (6, " Sanjay", "Prakash", 18, 3, "G2", " Sanjay", "C5 T5 H4", 6),
    (8, " Suman", " Sanjay", 18, 4, "G2", None, "T5 C4 H4", 6),
    (9, " Robert", " Edward", 19, 1, "G3", " Robert", "T5 D4 L4", 9),
    (10, " Daniel", "Robert", 16, 1, "G4", " Daniel", "L5 H5 T3", 10),
    (11, " Alphonse", "Daniel", 19, 1, "G5", " Alphonse", "T5 C4 H4", 11),
    (13, " Anshuman", "Prateek", 20, 1, "G6", " Anshuman", "H5 C5 L5", 13),
    (16, "Prateek", "Raksha", 16, 1, "G6", None, "D5 H4 C3", 13),
    (17, "Eren", "Nagato", 15, 1, "G7", None, "H4 C4 L4", 20),
    (18, "Genos", "Eren", 17, 1, "G7", None, "D5 L4 H3", 20),
    (20, "Stephen", "Genos", 19, 8, "G7", "Stephen", "C4 D4 T4", 20),
    (21, "Tachibana", "Krishna", 17, 7, "G8", None, "D5 T4 H3", 23),
    (23, "Krishna", "Tim", 17, 6, "G8", "Krishna", "D5 H5 C4", 23),
    (24, "Chang", "Tachibana", 16, 1, "G8", None, "H5 D4 L3", 23),
]
NAMES = {"C": " Credit", "D": " Deposit", "H": "HighRisk", "L": "Lease", "T": " Transfer"}


def _top(code):
    return [x for c in code.split() for x in (NAMES[c[0]], float(c[1]))]


def test_report_of_the_golden_rows(spark):
    rows = []
    for ref, orig, benef, total, day, _, _, top, _ in GOLDEN:
        rest = [x for n in NAMES if n not in top for x in (NAMES[n], 1.0)]
        rows.append((ref, orig, benef, *_top(top), *rest, float(total), dt.datetime(2021, 3, day), 3))
    rows.append((5, "low", "Eric", *rows[0][3:13], 14.0, dt.datetime(2021, 3, 1), 3))
    report = alerts.alert_report(spark.createDataFrame(rows, FEATURE_SCHEMA), "TOTAL_Score", 15)
    got = {r.REF_ID: r for r in report.collect()}
    tops = {g[0]: _top(g[7]) for g in GOLDEN}
    assert sorted(got) == [g[0] for g in GOLDEN]
    for ref, _, _, _, _, group, key, _, carried in GOLDEN:
        r = got[ref]
        assert (r.Group, r.Alert_Key) == (group, key), ref
        assert [r[f"{p}{i}{s}"] for i in (1, 2, 3) for p, s in (("Top", "_Feature"), ("top", "_val"))] == tops[ref]
        assert [r[f"alert_{p}{i}{s}"] for i in (1, 2, 3) for p, s in (("Top", "_Feature"), ("top", "_val"))] == tops[carried]
