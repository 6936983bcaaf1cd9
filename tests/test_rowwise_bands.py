"""Row-wise top features (R1-R6) and score bands (U1), with brute-force checks."""

from __future__ import annotations

import random

from acctflow.functions import bands, rowwise

SCHEMA = "REF_ID int, " + ", ".join(f"FEATURE{i} string, FEATURE{i}_Score double" for i in range(1, 6))


def _python_top3(names, scores):
    # The reference's semantics: a name-keyed dict built in column order (last
    # score wins, first position kept), stable sort by score descending.
    table = dict(zip(names, scores))
    ranked = sorted(table.items(), key=lambda kv: (kv[1] is None, -(kv[1] or 0)))
    ranked += [(None, None)] * 3
    return ranked[:3]


def _row(ref, names, scores):
    out = [ref]
    for n, s in zip(names, scores):
        out += [n, s]
    return tuple(out)


def test_top3_with_repeats_and_ties(spark):
    df = spark.createDataFrame(
        [_row(1, ["A", "B", "A", "C", "D"], [1.0, 5.0, 3.0, 5.0, 2.0]),
         _row(2, ["X", "X", "X", "X", "X"], [1.0, 2.0, 3.0, 4.0, 0.5])],
        SCHEMA,
    )
    got = {r.REF_ID: r for r in rowwise.with_top_features(df).collect()}
    r1 = got[1]
    assert (r1.Top1_Feature, r1.top1_val, r1.Top2_Feature, r1.top2_val, r1.Top3_Feature, r1.top3_val) == (
        "B", 5.0, "C", 5.0, "A", 3.0)
    r2 = got[2]
    assert (r2.Top1_Feature, r2.top1_val, r2.Top2_Feature, r2.Top3_Feature) == ("X", 0.5, None, None)


def test_top3_matches_brute_force(spark):
    rng = random.Random(7)
    rows = []
    for ref in range(300):
        names = [rng.choice(["a", "b", "c", "d", "e", "f", None]) for _ in range(5)]
        scores = [rng.choice([1.0, 2.0, 3.0, 4.0, 5.0, None]) for _ in range(5)]
        rows.append(_row(ref, names, scores))
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.REF_ID: r for r in rowwise.with_top_features(df).collect()}
    via_array = {r.REF_ID: r for r in rowwise.with_top_features_array(df).collect()}
    assert got == via_array
    for row in rows:
        names, scores = list(row[1::2]), list(row[2::2])
        want = _python_top3(names, scores)
        r = got[row[0]]
        have = [(r.Top1_Feature, r.top1_val), (r.Top2_Feature, r.top2_val), (r.Top3_Feature, r.top3_val)]
        # Null names make a real (None, score) entry; padding is (None, None).
        assert have == want, (row, have, want)


def test_top_values_matching_names_and_long_form(spark):
    df = spark.createDataFrame([_row(1, list("ABCDE"), [3.0, 5.0, 5.0, 1.0, 3.0])], SCHEMA)
    tv = rowwise.with_top_values(df).collect()[0]
    assert (tv.top1_val, tv.top2_val, tv.top3_val) == (5.0, 5.0, 3.0)
    m = rowwise.with_matching_names(rowwise.with_top_values(df), {"top1": "top1_val", "top3": "top3_val"})
    r = m.collect()[0]
    assert r.top1 == ["FEATURE2_Score", "FEATURE3_Score"]
    assert r.top3 == ["FEATURE1_Score", "FEATURE5_Score"]
    long = rowwise.features_long(df, ["REF_ID"]).orderBy("pos").collect()
    assert [(x.pos, x.name, x.score) for x in long] == [
        (1, "A", 3.0), (2, "B", 5.0), (3, "C", 5.0), (4, "D", 1.0), (5, "E", 3.0)]


def test_score_bands(spark):
    # Both sides of every bound, and scores in no band.
    want = {-5: "1", 30: "1", 31: "2", 45: "2", 46: "2", 60: "2", 61: "3", 75: "3", 76: "4", 100: "4", 101: None, None: None}
    df = spark.createDataFrame([(s,) for s in want], "Scores long")
    assert {r.Scores: r["rank"] for r in bands.with_band(df).collect()} == want
