"""The compression verdict against a plain restatement, and what it does to labelled texts."""

from __future__ import annotations

import os
import random

import pytest
import zstandard
from pyspark.sql import functions as F

from acctflow.llm import quality

RNG = random.Random(9)


def restated(text: str) -> tuple[float, int, int, bool]:
    raw, bands = text.encode(), quality.Bands()
    if not raw:
        return 0.0, 0, 0, False

    def ratio(part: bytes) -> float:
        return len(part) / len(zstandard.ZstdCompressor(level=3).compress(part))

    def fits(part: bytes) -> bool:
        for top, low, high in bands.whole:
            if len(part) <= top:
                return low <= ratio(part) <= high
        raise AssertionError

    parts = [raw[i : i + 4096] for i in range(0, len(raw), 4096)]
    full = [p for p in parts if len(p) == 4096]
    verdicts = [1.93 <= ratio(p) <= 2.3 for p in full]
    if full and 512 <= len(parts[-1]) < 4096:
        verdicts.append(fits(parts[-1]))
    wrong = verdicts.count(False)
    return ratio(raw), len(verdicts), wrong, not fits(raw) or bool(verdicts) and 2 * wrong >= len(verdicts)


def test_verdict_equals_the_restated_rule(spark):
    docs = [t or "" for (t,) in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    joined = " ".join(docs)
    docs += [joined[: RNG.randrange(1, 40_000)] for _ in range(60)] + ["x" * n for n in (1, 255, 4096, 4097, 9000)]
    docs += [RNG.randbytes(n).hex() for n in (100, 2048, 2304, 6000, 40_000)] + ["", "é" * 3000, joined[:4096], joined[:8192], joined * 3]
    made = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    for r in quality.quality(made).collect():
        ratio, chunks, bad, rejected = restated(docs[r.doc_id])
        assert (r.ratio, r.n_chunks, r.n_bad_chunks, r.kept) == (ratio, chunks, bad, not (r.base_failed or rejected))


def test_one_chunk_and_tails_are_judged():
    compressor = zstandard.ZstdCompressor(level=3)
    noise = RNG.randbytes(8192).hex()
    assert quality.band_verdict(noise[:4096].encode(), quality.Bands(), compressor)[1:] == (1, 1, True)
    assert quality.band_verdict((noise[:4096] + "x" * 600).encode(), quality.Bands(), compressor)[1:] == (2, 2, True)
    assert quality.band_verdict(noise[:4500].encode(), quality.Bands(), compressor)[1:] == (1, 1, True)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="test data not present")
def test_bands_reject_bad_texts_and_keep_good_ones(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id % 2 = 1")
    marked = docs.join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").repartition(8)
    judged = quality.quality(marked, keep=("text", "quality")).where("NOT base_failed")
    rows = judged.groupBy("quality").agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("kept"), 0).otherwise(1)).alias("gone"))
    found = {r.quality: (r.gone, r.n) for r in rows.collect()}
    assert found[0][0] >= 100 and found[1][0] <= 0.01 * found[1][1], found
