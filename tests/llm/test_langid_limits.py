"""Rejection by language identification: languages that were not learned, short
texts, one odd text among those that set a limit."""

from __future__ import annotations

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from acctflow.llm import langid

SF = "/root/testdata/sf0.1/documents.parquet"


@pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")
def test_texts_of_unlearned_languages_are_rejected(spark):
    docs = spark.read.parquet(SF).repartition(8)
    known = F.col("lang").isin("en", "fr")
    model = langid.train_on_folds(docs.where(known))
    out = langid.identify(docs, model, keep=("doc_id", "lang", "text"))
    short = F.when((F.length("text") < 150), "short").otherwise("long")
    counted = out.where("text <> '' AND lang_pred <> 'und'").groupBy(F.coalesce(known, F.lit(False)).alias("known"), short.alias("size"))
    share = {(r["known"], r["size"]): r["share"] for r in counted.agg(F.avg(F.col("accepted").cast("double")).alias("share")).collect()}
    assert share[False, "short"] <= 0.1 and share[False, "long"] <= 0.01, share
    assert share[True, "short"] >= 0.9 and share[True, "long"] >= 0.995, share


def test_one_long_text_does_not_move_a_limit(spark):
    words = "the of and that was with from they have this"
    rows = [(i, " ".join(words.split()[i % 5 : i % 5 + 4]), "en") for i in range(400)]
    odd = [*rows, (100_000, "xqz zqx " * 50_000, "en")]
    limits = []
    for held in (rows, odd):
        df = spark.createDataFrame(held, "doc_id long, text string, lang string").withColumn("one", langid.fold() == 1)
        parts = [df.where(c).select("lang", "text") for c in ("NOT one AND doc_id < 100000", "one OR doc_id >= 100000")]
        limits.append(langid.train(*parts).limits["en"])
    assert np.allclose(*limits, rtol=0.15)
