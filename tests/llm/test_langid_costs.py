"""Costs of words under the models: each n-gram of a block is looked up once, and
the costs are those of looking up every character of every word."""

from __future__ import annotations

import random

import numpy as np

from acctflow.llm import langid


def _plain(model: langid.Model, word: str) -> np.ndarray:
    """A word's costs, character by character."""
    _, points, at, _ = langid.framed([word])
    cost = np.zeros(len(model.langs))
    for i in at:
        p, one = np.full(len(model.langs), 1.0 / langid.ALPHABET), np.array([i])
        for size in range(1, langid.ORDER + 1):
            weight = model.look_up(langid.gram_hashes(points, one - 1, size - 1, langid.CONTEXT), 1.0)[0]
            p = model.look_up(langid.gram_hashes(points, one, size, langid.GRAM), 0.0)[0] + weight * p
        cost -= np.log(p)
    return cost


def test_each_gram_of_a_block_is_looked_up_once(spark):
    rows = spark.createDataFrame([("xx", "ab ab abc ba cab"), ("yy", "ba bab été 漢字")], "lang string, text string")
    model = langid.train(rows, rows.limit(0))
    rng = random.Random(7)
    words = ["".join(rng.choices("abcé漢", k=rng.randint(1, 9))) for _ in range(300)] * 20 + ["ab" * 5000, "😀"]
    plain = {w: _plain(model, w) for w in {*words[:300], *words[-1:]}}
    searched, look_up = [0], model.look_up

    def counted(hashes, unseen):
        searched[0] += len(hashes)
        return look_up(hashes, unseen)

    model.look_up = counted
    costs, n = model.word_costs(words)
    pads = ["   " + w + " " for w in words]
    grams = {p[i : i + langid.ORDER] for p in pads for i in range(len(p) - langid.ORDER + 1)}
    assert searched[0] <= 2 * langid.ORDER * len(grams)
    assert n.tolist() == [len(w) + 1 for w in words]
    for w, cost in zip(words, costs):
        if w in plain:
            assert np.allclose(cost, plain[w], rtol=1e-12)
    # The memo gives a text the sums of its words.
    scorer = langid.Scorer(model, size=50)
    texts = [" ".join(words[i : i + 7]) + ", " + words[i].upper() for i in range(0, 300, 7)]
    costs, n = scorer.texts([*texts, "", "12 --"])
    for t, cost, k in zip(texts, costs, n):
        own = [w for c in t.lower().split() for w in langid.words_of(c)]
        assert k == sum(len(w) + 1 for w in own)
        assert np.allclose(cost * k, sum(plain[w] for w in own), rtol=1e-12)
    assert n[-2:].tolist() == [0, 0] and not costs[-2:].any()
