"""A bounded labelled sample must not change the classes' shares that the toxicity model learns."""

import random

import numpy as np
import pytest

from tests.llm.helpers import words
from trolley.llm import toxicity

NO_LABELS = "doc_id long, quality int, toxic int"


def rare_corpus(spark, n=3000):
    """A tenth is toxic and says "zorgula"; so does every 25th clean text, so 27 % of its documents are clean."""
    rng = random.Random(8)
    docs, labels = [], []
    for i in range(n):
        tox = i % 10 == 1
        w = words(rng, 12).split(" ")
        for x in ["zorgula"] * (tox or i % 25 == 2) + ["blimfox"] * tox:
            w.insert(rng.randrange(1, len(w) + 1), x)
        docs.append((i, " ".join(w)))
        labels.append((i, 1, int(tox)))
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(labels, NO_LABELS)


def test_thinned_class_keeps_its_share(spark):
    docs, labels = rare_corpus(spark)
    whole, thin = (toxicity.fit(docs, labels, per_class=k) for k in (None, 300))
    for m in (whole, thin):
        assert m.lexicon.weight("blimfox") and not m.lexicon.weight("zorgula")
    none = np.zeros((1, len(toxicity.KINDS)))
    assert toxicity.score_of(none, thin.weights)[0] == pytest.approx(toxicity.score_of(none, whole.weights)[0], abs=0.02)


def test_weights_of_a_thinned_sample():
    """A sample of 1:1 from classes of 1:19: the score of an unmatched text is the share before thinning."""
    rng = np.random.default_rng(1)
    y = np.repeat([0.0, 1.0], [3000, 3000])
    counts = np.zeros((6000, len(toxicity.KINDS)))
    counts[rng.random(6000) < 0.1, 0] = 1.0
    w = toxicity.fit_weights(counts, y, np.where(y == 1, 1.0, 19.0))
    assert toxicity.score_of(np.zeros((1, len(toxicity.KINDS))), w)[0] == pytest.approx(0.05, abs=0.01)
