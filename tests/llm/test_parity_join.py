"""The parity-sketch join against brute force."""

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.helpers import awkward_docs, empty_docs
from tests.llm.test_search import brute_components, near_corpus
from trolley.llm import parity_join as pj


def components(docs):
    return {r["doc_id"]: r["component_id"] for r in pj.parity_join(docs).collect()}


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 400), st.integers(0, 60), st.integers(0, 60), st.integers(0, 1 << 30))
def test_linked_sets_meet_in_an_indexed_part(common, left, right, seed):
    rng = np.random.default_rng(seed)
    h = np.unique(rng.integers(0, 1 << 63, common + left + right, dtype=np.uint64))
    rng.shuffle(h)
    a, b = h[: common + left], np.concatenate([h[:common], h[common + left :]])
    tag = max(pj.band(len(a)), pj.band(len(b)))
    x, y = pj.sketch(a, tag), pj.sketch(b, tag)
    assert len(x) == pj.parts(tag)[0]
    apart = int(np.bitwise_count(x ^ y).sum())
    assert apart <= left + right and (apart - left - right) % 2 == 0
    if 100 * common < pj.PERCENT * (common + left + right):
        return
    assert left + right <= pj.most_different(len(a), len(b))
    assert abs(pj.band(len(a)) - pj.band(len(b))) <= 1
    indexed = np.full(len(x), pj.all_parts(x, tag) and pj.all_parts(y, tag)) | (np.bitwise_count(x) >= pj.LIGHT)
    assert ((x == y) & indexed).any()


def test_bands_hold_every_size():
    for n in range(1, 3000):
        assert pj.STARTS[pj.band(n)] <= n < pj.STARTS[pj.band(n) + 1]
        assert pj.band(100 * n // pj.PERCENT) - pj.band(n) <= 1


def test_against_brute_force(spark):
    docs = near_corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    want, _ = brute_components(docs, pj.PERCENT)
    assert components(df) == want
    assert len(set(want.values())) < len(want)


def test_sizes_follow_the_contract(spark):
    rows = [(1, "a b c d"), (2, "A B  c"), (3, "one two"), (4, "One\ttwo"), (5, "x"), (6, ""), (7, None), (8, "a b c a b c")]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in pj.parity_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (2, 1), 2: (1, 2), 3: (1, 3), 4: (1, 3), 5: (1, 5), 6: (0, 6), 7: (0, 7), 8: (3, 8)}


def dense_corpus(seed, n, words, edits):
    """Copies of few texts with some words changed: most pairs are near the threshold, on both sides of it."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        base = [f"w{i % 2}x{k}" for k in range(words)]
        for _ in range(rng.randint(0, edits)):
            base[rng.randrange(words)] = f"e{rng.randrange(10**6)}"
        out.append((i, " ".join(base)))
    return out


def test_dense_nodes_by_pivots_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(pj, "SMALL", 2)
    monkeypatch.setattr(pj, "STAR", 7)
    monkeypatch.setattr(pj, "BLOCK_SHINGLES", 2_000)
    monkeypatch.setattr(pj, "TILE", 8)
    for seed, edits in ((1, 4), (2, 9)):
        docs = dense_corpus(seed, 150, 120, edits)
        df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
        want, _ = brute_components(docs, pj.PERCENT)
        assert components(df) == want
    assert 2 < len(set(want.values())) < 140


def test_awkward_and_empty(spark):
    docs = awkward_docs(spark)
    rows = pj.parity_join(docs).collect()
    assert len(rows) == docs.count()
    plain = [(r["doc_id"], r["text"]) for r in docs.dropDuplicates(["doc_id"]).where("doc_id is not null").collect()]
    want = brute_components(plain, pj.PERCENT)[0] | {None: None}
    assert all(r["component_id"] == want[r["doc_id"]] for r in rows)
    assert pj.parity_join(empty_docs(spark)).count() == 0
