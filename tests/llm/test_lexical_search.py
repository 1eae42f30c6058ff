"""Ranked search against scoring every document, and bounds against scores."""

import math
import random
from collections import Counter

from tests.llm.helpers import awkward_docs, empty_docs, words
from trolley.llm.lexical_search import BLOCK_BITS, LEVELS, Block, Queries, search, stretch, term_hash, terms, width_of

import numpy as np


def cut(text):
    out, run = [], ""
    for c in (text or "") + " ":
        if c.isascii() and not c.isalnum():
            if run:
                out.append(run)
            run = ""
        else:
            run += chr(ord(c) + 32) if "A" <= c <= "Z" else c
    return out


def brute(docs, items):
    rows = [(d, cut(t)) for d, t in docs if cut(t)]
    total = sum(len(t) for _, t in rows)
    df = Counter(x for _, t in rows for x in set(t))
    out = []
    for item, text in items:
        scores = []
        for d, t in rows:
            n, m, s = Counter(t), 75 + 25 * len(t) * len(rows) // total, 0
            for x in cut(text):
                if n[x]:
                    w = math.floor(1000 * math.log((2 * len(rows) + 2) / (2 * df[x] + 1)))
                    s += w * (1_000_000_000 * n[x] // (1000 * n[x] + 12 * m))
            if s > 0:
                scores.append((-s, d is None, d))
        scores.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, k + 1, d, -s) for k, (s, _, d) in enumerate(scores[:20])]
    return sorted(out, key=repr)


def check(docs, items, **options):
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in items.collect()])
    got = sorted((tuple(r) for r in search(docs, items, **options).collect()), key=repr)
    assert got == want
    return got


def corpus(spark, seed, n):
    rng = random.Random(seed)
    common = words(rng, 12).split()
    texts = []
    for _ in range(n):
        w = words(rng, rng.randint(1, 60)).split() + [rng.choice(common) for _ in range(rng.randint(0, 80))]
        rng.shuffle(w)
        texts.append(rng.choice([" ", ", ", "-"]).join(w).title())
    rows = [(rng.randint(0, 10 * n), t) for t in texts] + [(5 * n + i, texts[0]) for i in range(n // 3)]
    items = [(f"q{i}", words(rng, rng.randint(1, 12)) + " " + " ".join(rng.choices(common, k=4))) for i in range(12)]
    items += [("none", "zzzz?"), ("blank", " .,"), ("null", None), ("again", texts[1])]
    return (
        spark.createDataFrame(rows, "doc_id long, text string").repartition(3),
        spark.createDataFrame(items, "item_id string, text string"),
    )


def test_all_documents_scored(spark):
    docs, items = corpus(spark, 3, 240)
    got = check(docs, items)
    assert len({r[0] for r in got}) >= 12
    assert check(docs, items, item_terms=30) == got  # several blocks of items


def test_awkward_and_empty(spark):
    docs = awkward_docs(spark)
    items = docs.selectExpr("cast(doc_id as string) item_id", "substr(text, 1, 80) text", "n", "size").limit(30)
    items = spark.createDataFrame(items.collect(), items.schema)
    check(docs, items)
    check(docs, items.unionByName(items.limit(2)))
    assert search(empty_docs(spark), items).count() == 0
    assert search(docs, items.where("false")).count() == 0


def test_no_score_above_its_bound():
    rng = random.Random(8)
    vocabulary = words(rng, 300).split()
    texts = [[rng.choice(vocabulary[: rng.randint(2, 300)]) for _ in range(rng.randint(1, 400))] for _ in range(60)]
    total = sum(map(len, texts))
    item = {t: (1 + i % 2, 1 + i % 40) for i, t in enumerate(sorted(set(vocabulary))[:60])}
    q = Queries({7: item}, len(texts), total)
    blocks = {}
    for i, t in enumerate(texts):
        n = Counter(t)
        counts = np.array(list(n.values()))
        width = width_of(counts)
        assert width <= BLOCK_BITS and width >= 8 * sum(v >= x for v in n.values() for x in LEVELS) / 2
        blocks.setdefault(width, Block(width)).add(i, np.array([term_hash(x) for x in n], np.uint64), counts)
    seen = 0
    for b in blocks.values():
        names = "kind term df width docs terms keys lengths most slices".split()
        for row, bound in q.bounds(dict(zip(names, b.row()))):
            for i, u in zip(b.keys, bound):
                s = q.score(row, Counter(texts[i]), stretch(len(texts[i]), len(texts), total))
                assert s <= u
                seen += s > 0
    assert seen > 30


def test_terms_follow_the_fixed_rule():
    for text in ("A-b_c É1 × x @[`{~\x7f9", "ÀÉ straße 漢字ab", ""):
        assert terms(text) == cut(text)
