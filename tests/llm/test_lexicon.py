"""The attack lexicon against a plain version, and on tables that grow."""

import math
import random
import re

from pyspark.sql import functions as F

from tests.llm.helpers import words
from trolley.llm import toxicity
from trolley.llm.common import held_out

STEMS = "zorg blim".split()  # attack words are these stems with endings


def corpus(n, seed, copies=1):
    """(doc_id, text, toxic) rows: toxic texts hold attack words, some clean ones an ordinary word that is often toxic."""
    rng = random.Random(seed)
    endings = words(rng, 12).split()
    base = []
    for i in range(n):
        w = words(rng, rng.randint(10, 40)).split()
        tox = i % 9 == 0
        if tox:
            w += [rng.choice(STEMS) + rng.choice(endings) for _ in range(rng.randint(1, 3))]
        if tox or i % 5 == 0:
            w.append("commonplace")
        base.append((w, int(tox)))
    rows = []
    for c in range(copies):
        for i, (w, tox) in enumerate(base):
            w = list(w)
            rng.shuffle(w)  # every copy gives its words other neighbours
            rows.append((c * n + i, " ".join(w) + rng.choice([".", "!", " end"]), tox))
    return rows


def frames(spark, rows):
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows], "doc_id long, quality int, toxic int")
    return docs, labels


def units(text):
    out, before = {}, ""
    for w in re.findall(r"[^\W\d_]+", text.lower()):
        if w not in out:
            out[w] = before
            for k in range(4, 10):
                if len(w) > k:
                    out.setdefault(w[:k] + "*", before)
        before = w
    return out


def plain_lexicon(rows, learnt, in_fold, base):
    """The same rules over lists; ``learnt``: doc_ids outside the held-out fold, ``in_fold``: those of the lexicon."""
    contexts, counts = {}, {}
    for i, text, y in rows:
        if i in learnt and i in in_fold:
            for u, c in units(text).items():
                counts.setdefault(u, [0, 0])[y] += 1
                if y:
                    contexts.setdefault(u, set()).add(c)
    contexts = {u: len(c) for u, c in contexts.items() if len(c) >= 4}
    need = next(n for n in range(1, 65) if len(contexts) * base**n < 0.5 or n == 64)
    contexts = {u: c for u, c in contexts.items() if c >= need}
    good = set()
    for u, c in contexts.items():
        clean, toxic = counts[u]
        share, n = toxic / (clean + toxic), c * (clean + toxic) / toxic
        z = 1.96
        low = (c / n + z * z / (2 * n) - z * math.sqrt(c / n * (1 - c / n) / n + z * z / (4 * n * n))) / (1 + z * z / n)
        m = max(c, math.ceil(n))
        tail = sum(math.comb(m, i) * base**i * (1 - base) ** (m - i) for i in range(c, m + 1))
        if share >= 0.9 and low >= 0.5 and len(contexts) * tail < 0.5:
            good.add(u)
    prefixes = {u[:-1] for u in good if u[-1] == "*"}
    prefixes = {p for p in prefixes if not any(p[:k] in prefixes for k in range(4, len(p)))}
    ok = {u for u in good if u[-1] != "*"}
    ok |= {w for w in toxicity.SEED_ATTACKS if counts.get(w, [0, 0])[1] >= 0.9 * sum(counts.get(w, [0, 0]))}
    return {w for w in ok if not any(w[:k] in prefixes for k in range(4, 10))}, prefixes


def folds(spark, rows):
    ids = spark.createDataFrame([(r[0],) for r in rows], "doc_id long")
    apart = F.pmod(F.xxhash64(F.lit(13), "doc_id"), F.lit(3)) == 0
    got = ids.select("doc_id", held_out(F.col("doc_id")).alias("h"), apart.alias("a")).collect()
    return {r["doc_id"] for r in got if not r["h"]}, {r["doc_id"] for r in got if not r["a"]}


def test_lexicon_against_a_plain_version(spark):
    rows = corpus(900, 3)
    learnt, fold = folds(spark, rows)
    kinds = [y for i, _, y in rows if i in learnt]
    base = sum(kinds) / len(kinds)
    want = plain_lexicon(rows, learnt, learnt, base)
    model = toxicity.fit(*frames(spark, rows))
    assert (set(model.lexicon.words), set(model.lexicon.prefixes)) == want
    docs = frames(spark, rows)[0]
    some = [(i, t, y, i not in fold) for i, t, y in rows if i in learnt]
    df = spark.createDataFrame(some, "doc_id long, text string, y int, apart boolean")
    both = toxicity.learn_lexicons(docs, df.drop("text"), df.drop("doc_id"), {0: kinds.count(0), 1: kinds.count(1)})
    assert both[0] == model.lexicon
    assert (set(both[1].words), set(both[1].prefixes)) == plain_lexicon(rows, learnt, fold, base)
    assert set(STEMS) <= want[1] and not model.lexicon.weight("commonplace")


def test_no_contradicted_unit_however_large_the_table(spark):
    for copies in (1, 10, 30):
        rows = corpus(300, 5, copies)
        learnt, _ = folds(spark, rows)
        got = toxicity.fit(*frames(spark, rows), per_class=150).lexicon
        for u in [*got.words, *(p + "*" for p in got.prefixes)]:
            held = [y for i, t, y in rows if i in learnt and u in units(t)]
            assert u in toxicity.SEED_ATTACKS or sum(held) >= 0.9 * len(held), (copies, u)
        assert all(got.weight(s + "ing") or copies == 1 for s in STEMS)


def test_labels_without_a_document_count_nowhere(spark):
    rows = corpus(300, 7)
    docs, labels = frames(spark, rows)
    more = spark.range(10_000, 14_000).selectExpr("id as doc_id", "1 as quality", "cast(id % 2 as int) as toxic")
    one, two = toxicity.fit(docs, labels), toxicity.fit(docs, labels.union(more))
    assert one.lexicon == two.lexicon and (one.weights == two.weights).all()
