import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import awkward_docs, empty_docs, words
from trolley.llm import quality_model, quality_rules, toxicity
from trolley.llm.common import held_out, labelled

NO_LABELS = "doc_id long, quality int, toxic int"


def corpus(spark, seed=2, n=400):
    """Clean texts, toxic ones (an attack word among the words) and junk, all labelled."""
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        t = words(rng, rng.randint(20, 80)) + "."
        tox = i % 4 == 1
        bad = i % 4 == 2
        if tox:
            w = t.split(" ")
            for _ in range(2):
                w.insert(rng.randrange(len(w)), rng.choice(["idiot", "scum", "zorgu" + rng.choice(["la", "mi", "ne"])]))
            t = " ".join(w)
        if bad:
            t = " ".join(x + rng.choice(["###", "&&&", "***"]) for x in t.split(" "))
        docs.append((i, t))
        labels.append((i, 0 if bad else 1, int(tox)))
    labels += [(None, 1, 1), (n + 5, None, None), (3, 1, 0)]
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(labels, NO_LABELS)


def test_held_out_fold(spark):
    import zlib

    rows = spark.range(200).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 4 == 2) for r in rows)
    docs, labels = corpus(spark)
    assert labelled(docs, labels, "toxic").where(held_out(F.col("doc_id"))).count() == 0
    assert labelled(docs, labels, "toxic", 10).groupBy("y").count().agg(F.max("count")).first()[0] <= 10


def brute_kinds(clause, is_attack):
    """The grammar's meaning, written without machines."""
    out, named, reported, since = [], False, False, 99
    for w in re.findall(r"[^\W\d_]+", clause):
        attack = is_attack(w)
        since += 1
        if attack:
            kind = "plain"
            kind = "aimed" if named else kind
            kind = "negated" if since <= toxicity.NEGATION_REACH else kind
            kind = "reported" if reported else kind
            out.append(kind)
        elif w in toxicity.NEGATIONS:
            since = 0
        elif w in toxicity.REPORTS:
            reported = True
        elif w in toxicity.TARGETS:
            named = True
    return out


def test_grammar_against_brute_force():
    rng = random.Random(3)
    lexicon = toxicity.Lexicon({"idiot": 0.9}, {"zorgu": 0.8})
    for _ in range(500):
        clause = " ".join(rng.choice("idiot zorgula you not said a b c d".split()) for _ in range(rng.randint(0, 9)))
        got = [k for k, _ in toxicity.clause_kinds(clause, lexicon)]
        assert got == brute_kinds(clause, lambda w: lexicon.weight(w) > 0), clause


def test_document_is_the_sum_of_its_clauses():
    rng = random.Random(4)
    lexicon = toxicity.Lexicon({"idiot": 1.0}, {})
    for _ in range(300):
        text = "".join(rng.choice(["idiot", " you ", " not ", ".", "\n", " a ", "!", " said ", "idiots "]) for _ in range(25))
        want = Counter(k for c in re.split(r"[.!?;:\n]", text.lower()) for k in brute_kinds(c, lambda w: w == "idiot"))
        got = toxicity.document_kinds(text, lexicon, toxicity.known_weights(lexicon))
        assert got == [want.get(k, 0) for k in toxicity.KINDS], text


def test_toxicity_learns_words_and_prefixes(spark):
    docs, labels = corpus(spark)
    rows = toxicity.toxicity(docs, labels).collect()
    assert len(rows) == 400 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    out = [r for r in rows if r["held_out"]]
    assert np.mean([r["predicted"] == (r["doc_id"] % 4 == 1) for r in out]) >= 0.97
    assert toxicity.clean_documents(docs, labels).where("doc_id % 4 <> 1").count() >= 0.98 * 300


def test_quality_model_held_out(spark):
    docs, labels = corpus(spark)
    rows = quality_model.quality(docs, labels).collect()
    out = [r for r in rows if r["held_out"]]
    assert len(rows) == 400 and np.mean([r["predicted"] == (r["doc_id"] % 4 != 2) for r in out]) >= 0.97
    assert sorted(r["score"] for r in rows) == sorted(r["score"] for r in quality_model.quality(docs, labels).collect())


def test_subword_features():
    idx, wt = quality_model.sparse("aa bb bb cc")
    assert wt.sum() == pytest.approx(1.0, abs=1e-5) and quality_model._SAME in idx
    w = quality_model._words(np.frombuffer(b" ab  ab\tabc\n", np.uint8))
    assert len(w) == 3 and w[0] == w[1] != w[2]
    long = "word " * 300_000  # several chunks, no gram lost
    assert sum(len(g) for g in quality_model.groups(long)) == (len(long) - 2) + (len(long) - 3) + 300_000 + 299_999
    assert len(quality_model.sparse("")[0]) == 0


def brute_statistics(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    win = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    c = Counter(win)
    cover = {j for i, x in enumerate(win) if c[x] > 1 for j in range(i, i + 5)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(cover)


def test_rule_statistics_against_brute_force(spark):
    rng = random.Random(5)
    texts = [None, "", "\n\n", "a", "a b c d e a b c d e", "x " * 50, "l1\nl1\n \nl1\nl2", "#|<>&%$* é漢🙂\n"]
    texts += [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 40))) for _ in range(60)]
    texts += ["\n".join(rng.choice(["p q", "r", "", " "]) for _ in range(12)) for _ in range(20)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in quality_rules.statistics(df).collect():
        got = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
        assert got == brute_statistics(texts[r["doc_id"]]), texts[r["doc_id"]]


def test_rules_find_junk_and_stay_native(spark):
    docs, labels = corpus(spark)
    out = quality_rules.quality_rules(docs, labels)
    assert not re.search("Python|Pandas|Arrow", out._jdf.queryExecution().toString())
    for r in out.collect():
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
        assert r["kept"] == (r["doc_id"] % 4 != 2 and not r["base_failed"])


@pytest.mark.parametrize("op", [toxicity.toxicity, quality_model.quality, quality_rules.quality_rules])
def test_awkward_rows_and_no_labels(spark, op):
    docs = awkward_docs(spark)
    none = spark.createDataFrame([], NO_LABELS)
    assert op(docs, none).count() == docs.count()
    _, labels = corpus(spark)
    rows = op(docs, labels).collect()
    assert len(rows) == docs.count()
    same = {tuple(r) for r in rows if r["doc_id"] == 0}
    assert len(same) == 1  # repeated rows, equal results
    assert op(empty_docs(spark), labels).count() == 0


def test_filters_keep_columns(spark):
    docs = awkward_docs(spark)
    _, labels = corpus(spark)
    assert toxicity.clean_documents(docs, labels).columns == docs.columns
    assert quality_model.good_documents(docs, labels).schema == docs.schema
