"""Spelling variants against brute force."""

import itertools
import random
import zlib
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.helpers import awkward_docs, empty_docs
from trolley.llm.spelling import near_pairs, one_edit_pairs, spelling_variants, words


def near(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def brute_pairs(words):
    return sorted(tuple(sorted(p)) for p in itertools.combinations(set(words), 2) if near(*p))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("abé", max_size=7), max_size=50))
def test_pairs_of_one_partition(strings):
    assert sorted(tuple(sorted(p)) for p in one_edit_pairs(strings)) == brute_pairs(strings)


def test_very_long_strings():
    got = one_edit_pairs(["a" * 20_000, "a" * 19_999, "b" + "a" * 19_999, "c"])
    assert len(got) == 3


def test_partitions_lose_no_pair(spark):
    rng = random.Random(4)
    some = ["".join(rng.choice("abc") for _ in range(rng.randint(7, 9))) for _ in range(500)]
    some += ["a" * 7, "a" * 8, "a" * 9]
    rows = spark.createDataFrame([(w,) for w in sorted(set(some))], "word string")
    for largest in (20_000, 25):  # the small one deals the hot partitions out again, several times
        got = sorted((r["a"], r["b"]) for r in near_pairs(rows, largest).collect())
        assert got == brute_pairs(some)


def brute(docs):
    letters = set(map(chr, [*range(65, 91), *range(97, 123), *range(0xC0, 0x100)]))
    n = Counter()
    for key, text in docs:
        run = ""
        for c in (text or "") + " ":
            if c in letters:
                run += chr(ord(c) + 32) if "A" <= c <= "Z" else c
                continue
            if run:
                h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
                if h % 31 == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
                n[run] += 1
            run = ""
    n = {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}
    out = {}
    for w, k in n.items():
        friends = sorted((-m, v) for v, m in n.items() if near(w, v))
        form = friends[0][1] if friends and -friends[0][0] >= 10 * k else None
        out[w] = [form, k, len(friends), n.get(form)]
    for w in out:
        root = w
        while out[root][0]:
            root = out[root][0]
        out[w].append(root)
    return {w: (f, r, k, m, fn) for w, (f, k, m, fn, r) in out.items()}


def check(docs):
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    rows = spelling_variants(docs).collect()
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    assert len(rows) == len(got) and got == want
    return got


def test_forms_and_roots(spark):
    base = "Mountain mountain MOUNTAIN straßen crèmeuse übergang thousand"
    texts = [(i, base + " words between") for i in range(300)]
    texts += [(1000 + i, "mountaim mountaim mountaims übergsng") for i in range(12)]
    texts += [(2000, "mountaimss mountaimss thousandx thousandx"), (None, base), (2001, None), (2002, "")]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    got = check(docs)
    assert got["mountaim"][0] == "mountain" and any(r != f for f, r, *_ in got.values() if f)


def test_awkward_and_empty(spark):
    check(awkward_docs(spark))
    assert spelling_variants(empty_docs(spark)).count() == 0


def test_flushing_counts_the_same(spark):
    docs = awkward_docs(spark, seed=5)
    assert sorted(words(docs, 3).collect()) == sorted(words(docs).collect())
