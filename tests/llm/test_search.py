import random

import numpy as np
import pytest

from tests.llm.helpers import awkward_docs, empty_docs, words
from trolley.llm import hamming_search, html_text, near_dedup


def brute_components(docs, percent=85):
    sets = {}
    for key, t in docs:
        w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        import re

        w = re.findall(r"[^\x20\x09-\x0D]+", w)
        sets[key] = {tuple(w[i : i + 3]) for i in range(len(w) - 2)} or ({tuple(w)} if w else set())
    keys = sorted(sets)
    root = {k: k for k in keys}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: find(k) for k in keys}, {k: len(s) for k, s in sets.items()}


def near_corpus(seed=1):
    rng = random.Random(seed)
    out, key = [], 0
    common = words(rng, 30)
    for _ in range(40):  # families of copies, edits of edits, shared passages
        base = words(rng, rng.randint(5, 90)).split(" ")
        for _ in range(rng.randint(1, 5)):
            t = list(base)
            for _ in range(rng.randint(0, 2)):
                t[rng.randrange(len(t))] = words(rng, 1)
            if rng.random() < 0.3:
                base = t
            text = " ".join(t)
            out.append((key, text.upper() if rng.random() < 0.2 else text))
            key += 1
    out += [(key + i, common + " " + words(rng, 40)) for i in range(10)]
    out += [(1000, None), (1001, ""), (1002, "one"), (1003, "One"), (1004, "one two"), (1005, "one two three")]
    return out


def test_near_dedup_against_brute_force(spark):
    rows = near_corpus()
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want, sizes = brute_components(rows)
    for r in near_dedup.near_dedup(df).collect():
        assert (r["component_id"], r["n_shingles"]) == (want[r["doc_id"]], sizes[r["doc_id"]]), r
        assert r["kept"] == (r["doc_id"] == r["component_id"]) == r["first"]


def test_dense_nodes_by_pivots_and_blocks(spark, monkeypatch):
    """Large groups of near copies and of texts just too different: every node is dense, nothing is lost."""
    monkeypatch.setattr(near_dedup, "SMALL", 2)
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    monkeypatch.setattr(near_dedup, "TILE", 8)
    rng = random.Random(6)
    rows = []
    for g, (n, edits) in enumerate([(40, 2), (30, 5)]):
        base = words(rng, 80).split(" ")
        for i in range(n):
            t = list(base)
            for _ in range(edits):
                t[rng.randrange(len(t))] = words(rng, 1)
            rows.append((g * 1000 + i, " ".join(t)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want, _ = brute_components(rows)
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_dedup(df).collect()}
    assert got == want


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 40)] + [(100, 101)], "a long, b long")
    got = {r["v"]: r["root"] for r in near_dedup.components(edges).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}


def test_merge_links_old_classes_and_new_vertices(spark):
    label = spark.createDataFrame([(1, 1), (2, 1), (5, 5), (6, 5)], "v long, root long")
    more = spark.createDataFrame([(2, 6), (8, 9), (6, 9)], "a long, b long")
    got = {r["v"]: r["root"] for r in near_dedup.merge(label, more).collect()}
    assert got == dict.fromkeys([1, 2, 5, 6, 8, 9], 1)
    assert near_dedup.merge(label, more.where("a > 99")).count() == 4


def test_near_dedup_awkward(spark):
    docs = awkward_docs(spark)
    rows = near_dedup.near_dedup(docs).collect()
    assert len(rows) == docs.count()
    assert {r["component_id"] for r in rows if r["doc_id"] == 0} == {0}
    assert sum(r["first"] for r in rows if r["component_id"] == 0) == 1
    assert all(r["kept"] and r["component_id"] is None for r in rows if r["doc_id"] is None)
    out = near_dedup.first_documents(docs)
    assert out.columns == docs.columns and out.where("doc_id = 0").count() == 1 and out.where("doc_id = 104").count() == 0
    assert near_dedup.near_dedup(empty_docs(spark)).count() == 0


def test_block_index_finds_all_within_radius():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 256, (500, 4), dtype=np.uint8)
    index = hamming_search.BlockIndex(codes)
    for q in codes[:20]:
        d = hamming_search._ONES[codes ^ q].sum(axis=1)
        for radius in (0, 3, 7, 11, 40):
            assert index.within(q, radius).tolist() == np.flatnonzero(d <= radius).tolist()


def vectors(spark, n=900, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 16)).astype(np.float32)
    x[500:520] = x[400]  # equal vectors: ties go to the smaller key
    rows = [(i, [float(v) for v in r], 0) for i, r in enumerate(x)]
    odd = [(2000, None, 0), (2100, [0.0] * 16, 0), (2200, [float("nan")] * 16, 0), (2300, [1.0, None] * 8, 0)]
    odd += [(2400, [1.0] * 3, 0), (None, [1.0] * 16, 0), (2500, [], 0)]
    return x, spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, score int").repartition(3)


@pytest.mark.parametrize("block", [128, 4096])
def test_nearest_recall_and_exact_scores(spark, monkeypatch, block):
    monkeypatch.setattr(hamming_search, "BLOCK", block)
    x, df = vectors(spark)
    got = {}
    for r in hamming_search.nearest(df).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(got) == list(range(0, 900, 100))
    x = x.astype(float)
    hit = 0
    for q, rows in got.items():
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        rows.sort()
        assert [r[0] for r in rows] == list(range(1, 11)) and all(d[v] == s and v != q for _, v, s in rows)
        assert rows == sorted(rows, key=lambda r: (r[2], r[1]))
        d[q] = np.inf
        best = np.lexsort((np.arange(len(d)), d))[:10]
        hit += len({v for _, v, _ in rows} & set(best.tolist()))
        if q == 400:
            assert [v for _, v, _ in rows] == list(range(500, 510))
    assert hit / 90 >= 0.9


def test_nearest_small_tables(spark):
    few = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(4)], "vec_id long, embedding array<float>")
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in hamming_search.nearest(few).orderBy("rank").collect()] == [(0, 1, 1), (0, 2, 2), (0, 3, 3)]
    one = few.where("vec_id = 0")
    assert hamming_search.nearest(one).count() == 0
    assert hamming_search.nearest(few.where("vec_id > 90")).count() == 0


@pytest.fixture(scope="module")
def trees():
    return html_text.boost(*html_text.training_rows(html_text.plain_pages()))


def text_of(trees, page):
    p = html_text.parse(page)
    return html_text.main_text(p, trees.log_odds(html_text.features(p)))


ARTICLE = "<h1>The title</h1><p>One <b>bold</b>ly written   sentence &amp; more, as it\n goes.<br>Next line of it.</p><p>Second&nbsp;one, with a good number of words in it."
EXPECT = "The title One boldly written sentence & more, as it goes. Next line of it. Second one, with a good number of words in it."


@pytest.mark.parametrize(
    "page",
    [
        f"<html><head><title>t</title><style>p{{}}</style><script>var a='</p>';</script></head><body><nav><ul><li><a href='/'>Home</a></li></ul></nav><!-- ad --><div class='ad'>Buy it now.</div><article>{ARTICLE}</article><footer>&copy; us &middot; all rights</footer></body></html>",
        f"<body><header><a href='/'>Site</a></header><main>{ARTICLE}</main><aside class='sidebar'><ul><li><a href=1>x</a></li></ul></aside><section id='comments'><div class='comment'><p>Nice one!</p></div></section><form><p>Mail</p><input></form></body>",
        f"<body><div class='menu'><a href=1>a</a></div><div class='content'>{ARTICLE}</div><div class='cookie-notice'><p>We use cookies.</p></div><div class='footer'><p>us</p></div></body>",
    ],
)
def test_main_text(trees, page):
    assert text_of(trees, page) == EXPECT


def test_decoding_has_no_contradictions(trees):
    rng = random.Random(1)
    for _ in range(50):
        page = "".join(rng.choice(["<div>", "</div>", "<p>", "<article>", "</article>", "some text here ", "<ul><li>", "</ul>", "<a>", "</a>"]) for _ in range(40))
        p = html_text.parse(page)
        odds = np.array([rng.uniform(-3, 3) for _ in p.nodes])
        taken = html_text.decode(p, odds)
        best = max_likelihood(p, np.clip(odds, -8, 8))
        got = sum(np.sqrt(x.chars) * -np.logaddexp(0, -odds[i] if taken[i] else odds[i]) for i, x in enumerate(p.nodes))
        assert got <= best + 1e-9 and len(taken) == len(p.nodes)


def max_likelihood(p, odds):
    return sum(np.sqrt(x.chars) * -np.logaddexp(0, -abs(odds[i])) for i, x in enumerate(p.nodes))


@pytest.mark.parametrize("page", [None, "", "<", "<p", "</div></p>", "<p>x<p", "<script>", "&#xZZ; <![CDATA[", "<a" * 2000, "<div>" * 3000 + "deep"])
def test_broken_pages(trees, page):
    assert isinstance(text_of(trees, page or ""), str)


def test_extract(spark):
    rows = [(1, "u", f"<article>{ARTICLE}</article><footer>foot</footer>", "x"), (2, None, None, "x"), (3, "v", "", None), (None, "w", "<nav>a</nav>", "x")]
    df = spark.createDataFrame(rows + rows[:1], "page_id long, url string, html string, text string")
    got = html_text.extract(df).collect()
    assert len(got) == 5 and all(r["n_chars"] == len(r["text"]) for r in got)
    assert [r["text"] for r in got if r["page_id"] == 1] == [EXPECT] * 2
    assert html_text.extract(df.where("page_id = 99")).count() == 0
