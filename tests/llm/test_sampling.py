"""Bounded samples, free column names, planning by parts and the pages that mark their article."""

import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import awkward_docs
from trolley.llm import html_text, mixing, near_dedup
from trolley.llm.common import free_names, sample_rows

PAGES = "/root/testdata/sf0.01/pages.parquet"


def test_sample_has_different_rows_and_no_layout(spark):
    df = spark.range(500).selectExpr("id % 200 as k", "id % 40 as v", "id % 3 as at")
    one, two = (sorted(map(tuple, sample_rows(x, "k", 50).collect())) for x in (df, df.repartition(7, "v")))
    assert one == two and len(set(one)) == len(one) == 50
    every = sample_rows(df, "k", 5000)
    assert every.columns == df.columns and every.count() == df.distinct().count()
    order = df.distinct().orderBy(F.xxhash64(F.lit(7), "k")).select("k").distinct()
    assert {r[0] for r in one} <= {r["k"] for r in order.collect()}
    assert sample_rows(df.where("false"), "k", 5).count() == 0


def test_free_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "row int, Row_ int, copy int")
    assert free_names(df, "row", "copy", "times", "row") == ["row__", "copy_", "times", "row___"]


def test_stages_keep_columns_of_any_name(spark):
    docs = awkward_docs(spark).withColumns(
        {n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in ("row", "times", "copy", "__row__", "mark", "part")}
    )
    for out in (near_dedup.first_documents(docs), mixing.mixed_documents(docs)):
        assert out.columns == docs.columns
        wrong = [r for r in out.collect() for n in ("row", "times", "copy", "__row__", "mark", "part")
                 if r[n] != (None if r["doc_id"] is None else f"{n}{r['doc_id']}")]
        assert not wrong


def test_parts_of_shards_share_the_seats(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_WORDS", 200)
    docs = spark.range(3000).selectExpr(
        "id as doc_id", "concat_ws(' ', array_repeat('word', 1 + cast(id % 9 as int))) as text", "concat('s', id % 3) as source"
    )
    got = {}
    for part in (1 << 12, 4):
        monkeypatch.setattr(mixing, "PART", part)
        got[part] = mixing.mix(docs).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    for rows in got.values():
        assert all(abs(r["taken"] - r["target"]) <= 0.02 * r["target"] for r in rows) and len(rows) == 3


def test_equal_rows_but_for_their_text_tie_by_it(spark):
    rows = [(7, " ".join([w] * 6), "s") for w in "abcdefgh"] + [(i, "some words of one source", "t") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    one, two = (
        sorted((r["doc_id"], r["text"]) for r in mixing.mixed_documents(x).collect()) for x in (df.repartition(5, "text"), df.coalesce(1))
    )
    assert one == two


@pytest.mark.skipif(not os.path.exists(PAGES), reason="test data not present")
def test_given_pages_give_their_article():
    files = sorted(glob.glob(f"{PAGES}/*.parquet")) if os.path.isdir(PAGES) else [PAGES]
    pages = [h or "" for f in files for h in pq.read_table(f, columns=["html"]).column(0).to_pylist()]
    trees = html_text.boost(*html_text.training_rows(pages[: html_text.SAMPLE_PAGES]))
    wrong = 0
    for h in pages:
        article = html_text._part(h, "article")
        page = html_text.parse(h)
        text = html_text.main_text(page, trees.log_odds(html_text.features(page)))
        foot = " ".join(t for _, t in html_text.parse(html_text._part(h, "footer")).runs)
        assert not (foot and text.endswith(foot))
        wrong += text != " ".join(t for _, t in html_text.parse(article).runs)
    assert wrong <= 0.001 * len(pages)


@pytest.mark.parametrize("words", [3, 8, 20])
def test_short_articles_beside_long_footers(words):
    trees = html_text.boost(*html_text.training_rows(html_text.plain_pages()))
    body = " ".join(["sentence"] * words) + "."
    page = html_text.parse(
        f"<body><nav><ul><li><a href='/'>Home</a></li></ul></nav><article><h1>A title</h1><p>{body}</p></article>"
        "<footer>&copy; host.example.com &middot; A line about us that is a good deal longer than the article above it is, "
        "and goes on for some more words.</footer></body>"
    )
    assert html_text.main_text(page, trees.log_odds(html_text.features(page))) == f"A title {body}"
