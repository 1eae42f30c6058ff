"""Row numbers belong to the rows: a later scan of the same files may be split in another way."""

import random
from contextlib import contextmanager

import pytest

import corpus_pipeline
from tests.llm.helpers import words
from trolley.llm import near_dedup

ONE_PARTITION = {"spark.sql.files.minPartitionNum": "1", "spark.sql.files.openCostInBytes": "0"}


@contextmanager
def other_splits(spark):
    """Packs all files of a scan into one partition, as a change of the cores may do."""
    for k, v in ONE_PARTITION.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k in ONE_PARTITION:
            spark.conf.unset(k)


@pytest.fixture
def docs(spark, tmp_path):
    """Files of 60 texts and a copy of every third one."""
    rng = random.Random(6)
    rows = [(i, words(rng, rng.randint(20, 60)), "en", f"s{i % 3}", 0) for i in range(60)]
    rows += [(100 + r[0], *r[1:]) for r in rows[::3]]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df.repartition(6, "doc_id").write.parquet(str(tmp_path / "docs"))
    return spark.read.parquet(str(tmp_path / "docs"))


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_splits_do_differ(spark, docs):
    before = docs.rdd.getNumPartitions()
    with other_splits(spark):
        assert spark.read.parquet(*docs.inputFiles()).rdd.getNumPartitions() == 1 < before


def test_near_dedup_keeps_the_same_rows(spark, docs):
    out = corpus_pipeline.near_dedup(spark, docs, "")
    with other_splits(spark):
        assert ids(out) == list(range(60))


def test_mix_takes_the_same_rows(spark, docs):
    want = ids(corpus_pipeline.mix(spark, docs, ""))
    out = corpus_pipeline.mix(spark, docs, "")
    with other_splits(spark):
        assert ids(out) == want


def test_numbered_rows_are_the_wanted_ones(spark):
    numbers = [0, 1, 62, 63, 64, 65, 127, 128, 1 << 33, (1 << 33) + 63, (5 << 33) + 64]
    rows = spark.createDataFrame([(n, f"t{n}", None, i) for i, n in enumerate(numbers)], "row long, text string, word string, at int")
    for part in ([], numbers, numbers[::2], numbers[1::2], [63, 63, 2, 66, None, 1 << 34]):
        wanted = spark.createDataFrame([(n,) for n in part], "rep long")
        got = near_dedup._numbered(rows, "row", wanted)
        assert got.columns == rows.columns
        assert sorted(r["row"] for r in got.collect()) == [n for n in numbers if n in part]


def test_texts_of_numbered_rows_are_not_shuffled(spark, docs, monkeypatch):
    """Neither for the sets of the likely pairs nor for the rows that stay, however small Spark's own broadcasts are."""
    plans, store = {}, near_dedup.store

    def noted(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return store(df, name)

    monkeypatch.setattr(near_dedup, "store", noted)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = near_dedup.first_documents(docs)
        plans["out"] = out._jdf.queryExecution().executedPlan().toString()
        assert ids(out) == list(range(60))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for name in ("dedup-sets", "out"):
        joined = [x for x in plans[name].splitlines() if "Join" in x and "text" in x or "Exchange" in x and "text" in x]
        scan = [x for x in plans[name].splitlines() if "Scan parquet" in x and "text" in x]
        assert scan and not joined and "BroadcastHashJoin" in plans[name].split("Scan parquet")[0]
