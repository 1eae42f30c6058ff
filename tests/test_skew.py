"""Joins with heavy keys apart, and bucketed catalog tables: equal to the plain join, bounded tasks, no exchange."""

import random

import pytest
from pyspark.sql import functions as F

from trolley.operators.skew import KINDS, heavy_keys, split_join
from trolley.sources import catalog


@pytest.fixture(scope="module")
def sides(spark):
    """A third of the rows has one key, some keys are NULL, rows repeat."""
    rng = random.Random(5)
    left = [(7 if i % 3 == 0 else rng.choice([None, *range(60)]), i % 400, i % 5) for i in range(3000)]
    right = [(k, k % 4, f"r{k}") for k in range(0, 60, 2)] + [(7, j, "many") for j in range(5)] + [(None, 0, "null")] * 3
    return (
        spark.createDataFrame(left + left[:50], "k int, a int, b int").repartition(6),
        spark.createDataFrame(right, "k int, b int, c string").repartition(3),
    )


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_heavy_keys(sides):
    left, _ = sides
    assert heavy_keys(left, "k", 0.2) == [7]
    assert heavy_keys(left.where("k is null"), "k", 0.2) == [] == heavy_keys(left.where("false"), "k", 0.2)
    n = {r["k"]: r["count"] for r in left.groupBy("k").count().collect()}
    assert {k for k, c in n.items() if k is not None and c >= 0.015 * left.count()} <= set(heavy_keys(left, "k", 0.012))


@pytest.mark.parametrize("how", KINDS)
@pytest.mark.parametrize("broadcast_rows", [1000, 0])
def test_split_join_equals_the_plain_join(sides, how, broadcast_rows):
    left, right = sides
    for on in (["k"], ["k", "b"]):
        got = split_join(left, right, on, how, key="k", share=0.1, broadcast_rows=broadcast_rows, salts=4)
        want = left.join(right, on, how)
        assert rows(got) == rows(want) and got.columns == want.columns
    assert rows(split_join(left, right.where("false"), ["k"], how, share=0.1)) == rows(left.join(right.where("false"), ["k"], how))


def test_salt_spreads_a_heavy_key(sides, spark):
    left, right = sides
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = split_join(left, right, ["k"], share=0.1, broadcast_rows=0, salts=16)
        hot = got.where("k = 7").groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(hot) > 1 and max(r["count"] for r in hot) < sum(r["count"] for r in hot)


def test_unknown_kinds_and_keys(sides):
    left, right = sides
    with pytest.raises(ValueError, match="full"):
        split_join(left, right, ["k"], "full")
    with pytest.raises(ValueError, match="not among"):
        split_join(left, right, ["k"], key="a")


@pytest.fixture(scope="module")
def stored(sides, spark):
    left, right = sides
    a = catalog.save_table(left, "skew_left", "k", buckets=4, sort_by=["k", "a"], share=0.2)
    return a, catalog.save_table(right, "skew_right", "k", buckets=4, heavy=a.heavy)


@pytest.mark.parametrize("how", KINDS)
@pytest.mark.parametrize("on", [["k"], ["k", "b"]])
def test_bucketed_join(sides, stored, spark, how, on):
    left, right = sides
    a, b = stored
    assert a.heavy == (7,) and rows(a.read(spark)) == rows(left) and rows(b.read(spark)) == rows(right)
    assert rows(catalog.join(catalog.bucket_session(spark), a, b, on, how)) == rows(left.join(right, on, how))


@pytest.mark.parametrize("on", [["k"], ["k", "b"]])
def test_buckets_meet_without_an_exchange(spark, on):
    df = spark.range(4000).selectExpr("id % 100 as k", "id % 7 as b", "id as a")
    one = catalog.save_table(df, "plain_left", "k", buckets=4, share=0.5)
    two = catalog.save_table(df.selectExpr("k", "b", "a as c").limit(500), "plain_right", "k", buckets=4, heavy=one.heavy)
    s = catalog.bucket_session(spark)
    s.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    joined = catalog.join(s, one, two, on, "left")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert not one.heavy and "Exchange" not in plan and "Join" in plan
    assert "requireAllClusterKeys" not in str(dict(spark.sparkContext.getConf().getAll()))
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"


def test_tables_must_be_bucketed_alike(sides, spark, stored):
    other = catalog.save_table(sides[1], "skew_other", "k", buckets=2, heavy=())
    with pytest.raises(ValueError, match="not bucketed alike"):
        catalog.join(spark, stored[0], other, ["k"])


def test_a_table_is_replaced(spark):
    one = spark.range(10).selectExpr("id as k")
    catalog.save_table(one, "replaced", "k", buckets=2, heavy=(3,))
    again = catalog.save_table(spark.table("replaced"), "replaced_too", "k", buckets=2, heavy=())
    assert again.read(spark).count() == 9
    catalog.save_table(one.limit(4), "replaced", "k", buckets=2, heavy=())
    assert spark.table("replaced").count() == 4 and not spark.catalog.tableExists("replaced_heavy")
