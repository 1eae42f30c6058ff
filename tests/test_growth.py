"""What is written, cached and dealt out must grow no faster than the sources."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from trolley import session
from trolley.operators import boosting, marts, models
from trolley.plans.chain import MartChain
from trolley.sources import basket
from trolley.sources.basket import Basket, line_context
from trolley.sources.io import AISLES_SCHEMA, LINES_SCHEMA, ORDERS_SCHEMA, PRODUCTS_SCHEMA, materialize


@pytest.fixture(scope="module")
def small(spark):
    """Orders of four users; the train lines hold one pair twice and a NULL label."""
    orders, priors, trains = [], [], []
    for user in range(4):
        for n in range(1, 5):
            order = 10 * user + n
            last = ("test" if user == 0 else "train") if n == 4 else "prior"
            orders.append((order, user, last, n, n % 7, n % 24, None if n == 1 else 3 * n))
            lines = [(order, 100 * a + user % 2, a, int(n > a)) for a in range(1, 3)]
            (priors if n < 4 else trains if user else []).extend(lines)
    trains += [trains[0], (14, 202, 3, None)]
    products = [(100 * a + u, "p", str(a), 1) for a in range(1, 3) for u in range(2)]
    make = spark.createDataFrame
    lines = make(trains, LINES_SCHEMA)
    return Basket(
        make(orders, ORDERS_SCHEMA), make(priors, LINES_SCHEMA), lines, lines, make(products, PRODUCTS_SCHEMA),
        make([(1, "a"), (2, "b")], AISLES_SCHEMA), make([(1, "d")], "department_id int, department string"),
    )


def bag(df):
    return Counter(map(tuple, df.collect()))


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hash")


def test_stored_labels_give_the_joined_train_rows(small):
    lazy, stored = MartChain(small), MartChain(small, store=True, tag="growth")
    assert bag(stored.train_data) == bag(lazy.train_data) and bag(stored.train_set) == bag(lazy.train_set)
    assert bag(stored.data_mart) == bag(lazy.data_mart) and bag(stored.test_set) == bag(lazy.test_set)
    assert lazy.train_data.count() == lazy.data_mart.where("eval_set = 'train'").count() + 1  # the pair that comes twice


def test_train_rows_are_not_dealt_out_again(small):
    stored = MartChain(small, store=True, tag="growth-plan")
    stored.data_mart
    assert exchanges(stored.train_data) == exchanges(stored.train_set) == 0


def test_settings_of_a_stage_are_put_back(spark):
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key)
    with session.settings(spark, {key: "false"}):
        assert spark.conf.get(key) == "false"
    assert spark.conf.get(key) == before


def test_shuffle_partitions_grow_with_the_sources(spark):
    own = spark.conf.get("spark.sql.shuffle.partitions")
    large, little = session.sized_session(spark, 100 * session.PARTITION_BYTES), session.sized_session(spark, 1)
    assert large.conf.get("spark.sql.shuffle.partitions") == "100"
    assert little.conf.get("spark.sql.shuffle.partitions") == own == spark.conf.get("spark.sql.shuffle.partitions")
    assert int(large.conf.get("spark.sql.files.maxPartitionBytes")) == session.SPLIT_BYTES
    assert large.conf.get("spark.sql.session.timeZone") == spark.conf.get("spark.sql.session.timeZone")


def test_stages_of_many_features_are_compiled(spark):
    work = session.sized_session(spark, 1)
    assert int(work.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000  # the JVM's own bound
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) > 8000


def test_joined_partitions_are_no_larger_than_a_scan_task(spark):
    work = session.sized_session(spark, 1)
    assert int(work.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")) == session.SPLIT_BYTES
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        small = session.sized_session(spark, 1)
        assert int(small.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")) == 1 << 20
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_cart_positions_need_no_stored_copy(spark, monkeypatch):
    def stored(*args, **kw):
        raise AssertionError("the lines are stored for their cart positions")

    monkeypatch.setattr("trolley.operators.ordering.materialize", stored)
    lines = spark.createDataFrame([(1, 7, 2), (1, 8, 1), (1, 7, 3), (2, 8, 5), (None, 7, 1)], "l_orderkey long, l_partkey long, l_linenumber int")
    pmap = spark.createDataFrame([(7, 101), (8, 102)], "p_partkey long, product_id long")
    orders = spark.createDataFrame([(1, 5, "prior", 1, 0, 0, None), (2, 5, "train", 2, 1, 1, 4)], ORDERS_SCHEMA)
    got = line_context(lines, pmap, orders).select("order_id", "product_id", "add_to_cart_order")
    assert bag(got) == Counter([(1, 102, 1), (1, 101, 2), (2, 102, 1)])


def test_order_ids_that_repeat_are_seen(spark):
    assert basket.unique_ids(spark.createDataFrame([(1,), (2,), (None,), (None,)], "order_id long"))
    assert not basket.unique_ids(spark.createDataFrame([(1,), (2,), (1,)], "order_id long"))


def test_averages_of_the_base_are_those_of_avg(small):
    opp = MartChain(small).opp.withColumn("add_to_cart_order", F.when(F.col("order_number") > 1, F.col("add_to_cart_order")))
    base = marts.user_product_features(opp).select("user_id", "product_id", "up_avg_cart", "up_avg_prior_days", "up_reoredered_avg")
    want = opp.groupBy("user_id", "product_id").agg(
        F.avg("add_to_cart_order"), F.avg("days_since_prior_order"), F.avg("reordered")
    )
    assert bag(base) == bag(want)


def test_fits_do_not_cache_whole_rows(spark, monkeypatch):
    def cached(*args, **kw):
        raise AssertionError("the rows are cached beside Spark's own copy")

    monkeypatch.setattr(models, "persisted", cached)
    rows = spark.createDataFrame([(i, i % 2, float(i % 2), i % 5 == 0) for i in range(60)], "k int, reordered int, x double, v boolean")
    df = models.assemble(rows, ["x"])
    assert models.fit_tree(df, maxDepth=1).depth == 1
    assert models.fit_forest(df, numTrees=2, maxDepth=1).getNumTrees == 2
    assert models.fit_gbt(df, maxIter=2, maxDepth=1).getNumTrees == 2
    cut = models.fit_gbt(df, maxIter=3, maxDepth=1, validationIndicatorCol="v", early_stopping_rounds=1)
    assert boosting.round_losses(cut, df.where("v"))


def test_buckets_grow_with_the_sources(spark, small, monkeypatch):
    from trolley.plans import registry
    from trolley.sources import catalog

    made = {}
    monkeypatch.setattr(registry, "chain", lambda s, d: MartChain(small, store=True, tag="growth-buckets"))
    monkeypatch.setattr(registry, "source_digest", lambda s, p: "growth")
    monkeypatch.setattr(registry, "source_bytes", lambda s, p: 40 * session.PARTITION_BYTES)
    monkeypatch.setattr(catalog, "save_table", lambda df, name, key, **kw: made.setdefault(name, catalog.BucketedTable(name, key, kw.get("buckets", 32), ())))
    registry.tables(spark, "/nowhere")
    assert {t.buckets for t in made.values()} == {40}


def test_small_dimensions_are_broadcast(spark, small, tmp_path):
    up = materialize(MartChain(small).up_base, str(tmp_path / "up"))
    chain = MartChain(small, store=True, tag="growth-small")
    plan = up.join(chain.product_mart, "product_id")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
