"""Key-hash splits: shares, independent seeds, nested flags, and the search's parameter axes."""

import pytest
from pyspark.sql import functions as F

from trolley.operators import models, splits, tuning


@pytest.fixture(scope="module")
def keys(spark):
    return spark.range(20000).select((F.col("id") % 700).alias("user_id"), (F.floor(F.col("id") / 700) * 101).alias("product_id"))


def test_shares_and_independent_seeds(keys):
    k = ["user_id", "product_id"]
    a, b = splits.key_slot(k, 1) < 0.2 * splits.HASH_SLOTS, splits.key_slot(k, 2) < 0.2 * splits.HASH_SLOTS
    r = keys.agg(F.avg(a.cast("int")).alias("a"), F.avg(b.cast("int")).alias("b"), F.avg((a & b).cast("int")).alias("ab")).first()
    assert abs(r["a"] - 0.2) < 0.01 and abs(r["b"] - 0.2) < 0.01 and abs(r["ab"] - 0.04) < 0.01


def test_nested_flag_is_a_fifth(keys):
    k = ["user_id", "product_id"]
    train, _ = splits.split(keys, [0.8, 0.2], seed=2021, keys=k)
    share = splits.with_validation_flag(train, 0.2, seed=2022, keys=k).agg(F.avg(F.col("isVal").cast("int"))).first()[0]
    assert abs(share - 0.2) < 0.01


def test_folds_do_not_depend_on_the_layout(keys):
    k = ["user_id", "product_id"]
    one = {tuple(r) for r in tuning.with_fold(keys, 3, 5, k).collect()}
    assert one == {tuple(r) for r in tuning.with_fold(keys.repartition(7), 3, 5, k).collect()}
    assert {r[2] for r in one} == {0, 1, 2}


def test_every_axis_of_the_search_acts():
    base = {n: spec[1] for n, spec in tuning.SEARCH_SPACE.items()}
    first = models.translate_gbt(base, rows=10000)
    for name, spec in tuning.SEARCH_SPACE.items():
        assert models.translate_gbt({**base, name: spec[2]}, rows=10000) != first, name
    assert models.translate_gbt(tuning.BEST_PARAMS, rows=7200)["maxDepth"] == 18


@pytest.mark.parametrize("name", sorted(models.UNMAPPED_GBT))
def test_unmapped_parameters_raise(name):
    with pytest.raises(ValueError, match=name):
        models.translate_gbt({name: 1})
    with pytest.raises(ValueError, match="rows"):
        models.translate_gbt({"numLeaves": 8})
