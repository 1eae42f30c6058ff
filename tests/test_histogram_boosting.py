"""The fit of binned blocks against Spark's own: the same trees, a byte a feature, one binned copy for a search."""

import re

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import functions as F

from trolley.operators import boosting, histogram_boosting, histograms, models, tuning

COLS = [f"c{i}" for i in range(5)]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    n = 12000  # more than the cuts are sampled from
    x = rng.normal(size=(n, 5))
    x[:, 1] = np.round(x[:, 1] * 2)
    x[:, 2] = np.where(rng.random(n) < 0.6, 0, rng.integers(0, 100, n))
    x[:, 3] = 7
    y = x[:, 0] + x[:, 1] / 2 + np.sin(x[:, 2]) + rng.normal(size=n) > 0.5
    made = [(i, *map(float, r), int(v), i % 5 == 0) for i, (r, v) in enumerate(zip(x, y))]
    df = spark.createDataFrame(made, "user_id long, " + ", ".join(f"{c} double" for c in COLS) + ", reordered int, isVal boolean")
    return models.assemble(df.repartition(3, "user_id"), COLS).persist()


NUMBER = r"-?\d+\.\d+(?:E-?\d+)?"


@pytest.mark.parametrize(
    "params",
    [
        {"maxIter": 3, "maxDepth": 3, "seed": 3},
        {"maxIter": 2, "maxDepth": 6, "minInstancesPerNode": 60, "subsamplingRate": 0.7, "featureSubsetStrategy": "0.5", "seed": -9},
        {"maxIter": 2, "maxDepth": 9, "minInstancesPerNode": 200, "maxBins": 300, "subsamplingRate": 0.741, "seed": 1},
        {"maxIter": 20, "maxDepth": 3, "stepSize": 0.5, "validationIndicatorCol": "isVal", "seed": 3},
    ],
)
def test_the_trees_are_those_of_sparks_fit(rows, params):
    own = GBTClassifier(labelCol="reordered", **params).fit(rows)
    got = models.gbt(**params).fit(rows)
    one, two = (m.toDebugString.split("\n", 1)[1] for m in (own, got))
    assert re.sub(NUMBER, "#", one) == re.sub(NUMBER, "#", two)
    assert [float(v) for v in re.findall(NUMBER, two)] == pytest.approx([float(v) for v in re.findall(NUMBER, one)], rel=1e-9, abs=1e-12)
    assert got.featureImportances.toArray() == pytest.approx(own.featureImportances.toArray(), abs=1e-9)
    assert got.getNumTrees == own.getNumTrees and got.getMaxDepth() == own.getMaxDepth()
    assert got.treeWeights == own.treeWeights


def test_fits_do_not_use_sparks_row_objects(rows, monkeypatch):
    def refused(*args):
        raise AssertionError("4 bytes a feature and all rows in every level")

    monkeypatch.setattr(GBTClassifier, "_fit", refused)
    assert models.fit_gbt(rows, maxIter=2, maxDepth=2).getNumTrees == 2


def test_binned_rows_take_a_byte_a_feature(rows):
    est = models.gbt(seed=1)
    data = est.bin_rows(rows, rows.count())
    blocks = data.blocks.collect()
    data.blocks.unpersist()
    assert sum(len(signs) for _, signs in blocks) == 12000 == data.rows
    assert all(bins.dtype == np.uint8 and bins.shape == (5, len(signs)) for bins, signs in blocks)


def test_only_the_smaller_child_is_counted(rows, monkeypatch):
    counted, count = [], histograms.count

    def seen(splits, opened, full, *rest):
        counted.append((len(opened), len(full)))
        return count(splits, opened, full, *rest)

    monkeypatch.setattr(histograms, "count", seen)
    models.gbt(maxIter=1, maxDepth=3, seed=1).fit(rows)
    assert counted == [(1, 1), (2, 1), (4, 2)]


def test_many_tasks_and_little_memory_give_the_same_trees(rows, monkeypatch):
    params = {"maxIter": 2, "maxDepth": 5, "minInstancesPerNode": 50, "seed": 2}
    one = models.gbt(**params).fit(rows).toDebugString.split("\n", 1)[1]
    monkeypatch.setattr(histogram_boosting, "DIRECT_PARTS", 2)
    two = models.gbt(**params, maxMemoryInMB=0).fit(rows).toDebugString.split("\n", 1)[1]
    assert re.sub(NUMBER, "#", one) == re.sub(NUMBER, "#", two)


def test_a_search_bins_its_rows_once(rows, monkeypatch):
    made, binned = [], histogram_boosting.binned
    monkeypatch.setattr(histogram_boosting, "binned", lambda *a: made.append(a) or binned(*a))
    got = tuning.adaptive_search(rows.drop("isVal"), ["user_id"], trials=3, rounds=2, startup=2, batch=1)
    assert len(got.trials) == 3 and len(made) == 1


def test_long_runs_cut_their_lineage_and_leave_no_files(rows, tmp_path, spark):
    before = spark.sparkContext.getCheckpointDir()
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    try:
        m = models.gbt(maxIter=7, maxDepth=2, checkpointInterval=2, subsamplingRate=0.5, seed=4).fit(rows)
        assert m.getNumTrees == 7 and not list(tmp_path.rglob("part-*"))
    finally:
        spark.sparkContext.setCheckpointDir(before)


def test_the_first_of_equal_splits_is_taken(spark):
    rng = np.random.default_rng(6)
    made = [(float(v), -2.0 * float(v), int(v + rng.normal() > 9)) for v in rng.integers(0, 20, 900)]
    df = models.assemble(spark.createDataFrame(made, "a double, b double, reordered int"), ["a", "b"])
    for parts in (1, 4):
        m = models.gbt(maxIter=4, maxDepth=3, seed=1).fit(df.repartition(parts))
        assert "feature 0" in m.toDebugString and "feature 1" not in m.toDebugString


def test_bad_rows_are_refused(spark):
    df = models.assemble(spark.createDataFrame([(1.0, 0), (float("nan"), 1)], "x double, reordered int"), ["x"], handle_invalid="keep")
    with pytest.raises(Exception, match="NaN or infinity"):
        models.gbt(maxIter=1).fit(df)
    df = models.assemble(spark.createDataFrame([(1.0, 0), (2.0, 2)], "x double, reordered int"), ["x"])
    with pytest.raises(Exception, match="labels in"):
        models.gbt(maxIter=1).fit(df)
    with pytest.raises(ValueError, match="no rows"):
        models.gbt(maxIter=1).fit(df.where(F.lit(False)))


def test_rounds_stop_on_the_flagged_rows(rows):
    cut, table = boosting.fit_stopping(models.gbt(maxIter=12, maxDepth=3, stepSize=0.8, seed=5), rows, "isVal", 2)
    assert table.count() == 12 and cut.getNumTrees == table.where("chosen").first()["round"]
