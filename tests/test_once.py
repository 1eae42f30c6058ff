"""Counts and metrics from one pass: bitmaps, coverage, class metrics, quantile AUC; stored models."""

import random

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from trolley.operators import bitmaps, evaluate, models, tuning
from trolley.operators.coverage import coverage
from trolley.plans import fitted


def test_bitmaps_count_exactly_and_merge(spark):
    rng = random.Random(2)
    ids = [0, 1, -1, 32767, 32768, 32769, 65536, 10**12, -(10**9), None]
    rows = [(rng.randint(0, 5), rng.choice(ids + [rng.randint(0, 10**6)] * 5)) for _ in range(2000)]
    df = spark.createDataFrame(rows, "g int, k long").repartition(4)
    bits = bitmaps.id_bitmaps(df, ["g"], "k")
    got = {r["g"]: r["n"] for r in bitmaps.distinct_counts(bits, ["g"], "n").collect()}
    assert got == {g: len({k for h, k in rows if h == g and k is not None}) for g in range(6)}
    up = bitmaps.merge_bitmaps(bits.withColumn("g", F.col("g") % 2), ["g"])
    got = {r["g"]: r["n"] for r in bitmaps.distinct_counts(up, ["g"], "n").collect()}
    assert got == {g: len({k for h, k in rows if h % 2 == g and k is not None}) for g in range(2)}
    assert bitmaps.distinct_counts(bitmaps.id_bitmaps(df.where("false"), ["g"], "k"), ["g"], "n").count() == 0


def test_coverage_against_anti_joins(spark):
    rng = random.Random(3)
    some = lambda n, top: [(rng.choice([None, *range(top)]), rng.randint(0, top), rng.random()) for _ in range(n)]
    lines = spark.createDataFrame(some(600, 12), "u int, p int, x double").repartition(3)
    features = spark.createDataFrame(some(80, 10), "u int, p int, y double").repartition(2)
    got = {r["by_keys"]: r for r in coverage(lines, features, ["u", "p"]).collect()}
    for by in ("u+p", "u", "p"):
        keys = by.split("+")
        miss = lines.join(features.select(*keys), keys, "left_anti")
        assert (got[by]["lines"], got[by]["missing"]) == (600, miss.count())
        assert got[by]["keys_missing"] == miss.select(*keys).distinct().count()
    plan = coverage(lines, features, ["u", "p"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 2 and "Join" not in plan


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(4)
    rows = [(float(y), float(rng.choice([y, y, rng.randint(0, 3)])), rng.random() + 0.3 * (y == 1)) for y in rng.choices(range(4), k=900)]
    return spark.createDataFrame(rows, "label double, prediction double, score double").repartition(3)


def test_class_metrics_equal_the_evaluators(scored):
    got = evaluate.class_metrics(scored)
    for m in evaluate.CLASS_METRICS:
        want = MulticlassClassificationEvaluator(metricName=m).evaluate(scored)
        assert got[m] == pytest.approx(want, abs=1e-12)
        assert evaluate.CountsEvaluator(metric=m).evaluate(scored) == got[m]
    with pytest.raises(ValueError, match="unknown metric"):
        evaluate.CountsEvaluator(metric="auc")
    assert all(v != v for v in evaluate.class_metrics(scored.where("false")).values())


def test_quantile_auc_bounds_the_exact_one(scored):
    df = scored.withColumn("label", (F.col("label") == 1).cast("int"))
    exact = evaluate.auc_exact(df).first()["auc"]
    for bins in (10, 100):
        r = evaluate.auc_of_quantiles(df, bins=bins).first()
        assert abs(r["auc"] - exact) <= r["error"] + 1e-12 and r["error"] < 1 / bins
    ties = df.withColumn("score", F.lit(0.5))
    assert evaluate.auc_of_quantiles(ties).first()["auc"] == 0.5
    assert evaluate.auc_of_quantiles(df.where("label = 0")).first()["auc"] is None


def test_counts_evaluator_in_cross_validation(spark):
    rows = [(i, float(i % 10), int(i % 10 >= 5)) for i in range(300)]
    df = models.assemble(spark.createDataFrame(rows, "k int, a double, reordered int"), ["a"])
    dt = models.tree(maxDepth=2)
    ev = evaluate.CountsEvaluator("reordered", metric="accuracy")
    cv = tuning.cross_validate(dt, tuning.grid(dt, {"maxDepth": [1, 2]}), ev, 2, fold_col="fold")
    assert max(cv.fit(tuning.with_fold(df, 2, 1, ["k"])).avgMetrics) == 1.0


def test_stored_models(spark):
    rows = [(i, float(i % 10), int(i % 10 >= 5)) for i in range(200)]
    df = models.assemble(spark.createDataFrame(rows, "k int, a double, reordered int"), ["a"])
    fits = []

    def fit():
        fits.append(1)
        return models.fit_forest(df, numTrees=3, seed=1)

    path = fitted.model_path(spark, "test", "sources", {"numTrees": 3}, random.random())
    one, two = (fitted.stored_model(spark, path, fit) for _ in range(2))
    assert len(fits) == 1
    want = sorted(tuple(r) for r in models.fit_forest(df, numTrees=3, seed=1).transform(df).select("k", "prediction").collect())
    for m in (one, two):
        assert sorted(tuple(r) for r in m.transform(df).select("k", "prediction").collect()) == want
    # A model that another application stored first stays, and nothing is left beside it.
    fitted.save_whole(spark, one, path)
    fs, Path = fitted._filesystem(spark, path)
    names = [str(f.getPath().getName()) for f in fs.listStatus(Path(path))]
    assert sorted(names) == ["metadata", "stages"] and fitted.stored_model(spark, path, fit).getNumTrees == 3
    assert path != fitted.model_path(spark, "test", "other sources", {"numTrees": 3})
