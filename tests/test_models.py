import pytest
from pyspark.sql import functions as F

from trolley.operators import evaluate, models, tuning
from trolley.operators.models import translate_gbt


@pytest.fixture(scope="module")
def separable(spark):
    rows = [(i, float(i % 10), float((i * 7) % 13), 1 if (i % 10) >= 5 else 0) for i in range(400)]
    df = spark.createDataFrame(rows, "user_id long, a double, b double, reordered int")
    return models.assemble(df, ["a", "b"])


def test_forest_keeps_ids_and_probabilities(separable):
    m = models.fit_forest(separable, numTrees=10, maxDepth=4, seed=1)
    p = models.predict(m, separable)
    assert "user_id" in p.columns
    probs = p.select(F.get(__import__("pyspark.ml.functions", fromlist=["vector_to_array"]).vector_to_array("probability"), 1).alias("p1"))
    lo, hi = probs.agg(F.min("p1"), F.max("p1")).first()
    assert 0.0 <= lo <= hi <= 1.0
    auc = evaluate.auc_exact(p.withColumn("score", F.col("prediction")), label="reordered", score="score").first()["auc"]
    assert auc > 0.95
    imp = models.feature_importance(m, ["a", "b"]).collect()
    assert imp[0]["feature"] == "a"
    s = models.tree_summary(m).first()
    assert s["num_trees"] == 10 and s["num_features"] == 2


def test_gbt_rejects_multiclass(spark):
    raw = spark.createDataFrame([(float(i), i % 3) for i in range(30)], "x double, label int")
    df = models.assemble(raw, ["x"])
    with pytest.raises(ValueError):
        models.fit_gbt(df, label="label", maxIter=2)


def test_gbt_translation():
    given = {"numIterations": 100, "maxDepth": 18, "numLeaves": 72, "baggingFraction": 0.741, "learningRate": 0.013}
    kw = translate_gbt(given, rows=7200)
    assert kw == {"maxIter": 100, "maxDepth": 18, "minInstancesPerNode": 100, "subsamplingRate": 0.741, "stepSize": 0.013}


def test_leaf_budget_bounds_the_leaves(spark):
    rows = [(float(i % 97), float((i * 31) % 89), int((i * 7) % 5 < 2)) for i in range(1000)]
    df = models.assemble(spark.createDataFrame(rows, "a double, b double, reordered int"), ["a", "b"])
    m = models.fit_gbt(df, maxIter=1, maxDepth=10, numLeaves=8)
    assert (m.trees[0].numNodes + 1) // 2 <= 8


def test_cross_validation_results(separable):
    dt = models.tree(maxDepth=3)
    ev = evaluate.MulticlassClassificationEvaluator(labelCol="reordered", metricName="accuracy")
    cvm = tuning.cross_validate(dt, tuning.grid(dt, {"maxDepth": [1, 3]}), ev, folds=3, seed=0).fit(separable)
    res = tuning.tuning_results(cvm).collect()
    assert len(res) == 2 and sum(r["is_best"] for r in res) >= 1


def test_threshold_search_runs(separable):
    est = models.gbt()
    draws = tuning.draw_params(n=2, seed=3)
    m = tuning.search(est, separable, draws=draws, rounds=3, parallelism=2)
    assert len(m.validationMetrics) == 2
