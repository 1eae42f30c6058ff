import itertools

from trolley.operators import evaluate

SCORES = [(1, 0.9), (0, 0.9), (1, 0.8), (0, 0.7), (1, 0.7), (0, 0.2), (0, 0.1), (1, 0.35), (0, 0.35), (0, 0.05)]


def _frame(spark, rows):
    return spark.createDataFrame(rows, "label int, score double").withColumn(
        "prediction", (__import__("pyspark.sql.functions", fromlist=["col"]).col("score") > 0.21).cast("double")
    )


def test_auc_matches_pairwise_count(spark):
    df = _frame(spark, SCORES)
    pos = [s for y, s in SCORES if y == 1]
    neg = [s for y, s in SCORES if y == 0]
    wins = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg))
    got = evaluate.auc_exact(df).first()["auc"]
    assert abs(got - wins / (len(pos) * len(neg))) < 1e-12


def test_roc_and_pr_points(spark):
    df = _frame(spark, SCORES)
    roc = {r["threshold"]: (r["fpr"], r["tpr"], r["rank"]) for r in evaluate.roc_curve(df).collect()}
    P = sum(1 for y, _ in SCORES if y == 1)
    N = len(SCORES) - P
    for rank, t in enumerate(sorted({s for _, s in SCORES}, reverse=True), start=1):
        tp = sum(1 for y, s in SCORES if y == 1 and s >= t)
        fp = sum(1 for y, s in SCORES if y == 0 and s >= t)
        assert roc[t] == (fp / N, tp / P, rank)
    pr = {r["threshold"]: (r["precision"], r["recall"]) for r in evaluate.pr_curve(df).collect()}
    tp = sum(1 for y, s in SCORES if y == 1 and s >= 0.35)
    n = sum(1 for _, s in SCORES if s >= 0.35)
    assert pr[0.35] == (tp / n, tp / P)


def test_single_class_auc_is_null(spark):
    df = _frame(spark, [(0, 0.1), (0, 0.4)])
    assert evaluate.auc_exact(df).first()["auc"] is None


def test_binary_metrics_and_confusion(spark):
    df = _frame(spark, SCORES)
    m = evaluate.binary_metrics(df).first()
    tp = sum(1 for y, s in SCORES if y == 1 and s > 0.21)
    fp = sum(1 for y, s in SCORES if y == 0 and s > 0.21)
    fn = sum(1 for y, s in SCORES if y == 1 and s <= 0.21)
    assert (m["tp"], m["fp"], m["fn"]) == (tp, fp, fn)
    assert abs(m["precision"] - tp / (tp + fp)) < 1e-12
    conf = {(r["label"], r["prediction"]): r["cnt"] for r in evaluate.confusion(df).collect()}
    assert sum(conf.values()) == len(SCORES)


def test_weighted_metrics_match_spark_evaluator(spark):
    df = _frame(spark, SCORES)
    w = evaluate.weighted_metrics(df).first()
    assert abs(w["weighted_precision"] - evaluate.multiclass_metric(df, "weightedPrecision")) < 1e-12
    assert abs(w["weighted_recall"] - evaluate.multiclass_metric(df, "weightedRecall")) < 1e-12
    assert abs(w["weighted_f1"] - evaluate.multiclass_metric(df, "f1")) < 1e-12
