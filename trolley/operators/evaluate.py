"""Classifier evaluation (E1-E9) as distributed DataFrame queries.

The reference collects predictions to pandas and calls sklearn for the confusion matrix, precision/recall,
ROC and PR curves. Here everything stays in Spark:

* confusion counts and the derived metrics are one aggregation;
* curves first count labels per distinct score (partial aggregation), then take running sums along the score
  with ``running_totals`` (range-partitioned, so no single task holds all scores), then compute the points;
* the exact AUC is a sum over distinct scores of ``neg * (2*tp - pos)`` in integers divided once by ``2PN``
  (ties count one half), so it does not depend on summation order.
"""

from __future__ import annotations

import math

from pyspark.ml.evaluation import BinaryClassificationEvaluator, Evaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


from trolley.functions.scalar import flag_count, ratio
from trolley.operators.ordering import running_totals

_BIG = T.DecimalType(38, 0)
REPORT = ("tn", "fp", "fn", "tp", "accuracy", "precision", "recall", "f1", "auc")


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Counts per (label, prediction)."""
    return df.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("cnt"))


def _counts(df: DataFrame, label: str, prediction: str) -> DataFrame:
    y = F.col(label) == 1
    p = F.col(prediction) == 1
    return df.agg(
        flag_count(y & p).alias("tp"),
        flag_count(~y & p).alias("fp"),
        flag_count(y & ~p).alias("fn"),
        flag_count(~y & ~p).alias("tn"),
    )


def _metrics(counts: DataFrame, *keep: str) -> DataFrame:
    """Counts and the metrics derived from them; zero divisors give NULL."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.select(
        "tp",
        "fp",
        "fn",
        "tn",
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        *keep,
    )


def binary_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Positive-class precision, recall, F1 and accuracy (one aggregation). Zero divisors give NULL."""
    return _metrics(_counts(df, label, prediction))


def _checked(score: str) -> Column:
    """The score; a NULL or NaN one raises."""
    bad = F.col(score).isNull() | F.isnan(score)
    return F.when(bad, F.raise_error(F.lit("NULL or NaN score"))).otherwise(F.col(score))


def score_counts(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Positives and negatives per distinct score (NULL scores are not allowed)."""
    return df.groupBy(_checked(score).alias("threshold")).agg(
        flag_count(F.col(label) == 1).alias("pos"), flag_count(F.col(label) != 1).alias("neg")
    )


def cumulative(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Per distinct score, descending: ``tp``/``fp`` = positives/negatives with score >= threshold.

    Adds ``rank`` (1 = highest score), the totals ``tp_total`` (P) and ``fp_total`` (N).
    """
    sc = score_counts(df, label, score)
    return running_totals(
        sc,
        order_by=[F.col("threshold").desc()],
        sums={"tp": F.col("pos"), "fp": F.col("neg")},
    )


def roc_curve(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """One ROC point per distinct score: (threshold, fpr, tpr), points with score >= threshold positive."""
    c = cumulative(df, label, score)
    return c.select(
        "threshold",
        ratio("fp", "fp_total").alias("fpr"),
        ratio("tp", "tp_total").alias("tpr"),
        "rank",
    )


def pr_curve(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """One point per distinct score: (threshold, precision, recall)."""
    c = cumulative(df, label, score)
    return c.select(
        "threshold",
        ratio("tp", F.col("tp") + F.col("fp")).alias("precision"),
        ratio("tp", "tp_total").alias("recall"),
        "rank",
    )


def auc_exact(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Exact ROC AUC (ties count one half), NULL when a class is absent."""
    c = cumulative(df, label, score)
    s = F.sum(F.col("neg").cast(_BIG) * (2 * F.col("tp") - F.col("pos")).cast(_BIG))
    agg = c.agg(
        s.alias("_s"),
        F.max("tp_total").alias("_p"),
        F.max("fp_total").alias("_n"),
    )
    den = F.lit(2.0) * F.col("_p").cast("double") * F.col("_n").cast("double")
    return agg.select(ratio(F.col("_s").cast("double"), den).alias("auc"))


def sample_curve(curve: DataFrame, step: int, rank: str = "rank") -> DataFrame:
    """Every ``step``-th point of a curve (0-based position along the curve's order)."""
    return curve.where((F.col(rank) - 1) % step == 0)


def evaluate_report(
    df: DataFrame, label: str = "label", prediction: str = "prediction", score: str = "score"
) -> DataFrame:
    """Confusion counts, accuracy, precision, recall, F1 and AUC as (metric, value) rows."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    per_score = df.groupBy(_checked(score).alias("threshold")).agg(
        flag_count(y).alias("pos"),
        flag_count(~y).alias("neg"),
        flag_count(y & p).alias("tp"),
        flag_count(~y & p).alias("fp"),
        flag_count(y & ~p).alias("fn"),
        flag_count(~y & ~p).alias("tn"),
    )
    c = running_totals(per_score, [F.col("threshold").desc()], sums={"above": F.col("pos")})
    # Twice the pairs (negative, positive scored higher), a tie counting one half; one row from one aggregate.
    twice = F.sum(F.col("neg").cast(_BIG) * (2 * F.col("above") - F.col("pos")).cast(_BIG)).cast("double")
    row = c.agg(
        *[F.sum(n).alias(n) for n in ("tp", "fp", "fn", "tn")],
        ratio(twice, F.lit(2.0) * F.sum("pos").cast("double") * F.sum("neg").cast("double")).alias("auc"),
    )
    row = _metrics(row, "auc")
    pairs = ", ".join(f"'{n}', cast({n} as double)" for n in REPORT)
    return row.select(F.expr(f"stack({len(REPORT)}, {pairs}) as (metric, value)"))


def multiclass_metric(df: DataFrame, metric: str, label: str = "label", prediction: str = "prediction") -> float:
    """Accuracy, weightedPrecision, weightedRecall, f1 ... from Spark's evaluator (always named, S9)."""
    ev = MulticlassClassificationEvaluator(labelCol=label, predictionCol=prediction, metricName=metric)
    return float(ev.evaluate(df))


def multiclass_report(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    metrics: tuple[str, ...] = ("accuracy", "weightedPrecision", "weightedRecall", "f1"),
) -> DataFrame:
    """E1/E2 as a small (metric, value) frame."""
    if set(metrics) <= set(CLASS_METRICS):
        known = class_metrics(df, label, prediction)  # one job for all of them
        vals = [(m, known[m]) for m in metrics]
    else:
        vals = [(m, multiclass_metric(df, m, label, prediction)) for m in metrics]
    return df.sparkSession.createDataFrame(vals, "metric string, value double")


CLASS_METRICS = ("accuracy", "weightedPrecision", "weightedRecall", "f1")


class CountsEvaluator(Evaluator):
    """A metric of CLASS_METRICS from the counts of (label, prediction), one grouping; for tuning too."""

    def __init__(self, label: str = "label", prediction: str = "prediction", metric: str = "f1"):
        super().__init__()
        if metric not in CLASS_METRICS:
            raise ValueError(f"unknown metric '{metric}'; known: {', '.join(CLASS_METRICS)}")
        self.label, self.prediction, self.metric = label, prediction, metric

    def _evaluate(self, dataset: DataFrame) -> float:
        return class_metrics(dataset, self.label, self.prediction)[self.metric]

    def isLargerBetter(self) -> bool:
        return True

    def copy(self, extra=None):
        return CountsEvaluator(self.label, self.prediction, self.metric)


def class_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> dict[str, float]:
    """All CLASS_METRICS, as Spark's evaluators define them, from one grouping (a row for each pair of classes)."""
    pairs = df.groupBy(F.col(label).cast("double").alias("y"), F.col(prediction).cast("double").alias("p"))
    cells = {(r["y"], r["p"]): r["n"] for r in pairs.agg(F.count(F.lit(1)).alias("n")).collect()}
    n = sum(cells.values())
    if not n:
        return dict.fromkeys(CLASS_METRICS, math.nan)
    out = dict.fromkeys(CLASS_METRICS, 0.0)
    for c in {y for y, _ in cells}:
        true = sum(k for (y, _), k in cells.items() if y == c)
        said = sum(k for (_, p), k in cells.items() if p == c)
        hit = cells.get((c, c), 0)
        precision, recall = hit / said if said else 0.0, hit / true
        out["accuracy"] += hit / n
        out["weightedPrecision"] += precision * true / n
        out["weightedRecall"] += recall * true / n
        out["f1"] += (2 * precision * recall / (precision + recall) if hit else 0.0) * true / n
    return out


def auc_of_quantiles(df: DataFrame, label: str = "label", score: str = "score", bins: int = 1000) -> DataFrame:
    """E5: (auc, error): ROC AUC over ``bins`` score ranges of equal size, cut by a mergeable quantile sketch.

    Pairs of a positive and a negative row in one range count one half, so the exact AUC lies within ``error``
    (half the share of such pairs). Two aggregates, whatever the number of different scores.
    """
    s, y = F.col(score).cast("double"), F.col(label).cast("double")
    rows = df.select(s.alias("s"), (y == 1).alias("up")).where("s IS NOT NULL AND up IS NOT NULL")
    got = rows.agg(F.percentile_approx("s", [i / bins for i in range(1, bins)], 100 * bins)).first()[0]
    edges = [-math.inf, *sorted(set(got or [0.0])), math.inf]  # at most ``bins`` numbers
    ranged = Bucketizer(splits=edges, inputCol="s", outputCol="bin", handleInvalid="keep").transform(rows)
    per = ranged.groupBy("bin").agg(
        F.sum(F.col("up").cast("long")).alias("p"), F.sum((~F.col("up")).cast("long")).alias("n")
    )
    below = per.agg(F.sort_array(F.collect_list(F.struct("bin", "p", "n"))).alias("b"))
    start = F.struct(*[F.lit(0.0).alias(c) for c in ("won", "tied", "neg", "pos")])
    total = F.aggregate(
        "b", start,
        lambda a, x: F.struct(
            (a["won"] + x["p"] * a["neg"]).alias("won"), (a["tied"] + x["p"] * x["n"].cast("double")).alias("tied"),
            (a["neg"] + x["n"]).alias("neg"), (a["pos"] + x["p"]).alias("pos"),
        ),
    )
    t = below.select(total.alias("t"))
    pairs = F.col("t.pos") * F.col("t.neg")
    return t.select(
        F.try_divide(F.col("t.won") + F.col("t.tied") / 2, pairs).alias("auc"),
        F.try_divide(F.col("t.tied") / 2, pairs).alias("error"),
    )


def weighted_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """E2 written as one query: per-class precision/recall weighted by class frequency, and weighted F1.

    Same definitions as Spark's ``MulticlassMetrics`` (weights = true-class share).
    """
    cells = df.groupBy(F.col(label).cast("double").alias("l"), F.col(prediction).cast("double").alias("c")).agg(
        F.count(F.lit(1)).alias("n")
    )
    # From here on: one row per (class, class), then one per class.
    sides = F.explode(
        F.array(
            F.struct(F.col("l").alias("cls"), F.col("n").alias("t"), F.lit(0).cast("long").alias("q")),
            F.struct(F.col("c").alias("cls"), F.lit(0).cast("long").alias("t"), F.col("n").alias("q")),
        )
    )
    hit = F.when(F.col("l") == F.col("c"), F.col("n")).otherwise(0)
    per = (
        cells.select(sides.alias("s"), hit.alias("h"))
        .groupBy("s.cls")
        .agg(F.sum("s.t").alias("n_true"), F.sum("s.q").alias("n_pred"), (F.sum("h") / 2).alias("n_hit"))
        .where("n_true > 0")
        .select(
            "cls",
            "n_true",
            F.coalesce(ratio("n_hit", "n_pred"), F.lit(0.0)).alias("p"),
            F.coalesce(ratio("n_hit", "n_true"), F.lit(0.0)).alias("r"),
        )
    )
    pr_sum = F.col("p") + F.col("r")
    per = per.withColumn("f", F.when(pr_sum == 0, 0.0).otherwise(2 * F.col("p") * F.col("r") / pr_sum))
    agg = per.agg(
        F.sum(F.col("n_true") * F.col("p")).alias("_wp"),
        F.sum(F.col("n_true") * F.col("r")).alias("_wr"),
        F.sum(F.col("n_true") * F.col("f")).alias("_wf"),
        F.sum("n_true").alias("_n"),
    )
    return agg.select(
        (F.col("_wp") / F.col("_n")).alias("weighted_precision"),
        (F.col("_wr") / F.col("_n")).alias("weighted_recall"),
        (F.col("_wf") / F.col("_n")).alias("weighted_f1"),
    )


def auc_binned(df: DataFrame, label: str = "label", raw: str = "rawPrediction", bins: int = 1000) -> float:
    """E5: Spark's binned ROC AUC (``BinaryClassificationEvaluator``, ``numBins`` bins)."""
    ev = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=raw, metricName="areaUnderROC", numBins=bins)
    return float(ev.evaluate(df))


def evaluator_report(df: DataFrame, label: str = "label", prediction: str = "prediction", score: str = "score") -> DataFrame:
    """Spark's evaluators (all thresholds for the AUC) as (metric, value), rounded to 9 digits."""
    names = ("accuracy", "weightedPrecision", "weightedRecall", "f1")
    d = df.select(F.col(label).cast("double").alias("label"), F.col(prediction).alias("prediction"), F.col(score).alias("raw"))
    rows = [(m, multiclass_metric(d, m, "label", "prediction")) for m in names]
    rows.append(("areaUnderROC", auc_binned(d, "label", "raw", 0)))
    return df.sparkSession.createDataFrame([(m, round(v, 9)) for m, v in rows], "metric string, value double")
