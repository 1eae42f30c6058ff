"""Tree classifiers on Spark ML.

Boosted trees of the XGBoost/LightGBM kind are mapped onto Spark's ``GBTClassifier``: rounds → ``maxIter``,
learning rate → ``stepSize``, bagging fraction → ``subsamplingRate``, feature fraction →
``featureSubsetStrategy``. Early stopping by ``validationIndicatorCol`` alone follows Spark's tolerance (it stops when the
validation loss improves by less than ``validationTol``); with ``early_stopping_rounds`` it counts rounds
(``operators/boosting.py``, where a missing value is handled too). Spark has no leaf-count limit; a leaf budget ``numLeaves`` becomes ``minInstancesPerNode = rows / numLeaves`` (a tree then has at most that many
leaves), and ``maxDepth`` acts beside it. Parameters without a counterpart raise.

A fit scans its rows a few times and then works on a binned copy that Spark keeps (4 bytes a feature). The ``fit_``
functions do not cache the rows beside it: whole rows are many times larger than the stored columns. A caller whose rows
are expensive to derive holds them with ``persisted``, best as columns that are not assembled yet (these are compressed).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from typing import Any

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.functions.scalar import LABEL
from trolley.operators import boosting
from trolley.operators.histogram_boosting import HistogramGBT

# Boosting parameter names of other libraries → Spark GBTClassifier parameter names.
GBT_ALIASES = {
    "n_estimators": "maxIter",
    "numIterations": "maxIter",
    "num_iterations": "maxIter",
    "learning_rate": "stepSize",
    "learningRate": "stepSize",
    "max_depth": "maxDepth",
    "baggingFraction": "subsamplingRate",
    "subsample": "subsamplingRate",
    "featureFraction": "featureSubsetStrategy",
    "colsample_bytree": "featureSubsetStrategy",
}
LEAF_BUDGET = {"numLeaves", "num_leaves"}
#: Parameters that an estimator alone can't hold, and where to find them.
UNMAPPED_GBT = {
    "earlyStoppingRound": "fit_gbt stops by rounds",
    "early_stopping_rounds": "fit_gbt stops by rounds",
    "missing": "assemble with boosting.MissingSides",
}


def translate_gbt(params: dict[str, Any], rows: int | None = None) -> dict[str, Any]:
    """Other libraries' boosting parameters → GBTClassifier parameters (see module notes).

    ``rows`` is the number of training rows; a leaf budget needs it. A parameter that cannot be mapped raises.
    """
    kw: dict[str, Any] = {}
    for k, v in params.items():
        if v is None:
            continue
        if k in UNMAPPED_GBT:
            raise ValueError(f"'{k}' is no parameter of Spark's boosted trees: {UNMAPPED_GBT[k]}")
        if k == "eval_metric":
            if v != "logloss":
                raise ValueError(f"boosted trees are evaluated by 'logloss', not by {v!r}")
            continue
        if k in LEAF_BUDGET:
            if rows is None:
                raise ValueError(f"'{k}' is mapped to the least rows of a leaf and needs the number of rows")
            kw["minInstancesPerNode"] = max(1, int(rows) // max(2, int(v)))
            continue
        name = GBT_ALIASES.get(k, k)
        if name == "featureSubsetStrategy" and isinstance(v, float):
            v = repr(min(max(v, 1e-6), 1.0))
        if name in ("maxIter", "maxDepth"):
            v = int(v)
        kw[name] = v
    return kw


def assembler(cols: Sequence[str], out: str = "features", handle_invalid: str = "error") -> VectorAssembler:
    """A VectorAssembler; with ``error`` a NULL feature raises at execution (fill first)."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid=handle_invalid)


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features", handle_invalid: str = "error") -> DataFrame:
    """Add the feature vector column; all other columns (ids included) are kept."""
    return assembler(cols, out, handle_invalid).transform(df)


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Keep a frame cached while an iterative fit scans it repeatedly (P5); released afterwards."""
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()


def check_binary(df: DataFrame, label: str = LABEL) -> None:
    """Boosted trees need labels in {0, 1}; fail early with a clear message (one small job)."""
    bad = df.where(~F.col(label).isin(0, 1) | F.col(label).isNull()).limit(1).count()
    if bad:
        raise ValueError(f"GBT needs a binary label: column '{label}' has values outside {{0, 1}}")


def tree(label: str = LABEL, features: str = "features", **params: Any) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(featuresCol=features, labelCol=label, **params)


def forest(label: str = LABEL, features: str = "features", **params: Any) -> RandomForestClassifier:
    return RandomForestClassifier(featuresCol=features, labelCol=label, **params)


def gbt(label: str = LABEL, features: str = "features", rows: int | None = None, **params: Any) -> GBTClassifier:
    """A GBTClassifier; other libraries' parameter names are translated (see ``GBT_ALIASES``)."""
    return HistogramGBT(featuresCol=features, labelCol=label, **translate_gbt(params, rows))


def fit_tree(df: DataFrame, label: str = LABEL, features: str = "features", **params: Any):
    """C4: decision tree."""
    return tree(label, features, **params).fit(df)


def fit_forest(df: DataFrame, label: str = LABEL, features: str = "features", **params: Any):
    """Random forest (Spark defaults: 20 trees, depth 5)."""
    return forest(label, features, **params).fit(df)


def fit_gbt(df: DataFrame, label: str = LABEL, features: str = "features", **params: Any):
    """Binary gradient-boosted trees.

    ``validationIndicatorCol`` enables early stopping: by Spark's tolerance, or with ``early_stopping_rounds`` by rounds.
    """
    params, patience = boosting.split_options(params)
    if patience is not None and "validationIndicatorCol" not in params:
        raise ValueError("early_stopping_rounds needs validationIndicatorCol")
    check_binary(df, label)
    rows = df.count() if LEAF_BUDGET & set(params) else None
    if patience is None:
        return gbt(label, features, rows, **params).fit(df)
    flag = params.pop("validationIndicatorCol")
    return boosting.fit_stopping(gbt(label, features, rows, **params), df, flag, patience)[0]


def predict(model, df: DataFrame) -> DataFrame:
    """``model.transform``; every input column (ids included) is kept, so nothing is re-joined."""
    return model.transform(df)


def feature_importance(model, cols: Sequence[str]) -> DataFrame:
    """C11: (feature, importance) sorted by importance, descending. One row per feature."""
    spark = _spark_of(model)
    imp = model.featureImportances.toArray().tolist()
    rows = [(c, float(v)) for c, v in zip(cols, imp)]
    df = spark.createDataFrame(rows, "feature string, importance double")
    return df.orderBy(F.desc("importance"), "feature")


def tree_summary(model) -> DataFrame:
    """Node count, depth, classes, features (ensembles: trees, total nodes, max depth)."""
    spark = _spark_of(model)
    if hasattr(model, "trees"):
        trees = model.trees
        row = (len(trees), int(model.totalNumNodes), max(t.depth for t in trees), int(model.numClasses), int(model.numFeatures))
    else:
        row = (1, int(model.numNodes), int(model.depth), int(model.numClasses), int(model.numFeatures))
    return spark.createDataFrame([row], "num_trees int, num_nodes int, depth int, num_classes int, num_features int")


def root_split(model) -> tuple[int, float]:
    """(feature index, threshold) of a tree's first split (an ensemble's first tree)."""
    tree_model = model.trees[0] if hasattr(model, "trees") else model
    root = tree_model._java_obj.rootNode()
    if root.subtreeDepth() == 0:
        raise ValueError("the tree is a single leaf")
    split = root.split()
    return int(split.featureIndex()), float(split.threshold())


def pipeline(stages: Sequence[Any]) -> Pipeline:
    """A Pipeline of the given stages."""
    return Pipeline(stages=list(stages))


def _spark_of(model):
    from pyspark.sql import SparkSession

    s = SparkSession.getActiveSession()
    if s is None:
        raise RuntimeError("no active SparkSession")
    return s


__all__ = [
    "PipelineModel",
    "assemble",
    "assembler",
    "check_binary",
    "feature_importance",
    "fit_forest",
    "fit_gbt",
    "fit_tree",
    "forest",
    "gbt",
    "pipeline",
    "predict",
    "root_split",
    "tree",
    "tree_summary",
]
