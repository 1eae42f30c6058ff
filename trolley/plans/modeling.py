"""Train → predict → threshold → submission, and the evaluation/tuning flows, over the mart chain.

Ids travel with the rows through ``VectorAssembler`` and ``model.transform`` (both keep every input column),
so predictions never need the reference's positional re-join by generated row ids.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.functions.scalar import ID_COLUMNS, LABEL, MODEL_FEATURES, REORDER_THRESHOLD, feature_columns
from trolley.operators import models, results, splits

SPLIT_KEYS = ["user_id", "product_id"]
SPLIT_SEED = 2021


@dataclass
class Prepared:
    train: DataFrame
    test: DataFrame
    features: list[str]


def split_rows(train_set: DataFrame, features: list[str] | None = None, test_fraction: float = 0.2) -> Prepared:
    """Zero-filled train rows, not assembled yet, by the key-hash 80/20 split."""
    cols = features or feature_columns(train_set)
    tr, te = splits.split(train_set.fillna(0), [1 - test_fraction, test_fraction], seed=SPLIT_SEED, keys=SPLIT_KEYS)
    return Prepared(tr, te, list(cols))


def prepare_binary(train_set: DataFrame, features: list[str] | None = None, test_fraction: float = 0.2) -> Prepared:
    """Zero-filled train rows → feature vector → key-hash 80/20 split (reproducible, ids kept)."""
    cols = features or feature_columns(train_set)
    vec = models.assemble(train_set.fillna(0), cols)
    tr, te = splits.split(vec, [1 - test_fraction, test_fraction], seed=SPLIT_SEED, keys=SPLIT_KEYS)
    return Prepared(tr, te, list(cols))


def prepare_multiclass(embeddings: DataFrame, test_fraction: float = 0.3) -> Prepared:
    """Embedding vectors with 10 classes: (vec_id, features, label) and a key-hash split on vec_id."""
    vec = embeddings.select("vec_id", array_to_vector("embedding").alias("features"), F.col("label").cast("double"))
    tr, te = splits.split(vec, [1 - test_fraction, test_fraction], seed=0, keys=["vec_id"])
    return Prepared(tr, te, ["embedding"])


def score(model, test_set: DataFrame, features: list[str] | None = None, threshold: float = REORDER_THRESHOLD) -> DataFrame:
    """Zero-fill, assemble, predict and re-threshold the scoring set; ids kept."""
    cols = features or MODEL_FEATURES
    vec = models.assemble(test_set.fillna(0), cols)
    pred = models.predict(model, vec)
    out = results.apply_threshold(results.positive_proba(pred), threshold)
    return out.select(*ID_COLUMNS, "1_proba", "prediction", "reordered")


def submission_from_model(model, test_set: DataFrame, threshold: float = REORDER_THRESHOLD) -> DataFrame:
    """Entry point B of the reference: scored test rows → one product list per order."""
    return results.submission(score(model, test_set, threshold=threshold))


def binary_predictions(model, df: DataFrame) -> DataFrame:
    """Predictions with ids, label and the class-1 probability."""
    p = models.predict(model, df)
    return results.positive_proba(p).select(*ID_COLUMNS, F.col(LABEL).alias("label"), "1_proba", "prediction", "rawPrediction")
