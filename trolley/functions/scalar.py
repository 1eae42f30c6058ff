"""Column helpers. All are built-in Spark expressions (JVM side, inside whole-stage codegen)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The 44 model features of the train/test sets, in the order the reference lists them.
UP_FEATURES = [
    "up_cnt", "up_reord_cnt", "up_no_reord_cnt", "up_reoredered_avg", "up_max_ord_num", "up_min_ord_num",
    "up_avg_cart", "up_avg_prior_days", "up_max_prior_days", "up_min_prior_days", "up_avg_ord_dow",
    "up_avg_ord_hour", "up_usr_ratio", "up_usr_reord_ratio", "up_usr_ord_num_diff",
]
USER_FEATURES = [
    "usr_total_cnt", "prd_uq_cnt", "order_uq_cnt", "usr_avg_prd_cnt", "usr_avg_uq_prd_cnt", "usr_uq_prd_ratio",
    "usr_reord_cnt", "usr_no_reord_cnt", "usr_reordered_avg", "usr_avg_prior_days", "usr_max_prior_days",
    "usr_min_prior_days", "usr_avg_order_dow", "usr_avg_order_hour_of_day", "usr_max_order_number",
]
PRODUCT_FEATURES = [
    "prd_reordered_cnt", "prd_no_reordered_cnt", "prd_avg_reordered", "prd_unq_usr_cnt", "prd_total_cnt",
    "prd_usr_ratio", "prd_avg_prior_days", "prd_min_prior_days", "prd_max_prior_days",
    "aisle_distinct_usr_cnt", "aisle_total_cnt", "aisle_usr_ratio", "usr_ratio_diff",
]
MODEL_FEATURES = [*UP_FEATURES, *USER_FEATURES, "days_since_prior_order", *PRODUCT_FEATURES]
ID_COLUMNS = ["user_id", "product_id", "order_id"]
LABEL = "reordered"
REORDER_THRESHOLD = 0.21  # fixed value: probability cut for "reordered"


def ratio(num: Column | str, den: Column | str) -> Column:
    """``num / den`` as double, NULL when ``den`` is 0 (ANSI ``/`` would raise)."""
    return F.try_divide(F.col(num) if isinstance(num, str) else num, F.col(den) if isinstance(den, str) else den)


def flag_count(cond: Column) -> Column:
    """``sum(case when cond then 1 else 0 end)``."""
    return F.sum(F.when(cond, 1).otherwise(0))


def is_missing(df: DataFrame, name: str, *, nan: bool = True) -> Column:
    """NULL test, plus NaN for float/double columns only (``isnan`` on other types raises under ANSI)."""
    c = F.col(name)
    if nan and isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def feature_columns(df: DataFrame, label: str = LABEL, ids: Iterable[str] = ID_COLUMNS) -> list[str]:
    """Every numeric column except the label and the id columns, in frame order."""
    skip = {label, *ids}
    numeric = (T.NumericType, T.BooleanType)
    return [f.name for f in df.schema.fields if f.name not in skip and isinstance(f.dataType, numeric)]


def positive_probability(probability: str = "probability") -> Column:
    """Probability of class 1 from an ML probability vector (NULL if the vector has one entry)."""
    return F.get(vector_to_array(probability), 1)


def above(score: Column | str, threshold: float, as_type: str = "int") -> Column:
    """``(score > threshold)`` cast to ``as_type``; strict, as in the reference."""
    s = F.col(score) if isinstance(score, str) else score
    return (s > F.lit(float(threshold))).cast(as_type)

