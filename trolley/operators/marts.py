"""Feature marts (M1-M13): product, aisle, user and user×product features, data mart, train/test sets.

Design (one pass over the prior lines): the lines are grouped once to user×product, together with the sums
and non-null counts needed later. Product and user features are roll-ups of that table: since every
(order, product) pair is one line, "distinct users of a product" is the number of user×product rows of the
product, and averages are sums over counts (exact: the inputs are integers). Only "distinct orders per user"
and "distinct users per aisle" need their own small aggregation. This replaces three separate groupings of the
line table (each with two ``count(distinct)`` that Spark would expand row-wise) by one shuffle of the lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.functions.scalar import (
    ID_COLUMNS,
    LABEL,
    MODEL_FEATURES,
    PRODUCT_FEATURES,
    UP_FEATURES,
    USER_FEATURES,
    flag_count,
    ratio,
)

OPP_COLUMNS = [
    "order_id", "product_id", "add_to_cart_order", "reordered", "user_id", "eval_set", "order_number",
    "order_dow", "order_hour_of_day", "days_since_prior_order",
]
UP_GROUP_COLUMNS = ["user_id", "product_id", *UP_FEATURES[:12]]
USER_MART_COLUMNS = ["user_id", *USER_FEATURES, "order_id", "eval_set", "days_since_prior_order"]
UP_MART_COLUMNS = [*UP_GROUP_COLUMNS, "up_usr_ratio", "up_usr_reord_ratio", "usr_reord_cnt", "up_usr_ord_num_diff"]
PRODUCT_MART_COLUMNS = ["product_id", *PRODUCT_FEATURES]
DATA_MART_COLUMNS = [
    "user_id", "product_id", "order_id", *UP_FEATURES, *USER_FEATURES, "eval_set", "days_since_prior_order",
    *PRODUCT_FEATURES,
]
LABELS = "labels"  # of the stored data mart
_DAYS = "days_since_prior_order"
_HELPERS = ["_days_sum", "_days_n", "_dow_sum", "_hour_sum"]


def prior_lines(priors: DataFrame, orders: DataFrame) -> DataFrame:
    """M1: prior lines with their order context (inner join on order_id)."""
    o = orders.select("order_id", "user_id", "eval_set", "order_number", "order_dow", "order_hour_of_day", _DAYS)
    return priors.select("order_id", "product_id", "add_to_cart_order", "reordered").join(o, "order_id").select(
        *OPP_COLUMNS
    )


def _up_base(opp: DataFrame) -> DataFrame:
    """User×product features plus the sums/counts the roll-ups need (one shuffle of the lines)."""
    # Averages are sums over counts (exact: whole numbers), so that the shuffled rows hold each sum once.
    g = opp.groupBy("user_id", "product_id").agg(
        F.count(F.lit(1)).alias("up_cnt"),
        F.sum("reordered").alias("up_reord_cnt"),
        F.count("reordered").alias("_reord_n"),
        flag_count(F.col("reordered") == 0).alias("up_no_reord_cnt"),
        F.max("order_number").alias("up_max_ord_num"),
        F.min("order_number").alias("up_min_ord_num"),
        F.sum("add_to_cart_order").alias("_cart_sum"),
        F.count("add_to_cart_order").alias("_cart_n"),
        F.max(_DAYS).alias("up_max_prior_days"),
        F.min(_DAYS).alias("up_min_prior_days"),
        F.sum(_DAYS).alias("_days_sum"),
        F.count(_DAYS).alias("_days_n"),
        F.sum("order_dow").alias("_dow_sum"),
        F.count("order_dow").alias("_dow_n"),
        F.sum("order_hour_of_day").alias("_hour_sum"),
        F.count("order_hour_of_day").alias("_hour_n"),
    )
    averages = {
        "up_reoredered_avg": ratio("up_reord_cnt", "_reord_n"),
        "up_avg_cart": ratio("_cart_sum", "_cart_n"),
        "up_avg_prior_days": ratio("_days_sum", "_days_n"),
        "up_avg_ord_dow": ratio("_dow_sum", "_dow_n"),
        "up_avg_ord_hour": ratio("_hour_sum", "_hour_n"),
    }
    return g.select(*[averages[c].alias(c) if c in averages else c for c in UP_GROUP_COLUMNS], *_HELPERS)


def user_product_features(opp: DataFrame) -> DataFrame:
    """M7: features per (user, product) over prior lines."""
    return _up_base(opp).select(*UP_GROUP_COLUMNS)


def product_aisles(products: DataFrame, aisles: DataFrame) -> DataFrame:
    """product_id → aisle_id for products whose aisle id is numeric and known (S2: dirty ids drop out)."""
    p = products.select("product_id", F.col("aisle_id").try_cast("int").alias("aisle_id"))
    return p.join(aisles.select("aisle_id"), "aisle_id").select("product_id", "aisle_id")


def product_features(up: DataFrame, prod_aisle: DataFrame) -> DataFrame:
    """M2: per-product features, rolled up from the user×product base."""
    g = up.groupBy("product_id").agg(
        F.sum("up_reord_cnt").alias("prd_reordered_cnt"),
        F.sum("up_no_reord_cnt").alias("prd_no_reordered_cnt"),
        F.count(F.lit(1)).alias("prd_unq_usr_cnt"),
        F.sum("up_cnt").alias("prd_total_cnt"),
        F.sum("_days_sum").alias("_ds"),
        F.sum("_days_n").alias("_dn"),
        F.min("up_min_prior_days").alias("_dmin"),
        F.max("up_max_prior_days").alias("_dmax"),
    )
    return g.join(prod_aisle, "product_id").select(
        "product_id",
        "prd_reordered_cnt",
        "prd_no_reordered_cnt",
        ratio("prd_reordered_cnt", "prd_total_cnt").alias("prd_avg_reordered"),
        "prd_unq_usr_cnt",
        "prd_total_cnt",
        ratio("prd_unq_usr_cnt", "prd_total_cnt").alias("prd_usr_ratio"),
        "aisle_id",
        F.coalesce(ratio("_ds", "_dn"), F.lit(0.0)).alias("prd_avg_prior_days"),
        F.coalesce(F.col("_dmin"), F.lit(0)).alias("prd_min_prior_days"),
        F.coalesce(F.col("_dmax"), F.lit(0)).alias("prd_max_prior_days"),
    )


def aisle_features(up: DataFrame, prod_aisle: DataFrame) -> DataFrame:
    """M3: distinct users, lines and their ratio per aisle."""
    per_user = (
        up.select("user_id", "product_id", "up_cnt")
        .join(prod_aisle, "product_id")
        .groupBy("aisle_id", "user_id")
        .agg(F.sum("up_cnt").alias("n"))
    )
    g = per_user.groupBy("aisle_id").agg(
        F.count(F.lit(1)).alias("aisle_distinct_usr_cnt"), F.sum("n").alias("aisle_total_cnt")
    )
    return g.select("*", ratio("aisle_distinct_usr_cnt", "aisle_total_cnt").alias("aisle_usr_ratio"))


def product_mart(up: DataFrame, prod_aisle: DataFrame) -> DataFrame:
    """M4: product features joined with aisle features, plus the user-ratio difference."""
    p = product_features(up, prod_aisle)
    a = aisle_features(up, prod_aisle)
    return p.join(a, "aisle_id").select(
        *PRODUCT_MART_COLUMNS[:-1], (F.col("prd_usr_ratio") - F.col("aisle_usr_ratio")).alias("usr_ratio_diff")
    )


def orders_with_lines(priors: DataFrame, orders: DataFrame) -> DataFrame:
    """Distinct prior orders that have at least one line, per user.

    Reads only ``order_id`` of the lines; the distinct is partially aggregated before its shuffle, so this pass
    moves one row per order instead of one per line, and the join to ``orders`` has unique keys on both sides.
    """
    ids = priors.select("order_id").distinct()
    return (
        ids.join(orders.select("order_id", "user_id"), "order_id")
        .groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("order_uq_cnt"))
    )


def user_features(up: DataFrame, priors: DataFrame, orders: DataFrame) -> DataFrame:
    """M5: per-user features, rolled up from the user×product base (+ distinct orders per user)."""
    orders_per_user = orders_with_lines(priors, orders)
    g = up.groupBy("user_id").agg(
        F.sum("up_cnt").alias("usr_total_cnt"),
        F.count(F.lit(1)).alias("prd_uq_cnt"),
        F.sum("up_reord_cnt").alias("usr_reord_cnt"),
        F.sum("up_no_reord_cnt").alias("usr_no_reord_cnt"),
        F.sum("_days_sum").alias("_ds"),
        F.sum("_days_n").alias("_dn"),
        F.max("up_max_prior_days").alias("usr_max_prior_days"),
        F.min("up_min_prior_days").alias("usr_min_prior_days"),
        F.sum("_dow_sum").alias("_dows"),
        F.sum("_hour_sum").alias("_hours"),
        F.max("up_max_ord_num").alias("usr_max_order_number"),
    )
    return g.join(orders_per_user, "user_id").select(
        "user_id",
        "usr_total_cnt",
        "prd_uq_cnt",
        "order_uq_cnt",
        ratio("usr_total_cnt", "order_uq_cnt").alias("usr_avg_prd_cnt"),
        ratio("usr_total_cnt", "prd_uq_cnt").alias("usr_avg_uq_prd_cnt"),
        ratio("prd_uq_cnt", "usr_total_cnt").alias("usr_uq_prd_ratio"),
        "usr_reord_cnt",
        "usr_no_reord_cnt",
        ratio("usr_reord_cnt", "usr_total_cnt").alias("usr_reordered_avg"),
        ratio("_ds", "_dn").alias("usr_avg_prior_days"),
        "usr_max_prior_days",
        "usr_min_prior_days",
        ratio("_dows", "usr_total_cnt").alias("usr_avg_order_dow"),
        ratio("_hours", "usr_total_cnt").alias("usr_avg_order_hour_of_day"),
        "usr_max_order_number",
    )


def user_mart(users: DataFrame, orders: DataFrame) -> DataFrame:
    """M6: user features with the user's train/test target order (1:1 join)."""
    target = orders.where(F.col("eval_set").isin("train", "test")).select("user_id", "order_id", "eval_set", _DAYS)
    return users.join(target, "user_id").select(*USER_MART_COLUMNS)


def _up_with_user(up: DataFrame, umart: DataFrame) -> DataFrame:
    return with_user_ratios(up.join(umart, "user_id"))


def with_user_ratios(joined: DataFrame) -> DataFrame:
    """User×product rows beside their user's features (J5), with the ratios of both."""
    return joined.select(
        "*",
        ratio("up_cnt", "usr_total_cnt").alias("up_usr_ratio"),
        ratio("up_reord_cnt", "usr_reord_cnt").alias("up_usr_reord_ratio"),
        (F.col("usr_max_order_number") - F.col("up_max_ord_num")).alias("up_usr_ord_num_diff"),
    )


def user_product_mart(up: DataFrame, umart: DataFrame) -> DataFrame:
    """M8: user×product features with ratios against the user's totals."""
    return _up_with_user(up, umart).select(*UP_MART_COLUMNS)


def data_mart(up: DataFrame, umart: DataFrame, pmart: DataFrame) -> DataFrame:
    """M9: user×product rows with user and product features (user columns come from one join)."""
    return _up_with_user(up, umart).join(pmart, "product_id").select(*DATA_MART_COLUMNS)


def train_lines(trains: DataFrame, orders: DataFrame) -> DataFrame:
    """Train lines with their user."""
    return (
        trains.select("order_id", "product_id", "reordered")
        .join(orders.select("order_id", "user_id"), "order_id")
        .select("order_id", "product_id", "reordered", "user_id")
    )


def train_set(dm: DataFrame, tlines: DataFrame, *, fill: bool = True) -> DataFrame:
    """Rows of train users with the label; a row without a train line gets label 0 when ``fill``.

    ``fill`` applies ``fillna(0)`` to every numeric column (NULL, and NaN in doubles), as before model fit.
    """
    labels = tlines.select("user_id", "product_id", LABEL)
    out = (
        dm.where(F.col("eval_set") == "train")
        .join(labels, ["user_id", "product_id"], "left")
        .select(*ID_COLUMNS, *MODEL_FEATURES, LABEL)
    )
    return out.fillna(0) if fill else out


def labelled_data_mart(up: DataFrame, umart: DataFrame, pmart: DataFrame, tlines: DataFrame) -> DataFrame:
    """The data mart with ``labels``, an array of the labels of the row's train lines (NULL if none)."""
    # Dealt out and sorted by user once, while the rows are narrow; a user has at most one row for each product.
    by_user = tlines.repartition("user_id")
    pairs = by_user.groupBy("user_id", "product_id").agg(F.collect_list(F.struct(LABEL)).alias(LABELS))
    rows = up.repartition("user_id").join(pairs, ["user_id", "product_id"], "left")
    return _up_with_user(rows, umart).join(pmart, "product_id").select(*DATA_MART_COLUMNS, LABELS)


def unfold_labels(labelled: DataFrame, *, fill: bool = True) -> DataFrame:
    """M11 from ``labelled_data_mart``, without an exchange: the rows of ``train_set``, one for each label or one without."""
    rows = labelled.where(F.col("eval_set") == "train").withColumn("_label", F.explode_outer(LABELS))
    out = rows.select(*ID_COLUMNS, *MODEL_FEATURES, F.col(f"_label.{LABEL}").alias(LABEL))
    return out.fillna(0) if fill else out


def test_set(dm: DataFrame) -> DataFrame:
    """Rows of test users, ids kept for the submission."""
    return dm.where(F.col("eval_set") == "test").select(*ID_COLUMNS, *MODEL_FEATURES)


def test_orders(orders: DataFrame) -> DataFrame:
    """Target orders of test users, sorted by order id."""
    return orders.where(F.col("eval_set") == "test").orderBy("order_id")
