"""DuckDB SQL for every deterministic query of ``__spark_entry__.queries()``.

Each string runs on the pre-registered star-schema views (orders, lineitem, part, ...). The basket derivation
and the marts are written here the *direct* way (plain windows, ``count(distinct)``, the reference's SQL
shape), independently of the Spark formulation (roll-ups, blocked ordering), so a match checks both.
DuckDB specifics: ``sum(int)`` is HUGEINT → cast to BIGINT; ``x / 0`` is inf → ``nullif(d, 0)``.
"""

from __future__ import annotations

from trolley.functions.scalar import ID_COLUMNS, MODEL_FEATURES, PRODUCT_FEATURES, UP_FEATURES, USER_FEATURES

THRESHOLD = "0.21"

BASKET = """
_o AS (
  SELECT o_orderkey AS order_id, o_custkey AS user_id, CAST(o_orderdate AS DATE) AS order_date,
         row_number() OVER w AS order_number,
         count(*) OVER (PARTITION BY o_custkey) AS n_orders,
         lag(CAST(o_orderdate AS DATE)) OVER w AS prev_date
  FROM orders
  WINDOW w AS (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey)
),
b_orders AS (
  SELECT order_id, user_id,
         CASE WHEN order_number < n_orders THEN 'prior' WHEN user_id % 3 = 0 THEN 'test' ELSE 'train' END AS eval_set,
         CAST(order_number AS INTEGER) AS order_number,
         CAST(dayofweek(order_date) AS INTEGER) AS order_dow,
         CAST(order_id % 24 AS INTEGER) AS order_hour_of_day,
         CAST(date_diff('day', prev_date, order_date) AS INTEGER) AS days_since_prior_order
  FROM _o
),
_pm AS (
  SELECT p_partkey, p_brand, p_type,
         CAST(dense_rank() OVER (ORDER BY p_brand) AS INTEGER) AS aisle_id,
         CAST(dense_rank() OVER (ORDER BY p_type) AS INTEGER) AS department_id
  FROM part
),
b_pmap AS (
  SELECT p_partkey, CAST(aisle_id AS BIGINT) * 100 + department_id AS product_id, aisle_id, department_id,
         p_brand, p_type
  FROM _pm
),
_l AS (
  SELECT l.l_orderkey AS order_id, m.product_id, min(l.l_linenumber) AS first_line
  FROM lineitem l JOIN b_pmap m ON l.l_partkey = m.p_partkey
  GROUP BY 1, 2
),
_lc AS (
  SELECT _l.order_id, _l.product_id,
         CAST(row_number() OVER (PARTITION BY _l.order_id ORDER BY _l.first_line, _l.product_id) AS INTEGER)
           AS add_to_cart_order,
         o.user_id, o.order_number, o.eval_set
  FROM _l JOIN b_orders o ON _l.order_id = o.order_id
),
b_lines AS (
  SELECT order_id, product_id, add_to_cart_order,
         CAST(CASE WHEN order_number > min(order_number) OVER (PARTITION BY user_id, product_id) THEN 1 ELSE 0 END
              AS INTEGER) AS reordered,
         eval_set
  FROM _lc
),
priors AS (SELECT order_id, product_id, add_to_cart_order, reordered FROM b_lines WHERE eval_set = 'prior'),
trains AS (SELECT order_id, product_id, add_to_cart_order, reordered FROM b_lines WHERE eval_set = 'train'),
products AS (
  SELECT DISTINCT product_id, p_brand || ' ' || p_type AS product_name, CAST(aisle_id AS VARCHAR) AS aisle_id,
         department_id
  FROM b_pmap
),
aisles AS (SELECT DISTINCT aisle_id, p_brand AS aisle FROM b_pmap)
"""

_PRD_COLS = ", ".join(
    [
        "prd_reordered_cnt", "prd_no_reordered_cnt", "prd_avg_reordered", "prd_unq_usr_cnt", "prd_total_cnt",
        "prd_usr_ratio", "prd_avg_prior_days", "prd_min_prior_days", "prd_max_prior_days",
    ]
)

MARTS = f"""
opp AS (
  SELECT a.order_id, a.product_id, a.add_to_cart_order, a.reordered, b.user_id, b.eval_set, b.order_number,
         b.order_dow, b.order_hour_of_day, b.days_since_prior_order
  FROM priors a JOIN b_orders b ON a.order_id = b.order_id
),
opp_dim AS (
  SELECT a.*, c.aisle_id AS aisle_key
  FROM opp a JOIN products b ON a.product_id = b.product_id JOIN aisles c ON TRY_CAST(b.aisle_id AS INTEGER) = c.aisle_id
),
prd_grp AS (
  SELECT product_id,
         CAST(sum(CASE WHEN reordered = 1 THEN 1 ELSE 0 END) AS BIGINT) AS prd_reordered_cnt,
         CAST(sum(CASE WHEN reordered = 0 THEN 1 ELSE 0 END) AS BIGINT) AS prd_no_reordered_cnt,
         avg(reordered) AS prd_avg_reordered,
         count(DISTINCT user_id) AS prd_unq_usr_cnt,
         count(*) AS prd_total_cnt,
         count(DISTINCT user_id) / count(*) AS prd_usr_ratio,
         max(aisle_key) AS aisle_id,
         coalesce(avg(days_since_prior_order), 0) AS prd_avg_prior_days,
         coalesce(min(days_since_prior_order), 0) AS prd_min_prior_days,
         coalesce(max(days_since_prior_order), 0) AS prd_max_prior_days
  FROM opp_dim GROUP BY product_id
),
aisle_grp AS (
  SELECT aisle_key AS aisle_id, count(DISTINCT user_id) AS aisle_distinct_usr_cnt, count(*) AS aisle_total_cnt,
         count(DISTINCT user_id) / count(*) AS aisle_usr_ratio
  FROM opp_dim GROUP BY aisle_key
),
prd_mart AS (
  SELECT a.product_id, {_PRD_COLS}, b.aisle_distinct_usr_cnt, b.aisle_total_cnt, b.aisle_usr_ratio,
         a.prd_usr_ratio - b.aisle_usr_ratio AS usr_ratio_diff
  FROM prd_grp a JOIN aisle_grp b ON a.aisle_id = b.aisle_id
),
user_f AS (
  SELECT user_id, count(*) AS usr_total_cnt, count(DISTINCT product_id) AS prd_uq_cnt,
         count(DISTINCT order_id) AS order_uq_cnt,
         count(*) / count(DISTINCT order_id) AS usr_avg_prd_cnt,
         count(*) / count(DISTINCT product_id) AS usr_avg_uq_prd_cnt,
         count(DISTINCT product_id) / count(*) AS usr_uq_prd_ratio,
         CAST(sum(reordered) AS BIGINT) AS usr_reord_cnt,
         CAST(sum(CASE WHEN reordered = 0 THEN 1 ELSE 0 END) AS BIGINT) AS usr_no_reord_cnt,
         avg(reordered) AS usr_reordered_avg,
         avg(days_since_prior_order) AS usr_avg_prior_days,
         max(days_since_prior_order) AS usr_max_prior_days,
         min(days_since_prior_order) AS usr_min_prior_days,
         avg(order_dow) AS usr_avg_order_dow,
         avg(order_hour_of_day) AS usr_avg_order_hour_of_day,
         max(order_number) AS usr_max_order_number
  FROM opp GROUP BY user_id
),
user_mart AS (
  SELECT a.*, b.order_id, b.eval_set, b.days_since_prior_order
  FROM user_f a JOIN b_orders b ON a.user_id = b.user_id
  WHERE b.eval_set IN ('train', 'test')
),
up_grp AS (
  SELECT user_id, product_id, count(*) AS up_cnt, CAST(sum(reordered) AS BIGINT) AS up_reord_cnt,
         CAST(sum(CASE WHEN reordered = 0 THEN 1 ELSE 0 END) AS BIGINT) AS up_no_reord_cnt,
         avg(reordered) AS up_reoredered_avg, max(order_number) AS up_max_ord_num,
         min(order_number) AS up_min_ord_num, avg(add_to_cart_order) AS up_avg_cart,
         avg(days_since_prior_order) AS up_avg_prior_days, max(days_since_prior_order) AS up_max_prior_days,
         min(days_since_prior_order) AS up_min_prior_days, avg(order_dow) AS up_avg_ord_dow,
         avg(order_hour_of_day) AS up_avg_ord_hour
  FROM opp GROUP BY user_id, product_id
),
up_mart AS (
  SELECT a.*, a.up_cnt / b.usr_total_cnt AS up_usr_ratio,
         a.up_reord_cnt / nullif(b.usr_reord_cnt, 0) AS up_usr_reord_ratio, b.usr_reord_cnt,
         b.usr_max_order_number - a.up_max_ord_num AS up_usr_ord_num_diff
  FROM up_grp a JOIN user_mart b ON a.user_id = b.user_id
),
data_mart AS (
  SELECT a.user_id, a.product_id, b.order_id,
         {", ".join("a." + c for c in UP_FEATURES)},
         {", ".join("b." + c for c in USER_FEATURES)}, b.eval_set, b.days_since_prior_order,
         {", ".join("c." + c for c in PRODUCT_FEATURES)}
  FROM up_mart a JOIN user_mart b ON a.user_id = b.user_id JOIN prd_mart c ON a.product_id = c.product_id
),
train_lines AS (
  SELECT a.order_id, a.product_id, a.reordered, b.user_id FROM trains a JOIN b_orders b ON a.order_id = b.order_id
),
train_data AS (
  SELECT {", ".join("a." + c for c in ID_COLUMNS)}, {", ".join("a." + c for c in MODEL_FEATURES)}, b.reordered
  FROM data_mart a LEFT JOIN train_lines b ON a.user_id = b.user_id AND a.product_id = b.product_id
  WHERE a.eval_set = 'train'
),
train_set AS (
  SELECT {", ".join(ID_COLUMNS)}, {", ".join(f"coalesce({c}, 0) AS {c}" for c in MODEL_FEATURES)},
         coalesce(reordered, 0) AS reordered
  FROM train_data
),
test_set AS (
  SELECT {", ".join(ID_COLUMNS)}, {", ".join(MODEL_FEATURES)} FROM data_mart WHERE eval_set = 'test'
)
"""


def with_ctes(final: str, *, marts: bool = True) -> str:
    ctes = BASKET + ("," + MARTS if marts else "")
    return f"WITH {ctes}\n{final}"


def mart_queries() -> dict[str, str]:
    return {
        "basket_orders": with_ctes("SELECT * FROM b_orders", marts=False),
        "basket_priors": with_ctes("SELECT * FROM priors", marts=False),
        "prior_lines": with_ctes("SELECT * FROM opp"),
        "product_features": with_ctes("SELECT * FROM prd_grp"),
        "aisle_features": with_ctes("SELECT * FROM aisle_grp"),
        "product_mart": with_ctes("SELECT * FROM prd_mart"),
        "user_features": with_ctes("SELECT * FROM user_f"),
        "user_mart": with_ctes("SELECT * FROM user_mart"),
        "user_product_features": with_ctes("SELECT * FROM up_grp"),
        "user_product_mart": with_ctes("SELECT * FROM up_mart"),
        "data_mart": with_ctes("SELECT * FROM data_mart"),
        "train_lines": with_ctes("SELECT * FROM train_lines"),
        "train_set": with_ctes("SELECT * FROM train_set"),
        "test_set": with_ctes("SELECT * FROM test_set"),
        "test_orders": with_ctes("SELECT * FROM b_orders WHERE eval_set = 'test' ORDER BY order_id", marts=False),
    }


EVAL = f"""
scored AS (
  SELECT user_id, product_id, order_id, reordered AS label, up_reord_cnt / up_cnt AS score,
         CAST(up_reord_cnt / up_cnt > {THRESHOLD} AS DOUBLE) AS prediction
  FROM train_set
),
cm AS (
  SELECT CAST(sum(CASE WHEN label = 1 AND prediction = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
         CAST(sum(CASE WHEN label <> 1 AND prediction = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
         CAST(sum(CASE WHEN label = 1 AND prediction <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
         CAST(sum(CASE WHEN label <> 1 AND prediction <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS tn
  FROM scored
),
metrics AS (
  SELECT tp, fp, fn, tn, tp / nullif(tp + fp, 0) AS precision, tp / nullif(tp + fn, 0) AS recall,
         (2 * tp) / nullif(2 * tp + fp + fn, 0) AS f1, (tp + tn) / nullif(tp + fp + fn + tn, 0) AS accuracy
  FROM cm
),
sc AS (
  SELECT score AS threshold,
         CAST(sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS pos,
         CAST(sum(CASE WHEN label <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS neg
  FROM scored GROUP BY score
),
cum AS (
  SELECT threshold, pos, neg,
         row_number() OVER (ORDER BY threshold DESC) AS rank,
         CAST(sum(pos) OVER (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS tp,
         CAST(sum(neg) OVER (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS fp,
         CAST(sum(pos) OVER () AS BIGINT) AS tp_total,
         CAST(sum(neg) OVER () AS BIGINT) AS fp_total
  FROM sc
),
roc AS (
  SELECT threshold, fp / nullif(fp_total, 0) AS fpr, tp / nullif(tp_total, 0) AS tpr, rank FROM cum
),
auc AS (
  SELECT CAST(sum(CAST(neg AS HUGEINT) * (2 * tp - pos)) AS DOUBLE)
         / nullif(CAST(2 AS DOUBLE) * CAST(max(tp_total) AS DOUBLE) * CAST(max(fp_total) AS DOUBLE), 0) AS auc
  FROM cum
),
wm_label AS (SELECT label AS cls, count(*) AS n_true FROM scored GROUP BY label),
wm_pred AS (SELECT prediction AS cls, count(*) AS n_pred FROM scored GROUP BY prediction),
wm_hit AS (SELECT label AS cls, count(*) AS n_hit FROM scored WHERE label = prediction GROUP BY label),
wm_per AS (
  SELECT a.cls, a.n_true, coalesce(h.n_hit / nullif(b.n_pred, 0), 0.0) AS p,
         coalesce(h.n_hit / nullif(a.n_true, 0), 0.0) AS r
  FROM wm_label a LEFT JOIN wm_pred b ON a.cls = b.cls LEFT JOIN wm_hit h ON a.cls = h.cls
),
wm AS (
  SELECT sum(n_true * p) / sum(n_true) AS weighted_precision, sum(n_true * r) / sum(n_true) AS weighted_recall,
         sum(n_true * CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END) / sum(n_true) AS weighted_f1
  FROM wm_per
),
tscored AS (
  SELECT user_id, product_id, order_id, up_reord_cnt / up_cnt AS "1_proba",
         CAST(up_reord_cnt / up_cnt > {THRESHOLD} AS INTEGER) AS reordered
  FROM test_set
),
sub AS (
  SELECT order_id,
         coalesce(string_agg(CASE WHEN reordered = 1 THEN CAST(product_id AS VARCHAR) END, ' ' ORDER BY product_id),
                  'None') AS products
  FROM tscored GROUP BY order_id
)
"""



def _slot(seed: int) -> str:
    """The first 8 hex digits of the MD5 of seed and keys, as a number."""
    return f"CAST('0x' || substr(md5('{seed}:' || user_id || ':' || product_id), 1, 8) AS BIGINT)"


_DESCRIBE = ["up_cnt", "usr_total_cnt", "prd_total_cnt", "days_since_prior_order", "reordered"]


def _describe_sql() -> str:
    def row(name: str, fn: str) -> str:
        cols = ", ".join(f"CAST({fn.format(c=c)} AS DOUBLE) AS {c}" for c in _DESCRIBE)
        return f"SELECT '{name}' AS summary, {cols} FROM train_set"

    parts = [
        row("count", "count({c})"),
        row("mean", "avg({c})"),
        row("stddev", "stddev_samp({c})"),
        row("min", "min({c})"),
        row("max", "max({c})"),
    ]
    return "\nUNION ALL\n".join(parts)


def with_eval(final: str) -> str:
    return f"WITH {BASKET},{MARTS},{EVAL}\n{final}"


def audit_queries() -> dict[str, str]:
    null_cols = [*ID_COLUMNS, *MODEL_FEATURES, "reordered"]
    nulls = ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in null_cols)
    return {
        "null_counts": with_ctes(f"SELECT {nulls} FROM train_data"),
        "row_counts": with_ctes(
            "SELECT 'data_mart' AS table_name, count(*) AS row_count FROM data_mart UNION ALL "
            "SELECT 'user_mart', count(*) FROM user_mart UNION ALL "
            "SELECT 'prd_mart', count(*) FROM prd_mart UNION ALL "
            "SELECT 'up_mart', count(*) FROM up_mart"
        ),
        "duplicate_keys": with_ctes(
            "SELECT user_id, product_id, count(*) AS cnt FROM train_lines GROUP BY user_id, product_id "
            "HAVING count(*) > 1"
        ),
        "unmatched": with_ctes(
            "SELECT a.* FROM up_mart a LEFT JOIN user_mart b ON a.user_id = b.user_id "
            "LEFT JOIN prd_mart c ON a.product_id = c.product_id WHERE b.user_id IS NULL OR c.product_id IS NULL"
        ),
        "label_coverage": with_ctes(
            "SELECT 'pair_count' AS gubun, count(*) AS cnt FROM train_lines a LEFT JOIN data_mart b "
            "ON a.user_id = b.user_id AND a.product_id = b.product_id WHERE b.product_id IS NULL UNION ALL "
            "SELECT 'only_user_id_count', count(*) FROM train_lines a LEFT JOIN "
            "(SELECT user_id FROM data_mart GROUP BY user_id) b ON a.user_id = b.user_id WHERE b.user_id IS NULL "
            "UNION ALL SELECT 'only_product_id_count', count(*) FROM train_lines a LEFT JOIN "
            "(SELECT product_id FROM data_mart GROUP BY product_id) b ON a.product_id = b.product_id "
            "WHERE b.product_id IS NULL"
        ),
        "unmatched_label_dist": with_ctes(
            "SELECT a.reordered, count(*) AS cnt FROM train_lines a LEFT JOIN data_mart b "
            "ON a.user_id = b.user_id AND a.product_id = b.product_id WHERE b.product_id IS NULL GROUP BY a.reordered"
        ),
        "unlabelled_counts": with_ctes(
            "SELECT 'train_data' AS gubun, count(*) AS cnt FROM train_data UNION ALL "
            "SELECT 'reordered null', count(*) FROM train_data WHERE reordered IS NULL"
        ),
        "undefined_ratios": with_ctes(
            "SELECT user_id, product_id, up_reord_cnt, usr_reord_cnt FROM up_mart WHERE up_usr_reord_ratio IS NULL"
        ),
        "describe_features": with_ctes(_describe_sql()),
    }


def more_audits() -> dict[str, str]:
    undefined = ["up_usr_reord_ratio", "up_avg_prior_days", "up_max_prior_days", "up_min_prior_days", "usr_avg_prior_days", "reordered"]
    cols = [*ID_COLUMNS, *MODEL_FEATURES, "reordered"]
    described = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(count({c}) AS DOUBLE) AS cnt, round(avg({c}), 6) AS mean, "
        f"round(stddev_samp({c}), 6) AS stddev, round(CAST(min({c}) AS DOUBLE), 6) AS min, "
        f"round(CAST(max({c}) AS DOUBLE), 6) AS max FROM train_set"
        for c in cols
    )
    return {
        "duplicate_products": with_ctes(
            "SELECT product_id, count(*) AS cnt FROM train_lines GROUP BY product_id HAVING count(*) > 1"
        ),
        "unmatched_filtered": with_ctes(
            "SELECT user_id, product_id, up_cnt FROM up_mart a WHERE NOT EXISTS (SELECT 1 FROM user_mart u "
            "WHERE u.user_id = a.user_id AND u.eval_set = 'train') OR NOT EXISTS (SELECT 1 FROM prd_mart p "
            "WHERE p.product_id = a.product_id AND p.product_id % 2 = 0)"
        ),
        "undefined_counts": with_ctes(
            " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) - count({c}) AS undefined FROM train_data" for c in undefined)
        ),
        "products_without_days": with_ctes(
            "SELECT user_id, product_id, count(*) AS cnt FROM opp GROUP BY user_id, product_id "
            "HAVING count(days_since_prior_order) = 0"
        ),
        "nan_counts": with_ctes(
            "SELECT count(*) - count(up_usr_ratio) AS up_usr_ratio, count(*) - count(up_usr_reord_ratio) AS up_usr_reord_ratio "
            "FROM up_mart"
        ),
        "top_products": with_ctes(
            "SELECT product_id, prd_total_cnt, prd_reordered_cnt FROM prd_mart ORDER BY prd_total_cnt DESC, product_id LIMIT 10"
        ),
        "describe_all": with_ctes(described),
    }


def fine_queries() -> dict[str, str]:
    """The evaluation on a score of thousands of values: the EVAL block with another score and cut."""
    old = f"up_reord_cnt / up_cnt AS score,\n         CAST(up_reord_cnt / up_cnt > {THRESHOLD} AS DOUBLE) AS prediction"
    score = "(up_cnt * prd_total_cnt) / usr_total_cnt"
    assert old in EVAL
    block = EVAL.replace(old, f"{score} AS score, CAST({score} > 20.0 AS DOUBLE) AS prediction")

    def run(final: str) -> str:
        return f"WITH {BASKET},{MARTS},{block}\n{final}"

    report = " UNION ALL ".join(
        f"SELECT '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM metrics"
        for m in ["tn", "fp", "fn", "tp", "accuracy", "precision", "recall", "f1"]
    )
    return {
        "roc_curve_fine": run("SELECT * FROM roc"),
        "pr_curve_sample": run(
            "SELECT threshold, tp / nullif(tp + fp, 0) AS precision, tp / nullif(tp_total, 0) AS recall, rank FROM cum "
            "WHERE (rank - 1) % 50 = 0"
        ),
        "auc_exact_fine": run("SELECT * FROM auc"),
        "evaluate_report_fine": run(f"{report} UNION ALL SELECT 'auc', auc FROM auc"),
        "evaluator_metrics": run(
            "SELECT 'accuracy' AS metric, round(accuracy, 9) AS value FROM metrics UNION ALL "
            "SELECT 'weightedPrecision', round(weighted_precision, 9) FROM wm UNION ALL "
            "SELECT 'weightedRecall', round(weighted_recall, 9) FROM wm UNION ALL "
            "SELECT 'f1', round(weighted_f1, 9) FROM wm UNION ALL SELECT 'areaUnderROC', round(auc, 9) FROM auc"
        ),
    }


STUMP = """
stump_set AS (
  SELECT user_id, product_id, order_id, up_cnt, up_max_ord_num, up_min_ord_num,
         CAST(2 * up_max_ord_num > usr_max_order_number AS INTEGER) AS reordered
  FROM train_set
),
long AS (
  SELECT f, CAST(v AS DOUBLE) AS v, reordered AS y FROM (
    UNPIVOT (SELECT reordered, CAST(up_cnt AS BIGINT) AS up_cnt, CAST(up_max_ord_num AS BIGINT) AS up_max_ord_num,
                    CAST(up_min_ord_num AS BIGINT) AS up_min_ord_num FROM stump_set)
    ON up_cnt, up_max_ord_num, up_min_ord_num INTO NAME f VALUE v)
),
per_value AS (SELECT f, v, count(*) AS n, sum(y) AS p FROM long GROUP BY f, v),
cuts AS (
  SELECT f, (v + lead(v) OVER w) / 2 AS cut, sum(n) OVER w AS ln, sum(p) OVER w AS lp,
         sum(n) OVER (PARTITION BY f) AS tn, sum(p) OVER (PARTITION BY f) AS tp
  FROM per_value WINDOW w AS (PARTITION BY f ORDER BY v)
),
best AS (
  SELECT f, cut FROM cuts WHERE cut IS NOT NULL
  ORDER BY lp * (ln - lp) / ln + (tp - lp) * ((tn - ln) - (tp - lp)) / (tn - ln), f, cut LIMIT 1
),
sided AS (
  SELECT t.*, CASE b.f WHEN 'up_cnt' THEN up_cnt WHEN 'up_max_ord_num' THEN up_max_ord_num ELSE up_min_ord_num END
              <= b.cut AS lower
  FROM stump_set t, best b
),
leaf AS (SELECT lower, count(*) AS cnt, CAST(sum(reordered) AS BIGINT) AS positives FROM sided GROUP BY lower)
"""


def stump_queries() -> dict[str, str]:
    """One split found in SQL: the cut with the least impurity (Gini and variance choose the same)."""

    def run(final: str) -> str:
        return f"WITH {BASKET},{MARTS},{STUMP}\n{final}"

    scored = run(
        "SELECT round(positives / cnt, 9) AS p1, CAST(2 * positives > cnt AS DOUBLE) AS prediction, cnt, positives FROM leaf"
    )
    return {
        "stump_tree": run("SELECT f AS feature, cut, 3 AS num_nodes, 1 AS depth FROM best"),
        "stump_predict": run(
            f"SELECT {', '.join('s.' + c for c in ID_COLUMNS)}, round(l.positives / l.cnt, 9) AS p1, "
            "CAST(2 * l.positives > l.cnt AS DOUBLE) AS prediction FROM sided s JOIN leaf l ON s.lower = l.lower"
        ),
        "stump_forest": scored,
        "stump_pipeline": scored,
        "stump_gbt": run(
            "SELECT round(1 / (1 + exp(-2 * (2 * positives / cnt - 1))), 9) AS p1, "
            "CAST(2 * positives > cnt AS DOUBLE) AS prediction, cnt, positives FROM leaf"
        ),
        "stump_importance": run(
            "SELECT x.feature, CAST(x.feature = b.f AS DOUBLE) AS importance FROM best b, "
            "(VALUES ('up_cnt'), ('up_max_ord_num'), ('up_min_ord_num')) AS x(feature)"
        ),
    }


STUMP_FEATURES = ("up_cnt", "up_max_ord_num", "up_min_ord_num")
STOP_ROUNDS, STOP_RATE, STOP_PATIENCE = 8, 1.0, 2
CV_FOLDS, CV_MIN_ROWS = 3, (1, 4000, 12000)


def _long(source: str, value: str) -> str:
    """Feature values of grouped rows, one below the other, with the sums that a split needs."""
    return " UNION ALL ".join(
        f"SELECT '{f}' AS f, {i} AS fi, CAST({f} AS DOUBLE) AS v, CAST(sum(n) AS BIGINT) AS n, sum({value}) AS g "
        f"FROM {source} GROUP BY {f}" for i, f in enumerate(STUMP_FEATURES)
    )


def boosting_ctes(rounds: int, rate: float) -> str:
    """Boosted one-split trees: every round fits the split of least squares to the pseudo-residuals.

    Grouped rows (features, label, validation flag) carry their count n, their sign y and the sum so far (score).
    """
    out = [
        "boost_0 AS MATERIALIZED (SELECT up_cnt, up_max_ord_num, up_min_ord_num, isval, y, count(*) AS n, "
        f"0.0::DOUBLE AS score FROM (SELECT up_cnt, up_max_ord_num, up_min_ord_num, {_slot(2022)} < "
        f"{round(0.2 * 2**32)} AS isval, 2 * reordered - 1 AS y FROM stump_set) GROUP BY ALL)"
    ]
    for r in range(1, rounds + 1):
        target = "y" if r == 1 else "4 * y / (1 + exp(2 * y * score))"
        out += [
            f"fit_{r} AS (SELECT *, n * {target} AS g FROM boost_{r - 1} WHERE NOT isval)",
            f"vals_{r} AS ({_long(f'fit_{r}', 'g')})",
            f"cuts_{r} AS (SELECT f, fi, (v + lead(v) OVER w) / 2 AS cut, sum(n) OVER w AS ln, sum(g) OVER w AS lg, "
            f"sum(n) OVER (PARTITION BY f) AS tn, sum(g) OVER (PARTITION BY f) AS tg FROM vals_{r} "
            "WINDOW w AS (PARTITION BY f ORDER BY v))",
            f"best_{r} AS MATERIALIZED (SELECT f, cut, lg / ln AS low, (tg - lg) / (tn - ln) AS high FROM cuts_{r} "
            "WHERE cut IS NOT NULL ORDER BY lg * lg / ln + (tg - lg) * (tg - lg) / (tn - ln) DESC, fi, cut LIMIT 1)",
            f"boost_{r} AS MATERIALIZED (SELECT b.* REPLACE (score + {1.0 if r == 1 else rate} * CASE WHEN CASE t.f "
            + " ".join(f"WHEN '{f}' THEN {f}" for f in STUMP_FEATURES)
            + f" END <= t.cut THEN t.low ELSE t.high END AS score) FROM boost_{r - 1} b, best_{r} t)",
        ]
    losses = " UNION ALL ".join(
        f"SELECT {r} AS round, sum(n * ln(1 + exp(-2 * y * score))) / sum(n) AS loss FROM boost_{r} WHERE isval"
        for r in range(1, rounds + 1)
    )
    out += [
        f"losses AS MATERIALIZED ({losses})",
        "so_far AS (SELECT *, arg_min(round, loss) OVER (ORDER BY round) AS best FROM losses)",
        f"chosen AS MATERIALIZED (SELECT coalesce((SELECT best FROM so_far WHERE round - best >= {STOP_PATIENCE} "
        "ORDER BY round LIMIT 1), (SELECT best FROM so_far ORDER BY round DESC LIMIT 1)) AS keep)",
    ]
    return ",".join(out)


def _forest_of_cuts(name: str, rows: str, least: int) -> str:
    """The best cut (Gini) of the grouped rows (features, label, n) with at least ``least`` rows on both sides."""
    return (
        f"{name}_v AS ({_long(rows, 'n * reordered')}), "
        f"{name}_c AS (SELECT f, fi, (v + lead(v) OVER w) / 2 AS cut, sum(n) OVER w AS ln, sum(g) OVER w AS lp, "
        f"sum(n) OVER (PARTITION BY f) AS tn, sum(g) OVER (PARTITION BY f) AS tp FROM {name}_v "
        "WINDOW w AS (PARTITION BY f ORDER BY v)), "
        f"{name}_b AS MATERIALIZED (SELECT f, cut, 2 * lp > ln AS low, 2 * (tp - lp) > tn - ln AS high, "
        f"lp / ln AS low_share, (tp - lp) / (tn - ln) AS high_share FROM {name}_c "
        f"WHERE cut IS NOT NULL AND ln >= {least} AND tn - ln >= {least} "
        "ORDER BY lp * (ln - lp) / ln + (tp - lp) * ((tn - ln) - (tp - lp)) / (tn - ln), fi, cut LIMIT 1), "
        f"{name}_m AS MATERIALIZED (SELECT 2 * sum(n * reordered) > sum(n) AS most, "
        f"sum(n * reordered) / sum(n) AS share FROM {rows})"
    )


def _predicted(name: str, kind: str) -> str:
    """A row's prediction ('low', 'high' classes) or share, from the cut, or from all rows where no cut was allowed."""
    low, high, whole = ("low_share", "high_share", "share") if kind == "share" else ("low", "high", "most")
    value = "CASE b.f " + " ".join(f"WHEN '{f}' THEN {f}" for f in STUMP_FEATURES) + " END"
    return f"coalesce(CASE WHEN {value} <= b.cut THEN b.{low} WHEN {value} > b.cut THEN b.{high} END, m.{whole})"


def tuning_ctes() -> str:
    """Accuracies of one-split trees by fold and least number of rows of a leaf, and on the key-hash validation part."""
    slot = _slot(31)
    out = [
        "tune AS MATERIALIZED (SELECT up_cnt, up_max_ord_num, up_min_ord_num, reordered, "
        f"{slot} % {CV_FOLDS} AS fold, {slot} < {round(0.75 * 2**32)} AS fits, count(*) AS n FROM stump_set GROUP BY ALL)"
    ]
    cases = [(f"k{k}_{m}", f"fold <> {k}", f"fold = {k}", m) for k in range(CV_FOLDS) for m in CV_MIN_ROWS]
    cases += [(f"v_{m}", "fits", "NOT fits", m) for m in CV_MIN_ROWS]
    for name, inside, outside, m in cases:
        out += [
            f"{name}_r AS (SELECT * FROM tune WHERE {inside})",
            _forest_of_cuts(name, f"{name}_r", m),
            f"{name}_a AS (SELECT sum(CASE WHEN {_predicted(name, 'class')} = (reordered = 1) THEN n ELSE 0 END) / sum(n) "
            f"AS accuracy FROM (SELECT * FROM tune WHERE {outside}) t LEFT JOIN {name}_b b ON true LEFT JOIN {name}_m m ON true)",
        ]
    cv = " UNION ALL ".join(
        f"SELECT {m} AS least, "
        + "(" + " + ".join(f"(SELECT accuracy FROM k{k}_{m}_a)" for k in range(CV_FOLDS)) + f") / {CV_FOLDS} AS metric"
        for m in CV_MIN_ROWS
    )
    tvs = " UNION ALL ".join(f"SELECT {m} AS least, accuracy AS metric FROM v_{m}_a" for m in CV_MIN_ROWS)
    out += [f"cv AS MATERIALIZED ({cv})", f"tvs AS MATERIALIZED ({tvs})"]
    for m in CV_MIN_ROWS:
        out.append(_forest_of_cuts(f"all_{m}", "tune", m))
    return ",".join(out)


def tuning_queries() -> dict[str, str]:
    boost = f"WITH {BASKET},{MARTS},{STUMP},{boosting_ctes(STOP_ROUNDS, STOP_RATE)}\n"
    tune = f"WITH {BASKET},{MARTS},{STUMP},{tuning_ctes()}\n"

    def results(t: str) -> str:
        return (
            f"SELECT 'minInstancesPerNode=' || least AS params, round(metric, 9) AS metric, "
            f"metric = (SELECT max(metric) FROM {t}) AS is_best FROM {t}"
        )

    best = "(SELECT least FROM cv ORDER BY metric DESC, least LIMIT 1)"
    scores = " UNION ALL ".join(
        f"SELECT {m} AS least, {_predicted(f'all_{m}', 'share')} AS p, reordered, n "
        f"FROM tune LEFT JOIN all_{m}_b b ON true LEFT JOIN all_{m}_m m ON true" for m in CV_MIN_ROWS
    )
    kept = " UNION ALL ".join(f"SELECT {r} AS round, * FROM boost_{r} WHERE isval" for r in range(1, STOP_ROUNDS + 1))
    return {
        "stop_rounds": boost + "SELECT round, round(loss, 9) AS loss, round = keep AS chosen FROM losses, chosen",
        "stop_predict": boost
        + "SELECT round(1 / (1 + exp(-2 * score)), 9) AS p1, CAST(score > 0 AS DOUBLE) AS prediction, "
        f"CAST(sum(n) AS BIGINT) AS cnt, CAST(sum(n) FILTER (WHERE y = 1) AS BIGINT) AS positives FROM ({kept}) k, chosen "
        "WHERE k.round = keep GROUP BY 1, 2",
        "stump_cv": tune + results("cv"),
        "stump_tvs": tune + results("tvs"),
        "stump_cv_chain": tune
        + "SELECT round(p, 9) AS p1, CAST(p > 0.5 AS DOUBLE) AS prediction, CAST(sum(n) AS BIGINT) AS cnt, "
        f"CAST(sum(n * reordered) AS BIGINT) AS positives FROM ({scores}) WHERE least = {best} GROUP BY 1, 2",
    }


def result_queries() -> dict[str, str]:
    return {
        "threshold_labels": with_eval("SELECT * FROM tscored"),
        "order_counts": with_eval(
            "SELECT order_id, count(*) AS total_cnt_by_order_id, CAST(sum(reordered) AS BIGINT) AS reordered_cnt "
            "FROM tscored GROUP BY order_id"
        ),
        "submission": with_eval("SELECT * FROM sub"),
        "submission_coverage": with_eval(
            "SELECT 'missing_rows' AS gubun, count(*) AS cnt FROM tscored a "
            "WHERE NOT EXISTS (SELECT 1 FROM sub b WHERE b.order_id = a.order_id) UNION ALL "
            "SELECT 'submission_orders', count(*) FROM sub UNION ALL "
            "SELECT 'test_orders', count(*) FROM b_orders WHERE eval_set = 'test'"
        ),
    }


def evaluation_queries() -> dict[str, str]:
    report = " UNION ALL ".join(
        f"SELECT '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM metrics"
        for m in ["tn", "fp", "fn", "tp", "accuracy", "precision", "recall", "f1"]
    )
    return {
        "confusion": with_eval("SELECT label, prediction, count(*) AS cnt FROM scored GROUP BY label, prediction"),
        "binary_metrics": with_eval("SELECT * FROM metrics"),
        "roc_curve": with_eval("SELECT * FROM roc"),
        "pr_curve": with_eval(
            "SELECT threshold, tp / nullif(tp + fp, 0) AS precision, tp / nullif(tp_total, 0) AS recall, rank FROM cum"
        ),
        "auc_exact": with_eval("SELECT * FROM auc"),
        "evaluate_report": with_eval(f"{report} UNION ALL SELECT 'auc', auc FROM auc"),
        "curve_sample": with_eval("SELECT * FROM roc WHERE (rank - 1) % 2 = 0"),
        "weighted_metrics": with_eval("SELECT * FROM wm"),
    }


def split_queries() -> dict[str, str]:
    return {
        "key_split": with_ctes(
            f"SELECT CASE WHEN {_slot(2021)} < {round(0.8 * 2**32)} THEN 0 ELSE 1 END AS split, count(*) AS cnt, "
            "CAST(sum(reordered) AS BIGINT) AS positives FROM train_set GROUP BY 1"
        ),
        "validation_flag": with_ctes(f"SELECT user_id, product_id, {_slot(2022)} < {round(0.2 * 2**32)} AS isVal FROM train_set"),
    }


def all_queries() -> dict[str, str]:
    out = {}
    out.update(mart_queries())
    out.update(audit_queries())
    out["sql_aisle_report"] = with_ctes(
        "SELECT aisle_key AS aisle_id, count(DISTINCT order_id) AS orders, count(DISTINCT user_id) AS users, "
        "count(*) AS line_count, sum(reordered) / count(*) AS reorder_share FROM opp_dim GROUP BY aisle_key"
    )
    out["csv_user_mart"] = with_ctes("SELECT * FROM user_mart")
    out["malformed_rows"] = with_ctes(
        "SELECT count(*) AS row_count, count(*) FILTER (WHERE department_id = 2) AS malformed FROM products", marts=False
    )
    out["uncastable_aisles"] = with_ctes(
        "SELECT 'Blunted' AS value, count(*) AS cnt FROM products WHERE department_id = 1", marts=False
    )
    out["assembled_features"] = with_ctes(
        f"SELECT {', '.join(ID_COLUMNS)}, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in MODEL_FEATURES)} FROM train_set"
    )
    out.update(more_audits())
    out.update(fine_queries())
    out.update(stump_queries())
    out["submission_csv"] = with_eval("SELECT * FROM sub")
    out.update(result_queries())
    out.update(evaluation_queries())
    out.update(split_queries())
    out.update(tuning_queries())
    out["table_user_mart"] = out["user_mart"]
    out["table_user_product_mart"] = out["user_product_mart"]
    out["split_data_mart"] = out["data_mart"]
    out["split_train_set"] = out["train_set"]
    out["bitmap_aisle_features"] = out["aisle_features"]
    out["bitmap_product_users"] = with_ctes("SELECT product_id, count(DISTINCT user_id) AS prd_unq_usr_cnt FROM opp GROUP BY 1")
    out["coverage_once"] = with_ctes(
        "SELECT by_keys, count(*) AS lines, count(*) FILTER (WHERE NOT found) AS missing, "
        "count(DISTINCT key) FILTER (WHERE NOT found) AS keys_missing FROM ("
        + " UNION ALL ".join(
            f"SELECT '{name}' AS by_keys, {key} AS key, {test} IN (SELECT {test} FROM data_mart WHERE up_cnt > 1) AS found "
            "FROM train_lines"
            for name, key, test in (
                ("user_id+product_id", "user_id || ':' || product_id", "(user_id, product_id)"),
                ("user_id", "CAST(user_id AS VARCHAR)", "user_id"),
                ("product_id", "CAST(product_id AS VARCHAR)", "product_id"),
            )
        )
        + ") GROUP BY by_keys"
    )
    out["table_labels"] = with_ctes(
        "SELECT u.user_id, u.product_id, u.up_cnt, t.order_id, t.reordered FROM up_grp u "
        "LEFT JOIN train_lines t USING (user_id, product_id)"
    )
    return out
