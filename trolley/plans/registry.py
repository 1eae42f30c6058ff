"""Named queries: each takes (spark, sf_dir) and returns a DataFrame built from the star tables in sf_dir."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trolley.functions import scalar
from trolley.functions.scalar import ID_COLUMNS, REORDER_THRESHOLD, above, ratio
from trolley.operators import audits, evaluate, results, splits
from trolley.operators.search import canonical

from trolley.plans.chain import MartChain
from trolley.sources.basket import Basket, SOURCES, load_basket, source_bytes, source_digest, table_path
from trolley.session import PARTITION_BYTES

Query = Callable[[SparkSession, str], DataFrame]

_CHAINS: dict[tuple[str, str], MartChain] = {}


def chain(spark: SparkSession, sf_dir: str) -> MartChain:
    """The mart chain of a data folder: built once per application and state of the source files."""
    digest = source_digest(spark, [table_path(sf_dir, n) for n in SOURCES])
    key = (spark.sparkContext.applicationId, f"{sf_dir}:{digest}")
    if key not in _CHAINS:
        _CHAINS[key] = MartChain(load_basket(spark, sf_dir), store=True, tag=f"chain-{digest}")
    return _CHAINS[key]


_TABLES: dict[tuple[str, str], dict] = {}


def tables(spark: SparkSession, sf_dir: str) -> dict:
    """The mart's stages as catalog tables bucketed by user, written once per application and state of the sources."""
    from trolley.sources import catalog

    digest = source_digest(spark, [table_path(sf_dir, n) for n in SOURCES])
    key = (spark.sparkContext.applicationId, f"{sf_dir}:{digest}")
    if key not in _TABLES:
        c, made = chain(spark, sf_dir), {}
        # The bucket count grows with the sources, so that a bucket's rows fit a task.
        buckets = max(catalog.BUCKETS, -(-source_bytes(spark, [table_path(sf_dir, n) for n in SOURCES]) // PARTITION_BYTES))
        up = catalog.save_table(c.up_base, f"up_base_{digest}", "user_id", buckets=buckets, sort_by=["user_id", "product_id"])
        made["up"] = up
        for name, df in (("user_mart", c.user_mart), ("train_lines", c.train_lines)):
            made[name] = catalog.save_table(df, f"{name}_{digest}", "user_id", buckets=buckets, heavy=up.heavy)
        _TABLES[key] = made
    return _TABLES[key]


def table_queries() -> dict[str, Query]:
    """IO4, IO6, J5, J6, J8 on catalog tables opened by name; M9, M11 with heavy keys apart; A3, M3, J9-J11 in one pass."""
    from trolley.operators import bitmaps, coverage, marts, skew
    from trolley.session import stage_dir
    from trolley.sources import catalog
    from trolley.sources.io import materialize

    def joined(s, d):
        t, b = tables(s, d), catalog.bucket_session(s)
        return t, b, marts.with_user_ratios(catalog.join(b, t["up"], t["user_mart"], ["user_id"]))

    def table_user_mart(s, d):
        return tables(s, d)["user_mart"].read(s)

    def table_user_product_mart(s, d):
        return joined(s, d)[2].select(*marts.UP_MART_COLUMNS)

    def table_labels(s, d):
        """user×product rows of train users with their label, both sides from buckets."""
        t, b = tables(s, d), catalog.bucket_session(s)
        pairs = catalog.join(b, t["up"], t["train_lines"], ["user_id", "product_id"], "left")
        return pairs.select("user_id", "product_id", "up_cnt", "order_id", "reordered")

    def split_data_mart(s, d):
        """M9: popular products' rows are joined apart."""
        c = chain(s, d)
        # Stored: the search for heavy keys and both joins read it.
        up = materialize(
            marts.with_user_ratios(c.up_base.join(c.user_mart, "user_id")), stage_dir(s, f"up-user-{uuid.uuid4().hex}")
        )
        return skew.split_join(up, c.product_mart, ["product_id"], share=SPLIT_SHARE).select(*marts.DATA_MART_COLUMNS)

    def split_train_set(s, d):
        """The label join with heavy users apart."""
        c = chain(s, d)
        labels = c.train_lines.select("user_id", "product_id", scalar.LABEL)
        rows = c.data_mart.where(F.col("eval_set") == "train")
        out = skew.split_join(rows, labels, ["user_id", "product_id"], "left", key="product_id", share=SPLIT_SHARE)
        return out.select(*ID_COLUMNS, *scalar.MODEL_FEATURES, scalar.LABEL).fillna(0)

    def bitmap_aisle_features(s, d):
        """M3 from the stored bitmaps of each product's users."""
        c = chain(s, d)
        bits = materialize(
            bitmaps.id_bitmaps(c.up_base, ["product_id"], "user_id"), stage_dir(s, f"bitmaps-{uuid.uuid4().hex}")
        )
        totals = c.up_base.groupBy("product_id").agg(F.sum("up_cnt").alias("prd_total_cnt"))
        return bitmaps.aisle_features(bits, totals, c.prod_aisle)

    def bitmap_product_users(s, d):
        """A3: distinct users per product, from bitmaps of the lines themselves."""
        bits = bitmaps.id_bitmaps(chain(s, d).opp, ["product_id"], "user_id")
        return bitmaps.distinct_counts(bits, ["product_id"], "prd_unq_usr_cnt")

    def coverage_once(s, d):
        """J9-J11, Q5 in one pass over the lines and one over the feature rows."""
        c = chain(s, d)
        return coverage.coverage(c.train_lines, c.data_mart.where(COVERED), ["user_id", "product_id"])

    return {
        "bitmap_aisle_features": bitmap_aisle_features,
        "bitmap_product_users": bitmap_product_users,
        "coverage_once": coverage_once,
        "table_user_mart": table_user_mart,
        "table_user_product_mart": table_user_product_mart,
        "table_labels": table_labels,
        "split_data_mart": split_data_mart,
        "split_train_set": split_train_set,
    }


def _stage(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(chain(spark, sf_dir), name)

    run.__name__ = name
    return run


def mart_queries() -> dict[str, Query]:
    return {
        "basket_orders": lambda s, d: load_basket(s, d).orders,
        "basket_priors": lambda s, d: load_basket(s, d).priors,
        "prior_lines": _stage("opp"),
        "product_features": _stage("product_features"),
        "aisle_features": _stage("aisle_features"),
        "product_mart": _stage("product_mart"),
        "user_features": _stage("user_features"),
        "user_mart": _stage("user_mart"),
        "user_product_features": _stage("up_features"),
        "user_product_mart": _stage("up_mart"),
        "data_mart": _stage("data_mart"),
        "train_lines": _stage("train_lines"),
        "train_set": _stage("train_set"),
        "test_set": _stage("test_set"),
        "test_orders": _stage("test_orders"),
    }


def heuristic_score():
    """Deterministic stand-in for a model score: the user's reorder share of the product."""
    return ratio("up_reord_cnt", "up_cnt")


def scored_train(c: MartChain) -> DataFrame:
    """Train rows with label, heuristic score and the thresholded prediction (double, as ML writes it)."""
    s = heuristic_score()
    return c.train_set.select(
        *ID_COLUMNS,
        F.col("reordered").alias("label"),
        s.alias("score"),
        above(s, REORDER_THRESHOLD, "double").alias("prediction"),
    )


def scored_test(c: MartChain) -> DataFrame:
    """Test rows with a probability vector [1 - s, s], class-1 probability and the thresholded label."""
    s = heuristic_score()
    vec = c.test_set.select(*ID_COLUMNS, array_to_vector(F.array(F.lit(1.0) - s, s)).alias("probability"))
    return results.apply_threshold(vec, REORDER_THRESHOLD).select(*ID_COLUMNS, "1_proba", "reordered")


DESCRIBE_COLUMNS = ["up_cnt", "usr_total_cnt", "prd_total_cnt", "days_since_prior_order", "reordered"]
ROC_SAMPLE_STEP = 2
PR_SAMPLE_STEP = 50
FOLD_SEED = 31
FINE_CUT = 20.0  # cut of the many-valued score
TOP_K = 10  # the report's length
COVERED = "up_cnt > 1"  # feature rows that the coverage report takes as there: the others make gaps for it to find
SPLIT_SHARE = 0.002  # of the rows: products above it are joined apart
UNDEFINED_COLUMNS = [
    "up_usr_reord_ratio", "up_avg_prior_days", "up_max_prior_days", "up_min_prior_days", "usr_avg_prior_days", "reordered",
]
VALIDATION_SEED = 2022  # not the split's seed (2021): the flag is drawn inside a part of that split


def audit_queries() -> dict[str, Query]:
    def q(f):
        return lambda s, d: f(chain(s, d))

    return {
        "null_counts": q(lambda c: audits.null_counts(c.train_data)),
        "row_counts": q(
            lambda c: audits.row_counts(
                {"data_mart": c.data_mart, "user_mart": c.user_mart, "prd_mart": c.product_mart, "up_mart": c.up_mart}
            )
        ),
        "duplicate_keys": q(lambda c: audits.duplicate_keys(c.train_lines, ["user_id", "product_id"])),
        "unmatched": q(lambda c: audits.unmatched(c.up_mart, {"user_id": c.user_mart, "product_id": c.product_mart})),
        "label_coverage": q(lambda c: audits.label_coverage(c.train_lines, c.data_mart)),
        "unmatched_label_dist": q(lambda c: audits.unmatched_label_dist(c.train_lines, c.data_mart)),
        "unlabelled_counts": q(lambda c: audits.unlabelled_counts(c.train_data)),
        "undefined_ratios": q(
            lambda c: audits.undefined_ratios(
                c.up_mart, "up_usr_reord_ratio", ["user_id", "product_id", "up_reord_cnt", "usr_reord_cnt"]
            )
        ),
        "duplicate_products": q(lambda c: audits.duplicate_keys(c.train_lines, ["product_id"])),
        "unmatched_filtered": q(
            lambda c: audits.unmatched(
                c.up_mart.select("user_id", "product_id", "up_cnt"),
                {
                    "user_id": c.user_mart.where("eval_set = 'train'"),
                    "product_id": c.product_mart.where(F.col("product_id") % 2 == 0),
                },
            )
        ),
        "undefined_counts": q(lambda c: audits.undefined_counts(c.train_data, UNDEFINED_COLUMNS)),
        "products_without_days": q(lambda c: audits.empty_groups(c.opp, ["user_id", "product_id"], "days_since_prior_order")),
        "nan_counts": q(
            lambda c: audits.null_counts(
                c.up_mart.select(
                    "up_usr_ratio", F.coalesce("up_usr_reord_ratio", F.lit(float("nan"))).alias("up_usr_reord_ratio")
                )
            )
        ),
        "top_products": q(
            lambda c: c.product_mart.select("product_id", "prd_total_cnt", "prd_reordered_cnt")
            .orderBy(F.desc("prd_total_cnt"), "product_id")
            .limit(TOP_K)
        ),
        "describe_all": q(lambda c: splits.describe_numeric(c.train_set)),
        "describe_features": q(lambda c: splits.describe_columns(c.train_set, DESCRIBE_COLUMNS)),
    }


AISLE_REPORT_SQL = """
WITH placed AS (
  SELECT d.aisle_id, l.order_id, l.user_id, l.reordered
  FROM lines l JOIN dims d USING (product_id)
)
SELECT aisle_id, count(DISTINCT order_id) AS orders, count(DISTINCT user_id) AS users, count(*) AS line_count,
       sum(reordered) / count(*) AS reorder_share
FROM placed
GROUP BY aisle_id
"""


def io_queries() -> dict[str, Query]:
    """IO1/IO4/IO5/IO8: SQL over registered views, and the submission written as CSV and read back."""
    from trolley.session import stage_dir
    from trolley.sources import io

    def sql_aisle_report(s, d):
        c = chain(s, d)
        # One SQL statement over views of stored frames (no chain of SQL views, see SURVEY P1).
        io.register_views({"lines": c.opp, "dims": c.prod_aisle})
        return c.opp.sparkSession.sql(AISLE_REPORT_SQL)

    def csv_user_mart(s, d):
        """The basket as CSV files (lines gzipped), read back with explicit schemas, and the user mart from them."""
        b, base = load_basket(s, d), stage_dir(s, f"csv-{uuid.uuid4().hex}")
        io.write_csv(b.orders, f"{base}/orders")
        io.write_csv(b.priors, f"{base}/priors", compression="gzip")
        orders = io.read_csv(s, f"{base}/orders", io.ORDERS_SCHEMA)
        priors = io.read_lines(s, f"{base}/priors")
        return MartChain(Basket(orders, priors, priors, priors, b.products, b.aisles, b.departments)).user_mart

    def _dirty_products(s, d):
        """The products as CSV where one department's rows hold a shifted text and another's a bad number."""
        path = stage_dir(s, f"csv-{uuid.uuid4().hex}")
        p = load_basket(s, d).products
        dirty = p.select(
            F.when(F.col("department_id") == 2, F.lit("12x")).otherwise(F.col("product_id").cast("string")).alias("product_id"),
            "product_name",
            F.when(F.col("department_id") == 1, F.lit("Blunted")).otherwise(F.col("aisle_id")).alias("aisle_id"),
            "department_id",
        )
        io.write_csv(dirty, path)
        return io.read_csv(s, path, io.PRODUCTS_SCHEMA, corrupt=True)

    def malformed_rows(s, d):
        scan = io.materialize(_dirty_products(s, d), stage_dir(s, f"scan-{uuid.uuid4().hex}"))
        return audits.malformed_rows(scan)

    def uncastable_aisles(s, d):
        return audits.uncastable(_dirty_products(s, d), "aisle_id")

    def submission_csv(s, d):
        path = stage_dir(s, f"submission-csv-{uuid.uuid4().hex}")
        io.write_submission(results.submission(scored_test(chain(s, d))), path)
        return io.read_csv(s, path, io.SUBMISSION_SCHEMA)

    return {
        "sql_aisle_report": sql_aisle_report,
        "csv_user_mart": csv_user_mart,
        "malformed_rows": malformed_rows,
        "uncastable_aisles": uncastable_aisles,
        "submission_csv": submission_csv,
    }


def result_queries() -> dict[str, Query]:
    def q(f):
        return lambda s, d: f(chain(s, d))

    def sub(c):
        return results.submission(scored_test(c))

    return {
        "threshold_labels": q(scored_test),
        "order_counts": q(lambda c: results.order_counts(scored_test(c))),
        "submission": q(sub),
        "submission_coverage": q(lambda c: audits.submission_coverage(scored_test(c), sub(c), c.test_orders)),
    }


def evaluation_queries() -> dict[str, Query]:
    def q(f):
        return lambda s, d: f(scored_train(chain(s, d)))

    def fine(f):
        """On a score of thousands of values: the product's sales weighed by its share of the user's lines."""

        def run(s, d):
            score = F.try_divide(F.col("up_cnt") * F.col("prd_total_cnt"), F.col("usr_total_cnt"))
            df = chain(s, d).train_set.select(F.col("reordered").alias("label"), score.alias("score"))
            return f(df.withColumn("prediction", above("score", FINE_CUT, "double")))

        return run

    return {
        "roc_curve_fine": fine(evaluate.roc_curve),
        "pr_curve_sample": fine(lambda df: evaluate.sample_curve(evaluate.pr_curve(df), PR_SAMPLE_STEP)),
        "auc_exact_fine": fine(evaluate.auc_exact),
        "evaluate_report_fine": fine(evaluate.evaluate_report),
        "evaluator_metrics": fine(evaluate.evaluator_report),
        "confusion": q(evaluate.confusion),
        "binary_metrics": q(evaluate.binary_metrics),
        "roc_curve": q(evaluate.roc_curve),
        "pr_curve": q(evaluate.pr_curve),
        "auc_exact": q(evaluate.auc_exact),
        "evaluate_report": q(evaluate.evaluate_report),
        "curve_sample": q(lambda df: evaluate.sample_curve(evaluate.roc_curve(df), ROC_SAMPLE_STEP)),
        "weighted_metrics": q(evaluate.weighted_metrics),
    }


def split_queries() -> dict[str, Query]:
    keys = ["user_id", "product_id"]

    def key_split(s, d):
        ts = chain(s, d).train_set
        return splits.split_index(ts, [0.8, 0.2], seed=2021, keys=keys).groupBy("split").agg(
            F.count(F.lit(1)).alias("cnt"), F.sum("reordered").alias("positives")
        )

    def validation_flag(s, d):
        ts = chain(s, d).train_set
        return splits.with_validation_flag(ts, 0.2, seed=VALIDATION_SEED, keys=keys).select(*keys, "isVal")

    return {"key_split": key_split, "validation_flag": validation_flag}


STUMP_FEATURES = ["up_cnt", "up_max_ord_num", "up_min_ord_num"]  # integers of few values: SQL finds the best split too
STOP_ROUNDS, STOP_RATE, STOP_PATIENCE = 8, 1.0, 2
CV_FOLDS = 3
CV_GRID = {"minInstancesPerNode": [1, 4000, 12000]}  # the larger ones rule out the best cut where tables are small
STUMP = {"maxDepth": 1, "maxBins": 512}  # more bins than values: every midpoint is a candidate


def stump_queries() -> dict[str, Query]:
    """C4-C7, C9-C13, H1-H7 on one split, where SQL can compute the same model."""
    from trolley.operators import boosting, models, tuning

    def data(s, d):
        # The label: bought in the second half of the user's orders. Both sides of the split then predict otherwise
        # (Spark joins two leaves that predict the same).
        late = (2 * F.col("up_max_ord_num") > F.col("usr_max_order_number")).cast("int").alias(scalar.LABEL)
        ts = chain(s, d).train_set.select(
            *ID_COLUMNS, late, *[F.col(c).cast("double").alias(c) for c in STUMP_FEATURES]
        )
        return models.assemble(ts, STUMP_FEATURES)

    def scored(model, df):
        p = models.predict(model, df)
        p1 = F.round(scalar.positive_probability(), 9).alias("p1")
        return p.groupBy(p1, "prediction").agg(F.count(F.lit(1)).alias("cnt"), F.sum(scalar.LABEL).alias("positives"))

    def stump_tree(s, d):
        m = models.fit_tree(data(s, d), **STUMP)
        i, cut = models.root_split(m)
        return models.tree_summary(m).select(
            F.lit(STUMP_FEATURES[i]).alias("feature"), F.lit(cut).alias("cut"), "num_nodes", "depth"
        )

    def stump_predict(s, d):
        df = data(s, d)
        p = models.predict(models.fit_tree(df, **STUMP), df)
        return p.select(*ID_COLUMNS, F.round(scalar.positive_probability(), 9).alias("p1"), "prediction")

    def stump_forest(s, d):
        df = data(s, d)
        m = models.fit_forest(df, numTrees=1, bootstrap=False, featureSubsetStrategy="all", **STUMP)
        return scored(m, df)

    def stump_gbt(s, d):
        df = data(s, d)
        return scored(models.fit_gbt(df, maxIter=1, **STUMP), df)

    def stump_importance(s, d):
        return models.feature_importance(models.fit_tree(data(s, d), **STUMP), STUMP_FEATURES)

    def stump_pipeline(s, d):
        df = data(s, d).drop("features")
        pipe = models.pipeline([models.assembler(STUMP_FEATURES), models.tree(**STUMP)])
        return scored(pipe.fit(df), df)

    def stopping(s, d):
        """Boosted one-split trees, stopped by the rounds on a flagged part: (rows, cut model, rounds)."""
        df = splits.with_validation_flag(data(s, d), 0.2, seed=VALIDATION_SEED, keys=["user_id", "product_id"])
        est = models.gbt(maxIter=STOP_ROUNDS, stepSize=STOP_RATE, **STUMP)
        return df, *boosting.fit_stopping(est, df, "isVal", STOP_PATIENCE)

    def stop_rounds(s, d):
        """Every round's loss on the flagged rows, and the round the model is cut to."""
        rounds = stopping(s, d)[2]
        return rounds.withColumn("loss", F.round("loss", 9))

    def stop_predict(s, d):
        """The cut model's probabilities of the flagged rows."""
        df, model, _ = stopping(s, d)
        return scored(model, df.where("isVal"))

    def stump_cv(s, d):
        """H1, H2, H6: cross-validated accuracy of one-split trees, folds from a key hash."""
        # The ids are not cached with the folds.
        df = tuning.with_fold(data(s, d), CV_FOLDS, FOLD_SEED, ["user_id", "product_id"]).drop(*ID_COLUMNS)
        dt = models.tree(**STUMP)
        ev = evaluate.MulticlassClassificationEvaluator(labelCol=scalar.LABEL, metricName="accuracy")
        cv = tuning.cross_validate(dt, tuning.grid(dt, CV_GRID), ev, CV_FOLDS, parallelism=4, fold_col="fold")
        return _rounded(tuning.tuning_results(cv.fit(df), s))

    def stump_cv_chain(s, d):
        """H3, H4: the same search with the assembler and the tree as a Pipeline, scores of the best model."""
        df = tuning.with_fold(data(s, d).drop("features"), CV_FOLDS, FOLD_SEED, ["user_id", "product_id"]).drop(*ID_COLUMNS)
        dt = models.tree(**STUMP)
        pipe = models.pipeline([models.assembler(STUMP_FEATURES), dt])
        ev = evaluate.MulticlassClassificationEvaluator(labelCol=scalar.LABEL, metricName="accuracy")
        cv = tuning.cross_validate(pipe, tuning.grid(dt, CV_GRID), ev, CV_FOLDS, parallelism=4, fold_col="fold")
        return scored(cv.fit(df).bestModel, df)

    def stump_tvs(s, d):
        """H5, H6: the same grid on a key-hash validation part."""
        dt = models.tree(**STUMP)
        ev = evaluate.MulticlassClassificationEvaluator(labelCol=scalar.LABEL, metricName="accuracy")
        keys = ["user_id", "product_id"]
        tvs = tuning.train_validation(dt, tuning.grid(dt, CV_GRID), ev, 0.75, seed=FOLD_SEED, parallelism=4, keys=keys)
        return _rounded(tuning.tuning_results(tvs.fit(data(s, d)), s))

    def _rounded(t):
        return t.withColumn("metric", F.round("metric", 9))

    return {
        "stop_rounds": stop_rounds,
        "stop_predict": stop_predict,
        "stump_cv": stump_cv,
        "stump_cv_chain": stump_cv_chain,
        "stump_tvs": stump_tvs,
        "stump_tree": stump_tree,
        "stump_predict": stump_predict,
        "stump_forest": stump_forest,
        "stump_gbt": stump_gbt,
        "stump_importance": stump_importance,
        "stump_pipeline": stump_pipeline,
    }


def model_queries() -> dict[str, Query]:
    """Fitted models, so no SQL oracle (row-count check only)."""
    from trolley.operators import boosting, models, tuning
    from trolley.plans import fitted, modeling

    def binary(s, d):
        return modeling.prepare_binary(chain(s, d).train_set)

    def multi(s, d):
        return modeling.prepare_multiclass(s.read.parquet(table_path(d, "embeddings")))

    def kept(s, d, name, sources, fit, *params):
        """A model fit once for the state of its sources, opened from its files after that."""
        digest = source_digest(s, [table_path(d, n) for n in sources])
        return fitted.stored_model(s, fitted.model_path(s, name, d, digest, *params), fit)

    def forest(s, d, p):
        return kept(s, d, "forest", SOURCES, lambda: models.fit_forest(p.train), p.features)

    def deep_tree(s, d, p):
        return kept(s, d, "tree", ["embeddings"], lambda: models.fit_tree(p.train, label="label", maxDepth=10), 10)

    def tree_predict(s, d):
        p = multi(s, d)
        m = deep_tree(s, d, p)
        return models.predict(m, p.test).select("vec_id", "label", "prediction")

    def forest_predict(s, d):
        p = binary(s, d)
        return modeling.binary_predictions(forest(s, d, p), p.test).drop("rawPrediction")

    def gbt_predict(s, d):
        p = binary(s, d)
        m = models.fit_gbt(p.train, maxDepth=4, maxIter=30)
        return modeling.binary_predictions(m, p.test).drop("rawPrediction")

    def missing_report(s, d):
        """Zeros as missing values, early stopping by rounds, and the evaluation of the cut model."""
        p = modeling.split_rows(chain(s, d).train_set)
        sides = boosting.MissingSides.of(p.train, p.features, 0.0)
        # Dealt out and held as columns; both copies of each are assembled from them by every scan.
        train = canonical(p.train, modeling.SPLIT_KEYS)
        with models.persisted(train):
            rows = sides.assemble(train).select(*ID_COLUMNS, "features", scalar.LABEL)
            m = models.fit_gbt(
                splits.with_validation_flag(rows, 0.2, seed=VALIDATION_SEED, keys=modeling.SPLIT_KEYS), n_estimators=100, learning_rate=0.1, max_depth=3, validationIndicatorCol="isVal",
                early_stopping_rounds=10, eval_metric="logloss",
            )
        pred = modeling.binary_predictions(m, sides.assemble(p.test))
        return evaluate.evaluate_report(pred, label="label", prediction="prediction", score="1_proba")

    def gbt_early_stop(s, d):
        p = binary(s, d)
        flagged = splits.with_validation_flag(p.train, 0.2, seed=VALIDATION_SEED, keys=["user_id", "product_id"])
        m = models.fit_gbt(
            flagged, n_estimators=100, learning_rate=0.1, max_depth=3, validationIndicatorCol="isVal"
        )
        return models.tree_summary(m)

    def feature_importance(s, d):
        p = binary(s, d)
        return models.feature_importance(forest(s, d, p), p.features)

    def tree_summary(s, d):
        p = multi(s, d)
        return models.tree_summary(deep_tree(s, d, p))

    def multiclass_metrics(s, d):
        p = multi(s, d)
        m = models.fit_forest(p.train, label="label", numTrees=100, maxDepth=4)
        return evaluate.multiclass_report(models.predict(m, p.test), label="label")

    def auc_binned(s, d):
        p = binary(s, d)
        pred = models.predict(forest(s, d, p), p.test)
        auc = evaluate.auc_binned(pred, label="reordered")
        return s.createDataFrame([("areaUnderROC", auc)], "metric string, value double")

    def model_report(s, d):
        p = binary(s, d)
        pred = modeling.binary_predictions(forest(s, d, p), p.test)
        return evaluate.evaluate_report(pred, label="label", prediction="prediction", score="1_proba")

    def model_roc(s, d):
        p = binary(s, d)
        pred = modeling.binary_predictions(forest(s, d, p), p.test)
        return evaluate.roc_curve(pred, label="label", score="1_proba")

    def accuracy():
        return evaluate.MulticlassClassificationEvaluator(labelCol="label", metricName="accuracy")

    def folded(df):
        return tuning.with_fold(df, 3, FOLD_SEED, ["vec_id"])

    def cv_results(s, d):
        p = multi(s, d)
        dt = models.tree(label="label", maxDepth=10)
        cv = tuning.cross_validate(
            dt, tuning.grid(dt, {"maxDepth": [5, 10], "minInstancesPerNode": [3, 6]}), accuracy(), 3, parallelism=4,
            fold_col="fold",
        )
        return tuning.tuning_results(cv.fit(folded(p.train)), s)

    def cv_chain(s, d):
        emb = s.read.parquet(table_path(d, "embeddings"))
        cols = [f"e{i}" for i in range(64)]
        wide = emb.select("vec_id", F.col("label").cast("double").alias("label"), *[F.col("embedding")[i].alias(c) for i, c in enumerate(cols)])
        tr, te = splits.split(wide, [0.7, 0.3], seed=0, keys=["vec_id"])
        dt = models.tree(label="label", maxDepth=10)
        pipe = models.pipeline([models.assembler(cols), dt])
        g = tuning.grid(dt, {"maxDepth": [5, 7, 8, 10], "minInstancesPerNode": [3, 5, 6]})
        model = tuning.cross_validate(pipe, g, accuracy(), 3, parallelism=4, fold_col="fold").fit(folded(tr))
        return tuning.tuning_results(model, s)

    def cv_stage(s, d):
        emb = s.read.parquet(table_path(d, "embeddings"))
        cols = [f"e{i}" for i in range(64)]
        wide = emb.select("vec_id", F.col("label").cast("double").alias("label"), *[F.col("embedding")[i].alias(c) for i, c in enumerate(cols)])
        tr, te = splits.split(wide, [0.7, 0.3], seed=0, keys=["vec_id"])
        dt = models.tree(label="label")
        g = tuning.grid(dt, {"maxDepth": [5, 7, 8, 10], "minInstancesPerNode": [3, 5, 6]})
        pipe = models.pipeline([models.assembler(cols), tuning.cross_validate(dt, g, accuracy(), 3, parallelism=4, fold_col="fold")])
        return pipe.fit(folded(tr)).transform(te).select("vec_id", "label", "prediction")

    def cv_best_score(s, d):
        """H7: the best model's scores on the test part."""
        p = multi(s, d)
        dt = models.tree(label="label", maxDepth=10)
        g = tuning.grid(dt, {"maxDepth": [5, 10], "minInstancesPerNode": [3, 6]})
        cv = tuning.cross_validate(dt, g, accuracy(), 3, parallelism=4, fold_col="fold")
        best = cv.fit(folded(p.train)).bestModel
        return evaluate.multiclass_report(models.predict(best, p.test), label="label")

    def assembled_features(s, d):
        """The assembled vector's entries as columns again."""
        ts = chain(s, d).train_set
        cols = scalar.feature_columns(ts)
        v = F.col("v")
        vec = models.assemble(ts, cols).select(*ID_COLUMNS, scalar.vector_to_array("features").alias("v"))
        return vec.select(*ID_COLUMNS, *[F.get(v, i).alias(c) for i, c in enumerate(cols)])

    def tvs_results(s, d):
        p = multi(s, d)
        dt = models.tree(label="label", maxDepth=10)
        g = tuning.grid(dt, {"maxDepth": [5, 7, 8, 10], "minInstancesPerNode": [3, 5, 6]})
        tvs = tuning.train_validation(dt, g, accuracy(), 0.75, seed=0, parallelism=4, keys=["vec_id"])
        return tuning.tuning_results(tvs.fit(p.train), s)

    def threshold_search(s, d):
        return tuning.adaptive_search(binary(s, d).train, modeling.SPLIT_KEYS).table(s)

    def refit_best(s, d):
        c = chain(s, d)
        vec = models.assemble(c.train_set, scalar.feature_columns(c.train_set))
        m = models.fit_gbt(vec, numIterations=tuning.REFIT_ROUNDS, **tuning.BEST_PARAMS)
        return modeling.submission_from_model(m, c.test_set)

    return {
        "tree_predict": tree_predict,
        "forest_predict": forest_predict,
        "gbt_predict": gbt_predict,
        "missing_report": missing_report,
        "gbt_early_stop": gbt_early_stop,
        "feature_importance": feature_importance,
        "tree_summary": tree_summary,
        "multiclass_metrics": multiclass_metrics,
        "auc_binned": auc_binned,
        "model_report": model_report,
        "model_roc": model_roc,
        "cv_results": cv_results,
        "cv_best_score": cv_best_score,
        "assembled_features": assembled_features,
        "cv_chain": cv_chain,
        "cv_stage": cv_stage,
        "tvs_results": tvs_results,
        "threshold_search": threshold_search,
        "refit_best": refit_best,
    }


def all_queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    out.update(mart_queries())
    out.update(table_queries())
    out.update(audit_queries())
    out.update(io_queries())
    out.update(result_queries())
    out.update(evaluation_queries())
    out.update(split_queries())
    out.update(stump_queries())
    out.update(model_queries())
    return out
