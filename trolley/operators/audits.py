"""Data-quality audits (Q1-Q10). Each returns a small DataFrame; none collects to the driver."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.functions.scalar import is_missing

# Fixed values, here and below: the reports' label columns and names (gubun, cnt, pair_count, only_..._count).


def null_counts(df: DataFrame, *, nan: bool = True) -> DataFrame:
    """Q1: one row, one column per input column with its NULL (and, for float/double, NaN) count."""
    return df.select(*[F.count(F.when(is_missing(df, c, nan=nan), 1)).alias(c) for c in df.columns])


def row_counts(frames: Mapping[str, DataFrame], *, name_col: str = "table_name", count_col: str = "row_count") -> DataFrame:
    """Q2/Q10: one labelled row count per frame (``UNION ALL`` of single-row aggregates)."""
    parts = [df.agg(F.count(F.lit(1)).alias(count_col)).select(F.lit(n).alias(name_col), count_col) for n, df in frames.items()]
    return reduce(DataFrame.unionByName, parts)


def duplicate_keys(df: DataFrame, keys: Sequence[str], *, count_col: str = "cnt") -> DataFrame:
    """Q3: key values that occur more than once (``GROUP BY keys HAVING count(*) > 1``)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col)).where(F.col(count_col) > 1)


def unmatched(df: DataFrame, targets: Mapping[str, DataFrame]) -> DataFrame:
    """Q4: rows of ``df`` that miss a partner in any target; ``targets`` maps a key column to a frame.

    Written as left joins against the *distinct* keys of each target, flagging the missing side, so a row
    missing in two targets is reported once.
    """
    out = df
    flags = []
    for i, (key, tgt) in enumerate(targets.items()):
        flag = f"_hit{i}"
        out = out.join(tgt.select(key).distinct().withColumn(flag, F.lit(True)), key, "left")
        flags.append(F.col(flag).isNull())
    return out.where(reduce(lambda a, b: a | b, flags)).drop(*[f"_hit{i}" for i in range(len(targets))])


def label_coverage(lines: DataFrame, dm: DataFrame, *, name_col: str = "gubun", count_col: str = "cnt") -> DataFrame:
    """Q5: labelled lines without a feature row, by (user, product), by user only and by product only."""
    # The single keys are aggregated before their shuffle: a popular product is one row a task, not all its rows.
    pair = lines.join(dm.select("user_id", "product_id"), ["user_id", "product_id"], "left_anti")
    only_user = lines.join(dm.select("user_id").distinct(), "user_id", "left_anti")
    only_product = lines.join(dm.select("product_id").distinct(), "product_id", "left_anti")
    return row_counts(
        {"pair_count": pair, "only_user_id_count": only_user, "only_product_id_count": only_product},
        name_col=name_col,
        count_col=count_col,
    )


def unmatched_label_dist(lines: DataFrame, dm: DataFrame, label: str = "reordered", count_col: str = "cnt") -> DataFrame:
    """Q6: label distribution of lines without a feature row (all 0 in a consistent build)."""
    miss = lines.join(dm.select("user_id", "product_id"), ["user_id", "product_id"], "left_anti")
    return miss.groupBy(label).agg(F.count(F.lit(1)).alias(count_col))


def unlabelled_counts(train_data: DataFrame, label: str = "reordered") -> DataFrame:
    """Q7: rows of the training data and rows whose label is NULL."""
    return row_counts(
        {"train_data": train_data, f"{label} null": train_data.where(F.col(label).isNull())},
        name_col="gubun",
        count_col="cnt",
    )


def undefined_ratios(df: DataFrame, ratio_col: str, keep: Sequence[str]) -> DataFrame:
    """Q8: rows whose ratio is undefined (NULL, i.e. a zero divisor)."""
    return df.where(F.col(ratio_col).isNull()).select(*keep)


def undefined_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Q8 for several columns: (column, undefined) with the number of rows where it is NULL, from one aggregate."""
    row = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in cols])
    pairs = ", ".join(f"'{c}', `{c}`" for c in cols)
    return row.select(F.expr(f"stack({len(cols)}, {pairs}) as (column_name, undefined)"))


def empty_groups(df: DataFrame, keys: Sequence[str], value: str, *, count_col: str = "cnt") -> DataFrame:
    """PF9: groups whose aggregate is NULL (no row of the group has a value)."""
    g = df.groupBy(*keys).agg(F.avg(value).alias("_avg"), F.count(F.lit(1)).alias(count_col))
    return g.where(F.col("_avg").isNull()).select(*keys, count_col)


def malformed_rows(df: DataFrame, corrupt: str = "_corrupt_record") -> DataFrame:
    """Rows and malformed rows of a CSV scan that keeps its corrupt lines.

    ``df`` should be the stored scan: a line is only found malformed where all its columns are parsed.
    """
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.count(F.when(F.col(corrupt).isNotNull(), 1)).alias("malformed"))


def uncastable(df: DataFrame, col: str, to: str = "int") -> DataFrame:
    """Values that are there but cannot be cast (S2: they drop out of the dimension join), with their row counts."""
    bad = F.col(col).isNotNull() & F.col(col).try_cast(to).isNull()
    return df.where(bad).groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("cnt"))


def submission_coverage(scored: DataFrame, submission: DataFrame, test_orders: DataFrame) -> DataFrame:
    """Q9: scored rows whose order is missing from the submission, submission rows, and test orders."""
    missing = scored.join(submission.select("order_id"), "order_id", "left_anti")
    return row_counts(
        {"missing_rows": missing, "submission_orders": submission, "test_orders": test_orders},
        name_col="gubun",
        count_col="cnt",
    )
