"""Train/test splits (C2), validation flags (C3) and summary statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the key hash (also written out in the SQL oracle): the first 8 hex digits of an MD5.
HASH_DIGITS = 8
HASH_SLOTS = 1 << (4 * HASH_DIGITS)


def key_slot(keys: Sequence[str], seed: int = 0) -> Column:
    """A slot in [0, 2^32): the first 8 hex digits of ``md5(seed || ':' || k1 || ':' || k2 ...)``.

    Depends only on the row's keys and the seed, so the split is the same on every run, partitioning and engine
    (``randomSplit`` depends on the partition layout, S11); the seed is hashed with the keys, so two seeds give
    independent splits. A NULL key hashes like an empty text.
    """
    parts = [F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, HASH_DIGITS), 16, 10).cast("long")


def split(
    df: DataFrame, weights: Sequence[float], seed: int = 0, keys: Sequence[str] | None = None
) -> list[DataFrame]:
    """Split rows by ``weights``. With ``keys`` the split is a key hash; without, Spark's ``randomSplit``."""
    if not keys:
        return df.randomSplit(list(weights), seed=seed)
    total = float(sum(weights))
    edges, acc = [], 0.0
    for w in weights:
        acc += w / total
        edges.append(round(acc * HASH_SLOTS))
    slot = key_slot(keys, seed)
    parts, lo = [], 0
    for hi in edges:
        parts.append(df.where((slot >= lo) & (slot < hi)))
        lo = hi
    return parts


def split_index(df: DataFrame, weights: Sequence[float], seed: int = 0, keys: Sequence[str] = (), out: str = "split") -> DataFrame:
    """C2 as one column: the index of the part each row falls in (no union, one pass)."""
    total = float(sum(weights))
    slot = key_slot(keys, seed)
    expr, acc = None, 0.0
    for i, w in enumerate(weights):
        acc += w / total
        hi = round(acc * HASH_SLOTS)
        expr = F.when(slot < hi, F.lit(i)) if expr is None else expr.when(slot < hi, F.lit(i))
    return df.withColumn(out, expr.otherwise(F.lit(len(weights) - 1)))


def with_validation_flag(
    df: DataFrame, fraction: float = 0.2, seed: int = 2021, keys: Sequence[str] = (), out: str = "isVal"
) -> DataFrame:
    """Boolean validation flag for about ``fraction`` of the rows, in one ``withColumn`` (no union)."""
    return df.withColumn(out, key_slot(keys, seed) < F.lit(round(fraction * HASH_SLOTS)))


def describe_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``df.describe(cols)`` with the statistics cast back to double (count, mean, stddev, min, max)."""
    d = df.describe(*cols)
    return d.select("summary", *[F.col(c).cast("double").alias(c) for c in cols])


def describe_numeric(df: DataFrame, digits: int = 6) -> DataFrame:
    """A17 for every column of a numeric frame: (column, cnt, mean, stddev, min, max), rounded, one row a column."""
    fns = {"cnt": F.count, "mean": F.avg, "stddev": F.stddev_samp, "min": F.min, "max": F.max}
    row = df.agg(*[f(c).cast("double").alias(f"{c}__{n}") for c in df.columns for n, f in fns.items()])
    parts = [f"'{c}', " + ", ".join(f"round(`{c}__{n}`, {digits})" for n in fns) for c in df.columns]
    return row.select(F.expr(f"stack({len(df.columns)}, {', '.join(parts)}) as (column_name, {', '.join(fns)})"))
