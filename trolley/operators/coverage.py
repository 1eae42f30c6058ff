"""J9-J11, Q4-Q6 in one pass: which rows of a fact table have partners, by several keys at once.

Both tables' keys are stacked with a tag and aggregated before their shuffle; a pair of keys then says how many lines it
has and whether a feature row has it. The single keys are grouping sets of the pairs. Each table is scanned once,
and a popular key is a few rows a task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_presence(lines: DataFrame, features: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, lines, present) of every combination of keys: rows in ``lines``, and whether ``features`` has it."""
    a = lines.select(*keys, F.lit(1).cast("long").alias("lines"), F.lit(False).alias("present"))
    b = features.select(*keys, F.lit(0).cast("long").alias("lines"), F.lit(True).alias("present"))
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()  # NULL has no partner
    both = a.unionByName(b.where(known))
    return both.groupBy(*keys).agg(F.sum("lines").alias("lines"), F.max("present").alias("present"))


def coverage(lines: DataFrame, features: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(by_keys, lines, missing, keys_missing): lines, and lines and keys without a feature row, by all keys and by each one."""
    keys = list(keys)
    sets = [F.array(*[F.lit(k) for k in keys]), *[F.array(F.lit(k)) for k in keys]]
    pairs = key_presence(lines, features, keys)
    # A row for each set of keys; a key outside the set is blanked, so that one grouping serves all sets.
    by = F.explode(F.array(*sets)).alias("by_keys")
    each = pairs.select("*", by)
    each = each.select(
        F.array_join("by_keys", "+").alias("by_keys"), "lines", "present",
        *[F.when(F.array_contains("by_keys", k), F.col(k)).alias(k) for k in keys],
    )
    gone = F.lit(False)
    for k in keys:
        gone = gone | (F.array_contains(F.split("by_keys", r"\+"), k) & F.col(k).isNull())
    per = each.groupBy("by_keys", *keys).agg(F.sum("lines").alias("lines"), F.max("present").alias("present"))
    absent = (~F.col("present") | gone) & (F.col("lines") > 0)
    return per.groupBy("by_keys").agg(
        F.sum("lines").alias("lines"),
        F.sum(F.when(absent, F.col("lines")).otherwise(0)).alias("missing"),
        F.sum(F.when(absent, 1).otherwise(0)).alias("keys_missing"),
    )
