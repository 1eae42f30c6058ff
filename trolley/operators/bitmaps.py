"""A3, M2, M3 with mergeable exact distinct counts: bitmaps of ids, kept per group and rolled up.

An id is one bit of a fixed-size bitmap; ids beyond one bitmap's range go to further buckets. Two groups' bitmaps are
merged by OR, so the distinct users of an aisle come from the stored bitmaps of its products: the (aisle, user) pairs are
never shuffled, and new days' bitmaps can be merged into old ones. Counts are exact, unlike a sketch's.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.functions.scalar import ratio


def id_bitmaps(df: DataFrame, groups: Sequence[str], key: str) -> DataFrame:
    """(groups, bucket, bits): the ids (a whole-number column, NULL left out) of every group."""
    k = F.col(key).cast("long")
    return (
        df.where(k.isNotNull())
        .groupBy(*groups, F.bitmap_bucket_number(k).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(k)).alias("bits"))
    )


def merge_bitmaps(bitmaps: DataFrame, groups: Sequence[str]) -> DataFrame:
    """The bitmaps of coarser groups (or of further rows of the same groups)."""
    return bitmaps.groupBy(*groups, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_counts(bitmaps: DataFrame, groups: Sequence[str], out: str) -> DataFrame:
    """(groups, out): how many different ids each group has."""
    return bitmaps.groupBy(*groups).agg(F.sum(F.bitmap_count("bits")).alias(out))


def aisle_features(bitmaps: DataFrame, totals: DataFrame, prod_aisle: DataFrame) -> DataFrame:
    """M3 from the products' bitmaps (product_id, bucket, bits) and line counts (product_id, prd_total_cnt)."""
    users = distinct_counts(
        merge_bitmaps(bitmaps.join(prod_aisle, "product_id"), ["aisle_id"]), ["aisle_id"], "aisle_distinct_usr_cnt"
    )
    lines = totals.join(prod_aisle, "product_id").groupBy("aisle_id").agg(F.sum("prd_total_cnt").alias("aisle_total_cnt"))
    return users.join(lines, "aisle_id").select("*", ratio("aisle_distinct_usr_cnt", "aisle_total_cnt").alias("aisle_usr_ratio"))
