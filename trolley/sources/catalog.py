"""IO4, IO6: marts as catalog tables, bucketed and sorted, that later queries open by name.

A table is written once, dealt to buckets by its join key (one file a bucket), with statistics for the optimizer. Tables
with the same number of buckets join on that key without an exchange. Files lie in a fresh folder below the session's
shared folder, so a half-written table is never seen under its name.

A join of buckets can't be split at run time, so a key with a large share of the rows would make one task: rows of heavy
keys (``operators/skew.py``) go to a second table without buckets, and ``join`` joins them apart.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trolley.operators.skew import HEAVY_SHARE, heavy_keys, split_join
from trolley.session import stage_dir

BUCKETS = 32
HEAVY = "_heavy"


def bucket_session(spark: SparkSession) -> SparkSession:
    """A session beside the given one (same catalog) that uses buckets for joins on more columns than the bucket key.

    The user's session is left as it is.
    """
    s = spark.newSession()
    for k in ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.session.timeZone"):
        s.conf.set(k, spark.conf.get(k))
    s.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return s


@dataclass(frozen=True)
class BucketedTable:
    """A catalog table bucketed by ``key``; rows of the keys in ``heavy`` are in ``<name>_heavy``."""

    name: str
    key: str
    buckets: int
    heavy: tuple

    def read(self, spark: SparkSession) -> DataFrame:
        """All rows."""
        df = spark.table(self.name)
        return df.unionByName(spark.table(self.name + HEAVY)) if self.heavy else df


def _write(df: DataFrame, name: str, key: str | None, buckets: int, sort_by: Sequence[str]) -> None:
    spark = df.sparkSession
    path = stage_dir(spark, f"table-{name}-{uuid.uuid4().hex}")
    spark.sql(f"DROP TABLE IF EXISTS `{name}`")
    if key:
        df = df.repartition(buckets, key)
        df.write.format("parquet").option("path", path).bucketBy(buckets, key).sortBy(*sort_by).saveAsTable(name)
    else:
        df.write.format("parquet").option("path", path).saveAsTable(name)
    spark.sql(f"ANALYZE TABLE `{name}` COMPUTE STATISTICS")


def save_table(
    df: DataFrame,
    name: str,
    key: str,
    *,
    buckets: int = BUCKETS,
    sort_by: Sequence[str] = (),
    heavy: Sequence | None = None,
    share: float = HEAVY_SHARE,
) -> BucketedTable:
    """Store a frame under ``name``, bucketed by ``key``. ``heavy`` keys are those found in ``df`` unless given.

    Tables that are joined must part the same heavy keys: pass those of the largest one to the others.
    """
    found = tuple(heavy_keys(df, key, share) if heavy is None else heavy)
    apart = F.coalesce(F.col(key).isin(list(found)), F.lit(False)) if found else F.lit(False)
    _write(df.where(~apart), name, key, buckets, list(sort_by) or [key])
    if found:
        _write(df.where(apart), name + HEAVY, None, 0, ())
    else:
        df.sparkSession.sql(f"DROP TABLE IF EXISTS `{name + HEAVY}`")
    return BucketedTable(name, key, buckets, found)


def join(spark: SparkSession, left: BucketedTable, right: BucketedTable, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join two tables of one bucket key: buckets meet without an exchange, heavy keys are joined apart."""
    if (left.key, left.buckets, left.heavy) != (right.key, right.buckets, right.heavy):
        raise ValueError(f"tables {left.name} and {right.name} are not bucketed alike")
    light = spark.table(left.name).join(spark.table(right.name), list(on), how)
    if not left.heavy:
        return light
    hot = split_join(spark.table(left.name + HEAVY), spark.table(right.name + HEAVY), on, how, key=left.key, share=0.0001)
    return light.union(hot)
