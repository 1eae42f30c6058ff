"""Ordered positions and running sums that do not put a whole group into one task.

``row_number() over (partition by g order by k)`` makes Spark move every row of a group to one task. If one user (or,
for curves, the whole table) holds a third of all rows, that task holds a third of the data. ``running_totals`` has one
plan, used at every size:

1. The rows are range-partitioned by (group, order) and written once, with the number of their range partition. Ranges
   follow the order, so a later partition holds later rows; a large group spans many partitions.
2. Per (group, partition) the row count and the sums are aggregated; a window over that small table (at most one row per
   group and partition it touches) gives each part its offset inside the group.
3. Rows join their part's offset (null-safe) and a window *within* (group, partition) adds the local position.

The result equals the single window for any key type, NULL groups and NULL order keys included.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trolley.session import stage_dir
from trolley.sources.io import materialize


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """``left.k <=> right.k`` for every key: an equi-join condition that keeps NULL keys."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def running_totals(
    df: DataFrame,
    order_by: Sequence[Column],
    partition_by: Sequence[str] = (),
    sums: Mapping[str, Column] | None = None,
    *,
    rank_col: str = "rank",
    count_col: str = "group_rows",
) -> DataFrame:
    """Add the 1-based position along ``order_by`` within ``partition_by`` and inclusive running sums.

    ``order_by`` must order rows uniquely inside a group (ties would make positions arbitrary, exactly as with
    ``row_number``). For each name in ``sums`` two columns are added: the running sum ``name`` and the group total
    ``name_total``. ``count_col`` holds the group's row count. The range-partitioned rows are stored in the session's
    shared folder when the frame is built.
    """
    part = list(partition_by)
    sums = dict(sums or {})
    work = df.select("*", *[expr.alias(f"_rt_v_{n}") for n, expr in sums.items()])
    ranged = work.repartitionByRange(*[F.col(c) for c in part], *order_by)
    ranged = ranged.withColumn("_rt_p", F.spark_partition_id())
    stored = materialize(ranged, stage_dir(df.sparkSession, f"ordered-{uuid.uuid4().hex}"))

    grp = [*part, "_rt_p"]
    table = stored.groupBy(*grp).agg(
        F.count(F.lit(1)).alias("_rt_n"), *[F.sum(f"_rt_v_{n}").alias(f"_rt_s_{n}") for n in sums]
    )
    group = Window.partitionBy(*part) if part else Window.partitionBy()
    before = group.orderBy("_rt_p").rowsBetween(Window.unboundedPreceding, -1)
    table = table.select(
        *grp,
        F.coalesce(F.sum("_rt_n").over(before), F.lit(0)).alias("_rt_off"),
        F.sum("_rt_n").over(group).alias(count_col),
        *[F.sum(f"_rt_s_{n}").over(before).alias(f"_rt_o_{n}") for n in sums],
        *[F.sum(f"_rt_s_{n}").over(group).alias(f"{n}_total") for n in sums],
    )

    inner = Window.partitionBy(*grp).orderBy(*order_by)
    upto = inner.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = stored.select(
        *stored.columns,
        F.row_number().over(inner).alias("_rt_r"),
        *[F.sum(f"_rt_v_{n}").over(upto).alias(f"_rt_c_{n}") for n in sums],
    )
    out = local.join(table, null_safe(local, table, grp))
    return out.select(
        *[local[c] for c in df.columns],
        (F.col("_rt_off") + F.col("_rt_r")).alias(rank_col),
        F.col(count_col),
        # A sum over NULLs only is NULL, as in the window; anything before or here counts from 0.
        *[
            F.when(F.col(f"_rt_o_{n}").isNull(), F.col(f"_rt_c_{n}"))
            .otherwise(F.col(f"_rt_o_{n}") + F.coalesce(F.col(f"_rt_c_{n}"), F.lit(0)))
            .alias(n)
            for n in sums
        ],
        *[F.col(f"{n}_total") for n in sums],
    )


def dense_rank_values(df: DataFrame, col_name: str, out: str) -> DataFrame:
    """``dense_rank() over (order by col)`` as a (value, rank) table: positions of the distinct values."""
    values = df.select(col_name).where(F.col(col_name).isNotNull()).distinct()
    return running_totals(values, [F.col(col_name)], rank_col=out, count_col="_n").select(col_name, out)
