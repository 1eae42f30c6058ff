"""J5, J6, M1, M9 with heavy keys: joins that split off the keys which hold a large share of the rows.

Heavy keys come from a mergeable frequent-items sketch (``approx_top_k``), one aggregate over the key column. Their
rows are joined apart: with a broadcast of the other side's rows of those keys where these are few, else salted.
Rows whose key is NULL match nothing and are never shuffled. The remaining rows have no key above the share. The result
is that of the plain join, whatever the sketch found.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEAVY_SHARE = 0.01  # of all rows: a key above it is heavy
TRACKED = 10_000  # keys that the sketch follows; its error is far below the share
BROADCAST_ROWS = 10_000  # rows of the other side that are sent to all tasks
SALTS = 32  # tasks that a heavy key is dealt to where its partners are too many to broadcast
KINDS = ("inner", "left", "left_semi", "left_anti")


def heavy_keys(df: DataFrame, key: str, share: float = HEAVY_SHARE) -> list:
    """The values of ``key`` that hold at least ``share`` of the rows, at most ``1 / share`` of them."""
    most = min(TRACKED, int(1 / share) + 1)
    row = df.select(key).agg(
        F.count(F.lit(1)).alias("n"),
        F.expr(f"approx_top_k(`{key}`, {most}, {TRACKED})").alias("top"),
    ).first()
    return [r["item"] for r in row["top"] or [] if r["item"] is not None and r["count"] >= share * row["n"]]


def split_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    *,
    key: str | None = None,
    share: float = HEAVY_SHARE,
    broadcast_rows: int = BROADCAST_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """``left.join(right, on, how)`` with the heavy values of ``key`` (a column of ``on``) in ``left`` joined apart."""
    if how not in KINDS:
        raise ValueError(f"split_join knows {', '.join(KINDS)}, not {how!r}")
    on = list(on)
    key = key or on[0]
    if key not in on:
        raise ValueError(f"'{key}' is not among the join columns {on}")
    gone = F.lit(False)
    for c in on:
        gone = gone | F.col(c).isNull()
    parts = [left.where(gone).join(right.where(F.lit(False)), on, how)] if how in ("left", "left_anti") else []
    left = left.where(~gone)
    heavy = heavy_keys(left, key, share)
    if heavy:
        hot, partners = left.where(F.col(key).isin(heavy)), right.where(F.col(key).isin(heavy))
        if partners.limit(broadcast_rows + 1).count() <= broadcast_rows:
            parts.append(hot.join(F.broadcast(partners), on, how))
        else:
            parts.append(_salted(hot, partners, on, how, salts))
        left, right = left.where(~F.col(key).isin(heavy)), right.where(~F.col(key).isin(heavy))
    out = left.join(right, on, how)
    for p in parts:
        out = out.union(p)  # by position: a plain join may hold a name twice
    return out


def _salted(hot: DataFrame, partners: DataFrame, on: list[str], how: str, salts: int) -> DataFrame:
    """Each row of ``hot`` goes to one of ``salts`` places by a hash of all its columns, each partner to all of them."""
    salt = _free("salt", hot.columns + partners.columns)
    dealt = hot.withColumn(salt, F.pmod(F.xxhash64(*hot.columns), F.lit(salts)).cast("int"))
    copied = partners.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    # The salt alone spreads a single heavy key; a join hint keeps Spark from broadcasting by a wrong estimate.
    return dealt.join(copied.hint("shuffle_hash"), [*on, salt], how).drop(salt)


def _free(name: str, taken: Sequence[str]) -> str:
    while name in taken:
        name = f"_{name}"
    return name
