"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

1. Sizes (words) are counted per document in Spark and summed per source.
2. Every source gets a *target*: its weight's share of the wanted total, at most ``max_repeat`` times its size;
   what a full source cannot take is shared again by weight.
3. The total is cut into blocks of equal size. Blocks go to the sources by highest quotients
   ``target / (2 * seats + 1)``, and a source's blocks go to its shards (hash buckets of about
   ``SHARD_WORDS`` words) in the same way: integer quotas per shard.
4. In a shard the documents lie on one line in a seeded order. The line is cut into blocks; every block is
   taken ``quota // blocks`` times and a seeded choice of them once more. A document takes the words of its
   part of the chosen blocks.

Only the table of sources (one row each: part of the mix's configuration) is on the driver. A shard is bounded
by ``SHARD_WORDS`` words plus one document, so a source with a third of all rows is spread over many tasks.

Defined cases: NULL or word-free texts have size 0 and take 0; NULL is a source of its own, ordered last; an
empty table gives no rows; repeated rows are counted and mixed each for itself; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import WORD, free_names, ship_package, store

SHARD_WORDS = 1 << 19
PART = 1 << 12  # shards whose quotas are planned together; a source's seats go to its parts first
MAX_BLOCK = 1024  # words


def sainte_lague(votes: Sequence[float], seats: int, most: Sequence[int] | None = None) -> list[int]:
    """Seats by highest quotients votes / (2 * seats + 1); ``most`` bounds a party's seats.

    Seats no party can take stay empty. Ties go to the earlier party.
    """
    v = [max(0.0, float(x)) for x in votes]
    cap = [math.inf] * len(v) if most is None else list(most)
    total = sum(v)
    if total <= 0 or seats <= 0:
        return [0] * len(v)
    # Start a little below the final allocation (a divisor that is surely too large), then hand out the rest
    # one by one: the result is that of handing out all seats one by one.
    d = total / max(1.0, seats - len(v))
    got = [0] * len(v)
    if seats > 2 * len(v):
        got = [int(min(cap[i], max(0, math.floor(x / d + 0.5)))) for i, x in enumerate(v)]
        while sum(got) > seats:
            d *= 1 + (sum(got) - seats + len(v)) / seats
            got = [int(min(cap[i], max(0, math.floor(x / d + 0.5)))) for i, x in enumerate(v)]
    heap = [(-x / (2 * got[i] + 1), i) for i, x in enumerate(v) if x > 0 and got[i] < cap[i]]
    heapq.heapify(heap)
    left = seats - sum(got)
    while left > 0 and heap:
        _, i = heapq.heappop(heap)
        got[i] += 1
        left -= 1
        if got[i] < cap[i]:
            heapq.heappush(heap, (-v[i] / (2 * got[i] + 1), i))
    return got


def fill_targets(sizes: Sequence[int], weights: Sequence[float], total: float, max_repeat: float) -> list[float]:
    """Shares of ``total`` by weight, none above ``max_repeat`` times its size; the excess is shared again."""
    caps = [max_repeat * s for s in sizes]
    out = [0.0] * len(sizes)
    open_ = [i for i in range(len(sizes)) if caps[i] > 0 and weights[i] > 0]
    left = float(total)
    while open_:
        w = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] / w >= caps[i]]
        if not full:
            for i in open_:
                out[i] = left * weights[i] / w
            break
        for i in full:
            out[i] = float(caps[i])
        left = max(0.0, left - sum(caps[i] for i in full))
        open_ = [i for i in open_ if i not in set(full)]
    return out


def _take_shard(pdf: pd.DataFrame, seed: int, max_repeat: int) -> pd.DataFrame:
    """Words each document of one shard takes; the rows are sorted by the seeded order first."""
    pdf = pdf.sort_values(["place", "doc_id", "size", "mark"], kind="stable", na_position="last")
    size = pdf["size"].to_numpy(np.int64)
    end = np.cumsum(size)
    total = int(end[-1])
    blocks, quota = int(pdf["blocks"].iloc[0]), int(pdf["quota"].iloc[0])
    if total == 0 or blocks == 0:
        return pdf.assign(taken=np.zeros(len(pdf), np.int64))[OUT]
    edge = (np.arange(blocks + 1, dtype=np.float64) * total / blocks).astype(np.int64)
    edge[-1] = total
    whole, more = divmod(quota, blocks)
    pick = np.zeros(blocks, np.int64)
    rng = np.random.default_rng([seed, int(pdf["source_no"].iloc[0]), int(pdf["shard"].iloc[0])])
    pick[rng.permutation(blocks)[:more]] = 1
    width = np.diff(edge)
    chosen = np.concatenate([[0], np.cumsum(pick * width)])

    def upto(x: np.ndarray) -> np.ndarray:  # chosen words before position x of the line
        k = np.clip(np.searchsorted(edge, x, side="right") - 1, 0, blocks - 1)
        return chosen[k] + pick[k] * (x - edge[k])

    taken = whole * size + upto(end) - upto(end - size)
    return pdf.assign(taken=np.minimum(taken, max_repeat * size))[OUT]


OUT = ["doc_id", "size", "source", "source_size", "target", "taken", "row"]
OUT_SCHEMA = "doc_id long, size long, source string, source_size long, target double, taken long, row long"


def mix(
    docs: DataFrame, *, share: float = 1.5, weights: Sequence[float] = (3, 1, 2), max_repeat: int = 2, seed: int = 2025
) -> DataFrame:
    """One row per document: (doc_id, size, source, source_size, target, taken, row).

    ``docs`` has doc_id, text and source; ``row`` numbers the input rows (unique), so that callers can tell
    repeated documents apart. The sizes are stored once; the texts are read once.
    """
    spark = docs.sparkSession
    ship_package(spark)
    sized = store(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            F.xxhash64("text").alias("mark"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "mix-sizes",
    )
    return take(sized, share=share, weights=weights, max_repeat=max_repeat, seed=seed)


def take(sized: DataFrame, *, share: float, weights: Sequence[float], max_repeat: int, seed: int) -> DataFrame:
    """``mix`` for a stored table (doc_id, source, size, mark, row); ``mark`` is a hash of the text, for ties."""
    spark = sized.sparkSession
    ship_package(spark)
    # One row per source: names, sizes. This is the mix's configuration, not data.
    found = sized.groupBy("source").agg(F.sum("size").alias("n")).collect()
    found.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [int(r["n"]) for r in found]
    w = [float(weights[i % len(weights)]) for i in range(len(found))]
    targets = fill_targets(sizes, w, share * sum(sizes), max_repeat)
    least = min((t for t in targets if t > 0), default=1.0)
    block = int(min(MAX_BLOCK, max(1, least // 128)))
    quotas = sainte_lague(targets, round(sum(targets) / block))
    shards = [max(1, -(-n // SHARD_WORDS)) for n in sizes]
    plan = spark.createDataFrame(
        [(i, r["source"], sizes[i], targets[i], quotas[i], shards[i]) for i, r in enumerate(found)],
        "source_no int, source string, source_size long, target double, seats long, shards int",
    )
    src = F.col("source")
    keyed = (
        sized.join(plan.withColumnRenamed("source", "_s"), src.eqNullSafe(F.col("_s")))
        .drop("_s")
        .withColumn("place", F.xxhash64(F.lit(seed), "doc_id"))
        .withColumn("shard", F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id"), F.col("shards")).cast("int"))
    )
    words = F.col("words")
    shard_words = keyed.groupBy("source_no", "shard", "seats").agg(F.sum("size").alias("words")).select(
        "*", F.floor(F.col("shard") / PART).cast("int").alias("part"),
        F.when(words > 0, F.greatest(F.lit(1), F.bround(words / block))).otherwise(0).cast("long").alias("blocks"),
    )

    def quota(pdf: pd.DataFrame, by: str, seats: str, out: str) -> pd.DataFrame:
        pdf = pdf.sort_values(by)
        most = [max_repeat * b for b in pdf["blocks"].tolist()]
        got = sainte_lague(pdf["words"].tolist(), int(pdf[seats].iloc[0]), most)
        return pdf[["source_no", by]].assign(**({"blocks": pdf["blocks"]} if by == "shard" else {}), **{out: got})

    parts = shard_words.groupBy("source_no", "part", "seats").agg(F.sum("words").alias("words"), F.sum("blocks").alias("blocks"))
    part_seats = parts.groupBy("source_no").applyInPandas(
        lambda pdf: quota(pdf, "part", "seats", "part_seats"), "source_no int, part int, part_seats long"
    )
    quotas_df = shard_words.join(part_seats, ["source_no", "part"]).groupBy("source_no", "part").applyInPandas(
        lambda pdf: quota(pdf, "shard", "part_seats", "quota"), "source_no int, shard int, blocks long, quota long"
    )
    return (
        keyed.join(quotas_df, ["source_no", "shard"])
        .groupBy("source_no", "shard")
        .applyInPandas(lambda pdf: _take_shard(pdf, seed, max_repeat), OUT_SCHEMA)
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents: the input's rows and columns, each as often as it is taken.

    A document's taken words are a number of whole copies and a rest; the rest becomes one more copy with the
    probability of its share (seeded by the document), so each source's words stay near its target. The rows'
    numbers are written with the rows: two scans of the same files need not number them alike.
    """
    cols = docs.columns
    row, times, copy = free_names(docs, "row", "times", "copy")
    rows = store(docs.withColumn(row, F.monotonically_increasing_id()), "mix-input")
    sized = rows.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64("text").alias("mark"),
        F.col(row).alias("row"),
    )
    o = {"share": 1.5, "weights": (3, 1, 2), "max_repeat": 2, "seed": 2025} | options
    got = take(store(sized, "mix-sizes"), **o)
    u = F.pmod(F.xxhash64(F.lit(o["seed"] + 2), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    copies = got.where(F.col("taken") > 0).select(
        F.col("row").alias(row), F.floor(F.col("taken") / F.col("size") + u).cast("int").alias(times)
    )
    out = rows.join(copies.where(F.col(times) > 0), row)
    return out.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*cols)
