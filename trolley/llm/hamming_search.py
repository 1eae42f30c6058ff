"""Approximate nearest neighbours by multi-index hashing of learned binary codes.

1. *Codes.* A bounded sample gives the mean and ``ROTATIONS`` learned rotations (principal axes, then iterative
   quantisation: rotate so that signs lose least). A vector's code is the signs under all rotations: with 64
   dimensions and 4 rotations 256 bits, held as bytes.
2. *Index.* A code is split into byte substrings; every substring of every row is indexed (sorted postings by value),
   block by block: a block is a hash partition of about ``BLOCK`` rows.
3. *Search.* By the pigeonhole principle a code within Hamming radius r of the query has at least one substring within
   ``r // substrings`` of the query's: probing those values of every substring retrieves every code within r. The
   codes' full distances are then checked against r, and what is within is ranked by the exact Euclidean distance of
   the original vectors in double precision.
4. The radius is learned too: on sample queries, the distance that holds the share ``COVER`` of true neighbours. A
   block in which fewer than k rows are within the radius ranks its nearest codes instead, so a query always gets k.

Every block gives its best k, and the blocks' lists are merged. All rows are indexed and all codes within the radius
are ranked; nothing is capped. Equal vectors lie in different blocks, so no value makes a block large.

Defined cases: vectors that are NULL, empty, zero or hold NULL or non-finite components take no part, nor do vectors of
another length than most; NULL keys take no part; repeated keys are rows of their own (a query's own key is never
its neighbour); with fewer than k candidates all are returned; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import one_blas_thread, sample_rows, ship_package, store

K = 10
QUERY_MODULUS = 100
SAMPLE = 8000  # rows the rotations and the radius are learned from
SAMPLE_QUERIES = 200
ROTATIONS = 4
STEPS = 20  # of iterative quantisation
COVER = 0.985
BLOCK = 16384  # rows of an index block
QUERY_BLOCK = 1024

_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)


@dataclass
class Codes:
    mean: np.ndarray
    rotations: np.ndarray  # dimensions x bits
    radius: int

    def encode(self, x: np.ndarray) -> np.ndarray:
        """(rows, bytes) codes."""
        return np.packbits((x - self.mean) @ self.rotations > 0, axis=1)


def learn_codes(x: np.ndarray, rotations: int = ROTATIONS, seed: int = 11) -> Codes:
    """Rotations and radius from a sample (rows x dimensions, float64)."""
    rng = np.random.default_rng(seed)
    dim = x.shape[1]
    mean = x.mean(axis=0)
    c = x - mean
    _, axes = np.linalg.eigh(c.T @ c)
    p = c @ axes
    parts = []
    for _ in range(rotations):
        r = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
        for _ in range(STEPS):
            u, _, v = np.linalg.svd(np.where(p @ r > 0, 1.0, -1.0).T @ p)
            r = (u @ v).T
        parts.append(axes @ r)
    codes = Codes(mean, np.hstack(parts), 0)
    bits = codes.encode(x)
    found = []
    for i in range(0, len(x), max(1, len(x) // SAMPLE_QUERIES)):
        d = ((x - x[i]) ** 2).sum(axis=1)
        d[i] = np.inf
        near = np.argsort(d, kind="stable")[:K]
        found.append(_ONES[bits[near] ^ bits[i]].sum(axis=1))
    codes.radius = int(np.quantile(np.concatenate(found), COVER)) if len(x) > 1 else bits.shape[1] * 8
    return codes


def flips(within: int) -> np.ndarray:
    """The byte differences of at most ``within`` bits."""
    return np.flatnonzero(_ONES <= within).astype(np.uint8)


class BlockIndex:
    """The multi-index of one block: for each substring the rows sorted by value, and where each value starts."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.order = np.argsort(codes, axis=0, kind="stable").T.astype(np.int32)
        self.first = np.stack([np.searchsorted(np.sort(c), np.arange(257)) for c in codes.T])

    def within(self, q: np.ndarray, radius: int) -> np.ndarray:
        """Rows whose code is within the radius of ``q``: pigeonhole probing, then the full distance."""
        n, subs = self.codes.shape
        each = radius // subs
        if each >= 8:
            rows = np.arange(n)
        else:
            seen = np.zeros(n, bool)
            diffs = flips(each)
            for j in range(subs):
                v = (diffs ^ q[j]).astype(np.int64)
                first = self.first[j]
                for a, b in zip(first[v].tolist(), first[v + 1].tolist()):
                    seen[self.order[j, a:b]] = True
            rows = np.flatnonzero(seen)
        return rows[_ONES[self.codes[rows] ^ q].sum(axis=1, dtype=np.int64) <= radius]


def search_block(index: pd.DataFrame, queries: pd.DataFrame, codes: Codes, k: int) -> pd.DataFrame:
    """Each query's best k rows of one block: (query_id, q_row, vec_id, score)."""
    ids = index["vec_id"].to_numpy()
    x = np.array(index["vector"].tolist(), np.float64)
    own = BlockIndex(codes.encode(x))
    out: list[tuple] = []
    asked = np.array(queries["vector"].tolist(), np.float64)
    for row, key, q, bits in zip(queries["q_row"], queries["query_id"], asked, codes.encode(asked)):
        rows = own.within(bits, codes.radius)
        if (ids[rows] != key).sum() < k:
            distance = _ONES[own.codes ^ bits].sum(axis=1, dtype=np.int64)
            distance[ids == key] = 1 << 30
            rows = np.flatnonzero(distance <= np.sort(distance)[min(k, len(ids)) - 1])
        rows = rows[ids[rows] != key]
        score = np.sqrt(((x[rows] - q) ** 2).sum(axis=1))
        best = np.lexsort((ids[rows], score))[:k]
        out += [(key, row, int(ids[rows[i]]), float(score[i])) for i in best]
    return pd.DataFrame(out, columns=["query_id", "q_row", "vec_id", "score"])


def _usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    v = F.col(vector)
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), v.cast("array<double>").alias("vector"))
    ok = F.col("vec_id").isNotNull() & F.forall("vector", number) & F.exists("vector", lambda x: x != 0)
    return rows.where(ok)


def nearest(
    vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding", k: int = K, modulus: int = QUERY_MODULUS
) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row whose key is divisible by ``modulus`` its k nearest others."""
    spark = vectors.sparkSession
    ship_package(spark)
    one_blas_thread()
    rows = store(_usable(vectors, key, vector), "search-vectors")
    sizes = rows.groupBy(F.size("vector").alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()  # a row per length
    schema = "query_id long, q_row long, vec_id long, score double"
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, n = max(((r["n"], r["d"]) for r in sizes))[::-1]
    rows = rows.where(F.size("vector") == dim)
    sample = np.array([r["vector"] for r in sample_rows(rows, "vec_id", SAMPLE).collect()], float)
    codes = learn_codes(sample)
    asked = rows.where(F.col("vec_id") % modulus == 0).select(
        F.col("vec_id").alias("query_id"), F.monotonically_increasing_id().alias("q_row"), "vector"
    )
    asked = store(asked, "search-queries")
    n_asked = asked.count()
    blocks, parts = max(1, -(-n // BLOCK)), max(1, -(-n_asked // QUERY_BLOCK))
    # Every pair of an index block and a query block is one group: the stated queries against all rows, in blocks.
    index = rows.withColumn("ib", F.pmod(F.xxhash64(F.lit(1), "vec_id", "vector"), F.lit(blocks)))
    index = index.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    asked = asked.withColumn("qb", F.pmod(F.xxhash64(F.lit(2), "q_row"), F.lit(parts)).cast("int"))
    asked = asked.withColumn("ib", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "q_row": [], "vec_id": [], "score": []})
        return search_block(left, right, codes, k)

    best = index.groupBy("ib", "qb").cogroup(asked.groupBy("ib", "qb")).applyInPandas(run, schema)
    # The blocks' lists of a query (k rows a block) are merged by one sort of their ranks.
    top = best.groupBy("q_row", "query_id").agg(
        F.slice(F.array_sort(F.collect_list(F.struct("score", "vec_id"))), 1, k).alias("t")
    )
    return top.select("query_id", F.posexplode("t").alias("i", "x")).select(
        "query_id", (F.col("i") + 1).cast("int").alias("rank"), "x.vec_id", "x.score"
    )
