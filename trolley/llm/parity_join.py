"""Jaccard join over word shingles by parity sketches.

Two sets of a and b elements with 100 * intersection >= ``PERCENT`` * union differ in at most
d = (a + b) * (100 - PERCENT) / (100 + PERCENT) elements.

1. *Sets.* A text's words (A-Z lower-cased) give its distinct 3-word shingles, as 64-bit hashes. Equal sets are found by
   a 128-bit signature and collapsed to one *representative*.
2. *Bands.* Sizes fall into bands so narrow that linked sets lie in one band or in two neighbours. A set takes
   part in its own band and in the next one; a band's largest size gives its d.
3. *Sketches.* Every element flips one bit of a sketch, so equal elements cancel and the sketches' Hamming
   distance is at most the number of different elements. A band's sketch has d + 1 + ``spare`` parts of 64 bits: linked sets agree
   in spare + 1 parts or more (pigeonhole). A part of fewer than ``LIGHT`` set bits says little and is left out, unless
   a set has more than ``spare`` such parts: so at least one agreeing part stays.
4. *Pairs.* Sets that agree in a part are candidates: all pairs of small groups. In larger ones members are compared with
   a few pivots (linear), links make classes, and what is left are pairs of different classes: those are compared in
   block tasks that give back only links which join two classes. Nothing is capped.
5. *Links.* Candidates whose sizes and Hamming distance allow it are verified on their full sets.

Defined cases: NULL, empty and word-free texts have an empty set and are linked with nothing; texts of one or two words
have their whole sequence as one shingle; rows with a NULL doc_id take no part (component NULL); repeated rows are equal
sets; very long texts have long sketches; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import ship_package, store
from trolley.llm.near_dedup import _sets as full_sets
from trolley.llm.near_dedup import components, merge, shingles, signature

PERCENT = 90
LIGHT = 3  # set bits below which a part is left out
SMALL = 24  # members of a group whose pairs are all listed
STAR = 1024  # members a pivot is compared with
BLOCK_SHINGLES = 400_000  # of a block's members
TILE = 512

_ONE, _TWO = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)


def _band_starts(percent: int) -> list[int]:
    starts = [1]
    while starts[-1] < 1 << 40:
        starts.append(100 * starts[-1] // percent + 1)
    return starts


STARTS = _band_starts(PERCENT)


def band(n: int) -> int:
    return bisect_right(STARTS, n) - 1


def most_different(a, b):
    """How many elements linked sets of these sizes can differ in."""
    return (a + b) * (100 - PERCENT) // (100 + PERCENT)


def parts(tag: int) -> tuple[int, int]:
    """(parts of a band's sketch, how many of them are spare)."""
    top = STARTS[tag + 1] - 1
    d = most_different(top, top)
    spare = (d + 1) // 8
    return d + 1 + spare, spare


def sketch(s: np.ndarray, tag: int) -> np.ndarray:
    """The parity sketch of a set for a band, as 64-bit parts."""
    n = parts(tag)[0]
    h = (s ^ (s >> np.uint64(32))) * _ONE
    h = (h ^ (h >> np.uint64(29))) * _TWO
    part = ((h >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
    bit = (part * np.uint64(64) + (h & np.uint64(63))).astype(np.int64)
    odd = (np.bincount(bit, minlength=64 * n) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.uint64)


def all_parts(sk: np.ndarray, tag: int) -> bool:
    """Whether a set has too many light parts to leave them out."""
    return int((np.bitwise_count(sk) < LIGHT).sum()) > parts(tag)[1]


_STAGE = "doc_id long, row long, n long, s1 long, s2 long, band int, own array<long>, next array<long>, own_all boolean, next_all boolean"


def _sketches(docs: DataFrame) -> DataFrame:
    def run(batches):
        none = np.zeros(0, np.int64)
        for b in batches:
            cols: list[list] = [[] for _ in range(8)]
            for t in b.column(2).to_pylist():
                s = shingles(t or "")
                k = band(len(s)) if len(s) else None
                made = [sketch(s, x) for x in (k, k + 1)] if len(s) else []
                row = [len(s), *signature(s), k]
                row += [x.view(np.int64) for x in made] or [none, none]
                row += [all_parts(x, k + i) for i, x in enumerate(made)] or [False, False]
                for c, v in zip(cols, row):
                    c.append(v)
            types = [pa.int64()] * 3 + [pa.int32()] + [pa.list_(pa.int64())] * 2 + [pa.bool_()] * 2
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), *(pa.array(c, t) for c, t in zip(cols, types))],
                names=[c.split()[0] for c in _STAGE.split(", ")],
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"),
        F.col("text").cast("string").alias("text"),
    )
    return store(rows.mapInArrow(run, _STAGE), "join-sketches")


def _postings(reps: DataFrame) -> DataFrame:
    """(node, part, rep, mine): a row for each part by which a representative can be found."""

    def side(tag, sketch_col, every, mine):
        at = reps.select("rep", F.col(every).alias("every"), tag.alias("tag"), F.posexplode(sketch_col).alias("part", "bits"))
        at = at.where(F.col("every") | (F.bit_count("bits") >= LIGHT))
        return at.select(F.xxhash64("tag", "part", "bits").alias("node"), "part", "rep", F.lit(mine).alias("mine"))

    return side(F.col("band"), "own", "own_all", True).union(side(F.col("band") + 1, "next", "next_all", False))


def _pairs_inside(groups: DataFrame) -> DataFrame:
    """All pairs (a < b) of small groups (column ``m``: at most SMALL members)."""
    m = F.col("m")
    tails = F.transform(m, lambda x, i: F.transform(F.slice(m, i + 2, F.size(m)), lambda y: F.struct(x.alias("a"), y.alias("b"))))
    return groups.select(F.explode(F.flatten(tails)).alias("p")).select("p.a", "p.b")


def _star(dense: DataFrame) -> DataFrame:
    """Pairs of the members of dense nodes with pivots.

    A node is dealt into stars of about STAR members. A star's pivots are the member that lies in the most dense
    nodes, which is the one most like the others, and another; the stars' first pivots make one star more.
    """
    degree = dense.groupBy("rep").agg(F.count(F.lit(1)).alias("degree"))
    deal = F.pmod(F.xxhash64(F.lit(1), "rep"), F.ceil(F.col("size") / STAR).cast("long"))
    m = dense.join(degree, "rep").select("node", "rep", "degree", deal.alias("star"))
    other = F.struct(F.xxhash64(F.lit(2), "rep"), F.col("rep"))
    pivots = m.groupBy("node", "star").agg(
        F.max(F.struct("degree", "rep")).alias("p"), F.min_by("rep", other).alias("q")
    )
    near = m.join(pivots.select("node", "star", F.explode(F.array("p.rep", "q")).alias("pivot")), ["node", "star"])
    tops = pivots.groupBy("node").agg(F.max("p").alias("top"))
    far = pivots.join(tops, "node").select(F.col("p.rep").alias("rep"), F.col("top.rep").alias("pivot"))
    pairs = near.select("rep", "pivot").union(far).where("rep <> pivot")
    return pairs.select(F.least("rep", "pivot").alias("a"), F.greatest("rep", "pivot").alias("b")).distinct()


def _likely(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """Pairs whose sizes and sketches allow a link."""
    side = lambda x: reps.select(
        F.col("rep").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in ("n", "band", "own", "next")]
    )
    j = pairs.join(side("a"), "a").join(side("b"), "b")
    fits = 100 * F.least("n_a", "n_b") >= PERCENT * F.greatest("n_a", "n_b")
    # The band that both take part in: the larger set's own one.
    x = F.when(F.col("band_a") >= F.col("band_b"), F.col("own_a")).otherwise(F.col("next_a"))
    y = F.when(F.col("band_b") >= F.col("band_a"), F.col("own_b")).otherwise(F.col("next_b"))
    apart = F.aggregate(
        F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0).cast("long"), lambda s, v: s + v
    )
    allowed = F.floor((F.col("n_a") + F.col("n_b")) * (100 - PERCENT) / (100 + PERCENT))
    return j.where(fits).where(apart <= allowed).select("a", "b")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    a = sets.select(F.col("rep").alias("a"), F.col("set").alias("sa"))
    b = sets.select(F.col("rep").alias("b"), F.col("set").alias("sb"))
    j = pairs.join(a, "a").join(b, "b")
    both = F.size(F.array_intersect("sa", "sb"))
    j = j.select("a", "b", both.alias("i"), (F.size("sa") + F.size("sb")).alias("t"))
    return j.where(100 * F.col("i") >= PERCENT * (F.col("t") - F.col("i"))).select("a", "b")


def _open(dense: DataFrame, label: DataFrame) -> DataFrame:
    """Members of the dense nodes that still hold more than one class."""
    j = dense.join(label.withColumnRenamed("v", "rep"), "rep", "left").withColumn("cls", F.coalesce("root", "rep"))
    many = j.groupBy("node").agg(F.min("cls").alias("x"), F.max("cls").alias("y")).where("x <> y").select("node")
    return j.join(many, "node", "left_semi").select("node", "part", "rep", "mine", "cls")


def _block_links(members: DataFrame, reps: DataFrame, sets: DataFrame) -> DataFrame:
    """Links that join classes inside nodes, from all pairs of blocks of members."""
    own = F.when(F.col("mine"), F.col("own")).otherwise(F.col("next"))
    m = members.join(reps.select("rep", "n", "own", "next"), "rep").select(*members.columns, "n", own.alias("sketch"))
    size = m.groupBy("node").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("int").alias("blocks"))
    m = m.join(size, "node").join(sets, "rep")
    m = m.withColumn("block", F.pmod(F.xxhash64(F.lit(9), "rep"), F.col("blocks")).cast("int"))
    m = m.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    m = m.withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other"))

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        k, part = len(pdf), int(pdf["part"].iloc[0])
        sk = np.zeros((k, max(map(len, pdf["sketch"]))), np.uint64)  # one length, but for nodes whose hashes collide
        for v, bits in enumerate(pdf["sketch"]):
            sk[v, : len(bits)] = np.asarray(bits, np.int64).view(np.uint64)
        n, rep, cls, block, mine = (pdf[c].to_numpy() for c in ("n", "rep", "cls", "block", "mine"))
        own_sets = [np.asarray(x, np.int64) for x in pdf["set"]]
        two = pdf["lo"].iloc[0] != pdf["hi"].iloc[0]
        root = {c: c for c in cls.tolist()}

        def find(c: int) -> int:
            while root[c] != c:
                root[c] = root[root[c]]
                c = root[c]
            return c

        out: list[tuple[int, int]] = []
        for x in range(0, k, TILE):
            for y in range(x, k, TILE):
                i, j = np.arange(x, min(k, x + TILE))[:, None], np.arange(y, min(k, y + TILE))
                ok = (cls[i] != cls[j]) & (i < j) & (mine[i] | mine[j])
                ok &= 100 * np.minimum(n[i], n[j]) >= PERCENT * np.maximum(n[i], n[j])
                if two:
                    ok &= block[i] != block[j]
                p, q = (v.ravel()[ok.ravel()] for v in np.broadcast_arrays(i, j))
                for c in range(part):  # a pair that meets in an earlier part is compared there
                    if not len(p):
                        break
                    keep = (sk[p, c] != sk[q, c]) | (np.bitwise_count(sk[p, c]) < LIGHT)
                    p, q = p[keep], q[keep]
                apart = np.zeros(len(p), np.int64)
                for c in range(sk.shape[1] if len(p) else 0):
                    apart += np.bitwise_count(sk[p, c] ^ sk[q, c])
                keep = apart <= most_different(n[p], n[q])
                for v, w in zip(p[keep].tolist(), q[keep].tolist()):
                    a, b = find(int(cls[v])), find(int(cls[w]))
                    if a == b:
                        continue
                    both = len(np.intersect1d(own_sets[v], own_sets[w], assume_unique=True))
                    if 100 * both >= PERCENT * (n[v] + n[w] - both):
                        root[a] = b
                        out.append((int(min(rep[v], rep[w])), int(max(rep[v], rep[w]))))
        return pd.DataFrame(out, columns=["a", "b"], dtype=np.int64)

    return m.groupBy("node", "lo", "hi").applyInPandas(compare, "a long, b long")


def links(docs: DataFrame, reps: DataFrame) -> DataFrame:
    """(v, root) of the linked representatives."""
    postings = _postings(reps)
    nodes = postings.groupBy("node").agg(
        F.count(F.lit(1)).alias("size"), F.max("mine").alias("mine"), F.min("rep").alias("a"), F.max("rep").alias("b")
    )
    nodes = store(nodes.where("size > 1 and mine and a <> b").drop("mine"), "join-nodes")
    members = store(postings.join(nodes.where("size > 2").select("node", "size"), "node"), "join-members")
    small = members.where(F.col("size") <= SMALL).groupBy("node").agg(F.sort_array(F.collect_set("rep")).alias("m"))
    dense = members.where(F.col("size") > SMALL)
    pairs = nodes.where("size = 2").select("a", "b").union(_pairs_inside(small)).union(_star(dense)).distinct()
    likely = store(_likely(pairs, reps), "join-likely")
    wanted = likely.select(F.col("a").alias("rep")).union(likely.select("b")).distinct()
    sets = full_sets(docs, reps.join(wanted, "rep", "left_semi"))
    label = components(_verified(likely, sets))
    left = store(_open(dense, label), "join-open")
    if not left.limit(1).count():
        return label
    sets = full_sets(docs, reps.join(left.select("rep").distinct(), "rep", "left_semi"))
    return merge(label, store(_block_links(left, reps, sets), "join-blocks"))


def parity_join(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id): see the module text."""
    ship_package(docs.sparkSession)
    stage = _sketches(docs)
    first = [F.first(c).alias(c) for c in ("band", "own", "next", "own_all", "next_all")]
    reps = stage.where("n > 0 and doc_id is not null").groupBy("n", "s1", "s2")
    reps = store(reps.agg(F.min("row").alias("rep"), F.min("doc_id").alias("did"), *first), "join-reps")
    label = links(docs, reps)
    rooted = reps.select("n", "s1", "s2", "rep", "did").join(label.withColumnRenamed("v", "rep"), "rep", "left")
    rooted = store(rooted.withColumn("root", F.coalesce("root", "rep")), "join-rooted")
    heads = rooted.groupBy("root").agg(F.min("did").alias("head"))
    keyed = rooted.join(heads, "root").select("n", "s1", "s2", "head")
    out = stage.select("doc_id", "n", "s1", "s2").join(keyed, ["n", "s1", "s2"], "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("head", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))
