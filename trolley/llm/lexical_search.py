"""Ranked lexical search over bit-sliced Bloom signatures.

1. *Signatures.* A document's terms enter a Bloom filter: (term, level) for every level of ``LEVELS`` that the term's
   count reaches. The filter has 8 to 16 bits an entry, so its width is one of few powers of two. Documents of one
   width stand side by side in blocks, and a block is kept by bit: slice b holds bit b of all its documents.
   Blocks are made inside the scan's tasks; no text is shuffled.
2. *Upper bounds.* A term's slices, joined by AND, name the documents that may hold it; a document that holds it is always
   named. The weighted sums of these bitmaps by level, times what a level can add to a term's score in a document of that
   length, bound each document's score from above.
3. *Threshold.* For each item the documents of the ``TOP`` highest bounds are scored exactly. The last of the best ``TOP``
   scores is a lower bound of the score that the final list needs.
4. *Scores.* Every document whose bound is not below that threshold is scored exactly from its whole text; the others are
   provably outside the list.

Items go in blocks of about ``ITEM_TERMS`` terms, all against every index block. The driver holds one block of items and
a map of ``FILTER_BITS`` bits of the items' terms, which keeps other terms out of the document counts.

Defined cases: NULL and empty texts have no terms, and such items no results; every row of ``items`` is an item, every
row of ``docs`` a document (repeated rows too, one after another in the ranks); among equal scores a NULL doc_id comes
last; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trolley.llm.common import ship_package, store
from trolley.llm.tokens import Memo

TOP = 20
LEVELS = (1, 2, 3, 4, 6, 9, 14, 24)  # counts of a term that get an entry of their own
HASHES = 4
BLOCK_BITS = 1 << 22  # of a block's slices
BLOCK_DOCS = 4096
FILTER_BITS = 1 << 20
ITEM_TERMS = 100_000  # of a block of items
FLUSH = 300_000  # counted terms that a task holds

#: Fixed by the task: a term is a run of these characters, only A-Z are lower-cased.
_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

_INDEX = "kind int, term string, df long, width int, docs int, terms long, keys binary, lengths binary, most binary, slices binary"
_NAMES = [c.split()[0] for c in _INDEX.split(", ")]
_TYPES = [pa.int32(), pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 4]
_DOCUMENTS, _COUNTS = 0, 1


def terms(text: str) -> list[str]:
    return _TERM.findall(text.encode("utf-8", "replace").lower().decode("utf-8"))


def term_hash(term: str) -> int:
    return xxhash.xxh3_64_intdigest(term.encode("utf-8"))


def places(hashes: np.ndarray, level: int, width: int) -> np.ndarray:
    """(n, HASHES) bit numbers of the entries (term, level) in a filter of ``width`` bits."""
    h = (hashes + np.uint64(level + 1)) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    low, step = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    at = low[:, None] + step[:, None] * np.arange(HASHES, dtype=np.uint64)
    return (at & np.uint64(width - 1)).astype(np.int64)


class Block:
    """Documents of one width on their way into slices."""

    def __init__(self, width: int):
        self.width = width
        self.room = max(8, min(BLOCK_DOCS, BLOCK_BITS // width))
        self.slices = np.zeros((width, self.room // 8), np.uint8)
        self.keys: list[int] = []
        self.lengths: list[int] = []
        self.most: list[int] = []

    def add(self, key: int, hashes: np.ndarray, counts: np.ndarray) -> None:
        j = len(self.keys)
        for level, least in enumerate(LEVELS):
            there = hashes[counts >= least]
            if not len(there):
                break
            self.slices[places(there, level, self.width), j >> 3] |= np.uint8(128 >> (j & 7))
        self.keys.append(key)
        self.lengths.append(int(counts.sum()))
        self.most.append(int(counts.max()))

    def row(self) -> tuple:
        used = self.slices[:, : (len(self.keys) + 7) // 8]
        longs = (np.array(x, np.int64).tobytes() for x in (self.keys, self.lengths, self.most))
        return (_DOCUMENTS, None, None, self.width, len(self.keys), sum(self.lengths), *longs, used.tobytes())


def width_of(counts: np.ndarray) -> int:
    entries = sum(int((counts >= least).sum()) for least in LEVELS)
    return 8 << max(3, (entries - 1).bit_length())


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * len(_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _TYPES)], names=_NAMES)


def _texts(docs: DataFrame) -> DataFrame:
    """(key, doc_id, text); rows of one key are equal, but for a colliding hash (then one more row is scored)."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    return rows.select(F.xxhash64("doc_id", "text").alias("key"), "doc_id", "text")


def build(docs: DataFrame, wanted: np.ndarray) -> DataFrame:
    """The stored index: rows of document blocks, and rows (term, df) of the terms on the ``wanted`` bit map."""

    def run(batches):
        hash_of = Memo(term_hash)
        blocks: dict[int, Block] = {}
        df: Counter = Counter()
        for b in batches:
            rows = []
            for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                n = Counter(terms(text))
                if not n:
                    continue
                hashes = np.fromiter(map(hash_of.__getitem__, n), np.uint64, len(n))
                counts = np.fromiter(n.values(), np.int64, len(n))
                asked = np.flatnonzero(wanted[hashes & np.uint64(FILTER_BITS - 1)])
                if len(asked):
                    names = list(n)
                    df.update(names[i] for i in asked.tolist())
                width = width_of(counts)
                block = blocks.setdefault(width, Block(width))
                block.add(key, hashes, counts)
                if len(block.keys) == block.room:
                    rows.append(blocks.pop(width).row())
            if len(df) >= FLUSH:
                rows += [(_COUNTS, t, k, *[None] * 7) for t, k in df.items()]
                df.clear()
            if rows:
                yield _batch(rows)
        yield _batch([(_COUNTS, t, k, *[None] * 7) for t, k in df.items()])
        for block in blocks.values():
            yield _batch([block.row()])

    return store(_texts(docs).select("key", "text").mapInArrow(run, _INDEX), "search-index")


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def stretch(length, n_docs: int, all_terms: int):
    """A document's m, for one length or an array of lengths."""
    return 100 - 25 + (25 * length * n_docs) // all_terms


def gain(tf, m):
    """What ``tf`` occurrences add to a score, before the term's weight; it grows with tf."""
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


class Queries:
    """A block of items: their terms' hashes and weights."""

    def __init__(self, items: dict[int, dict[str, tuple[int, int]]], n_docs: int, all_terms: int):
        """``items``: row → term → (occurrences in the item, df)."""
        self.n_docs, self.all_terms = n_docs, all_terms
        names = sorted({t for ts in items.values() for t in ts})
        number = {t: i for i, t in enumerate(names)}
        self.hashes = np.array([term_hash(t) for t in names], np.uint64)
        self.items: dict[int, dict[str, int]] = {}  # row → term → weight, repeats included
        for row, ts in items.items():
            weights = {t: k * term_weight(n_docs, df) for t, (k, df) in ts.items()}
            self.items[row] = {t: w for t, w in weights.items() if w > 0}
        self.at = {
            row: (np.array([number[t] for t in ts], np.int64), np.array(list(ts.values()), float))
            for row, ts in self.items.items()
            if ts
        }

    def bounds(self, r: dict):
        """(row, upper bounds of the block's documents) for every item that may match."""
        docs, width = r["docs"], r["width"]
        slices = np.frombuffer(r["slices"], np.uint8).reshape(width, -1)
        m = stretch(np.frombuffer(r["lengths"], np.int64), self.n_docs, self.all_terms)
        most = np.frombuffer(r["most"], np.int64)
        maps, adds, before = [], [], np.zeros(docs, np.int64)
        for level in range(len(LEVELS)):
            at = places(self.hashes, level, width)
            there = slices[at[:, 0]]
            for k in range(1, HASHES):
                there = there & slices[at[:, k]]
            if maps:
                there &= maps[-1]
            if not there.any():
                break
            # With this level and not the next one a term occurs less often than the next level says.
            up = np.minimum(most, LEVELS[level + 1] - 1) if level + 1 < len(LEVELS) else most
            now = gain(up, m)
            maps.append(there)
            adds.append((now - before).astype(float))
            before = now
        for row, (at, weight) in self.at.items():
            total = None
            for there, add in zip(maps, adds):
                bits = there[at]
                if not bits.any():
                    break
                part = (weight @ np.unpackbits(bits, axis=1, count=docs).astype(float)) * np.maximum(add, 0.0)
                total = part if total is None else total + part
            if total is not None:
                yield row, total

    def score(self, row: int, n: Counter, m: int) -> int:
        return sum(w * gain(n[t], m) for t, w in self.items[row].items() if t in n)


def _candidates(index: DataFrame, queries: Queries, floors: dict[int, int] | None) -> DataFrame:
    """(row, key, bound): all documents not below their item's floor; without floors each task's TOP highest."""

    def run(batches):
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for b in batches:
            out: list[tuple[np.ndarray, ...]] = []
            for i in range(b.num_rows):
                r = {c: b.column(j)[i].as_py() for j, c in enumerate(b.schema.names)}
                keys = np.frombuffer(r["keys"], np.int64)
                for row, bound in queries.bounds(r):
                    if floors is None:
                        old = best.get(row)
                        k, v = (keys, bound) if old is None else (np.append(old[0], keys), np.append(old[1], bound))
                        if len(v) > TOP:
                            top = np.argpartition(-v, TOP - 1)[:TOP]
                            k, v = k[top], v[top]
                        best[row] = (k, v)
                        continue
                    over = np.flatnonzero(bound >= floors.get(row, 1))
                    if len(over):
                        out.append((np.full(len(over), row), keys[over], bound[over]))
            if out:
                yield _arrays(out)
        if best:
            yield _arrays([(np.full(len(k), row), k, v) for row, (k, v) in best.items()])

    blocks = index.where(F.col("kind") == _DOCUMENTS)
    return blocks.select("width", "docs", "keys", "lengths", "most", "slices").mapInArrow(
        run, "row long, key long, bound double"
    )


def _arrays(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    rows, keys, bounds = (np.concatenate(x) for x in zip(*parts))
    return pa.RecordBatch.from_arrays(
        [pa.array(rows.astype(np.int64)), pa.array(keys), pa.array(bounds)], names=["row", "key", "bound"]
    )


def _exact(texts: DataFrame, candidates: DataFrame, queries: Queries) -> DataFrame:
    """(row, doc_id, score) of the candidates with a score, from their whole texts."""
    # At most a block of items a key.
    asked = candidates.groupBy("key").agg(F.collect_set("row").alias("rows"))

    def run(batches):
        for b in batches:
            out = []
            for doc_id, text, rows in zip(*(b.column(i).to_pylist() for i in range(3))):
                n = Counter(terms(text))
                m = stretch(n.total(), queries.n_docs, queries.all_terms)
                out += [(row, doc_id, s) for row in rows if (s := queries.score(row, n, m)) > 0]
            cols = list(zip(*out)) if out else [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["row", "doc_id", "score"])

    return texts.join(asked, "key").select("doc_id", "text", "rows").mapInArrow(run, "row long, doc_id long, score long")


def _best(scored: DataFrame) -> DataFrame:
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP)


def _asked(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The stored items (row, item_id, text) and their terms (row, term, k, bit)."""
    made = store(items.select(F.monotonically_increasing_id().alias("row"), "item_id", F.col("text").cast("string")), "search-items")

    def run(batches):
        for b in batches:
            out = [
                (row, t, k, term_hash(t) & (FILTER_BITS - 1))
                for row, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist())
                for t, k in Counter(terms(text or "")).items()
            ]
            cols = list(zip(*out)) if out else [(), (), (), ()]
            types = [pa.int64(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["row", "term", "k", "bit"])

    return made, store(made.select("row", "text").mapInArrow(run, "row long, term string, k long, bit long"), "search-terms")


def search(docs: DataFrame, items: DataFrame, item_terms: int = ITEM_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's TOP highest-scoring documents."""
    spark = docs.sparkSession
    ship_package(spark)
    named, asked = _asked(items)
    wanted = np.zeros(FILTER_BITS, bool)
    wanted[[r["bit"] for r in asked.select("bit").distinct().collect()]] = True  # at most FILTER_BITS rows
    index = build(docs, wanted)
    sums = index.where(F.col("kind") == _DOCUMENTS).agg(F.sum("docs").alias("n"), F.sum("terms").alias("l")).first()
    found = spark.createDataFrame([], "row long, doc_id long, score long, rank int")
    if sums["n"]:
        counts = index.where(F.col("kind") == _COUNTS).groupBy("term").agg(F.sum("df").alias("df"))
        weighed = store(asked.join(counts, "term").select("row", "term", "k", "df"), "search-weights")
        texts = _texts(docs)
        blocks = -(-weighed.count() // item_terms)
        for i in range(blocks):
            mine: dict[int, dict[str, tuple[int, int]]] = {}
            for r in weighed.where(F.pmod(F.xxhash64(F.lit(5), "row"), F.lit(blocks)) == i).toLocalIterator():
                mine.setdefault(r["row"], {})[r["term"]] = (r["k"], r["df"])
            queries = Queries(mine, sums["n"], sums["l"])
            order = Window.partitionBy("row").orderBy(F.desc("bound"), "key")
            seeds = _candidates(index, queries, None).withColumn("at", F.row_number().over(order)).where(F.col("at") <= TOP)
            first = _best(_exact(texts, seeds, queries)).where(F.col("rank") == TOP)
            floors = {r["row"]: r["score"] for r in first.collect()}  # one row an item of the block
            rest = store(_candidates(index, queries, floors), "search-candidates")
            found = found.unionByName(store(_best(_exact(texts, rest, queries)), "search-found"))
    out = named.select("row", "item_id").join(found, "row")
    return out.select("item_id", "rank", "doc_id", "score")
