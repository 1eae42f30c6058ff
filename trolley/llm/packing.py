"""Packing token sequences as a cutting-stock problem, solved by column generation.

Documents are cut into pieces and laid into sequences of at most ``cap`` tokens.

1. A document of n ids gives ``n // cap`` full pieces (a sequence each) and a *remainder* of ``n % cap`` ids.
2. The remainders' length histogram (at most ``cap - 1`` rows, whatever the number of documents) is a
   cutting-stock problem: how often to use each *pattern* (a multiset of lengths that fits into ``cap``). Its
   linear program is solved by column generation: a greedy heuristic gives the first basis, a knapsack dynamic
   program over the capacity prices new columns, and the simplex step exchanges one column at a time until the
   gap to the bound "tokens / cap" is below ``gap`` or no column prices out.
3. The solution is rounded down, then up where the demand allows. Only patterns that fill a sequence to the last
   token are kept. The k-th remainder of a length (its rank) belongs to a fixed place of a fixed copy of a
   pattern, so the assignment is arithmetic on ranks.
4. What no exact pattern holds is laid end to end on one token line, also by rank, and cut at every ``cap``
   tokens. The line's last part is cut into powers of two, which need no padding.

Ranks come in two levels (inside a shard, and the counts of the shards before), so a length that a third of all
documents share is spread over all tasks.

Defined cases: a NULL text is empty and packs its end id alone; repeated doc_ids are separate documents; an empty
table gives no rows; NULL doc_ids are kept; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trolley.llm.common import one_blas_thread, ship_package, slices, small_batches, store
from trolley.llm.tokens import encoder, widen

CAP = 1024
END_ID = 0
GAP = 0.0005  # of the number of sequences, where column generation stops
MAX_PIVOTS = 400


def knapsack(values: np.ndarray, lengths: np.ndarray, cap: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of ``lengths`` (ascending) that fits into ``cap``: (value, counts)."""
    best = np.zeros(cap + 1)
    last = np.full(cap + 1, -1, np.int64)
    fits = np.searchsorted(lengths, np.arange(cap + 1), side="right")
    for c in range(1, cap + 1):
        k = fits[c]
        best[c] = best[c - 1]
        if k:
            v = values[:k] + best[c - lengths[:k]]
            i = int(v.argmax())
            if v[i] > best[c] + 1e-12:
                best[c], last[c] = v[i], i
    counts = np.zeros(len(lengths), np.int64)
    c = cap
    while c > 0:
        if last[c] < 0:
            c -= 1
        else:
            counts[last[c]] += 1
            c -= int(lengths[last[c]])
    return float(best[cap]), counts


def greedy_pattern(left: np.ndarray, lengths: np.ndarray, cap: int) -> np.ndarray:
    """Largest first; closes with an exact fit as soon as one is there."""
    counts = np.zeros(len(lengths), np.int64)
    place = {int(x): i for i, x in enumerate(lengths)}
    space, i = cap, len(lengths) - 1
    while space > 0 and i >= 0:
        j = place.get(space)
        if j is not None and left[j] - counts[j] >= 1:
            counts[j] += 1
            break
        i = min(i, int(np.searchsorted(lengths, space, side="right")) - 1)
        while i >= 0 and left[i] - counts[i] < 1:
            i -= 1
        if i >= 0:
            counts[i] += 1
            space -= int(lengths[i])
    return counts


def first_basis(demand: np.ndarray, lengths: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray]:
    """Columns and their use from repeated greedy patterns; each exhausts one length, so they form a basis."""
    n = len(lengths)
    left = demand.astype(float).copy()
    cols, use, open_ = [], [], np.ones(n, bool)
    while open_.any():
        a = greedy_pattern(np.where(open_, np.maximum(left, 1.0), 0.0), lengths, cap)
        inside = np.flatnonzero(a)
        t = left[inside] / a[inside]
        k = inside[int(t.argmin())]
        x = max(0.0, float(t.min()))
        left[inside] -= x * a[inside]
        left[k], open_[k] = 0.0, False
        cols.append(a)
        use.append(x)
    return np.array(cols, float).T, np.array(use)


def solve(demand: np.ndarray, lengths: np.ndarray, cap: int, gap: float = GAP, pivots: int = MAX_PIVOTS):
    """Column generation: (columns, use) of a basic solution of min sum(use), columns @ use = demand."""
    B, x = first_basis(demand, lengths, cap)
    inv = np.linalg.inv(B)
    bound = float(demand @ lengths) / cap
    for _ in range(pivots):
        if x.sum() <= bound * (1 + gap):
            break
        price = inv.sum(axis=0)  # cost 1 a column
        value, a = knapsack(np.maximum(price, 0.0), lengths, cap)
        if value <= 1 + 1e-9:
            break
        d = inv @ a
        grow = d > 1e-9
        if not grow.any():
            break
        ratio = np.where(grow, x / np.where(grow, d, 1.0), np.inf)
        r = int(ratio.argmin())
        step = ratio[r]
        x = x - step * d
        x[r] = step
        x = np.maximum(x, 0.0)
        B[:, r] = a
        row = inv[r] / d[r]
        inv = inv - np.outer(d, row)
        inv[r] = row
    return B, x


@dataclass
class Plan:
    """Where the ranks of each remainder length go."""

    cap: int
    covered: dict[int, int]  # length → remainders held by exact patterns
    slots: dict[int, tuple[np.ndarray, ...]]  # length → (first rank, first sequence, copies, first offset) rows
    pattern_sequences: int
    line: dict[int, int]  # length → where its uncovered remainders start on the token line
    line_tokens: int
    sequences: int  # of the linear program before rounding, rounded up


def round_plan(histogram: dict[int, int], cap: int = CAP) -> Plan:
    lengths = np.array(sorted(k for k, v in histogram.items() if v > 0), np.int64)
    demand = np.array([histogram[int(k)] for k in lengths], np.int64)
    covered = {int(k): 0 for k in lengths}
    slots: dict[int, list[tuple[int, int, int, int]]] = {int(k): [] for k in lengths}
    seq, lp = 0, 0
    if len(lengths):
        cols, use = solve(demand, lengths, cap)
        lp = math.ceil(float(use.sum()) - 1e-9)
        exact = [j for j in range(cols.shape[1]) if int(cols[:, j] @ lengths) == cap]
        left = demand.copy()
        times = {}
        for j in exact:
            a = cols[:, j].astype(np.int64)
            inside = np.flatnonzero(a)
            t = min(int(math.floor(use[j] + 1e-9)), int((left[inside] // a[inside]).min()))
            times[j] = t
            left -= t * a
        for j in sorted(exact, key=lambda j: -(use[j] - times[j])):
            a = cols[:, j].astype(np.int64)
            inside = np.flatnonzero(a)
            if use[j] - times[j] > 1e-9 and (left[inside] >= a[inside]).all():
                times[j] += 1
                left -= a
        for j in exact:
            if times[j] == 0:
                continue
            at = 0
            for i in np.flatnonzero(cols[:, j])[::-1]:
                k, m = int(lengths[i]), int(cols[i, j])
                slots[k].append((covered[k], seq, m, at))
                covered[k] += m * times[j]
                at += k * m
            seq += times[j]
    line, pos = {}, 0
    for k, n in zip(lengths.tolist(), demand.tolist()):
        line[k] = pos
        pos += (n - covered[k]) * k
    arrays = {k: tuple(np.array(c, np.int64) for c in zip(*v)) for k, v in slots.items() if v}
    return Plan(cap, covered, arrays, seq, line, pos, lp)


def line_cuts(plan: Plan) -> np.ndarray:
    """Lengths of the parts of the line's last sequence: powers of two, largest first."""
    rest = plan.line_tokens % plan.cap
    return np.array([1 << b for b in range(plan.cap.bit_length(), -1, -1) if rest >> b & 1], np.int64)


def place_remainder(plan: Plan, length: int, rank: int) -> list[tuple[int, int, int, int]]:
    """Pieces (start in the remainder, length, sequence, offset) of the rank-th remainder of a length."""
    if rank < plan.covered[length]:
        first, seq, copies, at = plan.slots[length]
        i = int(np.searchsorted(first, rank, side="right")) - 1
        k, m = divmod(rank - int(first[i]), int(copies[i]))
        return [(0, length, int(seq[i]) + k, int(at[i]) + m * length)]
    pos = plan.line[length] + (rank - plan.covered[length]) * length
    whole = plan.line_tokens // plan.cap
    cuts = line_cuts(plan)
    edges = whole * plan.cap + np.concatenate([[0], np.cumsum(cuts)])
    out, start = [], 0
    while start < length:
        p = pos + start
        if p < whole * plan.cap:
            seq, lo, hi = p // plan.cap, p // plan.cap * plan.cap, (p // plan.cap + 1) * plan.cap
        else:
            i = int(np.searchsorted(edges, p, side="right")) - 1
            seq, lo, hi = whole + i, int(edges[i]), int(edges[i + 1])
        n = min(length - start, hi - p)
        out.append((start, n, plan.pattern_sequences + seq, p - lo))
        start += n
    return out


STAGE_SCHEMA = (
    "shard int, doc_id long, doc_tokens long, full_before long, full_crc array<long>, rem_len int, rem_rank long, "
    "rem_ids binary, ids binary"
)
PIECE_SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
)


def wide(ids: bytes, dtype: str, start: int, n: int) -> bytes:
    """Ids [start, start + n) of a narrow row as uint32."""
    size = np.dtype(dtype).itemsize
    return np.frombuffer(ids, dtype, n, start * size).astype("<u4").tobytes()


def tokenise(docs: DataFrame, tokenizer: str, end_id: int, cap: int, keep_ids: bool) -> DataFrame:
    """The stored stage: a row per document with its full pieces' checksums and its remainder.

    ``full_before`` and ``rem_rank`` count inside the shard (the scan partition).
    """

    def run(batches):
        shard, fulls, ranks = TaskContext.get().partitionId(), 0, [0] * cap
        for b in slices(batches, keep=True):
            enc = encoder(tokenizer)
            end, size = enc.pack(end_id), np.dtype(enc.dtype).itemsize
            cols = {f: [] for f in ("n", "before", "crc", "len", "rank", "rem", "ids")}
            for made in enc.encode_all(t or "" for t in b.column(1).to_pylist()):
                ids = made + end
                n = len(ids) // size
                k, r = divmod(n, cap)
                full = widen(ids[: size * cap * k], enc.dtype)
                cols["n"].append(n)
                cols["before"].append(fulls)
                cols["crc"].append([zlib.crc32(full[4 * cap * i : 4 * cap * (i + 1)]) for i in range(k)])
                cols["len"].append(r)
                cols["rank"].append(ranks[r])
                cols["rem"].append(ids[size * cap * k :])
                cols["ids"].append(ids if keep_ids else None)
                fulls += k
                ranks[r] += 1
            rows = len(cols["n"])
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard] * rows, pa.int32()), b.column(0), pa.array(cols["n"], pa.int64()),
                 pa.array(cols["before"], pa.int64()), pa.array(cols["crc"], pa.list_(pa.int64())),
                 pa.array(cols["len"], pa.int32()), pa.array(cols["rank"], pa.int64()),
                 pa.array(cols["rem"], pa.binary()), pa.array(cols["ids"], pa.binary())],
                names=[c.split()[0] for c in STAGE_SCHEMA.split(", ")],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    with small_batches(docs.sparkSession):
        return store(rows.mapInArrow(run, STAGE_SCHEMA), "pack-tokens")


def pack(
    docs: DataFrame, tokenizer: str, *, end_id: int = END_ID, cap: int = CAP, keep_ids: bool = False
) -> DataFrame:
    """A row per piece (PIECE_SCHEMA); ``ids`` holds the piece's ids (uint32) if ``keep_ids``, else NULL."""
    spark = docs.sparkSession
    ship_package(spark)
    stage = tokenise(docs, tokenizer, end_id, cap, keep_ids)
    per = stage.groupBy("rem_len", "shard").agg(F.count(F.lit(1)).alias("n"))
    hist = {r["rem_len"]: r["n"] for r in per.groupBy("rem_len").agg(F.sum("n").alias("n")).collect()}  # ≤ cap rows
    hist.pop(0, None)
    one_blas_thread()
    plan = round_plan(hist, cap)
    before = Window.partitionBy("rem_len").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per.select("rem_len", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rank_before"))
    # One row per scan partition: the number of full sequences before it.
    shards = stage.groupBy("shard").agg(F.sum(F.size("full_crc")).alias("n"))
    w = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    firsts = shards.select("shard", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("full_first"))
    full_total = plan.pattern_sequences + plan.line_tokens // cap + len(line_cuts(plan))

    def pieces(batches):
        dtype = encoder(tokenizer).dtype
        for b in slices(batches, keep=True):
            out = [[] for _ in range(8)]
            for r in b.to_pylist():
                rows = [
                    (i * cap, cap, crc, full_total + r["full_first"] + r["full_before"] + i, 0)
                    for i, crc in enumerate(r["full_crc"])
                ]
                if r["rem_len"]:
                    at = len(rows) * cap
                    for s, n, seq, off in place_remainder(plan, r["rem_len"], r["rank_before"] + r["rem_rank"]):
                        rows.append((at + s, n, zlib.crc32(wide(r["rem_ids"], dtype, s, n)), seq, off))
                for s, n, crc, seq, off in rows:
                    ids = wide(r["ids"], dtype, s, n) if r["ids"] is not None else None
                    for c, v in zip(out, (r["doc_id"], s, n, crc, r["doc_tokens"], seq, off, ids)):
                        c.append(v)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in out[:7]), pa.array(out[7], pa.binary())],
                names=[c.split()[0] for c in PIECE_SCHEMA.split(", ")],
            )

    return stage.join(offsets, ["rem_len", "shard"]).join(firsts, "shard").mapInArrow(pieces, PIECE_SCHEMA)


def sequences(pieces: DataFrame, cap: int = CAP) -> DataFrame:
    """Packed sequences of pieces with ids: (sequence_id, length, ids, doc_ids, offsets, padded_length).

    ``ids`` are the sequence's ids as uint32 bytes in the order of the offsets; a sequence is padded to ``cap``
    unless its length is a power of two. A group is one sequence, at most ``cap`` ids.
    """
    part = F.struct("offset", "doc_id", "length", F.hex("ids").alias("hex"))
    g = pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(part)).alias("p"), F.sum("length").alias("length"))
    two = F.bit_count("length") == 1
    return g.select(
        "sequence_id",
        "length",
        F.unhex(F.array_join(F.transform("p", lambda x: x["hex"]), "")).alias("ids"),
        F.transform("p", lambda x: x["doc_id"]).alias("doc_ids"),
        F.transform("p", lambda x: x["offset"]).alias("offsets"),
        F.when(two, F.col("length")).otherwise(F.lit(cap).cast("long")).alias("padded_length"),
    )
