"""Near-duplicate classes by a chosen-path similarity join over word shingles.

1. *Sets.* A text's words (A-Z lower-cased) give its distinct 3-word shingles, as 64-bit hashes. Equal sets are found
   by a 128-bit signature and collapsed to one *representative*; from here on only different sets are compared. Rows with
   stored numbers are found again by a scan with a bit a row, others by a join on their doc_id.
2. *Trees.* ``TREES`` independent trees branch the representatives: at each level a set goes to the child named by its
   minwise token of that tree and level, so two sets of similarity s stay together with probability s a level. Nodes
   of one member end; nodes of up to ``SMALL`` members are compared exhaustively; larger nodes branch on, up to
   ``LEVELS`` times. Two sets of similarity 0.85 are missed by all trees with a probability below 1e-5, even where
   every level is used (0.522 a tree); most nodes are small after one level.
3. *Dense nodes*, still larger after the last level, hold texts that are nearly all alike. Listing their pairs would
   grow with the square of the group. They are linked through pivots: the member closest to the node's consensus and
   a few others are compared with all members (linear work), links make classes, and what is left are the pairs
   between different classes. Those are compared exhaustively, on full sets, inside block tasks that give back only
   links that join two classes; a pair that meets in several trees is compared in the first one. Nothing is capped.
4. *Links* are confirmed on the full sets: 100 * intersection >= 85 * union. Connected components come from minimum
   labels with pointer jumping; links and labels stay in Spark.

Defined cases: NULL, empty and word-free texts have an empty set and are linked with nothing; texts of one or two words
have their whole sequence as one shingle; rows with a NULL doc_id take no part (component NULL, kept); repeated rows are
equal sets; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import free_names, ship_package, slices, small_batches, store
from trolley.llm.quality_model import _words as word_hashes

WIDTH = 3
PERCENT = 85
TREES = 16
LEVELS = 4
TOKENS = TREES * LEVELS
SMALL = 24
#: Agreeing tokens (of 64) below which a pair is not looked at: at similarity 0.85 the mean is 54.4 and the standard
#: deviation 2.9, so a true pair falls below with a probability under 1e-7.
MIN_AGREE = 38
PIVOTS = 3  # besides the consensus member
SAMPLE = 64  # members that make a node's consensus
BLOCK = 2048
TILE = 256  # members a side whose sets are compared at a time inside a block task
COLUMNS = 1 << 14  # shingles whose incidence in a tile's sets is in memory at a time

_P = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_RNG = np.random.default_rng(20250)
_XOR = _RNG.integers(0, 1 << 63, TOKENS, dtype=np.uint64)
_MUL = _RNG.integers(0, 1 << 63, TOKENS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: str, width: int = WIDTH) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    w = word_hashes(np.frombuffer(text.encode("utf-8", "replace").lower(), np.uint8))
    if not len(w):
        return np.zeros(0, np.uint64)
    w = _mix(w)
    n = min(width, len(w))
    h = np.full(len(w) - n + 1, np.uint64(n))
    for k in range(n):
        h = _mix(h * _P + w[k : len(w) - n + 1 + k])
    return np.unique(h)


def signature(s: np.ndarray) -> tuple[int, int]:
    """128 bits that are equal for equal sets, as two signed 64-bit integers."""
    a = np.add.reduce(_mix(s ^ _P)) if len(s) else np.uint64(0)
    b = np.bitwise_xor.reduce(_mix(s + _P)) if len(s) else np.uint64(0)
    return int(np.uint64(a).astype(np.int64)), int(np.uint64(b).astype(np.int64))


def tokens(s: np.ndarray) -> np.ndarray:
    """The minwise tokens of a set (TOKENS 32-bit numbers)."""
    best = np.full(TOKENS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(s), 2048):
        best = np.minimum(best, ((s[None, at : at + 2048] ^ _XOR[:, None]) * _MUL[:, None]).min(axis=1))
    return (best >> np.uint64(32)).astype(np.uint32).view(np.int32)


_STAGE = "doc_id long, row long, n long, s1 long, s2 long, tokens array<int>"


def _signatures(docs: DataFrame, row: str | None = None) -> DataFrame:
    def run(batches):
        for b in slices(batches):
            n, s1, s2, tk = [], [], [], []
            for t in b.column(2).to_pylist():
                s = shingles(t or "")
                one, two = signature(s)
                n.append(len(s))
                s1.append(one)
                s2.append(two)
                tk.append(tokens(s) if len(s) else np.zeros(0, np.int32))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(s1, pa.int64()),
                 pa.array(s2, pa.int64()), pa.array(tk, pa.list_(pa.int32()))],
                names=[c.split()[0] for c in _STAGE.split(", ")],
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.col(row) if row else F.monotonically_increasing_id()).alias("row"),
        F.col("text").cast("string").alias("text"),
    )
    with small_batches(docs.sparkSession):
        return store(rows.mapInArrow(run, _STAGE), "dedup-signatures")


def _numbered(rows: DataFrame, row: str, wanted: DataFrame) -> DataFrame:
    """The rows whose stored number is in ``wanted`` (one column). Every task gets a bit a row, so that no text is shuffled."""
    word, bits = free_names(rows, "word", "bits")
    n = F.col(wanted.columns[0])
    bit = F.expr("shiftleft(1L, cast(at as int))")
    words = wanted.select(F.shiftright(n, 6).alias(word), n.bitwiseAND(63).alias("at")).groupBy(word).agg(F.bit_or(bit).alias(bits))
    found = rows.withColumn(word, F.shiftright(row, 6)).join(F.broadcast(words), word)
    return found.where(F.getbit(bits, F.col(row).bitwiseAND(63).cast("int")) == 1).select(*rows.columns)


def _numbered_sets(docs: DataFrame, wanted: DataFrame, row: str) -> DataFrame:
    """``_sets`` of rows with stored numbers: a representative is the number of its row."""

    def run(batches):
        for b in slices(batches):
            made = [shingles(t or "").view(np.int64) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(made, pa.list_(pa.int64()))], names=["rep", "set"])

    texts = docs.select(F.col(row).alias("rep"), F.col("text").cast("string").alias("text"))
    made = _numbered(texts, "rep", wanted.select("rep")).mapInArrow(run, "rep long, set array<long>")
    with small_batches(docs.sparkSession):
        return store(made, "dedup-sets")


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(rep, set) of the wanted representatives (rep, did, s1, s2), from their texts."""

    def run(batches):
        for b in slices(batches):
            made = [shingles(t or "") for t in b.column(1).to_pylist()]
            sig = [signature(s) for s in made]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([x[0] for x in sig], pa.int64()), pa.array([x[1] for x in sig], pa.int64()),
                 pa.array([s.view(np.int64) for s in made], pa.list_(pa.int64()))],
                names=["did", "s1", "s2", "set"],
            )

    texts = docs.select(F.col("doc_id").cast("long").alias("did"), F.col("text").cast("string").alias("text"))
    texts = texts.join(wanted.select("did").distinct(), "did", "left_semi")
    made = texts.mapInArrow(run, "did long, s1 long, s2 long, set array<long>")
    # A doc_id may occur on several rows: one of the equal sets is enough.
    one = made.join(wanted.select("rep", "did", "s1", "s2"), ["did", "s1", "s2"]).groupBy("rep")
    with small_batches(docs.sparkSession):
        return store(one.agg(F.first("set").alias("set")), "dedup-sets")


def _likely(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """Pairs whose sizes allow the similarity and whose tokens agree often enough."""
    a = reps.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    b = reps.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    j = pairs.join(a, "a").join(b, "b")
    fits = 100 * F.least("na", "nb") >= PERCENT * F.greatest("na", "nb")
    same = F.aggregate(F.zip_with("ta", "tb", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    return j.where(fits).where(same >= MIN_AGREE).select("a", "b")


def _confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs that are links on their full sets."""
    a = sets.select(F.col("rep").alias("a"), F.col("set").alias("sa"))
    b = sets.select(F.col("rep").alias("b"), F.col("set").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    j = pairs.join(a, "a").join(b, "b").select("a", "b", both.alias("i"), (F.size("sa") + F.size("sb")).alias("t"))
    return j.where(100 * F.col("i") >= PERCENT * (F.col("t") - F.col("i"))).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """(v, root): the smallest vertex of each linked vertex's component."""
    both = store(links.union(links.select(F.col("b"), F.col("a"))).toDF("u", "v").distinct(), "dedup-links")
    label = store(both.groupBy(F.col("u").alias("v")).agg(F.least(F.min("v"), F.min("u")).alias("root")), "dedup-label")
    while True:
        near = both.join(label, "v").groupBy(F.col("u").alias("v")).agg(F.min("root").alias("m"))
        low = label.join(near, "v").select("v", "root", F.least("root", "m").alias("r"))
        up = label.select(F.col("v").alias("r"), F.col("root").alias("rr"))
        step = store(low.join(up, "r").select("v", "root", F.least("r", "rr").alias("r")), "dedup-label")
        changed = step.where("r <> root").limit(1).count()
        label = step.select("v", F.col("r").alias("root"))
        if not changed:
            return label


def _pairs_inside(groups: DataFrame) -> DataFrame:
    """All pairs (a < b) of small groups (column ``m``: at most SMALL members)."""
    m = F.col("m")
    each = F.flatten(
        F.transform(
            m,
            lambda x, i: F.transform(F.slice(m, i + 2, F.size(m)), lambda y: F.struct(x.alias("a"), y.alias("b"))),
        )
    )
    return groups.select(F.explode(each).alias("p")).select("p.a", "p.b")


def _branch(reps: DataFrame) -> tuple[list[DataFrame], DataFrame | None]:
    """Candidate pairs of the small nodes by level, and the members (node, rep, t) of the dense nodes."""
    trees = F.explode(
        F.transform(
            F.sequence(F.lit(0), F.lit(TREES - 1)),
            lambda t: F.struct(t.alias("t"), F.slice("tokens", t * LEVELS + 1, LEVELS).alias("path")),
        )
    )
    nodes = reps.select("rep", trees.alias("x")).select(
        "rep", "x.t", "x.path", F.xxhash64("x.t", F.get("x.path", 0)).alias("node")
    )
    found = []
    for level in range(1, LEVELS + 1):
        size = nodes.groupBy("node").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        members = store(nodes.join(size, "node"), "dedup-nodes")
        small = members.where(F.col("size") <= SMALL).groupBy("node").agg(F.sort_array(F.collect_list("rep")).alias("m"))
        found.append(_pairs_inside(small))
        large = members.where(F.col("size") > SMALL)
        if not large.limit(1).count():
            return found, None
        if level == LEVELS:
            return found, store(large.select("node", "rep", "t"), "dedup-dense")
        nodes = large.select("rep", "t", "path", F.xxhash64("node", F.get("path", level)).alias("node"))
    return found, None


def _consensus(members: DataFrame, reps: DataFrame) -> DataFrame:
    """(node, c): the most frequent token at each place, from about SAMPLE members of a node."""
    size = members.groupBy("node").agg(F.count(F.lit(1)).alias("n"))
    some = members.join(size, "node").where(F.pmod(F.xxhash64(F.lit(3), "rep"), F.col("n")) < SAMPLE)

    def mode(pdf: pd.DataFrame) -> pd.DataFrame:
        m = np.sort(np.array(pdf["tokens"].tolist(), np.int32), axis=0)
        best = []
        for col in m.T:
            value, count = np.unique(col, return_counts=True)
            best.append(int(value[count.argmax()]))
        return pd.DataFrame({"node": [pdf["node"].iloc[0]], "c": [best]})

    got = some.join(reps.select("rep", "tokens"), "rep").select("node", "tokens")
    return got.groupBy("node").applyInPandas(mode, "node long, c array<int>")


def _with_class(members: DataFrame, label: DataFrame) -> DataFrame:
    j = members.join(label.withColumnRenamed("v", "rep"), "rep", "left")
    return j.select("node", "rep", F.coalesce("root", "rep").alias("cls"))


def _open_nodes(members: DataFrame) -> DataFrame:
    """Members of the nodes that still hold more than one class."""
    many = members.groupBy("node", "cls").agg(F.lit(1).alias("one")).groupBy("node").agg(F.count("one").alias("k"))
    return members.join(many.where("k > 1").select("node"), "node", "left_semi")


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Intersection sizes of every left with every right set, as products of incidence matrices of COLUMNS shared shingles."""
    shared = np.intersect1d(np.concatenate(left), np.concatenate(right))
    places = []
    for sets in (left, right):
        rows, every = np.repeat(np.arange(len(sets)), [len(x) for x in sets]), np.concatenate(sets)
        found = np.isin(every, shared)
        places.append((rows[found], np.searchsorted(shared, every[found])))
    out = np.zeros((len(left), len(right)), np.int64)
    for first in range(0, len(shared), COLUMNS):
        some = []
        for sets, (rows, at) in zip((left, right), places):
            here = (at >= first) & (at < first + COLUMNS)
            some.append(np.zeros((len(sets), min(COLUMNS, len(shared) - first)), np.float32))
            some[-1][rows[here], at[here] - first] = 1
        out += np.rint(some[0] @ some[1].T).astype(np.int64)
    return out


def _block_links(members: DataFrame, dense: DataFrame, reps: DataFrame, sets: DataFrame) -> DataFrame:
    """Links that join classes inside nodes, from all pairs of blocks of about BLOCK members."""
    size = members.groupBy("node").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    where = dense.groupBy("rep").agg(F.collect_list(F.struct("t", "node")).alias("nodes"))  # one a tree
    m = members.join(dense.select("node", F.col("t")).distinct(), "node").join(size, "node")
    m = m.join(where, "rep").join(reps.select("rep", "n", "tokens"), "rep").join(sets, "rep")
    m = m.withColumn("block", F.pmod(F.xxhash64(F.lit(9), "rep"), F.col("blocks")).cast("int"))
    # A member goes to every pair of blocks that holds its own block.
    m = m.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    m = m.withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other"))

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        k = len(pdf)
        tok, n = np.array(pdf["tokens"].tolist(), np.int32), pdf["n"].to_numpy(np.int64)
        rep, cls, block = (pdf[c].to_numpy() for c in ("rep", "cls", "block"))
        tree, two = int(pdf["t"].iloc[0]), pdf["lo"].iloc[0] != pdf["hi"].iloc[0]
        path = np.repeat(-np.arange(1, k + 1, dtype=np.int64)[:, None], TREES, axis=1)
        for i, nodes in enumerate(pdf["nodes"]):
            for x in nodes:
                path[i, x["t"]] = x["node"]
        own = [np.asarray(x, np.int64) for x in pdf["set"]]
        root = {c: c for c in cls.tolist()}

        def find(c: int) -> int:
            while root[c] != c:
                root[c] = root[root[c]]
                c = root[c]
            return c

        out: list[tuple[int, int]] = []
        for x in range(0, k, TILE):
            for y in range(x, k, TILE):
                i, j = np.arange(x, min(k, x + TILE)), np.arange(y, min(k, y + TILE))
                ok = (cls[i][:, None] != cls[j]) & (i[:, None] < j)
                ok &= 100 * np.minimum(n[i][:, None], n[j]) >= PERCENT * np.maximum(n[i][:, None], n[j])
                if two:
                    ok &= block[i][:, None] != block[j]
                for c in range(tree):
                    ok &= path[i, c][:, None] != path[j, c]
                if not ok.any():
                    continue
                agree = np.zeros(ok.shape, np.int16)
                for c in range(TOKENS):
                    agree += tok[i, c][:, None] == tok[j, c]
                ok &= agree >= MIN_AGREE
                if not ok.any():
                    continue
                left, right = ok.any(axis=1), ok.any(axis=0)
                i, j, ok = i[left], j[right], ok[left][:, right]
                both = _overlaps([own[v] for v in i], [own[v] for v in j])
                ok &= 100 * both >= PERCENT * (n[i][:, None] + n[j] - both)
                for p, q in np.argwhere(ok).tolist():
                    a, b = find(int(cls[i[p]])), find(int(cls[j[q]]))
                    if a != b:
                        root[a] = b
                        out.append((int(min(rep[i[p]], rep[j[q]])), int(max(rep[i[p]], rep[j[q]]))))
        return pd.DataFrame(out, columns=["a", "b"], dtype=np.int64)

    return m.groupBy("node", "lo", "hi").applyInPandas(compare, "a long, b long")


def _star(dense: DataFrame, reps: DataFrame) -> DataFrame:
    """Pairs of every member of a dense node with the node's pivots: the member closest to the consensus, and others."""
    members = dense.select("node", "rep")
    close = members.join(_consensus(members, reps), "node").join(reps.select("rep", "tokens"), "rep")
    agree = F.aggregate(F.zip_with("tokens", "c", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    picks = [F.max_by("rep", F.struct("agree", "rep")).alias("p0")]
    picks += [F.min_by("rep", F.struct(F.xxhash64(F.lit(k), "rep"), F.col("rep"))).alias(f"p{k}") for k in range(1, PIVOTS + 1)]
    pivots = close.select("node", "rep", agree.alias("agree")).groupBy("node").agg(*picks)
    some = F.array_distinct(F.array(*[f"p{k}" for k in range(PIVOTS + 1)]))
    star = members.join(pivots.select("node", F.explode(some).alias("p")), "node").where("rep <> p")
    return star.select(F.least("rep", "p").alias("a"), F.greatest("rep", "p").alias("b"))


def merge(label: DataFrame, links: DataFrame) -> DataFrame:
    """``label`` after more links: the components of the graph of roots, which is much smaller."""
    root = lambda c: label.select(F.col("v").alias(c), F.col("root").alias(f"{c}r"))
    j = links.join(root("a"), "a", "left").join(root("b"), "b", "left")
    over = store(j.select(F.coalesce("ar", "a").alias("a"), F.coalesce("br", "b").alias("b")).where("a <> b"), "dedup-roots")
    if not over.limit(1).count():
        return label
    up = components(over)
    known = label.unionByName(up.select("v", F.col("v").alias("root")).join(label.select("v"), "v", "left_anti"))
    j = known.join(up.select(F.col("v").alias("root"), F.col("root").alias("r")), "root", "left")
    return store(j.select("v", F.coalesce("r", "root").alias("root")), "dedup-label")


def near_links(docs: DataFrame, reps: DataFrame, row: str | None = None) -> DataFrame:
    """(v, root) of the linked representatives; ``row`` as in ``near_dedup``."""
    found, dense = _branch(reps)
    if dense is not None:
        found.append(_star(dense, reps))
    pairs = found[0]
    for p in found[1:]:
        pairs = pairs.union(p)
    likely = store(_likely(pairs.distinct(), reps), "dedup-likely")
    wanted = likely.select(F.col("a").alias("rep")).union(likely.select("b"))
    if dense is not None:
        wanted = wanted.union(dense.select("rep"))
    sets = _numbered_sets(docs, wanted, row) if row else _sets(docs, reps.join(wanted.distinct(), "rep", "left_semi"))
    label = components(_confirm(likely, sets))
    if dense is None:
        return label
    left = store(_open_nodes(_with_class(dense.select("node", "rep"), label)), "dedup-open")
    if not left.limit(1).count():
        return label
    with small_batches(docs.sparkSession):
        links = store(_block_links(left, dense, reps, sets), "dedup-blocks")
    return merge(label, links)


def near_dedup(docs: DataFrame, row: str | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, row, first): see the module text.

    ``row`` numbers the input's rows, by the column of that name if one is given (stored with the rows: different, not
    null, the same in every scan); ``first`` is true for one row of each component.
    """
    spark = docs.sparkSession
    ship_package(spark)
    stage = _signatures(docs, row)
    reps = store(
        stage.where("n > 0 and doc_id is not null")
        .groupBy("n", "s1", "s2")
        .agg(F.min("row").alias("rep"), F.min("doc_id").alias("did"), F.first("tokens").alias("tokens"),
             F.min(F.struct("doc_id", "row")).alias("head")),
        "dedup-reps",
    )
    label = near_links(docs, reps, row)
    rooted = reps.select("n", "s1", "s2", "rep", "head").join(label.withColumnRenamed("v", "rep"), "rep", "left")
    rooted = store(rooted.withColumn("root", F.coalesce("root", "rep")), "dedup-rooted")
    heads = rooted.groupBy("root").agg(F.min("head").alias("h"))
    keyed = rooted.join(heads, "root").select("n", "s1", "s2", "h")
    out = stage.drop("tokens").join(
        keyed.withColumn("named", F.lit(True)), ["n", "s1", "s2"], "left"
    )
    named = F.col("named").isNotNull() & F.col("doc_id").isNotNull()
    comp = F.when(named, F.col("h.doc_id")).otherwise(F.col("doc_id"))
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"), comp.alias("component_id"),
        F.coalesce(F.col("doc_id") == comp, F.lit(True)).alias("kept"), "row",
        F.when(named, F.col("h.row") == F.col("row")).otherwise(F.lit(True)).alias("first"),
    )


def first_documents(docs: DataFrame) -> DataFrame:
    """The input's rows and columns with one row of each component.

    The rows' numbers are written with the rows: two scans of the same files need not number them alike.
    """
    (number,) = free_names(docs, "row")
    rows = store(docs.withColumn(number, F.monotonically_increasing_id()), "dedup-input")
    return _numbered(rows, number, near_dedup(rows, number).where("first").select("row")).select(*docs.columns)
