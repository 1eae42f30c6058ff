"""Spelling variants: all word pairs one edit apart, by composing finite-state machines.

1. *Words.* A text's maximal letter runs (A-Z lower-cased) are counted. A run whose keyed checksum is a multiple of
   ``NOISE`` loses one letter in that document (a fixed rule of the task). Words are results of at least ``SHORTEST``
   code points and ``RARE`` occurrences.
2. *Partitions.* Two words one edit apart either share their first ``HEAD`` letters, or the edit lies among those and
   the letters behind it are equal. So every word goes to the partition of its head (with the rest of the word) and
   to the partitions of its tail (with the head): once for an edit that keeps the length and for the shorter word, once
   for the longer one. The head partitions are the states of the whole vocabulary's acceptor after ``HEAD`` letters. A
   partition of more than ``LARGEST`` words is parted again in the same way, by one letter, and so on; strings of
   at most two letters end this, as there are fewer than ``LARGEST`` of them. No partition is cut.
3. *Composition.* In a partition the strings make a minimal acyclic acceptor. It is composed with a transducer that
   copies letters and makes exactly one edit, and with the acceptor again. The composed machine's paths are the accepted
   pairs; product states without a common ending are found once and never entered again. An edit stands at the first
   letter where the two strings differ, so each pair has one path.
4. *Forms.* A word's form is its near word of largest n (ties: smallest in code-point order) if that n is at least
   ``FACTOR`` times its own. Along forms n grows by that factor, so pointer jumping ends after a few rounds.

Defined cases: NULL, empty and letter-free texts hold no words; a NULL doc_id counts as an empty key in the checksum;
repeated rows count again; very long runs are words like others; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import ship_package, store

SHORTEST = 7
RARE = 2
NOISE = 31
FACTOR = 10
HEAD = 3
LARGEST = 20_000  # strings in a partition; more than there are strings of up to two letters
FLUSH = 400_000  # words counted in a task before they are given on

_RUN = re.compile("[A-Za-zÀ-ÿ]{%d,}" % SHORTEST)  # shorter runs can't give a word


def document_words(key: str, text: str) -> Iterator[tuple[str, int]]:
    """(word, occurrences) of one document; a word may come several times."""
    for run, n in Counter(_RUN.findall(text)).items():
        w = run.encode().lower().decode()  # A-Z alone
        h = zlib.crc32(f"{key}:{w}".encode())
        if h % NOISE == 0:
            i = h % len(w)
            w = w[:i] + w[i + 1 :]
            if len(w) < SHORTEST:
                continue
        yield w, n


def words(docs: DataFrame, flush: int = FLUSH) -> DataFrame:
    """(word, n) of all words that occur often enough."""

    def run(batches):
        n: Counter = Counter()

        def give():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], names=["word", "n"]
            )

        for b in batches:
            for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for w, k in document_words(key or "", text or ""):
                    n[w] += k
                if len(n) >= flush:
                    yield give()
                    n.clear()
        yield give()

    rows = docs.select(F.col("doc_id").cast("string").alias("k"), F.col("text").cast("string").alias("text"))
    counted = rows.mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= RARE)


class Acceptor:
    """The minimal acyclic automaton of some strings: state 0 is the start; ``arcs[s]`` maps letters to states."""

    def __init__(self, strings: list[str]):
        self.arcs: list[dict[str, int]] = [{}]
        self.final: list[bool] = [False]
        known: dict[tuple, int] = {}
        path = [0]  # the states of the last string
        last = ""

        def settle(keep: int) -> None:
            # Merge the last string's states below depth ``keep`` with equal ones.
            for i in range(len(last), keep, -1):
                s = path.pop()
                form = (self.final[s], tuple(self.arcs[s].items()))
                self.arcs[path[-1]][last[i - 1]] = known.setdefault(form, s)

        for w in sorted(set(strings)):
            k = 0
            while k < min(len(w), len(last)) and w[k] == last[k]:
                k += 1
            settle(k)
            for c in w[k:]:
                self.arcs.append({})
                self.final.append(False)
                self.arcs[path[-1]][c] = len(self.arcs) - 1
                path.append(len(self.arcs) - 1)
            self.final[path[-1]] = True
            last = w
        settle(0)


def _spell(ending: tuple) -> str:
    out = []
    while ending:
        out.append(ending[0])
        ending = ending[1]
    return "".join(out)


def one_edit_pairs(strings: list[str]) -> list[tuple[str, str]]:
    """All unordered pairs of different strings that one edit turns into each other.

    Endings are linked letters, ``(letter, ending)`` or ``()``: strings share them.
    """
    m = Acceptor(strings)
    arcs, final = m.arcs, m.final
    common: dict[tuple[int, int], list[tuple]] = {}

    def shared(p: int, q: int) -> list[tuple]:
        """The endings that both states accept: the composed machine behind its edit."""
        stack = [(p, q) if p <= q else (q, p)]
        first = stack[0]
        while stack:
            at = stack[-1]
            if at in common:
                stack.pop()
                continue
            a, b = arcs[at[0]], arcs[at[1]]
            if len(b) < len(a):
                a, b = b, a
            steps = [(c, (s, b[c]) if s <= b[c] else (b[c], s)) for c, s in a.items() if c in b]
            todo = [k for _, k in steps if k not in common]
            if todo:
                stack.extend(todo)
                continue
            out: list[tuple] = [()] if final[at[0]] and final[at[1]] else []
            for c, k in steps:
                out += [(c, x) for x in common[k]]
            common[at] = out
            stack.pop()
        return common[first]

    edits: dict[int, list[tuple[tuple, tuple]]] = {}

    def edit(s: int) -> list[tuple[tuple, tuple]]:
        """The pairs of endings whose edit stands at this state."""
        if s in edits:
            return edits[s]
        out = []
        letters = list(arcs[s].items())
        for i, (x, p) in enumerate(letters):
            for y, q in letters[i + 1 :]:
                out += [((x, t), (y, t)) for t in shared(p, q)]
            # One string has x here and the other has not; what follows x begins with another letter.
            if final[p] and final[s]:
                out.append(((x, ()), ()))
            for c, q in letters:
                if c != x and c in arcs[p]:
                    out += [((x, (c, t)), (c, t)) for t in shared(arcs[p][c], q)]
        edits[s] = out
        return out

    found: list[tuple[str, str]] = []
    path: list[str] = []
    stack = [(0, 0, "")]
    while stack:
        s, depth, c = stack.pop()
        del path[max(0, depth - 1) :]
        if depth:
            path.append(c)
        here = edit(s)
        if here:
            head = "".join(path)
            found += [(head + _spell(a), head + _spell(b)) for a, b in here]
        stack += [(t, depth + 1, x) for x, t in arcs[s].items()]
    return found


def _parted(items: DataFrame, letters: int) -> DataFrame:
    """Items (part, s, word) dealt to smaller partitions by their first ``letters`` letters; see the module text."""
    s = F.col("s")
    rest = lambda k: F.substring(s, k + 1, 2_000_000_000)
    head = lambda k: F.substring(s, 1, k)
    to = F.array(
        F.struct(F.concat("part", F.lit("<"), head(letters)).alias("part"), rest(letters).alias("s")),
        F.struct(F.concat("part", F.lit(">"), rest(letters)).alias("part"), head(letters).alias("s")),
        F.struct(F.concat("part", F.lit(">"), rest(letters + 1)).alias("part"), head(letters + 1).alias("s")),
    )
    # A string without a letter behind its head has the same place for both lengths.
    return items.select(F.explode(F.array_distinct(to)).alias("x"), "word").select("x.part", "x.s", "word")


def near_pairs(vocabulary: DataFrame, largest: int = LARGEST) -> DataFrame:
    """(a, b), a < b: every pair of words one edit apart, once."""
    items = _parted(vocabulary.select(F.lit("").alias("part"), F.col("word").alias("s"), "word"), HEAD)
    done = None
    while True:
        items = store(items, "spelling-parts")
        large = store(
            items.groupBy("part").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > largest).select("part"),
            "spelling-large",
        )
        some = bool(large.limit(1).count())
        fit = items.join(large, "part", "left_anti") if some else items
        done = fit if done is None else done.unionByName(fit)
        if not some:
            break
        items = _parted(items.join(large, "part", "left_semi"), 1)

    def run(batches):
        def rows():
            for b in batches:
                yield from zip(*(b.column(i).to_pylist() for i in range(3)))

        out: list[tuple[str, str]] = []
        for _, group in groupby(rows(), key=lambda r: r[0]):
            word = {s: w for _, s, w in group}
            if len(word) > 1:
                pairs = ((word[x], word[y]) for x, y in one_edit_pairs(list(word)))
                out += [(a, b) if a < b else (b, a) for a, b in pairs]
            if len(out) >= 20_000:
                yield _pairs_batch(out)
                out = []
        yield _pairs_batch(out)

    parts = done.repartition("part").sortWithinPartitions("part")
    return parts.mapInArrow(run, "a string, b string").distinct()


def _pairs_batch(pairs: list[tuple[str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.string()) for i in (0, 1)], names=["a", "b"])


def forms(vocabulary: DataFrame, pairs: DataFrame) -> DataFrame:
    """(word, n, n_near, form, form_n) of all words."""
    near = pairs.union(pairs.select("b", "a")).toDF("word", "near")
    near = near.join(vocabulary.select(F.col("word").alias("near"), F.col("n").alias("m")), "near")
    best = near.groupBy("word").agg(
        F.count(F.lit(1)).alias("k"), F.min(F.struct((-F.col("m")).alias("m"), F.col("near").alias("near"))).alias("b")
    )
    j = vocabulary.join(best, "word", "left")
    has = -F.col("b.m") >= FACTOR * F.col("n")
    return j.select(
        "word", "n", F.coalesce("k", F.lit(0).cast("long")).alias("n_near"),
        F.when(has, F.col("b.near")).alias("form"), F.when(has, -F.col("b.m")).alias("form_n"),
    )


def roots(formed: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form, by pointer jumping."""
    at = store(formed.where("form is not null").select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = store(at.join(on, "root", "left").select("word", "root", "further"), "spelling-roots")
        at = step.select("word", F.coalesce("further", "root").alias("root"))
        if not step.where("further is not null").limit(1).count():
            return at


def spelling_variants(docs: DataFrame, largest: int = LARGEST) -> DataFrame:
    """(word, form, root, n, n_near, form_n): see the module text."""
    ship_package(docs.sparkSession)
    vocabulary = store(words(docs), "spelling-words")
    pairs = near_pairs(vocabulary, largest)
    formed = store(forms(vocabulary, pairs), "spelling-forms")
    j = formed.join(roots(formed), "word", "left")
    return j.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
