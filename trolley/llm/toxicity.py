"""Toxicity by a weighted finite-state pattern grammar over clauses.

Words become classes: *attack* (an insult or a threat), *target* (someone addressed or spoken of), *negation* and
*report* (a verb or mark of reported speech). Four small transducers read a clause's classes: one finds attacks, one
remembers whether a target was named, one whether a negation stands close before, one whether the clause reports
speech. They are composed (a product construction over the classes), and the composed machine writes for each
attack which pattern it matched: plain, aimed, negated or reported. A document's score is a logistic function of
how often each pattern matched, so it is the clause that counts: the same word weighs less where it is denied or
quoted, if the labels say so.

The attack lexicon and the patterns' weights are learnt from labelled documents outside the held-out fold:

* a *unit* (a word, or a word's first 4 to 9 letters) is a candidate if it occurs in toxic documents of the sample behind
  at least ``MIN_CONTEXTS`` different words, its first occurrence in a document counting. Copies of one text share their
  contexts, so a group of copies counts once;
* the candidates' documents are counted over all learnable documents, toxic and clean, in one pass. A candidate
  is kept if the share of toxic documents among its documents, and its lower bound, are high enough, and if so many contexts
  would rarely be toxic by chance: of all candidates together fewer than ``FALSE_UNITS`` are expected to pass by chance. So
  the lexicon of a table does not widen with its size. The shortest unit wins: a kept prefix covers the words that
  begin with it;
* seed words of common languages (fixed values below) are used unless labelled documents speak against them.

``PER_CLASS`` bounds the labelled documents of each class that candidates and weights come from. A sampled document
counts in the weights' fit as often as its class was thinned, so that the classes keep their shares at every size. Every
document's whole text is scored: a word is looked up in the lexicon, whatever its size, and clauses that hold an attack
are read by the grammar.

Defined cases: NULL and empty texts match nothing and get the base score; very long texts are read whole; without usable
labels the seed lexicon and the prior weights are used; labels without a document count nowhere; repeated rows get equal
scores; labels, lang, source and doc_id are never inputs of a score; an empty table gives no rows; other columns are
ignored by ``toxicity`` and kept by ``clean_documents``.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import held_out, labelled, learnable, one_blas_thread, ship_package, slices, store
from trolley.llm.tokens import Memo

THRESHOLD = 0.3  # fixed by the contract
PER_CLASS = 8000  # labelled documents of each class that may be learnt from
MIN_CONTEXTS = 4
MIN_PRECISION = 0.9  # a unit's share of toxic documents among the documents that hold it ...
MIN_BOUND = 0.5  # ... and the lower bound of that share (Wilson, 95 %)
MEMO_WORDS = 60_000  # words remembered per generation (``tokens.Memo``)
FALSE_UNITS = 0.5  # units that may be expected to pass by chance, of all candidates together
SEED_WEIGHT = 0.5  # of a seed word that the labelled documents neither hold nor contradict
PREFIXES = (4, 5, 6, 7, 8, 9)
NEGATION_REACH = 3  # words

# Seed words of the classes (English, German, French, Spanish). A copula is no target.
SEED_ATTACKS = (
    "idiot idiots moron morons imbecile scum trash loser losers pathetic worthless stupid disgusting clown "
    "dumm dummkopf idioten abschaum versager trottel widerlich imbécile imbéciles stupide crétin ordure "
    "estúpido estúpida imbécil basura escoria kill murder hang töten umbringen tuer crever matar"
).split()
TARGETS = set(
    "you your yours he she they them him her his their we us du dich dir ihr euch er sie sein vous tu te toi il elle "
    "ils elles lui leur usted ustedes tú ti él ella ellos ellas su".split()
)
NEGATIONS = set("not no never neither nor cannot nicht kein keine nie niemals pas jamais aucun ne nunca jamás ni".split())
REPORTS = set(
    "said says say told claimed called quoted wrote sagte sagt behauptete nannte schrieb dit disait appelé écrit "
    "dijo dice llamó escribió quote".split()
)
_WORD = re.compile(r"[^\W\d_]+")
_CLAUSE_END = re.compile(r"[.!?;:\n]")
KINDS = ("plain", "aimed", "negated", "reported")
PRIOR = np.array([-3.0, 4.0, 4.0, 2.0, 2.0])  # bias, then a weight per kind


class Transducer:
    """A deterministic machine over word classes: step(state, class) → (state, output or None)."""

    def __init__(self, states: int, arcs: dict[tuple[int, str], tuple[int, str | None]]):
        self.states, self.arcs = states, arcs

    def step(self, state: int, cls: str) -> tuple[int, str | None]:
        return self.arcs.get((state, cls), (state, None))


CLASSES = ("attack", "target", "negation", "report", "other")


def attacks() -> Transducer:
    return Transducer(1, {(0, "attack"): (0, "attack")})


def targets() -> Transducer:
    """State 1 once a target was named in the clause."""
    return Transducer(2, {(0, "target"): (1, None), (1, "attack"): (1, "aimed")})


def negations(reach: int = NEGATION_REACH) -> Transducer:
    """State k > 0: a negation stands fewer than k words back."""
    arcs: dict = {}
    for s in range(reach + 1):
        for c in CLASSES:
            arcs[s, c] = (max(0, s - 1), "negated" if c == "attack" and s else None)
        arcs[s, "negation"] = (reach, None)
    return Transducer(reach + 1, arcs)


def reports() -> Transducer:
    return Transducer(2, {(0, "report"): (1, None), (1, "attack"): (1, "reported")})


def compose(machines: Iterable[Transducer]) -> dict[tuple[tuple[int, ...], str], tuple[tuple[int, ...], str | None]]:
    """The reachable product of the machines; its output is the last machine's that says anything of an attack."""
    ms = list(machines)
    start = (0,) * len(ms)
    table, todo = {}, [start]
    while todo:
        state = todo.pop()
        for c in CLASSES:
            moves = [m.step(s, c) for m, s in zip(ms, state)]
            said = [o for _, o in moves if o]
            out = None
            if "attack" in said:
                out = said[-1] if said[-1] != "attack" else "plain"
            nxt = tuple(s for s, _ in moves)
            table[state, c] = (nxt, out)
            if (nxt, CLASSES[0]) not in table and nxt not in todo:
                todo.append(nxt)
    return table


GRAMMAR = compose([attacks(), targets(), negations(), reports()])
_START = (0, 0, 0, 0)


@dataclass
class Lexicon:
    """Attack words and prefixes with their weights (0 to 1): the weights of the grammar's attack arcs."""

    words: dict[str, float]
    prefixes: dict[str, float]

    def weight(self, word: str) -> float:
        """0 for a word that is no attack."""
        found = self.words.get(word, 0.0)
        return found or next((self.prefixes[word[:k]] for k in PREFIXES if word[:k] in self.prefixes), 0.0)


def clause_kinds(clause: str, lexicon: Lexicon) -> list[tuple[str, float]]:
    """The patterns that a lower-case clause matches, one for each attack in it, with the attack's weight."""
    state, out = _START, []
    for w in _WORD.findall(clause):
        weight = lexicon.weight(w)
        if weight:
            c = "attack"
        elif w in NEGATIONS:
            c = "negation"
        elif w in REPORTS:
            c = "report"
        elif w in TARGETS:
            c = "target"
        else:
            c = "other"
        state, said = GRAMMAR[state, c]
        if said:
            out.append((said, weight))
    return out


def document_kinds(text: str, lexicon: Lexicon, weight_of: dict[str, float]) -> list[float]:
    """The weight of the matches of each of KINDS; ``weight_of`` keeps the lexicon's answers (``known_weights``)."""
    counts = [0.0] * len(KINDS)
    low = text.lower()
    found = [w for w in set(_WORD.findall(low)) if weight_of[w]]
    if not found:
        return counts
    for clause in _CLAUSE_END.split(low):
        if any(w in clause for w in found):  # maybe inside another word; the grammar reads words
            for kind, weight in clause_kinds(clause, lexicon):
                counts[KINDS.index(kind)] += weight
    return counts


def known_weights(lexicon: Lexicon) -> Memo:
    """word → weight, asked of the lexicon once while it is remembered."""
    return Memo(lexicon.weight, MEMO_WORDS)


def score_of(counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    z = weights[0] + np.log1p(counts) @ weights[1:]
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def wilson_low(k: float, n: float, z: float = 1.96) -> float:
    if n <= 0:
        return 0.0
    p = k / n
    return (p + z * z / (2 * n) - z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def contexts_needed(base: float, candidates: int) -> int:
    """So many contexts, all toxic, that fewer than FALSE_UNITS of the candidates would have them by chance."""
    n = 1
    while n < 64 and candidates * base**n >= FALSE_UNITS:
        n += 1
    return n


def chance(toxic: int, n: float, base: float) -> float:
    """The probability of at least ``toxic`` toxic ones among ``n`` documents if the share is ``base``."""
    m = max(toxic, math.ceil(n))
    logs = [
        math.lgamma(m + 1) - math.lgamma(i + 1) - math.lgamma(m - i + 1) + i * math.log(base) + (m - i) * math.log1p(-base)
        for i in range(toxic, m + 1)
    ]
    return min(1.0, sum(math.exp(x) for x in logs))


def first_units(text: str) -> dict[str, str]:
    """unit → the word before its first occurrence; prefixes are marked with a trailing ``*``."""
    out: dict[str, str] = {}
    before = ""
    for w in _WORD.findall(text.lower()):
        if w not in out:
            out[w] = before
            for k in PREFIXES:
                if len(w) > k:
                    out.setdefault(w[:k] + "*", before)
        before = w
    return out


def toxic_contexts(texts: DataFrame) -> DataFrame:
    """(unit, c, c_in, k): different words before a unit in the toxic texts (text, apart), and in those not apart; texts."""

    def run(batches):
        for b in batches:
            met: dict[tuple[str, int], list[int]] = {}
            for part in slices([b]):
                for t, apart in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    for u, c in first_units(t).items():
                        n = met.setdefault((u, zlib.crc32(c.encode("utf-8", "replace"))), [0, 0])
                        n[0] += 1
                        n[1] = n[1] or int(not apart)
            yield pa.RecordBatch.from_arrays(
                [pa.array([u for u, _ in met], pa.string()), pa.array([c for _, c in met], pa.int64()),
                 *(pa.array([n[i] for n in met.values()], pa.int64()) for i in (0, 1))],
                names=["unit", "context", "k", "inside"],
            )

    met = texts.select("text", "apart").mapInArrow(run, "unit string, context long, k long, inside long")
    seen = met.groupBy("unit", "context").agg(F.sum("k").alias("k"), F.max("inside").alias("inside"))
    per = seen.groupBy("unit").agg(F.count(F.lit(1)).alias("c"), F.sum("inside").alias("c_in"), F.sum("k").alias("k"))
    return store(per.where(F.col("c") >= MIN_CONTEXTS), "toxic-units")


def units_of(known: frozenset[str] | None = None) -> Memo:
    """word → its units: the word and its beginnings, all or the known ones."""

    def made(word: str) -> tuple[str, ...]:
        every = (word, *(word[:k] + "*" for k in PREFIXES if len(word) > k))
        return every if known is None else tuple(u for u in every if u in known)

    return Memo(made, MEMO_WORDS if known is not None else MEMO_WORDS // 8)  # all units of a word take more room


def clean_texts(texts: DataFrame) -> DataFrame:
    """(unit, n): how many of the texts hold a unit."""

    def run(batches):
        memo, n = units_of(), Counter()
        for b in batches:
            for part in slices([b]):
                for t in part.column(0).to_pylist():
                    n.update({u for w in set(_WORD.findall(t.lower())) for u in memo[w]})
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], names=["unit", "n"]
            )
            n.clear()

    return texts.select("text").mapInArrow(run, "unit string, n long").groupBy("unit").agg(F.sum("n").alias("n"))


def unit_counts(docs: DataFrame, labels: DataFrame, known: frozenset[str]) -> tuple[dict[str, list[int]], dict[str, list[int]]]:
    """unit → [clean, toxic] documents that hold it, of the known units: of all labels (doc_id, y, apart), and not apart.

    The texts stay where they are: what is joined with the labels are the known units that a document holds.
    """

    def run(batches):
        memo = units_of(known)
        for b in slices(batches):
            ids, units = [], []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                held = {u for w in set(_WORD.findall((t or "").lower())) for u in memo[w]}
                ids += [i] * len(held)
                units += held
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(units, pa.string())], names=["doc_id", "unit"])

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    held = texts.mapInArrow(run, "doc_id long, unit string").join(labels, "doc_id")
    every: dict[str, list[int]] = {}
    inside: dict[str, list[int]] = {}
    for r in held.groupBy("unit", "y", "apart").agg(F.count(F.lit(1)).alias("n")).collect():  # known units alone
        every.setdefault(r["unit"], [0, 0])[r["y"]] += r["n"]
        if not r["apart"]:
            inside.setdefault(r["unit"], [0, 0])[r["y"]] += r["n"]
    return every, inside


def choose_units(contexts: dict[str, int], counts: dict[str, list[int]], base: float, candidates: int) -> Lexicon:
    """The lexicon of the candidates that the documents' counts bear out."""

    def low(u: str, z: float) -> float:
        clean, toxic = counts.get(u, (0, 0))
        return wilson_low(contexts[u], contexts[u] * (clean + toxic) / max(1, toxic), z)

    def kept(u: str) -> bool:
        clean, toxic = counts.get(u, (0, 0))
        if toxic < MIN_PRECISION * (clean + toxic) or low(u, 1.96) < MIN_BOUND:
            return False
        return candidates * chance(contexts[u], contexts[u] * (clean + toxic) / max(1, toxic), base) < FALSE_UNITS

    good = [u for u in contexts if kept(u)]
    prefixes: dict[str, float] = {}
    for u in sorted((u for u in good if u.endswith("*")), key=lambda u: (len(u), u)):
        if not any(u.startswith(p) for p in prefixes):
            prefixes[u[:-1]] = low(u, 1.0)
    words = {}
    for w in SEED_ATTACKS:
        clean, toxic = counts.get(w, (0, 0))
        if toxic >= MIN_PRECISION * (clean + toxic):
            words[w] = SEED_WEIGHT
    words |= {u: low(u, 1.0) for u in good if not u.endswith("*")}
    words = {w: x for w, x in words.items() if not any(w[:k] in prefixes for k in PREFIXES)}
    return Lexicon(words, prefixes)


def learn_lexicons(
    docs: DataFrame, labels: DataFrame, sample: DataFrame, classes: dict[int, int], thinned: float = 1.0
) -> tuple[Lexicon, Lexicon]:
    """The lexicon of all labelled documents, and that of those not apart.

    Candidates come from the ``sample`` (text, y, apart), in which a toxic document stands for ``thinned`` ones; those that
    the sample's clean documents alone speak against go at once. The documents of the others are counted over all
    ``labels`` (doc_id, y, apart); ``classes`` are the numbers of labels of each class.
    """
    if not classes.get(1):
        both = unit_counts(docs, labels, frozenset(SEED_ATTACKS))
        return tuple(choose_units({}, n, 0.0, 0) for n in both)
    base = min(0.5, classes[1] / sum(classes.values()))
    found = toxic_contexts(sample.where("y = 1"))
    need, candidates = [], []
    for c in ("c", "c_in"):
        need.append(max(MIN_CONTEXTS, contexts_needed(base, found.where(F.col(c) >= MIN_CONTEXTS).count())))
        candidates.append(found.where(F.col(c) >= need[-1]).count())
    # The fold inside holds two thirds of both classes; a unit that is good there may be contradicted outside.
    toxic, fold = F.col("k") * thinned, clean_texts(sample.where("y = 0 and not apart"))
    units = found.where((F.col("c") >= need[0]) | (F.col("c_in") >= need[1])).join(fold, "unit", "left")
    units = units.where(toxic >= MIN_PRECISION * (toxic + F.coalesce("n", F.lit(0)))).collect()
    contexts = [{r["unit"]: r[c] for r in units if r[c] >= k} for c, k in zip(("c", "c_in"), need)]
    counts = unit_counts(docs, labels, frozenset(r["unit"] for r in units) | frozenset(SEED_ATTACKS))
    return tuple(choose_units(x, n, base, m) for x, n, m in zip(contexts, counts, candidates))


def fit_weights(
    counts: np.ndarray, y: np.ndarray, importance: np.ndarray | None = None, ridge: float = 1.0, steps: int = 30
) -> np.ndarray:
    """Logistic weights by Newton's method, pulled towards PRIOR; a row counts ``importance`` times (mean 1)."""
    X = np.column_stack([np.ones(len(y)), np.log1p(counts)])
    m = np.ones(len(y)) if importance is None else importance / importance.mean()
    w = PRIOR.copy()
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(X @ w, -30, 30)))
        grad = X.T @ (m * (p - y)) + ridge * (w - PRIOR)
        hess = (X * (m * p * (1 - p))[:, None]).T @ X + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray


def _kinds(df: DataFrame, lexicon: Lexicon, keep: str, schema: str, weights: np.ndarray | None = None) -> DataFrame:
    """``keep`` (a long column) and each text's counts, and a score if there are weights."""

    def run(batches):
        memo = known_weights(lexicon)
        for b in slices(batches):
            rows = [document_kinds(t or "", lexicon, memo) for t in b.column(1).to_pylist()]
            counts = np.array(rows, float).reshape(-1, len(KINDS))
            cols = [b.column(0), *(pa.array(counts[:, i].copy()) for i in range(len(KINDS)))]
            if weights is not None:
                cols.append(pa.array(score_of(counts, weights)))
            yield pa.RecordBatch.from_arrays(cols, names=[c.split()[0] for c in schema.split(", ")])

    return df.select(F.col(keep).cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


_COUNTS = ", ".join(f"m_{k} double" for k in KINDS)


def fit(docs: DataFrame, labels: DataFrame, *, per_class: int = PER_CLASS) -> Model:
    """Learn the lexicon and the weights; at most ``per_class`` documents of each class make candidates and weights."""
    ship_package(docs.sparkSession)
    known = store(learnable(labels, "toxic", docs), "toxic-labels")
    classes = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    each = {y: max(1.0, classes.get(y, 0) / (per_class or math.inf)) for y in (0, 1)}
    sample = store(labelled(docs, labels, "toxic", per_class), "toxic-train")
    apart = (F.pmod(F.xxhash64(F.lit(13), "doc_id"), F.lit(3)) == 0).alias("apart")
    split = sample.select("text", "y", apart)
    lexicon, inside = learn_lexicons(docs, known.select("*", apart), split, classes, each[1])
    # The weights come from labelled documents that their lexicon has not seen; then the lexicon of all takes its place.
    rows = _kinds(split.where("apart"), inside, "y", f"y long, {_COUNTS}").collect()
    one_blas_thread()
    if not rows:
        return Model(lexicon, PRIOR.copy())
    a = np.array([tuple(r) for r in rows], float)
    return Model(lexicon, fit_weights(a[:, 1:], a[:, 0], np.where(a[:, 0] == 1, each[1], each[0])))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, m_plain, m_aimed, m_negated, m_reported, score) of every whole text."""
    ship_package(docs.sparkSession)
    return _kinds(docs, model.lexicon, "doc_id", f"doc_id long, {_COUNTS}, score double", model.weights)


def toxicity(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    s = score(docs, fit(docs, labels, **options))
    return s.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), *[f"m_{k}" for k in KINDS],
    )


def clean_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The input's rows and columns without those that are predicted toxic."""
    ship_package(docs.sparkSession)
    model = fit(docs, labels, **options)
    lexicon, weights = model.lexicon, model.weights

    def run(batches):
        memo = known_weights(lexicon)
        for b in slices(batches):
            texts = b.column(b.schema.get_field_index("text")).to_pylist()
            counts = np.array([document_kinds(t or "", lexicon, memo) for t in texts], float)
            yield b.filter(pa.array(score_of(counts.reshape(-1, len(KINDS)), weights) < THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
