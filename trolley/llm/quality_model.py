"""Quality classifier: supervised subword embeddings trained by numpy stochastic gradient descent.

Three groups of features are hashed into one table of vectors: character 3- and 4-grams (of the UTF-8 bytes), words,
and pairs of neighbouring words (a word beside itself falls into one bucket, whatever the word). A document's vector is
the mean of its groups' mean vectors; a softmax layer gives the classes' probabilities. Vectors and the layer are
learnt together, by gradient steps on one document at a time.

Since the output is linear in the vectors, a trained table is folded into one number per bucket for scoring: the
document's log-odds are the means of its buckets' numbers.

``PER_CLASS`` bounds the labelled sample; every document's whole text is read, in training and in scoring.

Defined cases: NULL and empty texts have no features and get the score of the bias; without usable labels every score
is 0.5; with labels of one class the scores approach that class; repeated rows get equal scores; labels, lang, source
and doc_id are never inputs of a score; labels without a document count nowhere; very long texts are hashed chunk by chunk, to
their end; an empty table gives no rows; other columns are ignored by ``quality`` and kept by ``good_documents``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import held_out, label_counts, labelled, one_blas_thread, ship_package, slices, small_batches, store

THRESHOLD = 0.7  # fixed by the contract
PER_CLASS = 2000  # labelled documents of each class that may be learnt from
BUCKETS = 1 << 16
DIM = 8
EPOCHS = 4
RATE = 0.5
CHUNK = 1 << 20  # bytes of a text hashed at a time; chunks overlap, so no gram is lost
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_M = np.uint64(0x9E3779B97F4A7C15)
_SAME = 0  # the bucket of a word beside itself


def _mix(h: np.ndarray, salt: int) -> np.ndarray:
    """Hashes → buckets 1 .. BUCKETS - 1."""
    h = (h + np.uint64(salt)) * _M
    h ^= h >> np.uint64(29)
    h *= _M
    return 1 + ((h >> np.uint64(32)) % np.uint64(BUCKETS - 1)).astype(np.int64)


def _chars(b: np.ndarray, at: int) -> list[np.ndarray]:
    """The 3- and 4-grams that begin in the chunk at ``at``."""
    w = b[at : at + CHUNK + 3].astype(np.uint64)
    out = []
    if len(w) >= 3:
        g = w[:-2] | w[1:-1] << np.uint64(8) | w[2:] << np.uint64(16)
        out.append(_mix(g[:CHUNK], 3))
        if len(w) >= 4:
            out.append(_mix((g[:-1] | w[3:] << np.uint64(24))[:CHUNK], 4))
    return out


def _words(b: np.ndarray) -> np.ndarray:
    """One 64-bit hash per word (run of bytes that are not white space)."""
    inside = ~_SPACE[b]
    if not inside.any():
        return np.zeros(0, np.uint64)
    edge = np.diff(np.concatenate([[0], inside.view(np.int8), [0]]))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    # Position-weighted sum of the bytes: the k-th byte of a word counts times the k-th power of an odd number.
    longest = int((end - start).max())
    power = np.cumprod(np.full(longest, _M, np.uint64))
    where = np.flatnonzero(inside)
    place = where - np.repeat(start, end - start)
    terms = (b[where].astype(np.uint64) + np.uint64(1)) * power[place]
    first = np.concatenate([[0], np.cumsum(end - start)[:-1]])
    return np.add.reduceat(terms, first)


def groups(text: str) -> list[np.ndarray]:
    """The buckets of a text's features by group (characters, words, pairs); groups without any are left out."""
    b = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    out = []
    chars = [g for at in range(0, max(1, len(b)), CHUNK) for g in _chars(b, at)]
    if chars:
        out.append(np.concatenate(chars))
    w = _words(b)
    if len(w):
        out.append(_mix(w, 11))
        if len(w) > 1:
            pair = _mix(w[:-1] * np.uint64(3) + w[1:], 12)
            pair[w[:-1] == w[1:]] = _SAME
            out.append(pair)
    return out


def sparse(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, weights): the document's vector is the weighted sum of the buckets' vectors."""
    gs = groups(text)
    if not gs:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    acc = np.zeros(BUCKETS)
    for g in gs:
        acc += np.bincount(g, minlength=BUCKETS) / (len(g) * len(gs))
    idx = np.flatnonzero(acc)
    return idx.astype(np.int32), acc[idx].astype(np.float32)


@dataclass
class Model:
    bucket: np.ndarray  # log-odds of class 1 that a bucket contributes
    bias: float

    def score(self, text: str) -> float:
        gs = groups(text)
        z = self.bias
        if gs:
            z += sum(float(self.bucket[g].mean()) for g in gs) / len(gs)
        return 1.0 / (1.0 + float(np.exp(-np.clip(z, -30, 30))))


def train(rows: list[tuple[np.ndarray, np.ndarray, int, float]], *, epochs: int = EPOCHS, rate: float = RATE, seed: int = 3) -> Model:
    """Gradient descent over (buckets, weights, class, importance) examples."""
    rng = np.random.default_rng(seed)
    E = (rng.random((BUCKETS, DIM)) - 0.5).astype(np.float64) / DIM
    W, bias = np.zeros((DIM, 2)), np.zeros(2)
    total = max(1, epochs * len(rows))
    step = 0
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            idx, wt, y, importance = rows[i]
            lr = rate * (1 - step / total)
            step += 1
            h = wt @ E[idx] if len(idx) else np.zeros(DIM)
            z = h @ W + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1.0
            p *= lr * importance
            if len(idx):
                # The step on the vectors is scaled by the weights' norm: each bucket sees a share of a document.
                E[idx] -= np.outer(wt / max(float(wt @ wt), 1e-3) * 0.5, W @ p)
                W -= np.outer(h, p)
            bias -= 0.1 * p
    return Model(E @ (W[:, 1] - W[:, 0]), float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, *, per_class: int = PER_CLASS, label: str = "quality") -> Model:
    """Learn from at most ``per_class`` labelled documents of each class; features are made in the tasks."""
    ship_package(docs.sparkSession)

    def features(batches):
        for b in slices(batches):
            made = [sparse(t) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([m[0].tobytes() for m in made], pa.binary()),
                 pa.array([m[1].tobytes() for m in made], pa.binary()), b.column(1), b.column(2)],
                names=["idx", "wt", "y", "doc_id"],
            )

    sample = labelled(docs, labels, label, per_class)
    made = sample.select("text", "y", "doc_id").mapInArrow(features, "idx binary, wt binary, y int, doc_id long")
    with small_batches(docs.sparkSession):
        got = store(made, "quality-train")
    rows = got.collect()  # at most 2 * per_class labelled documents
    rows.sort(key=lambda r: (r["doc_id"], r["y"], bytes(r["idx"])))
    one_blas_thread()
    if not rows:
        return Model(np.zeros(BUCKETS), 0.0)
    # The sample holds the classes in equal numbers at most; an example's importance restores their shares.
    share = {r["y"]: r["n"] for r in label_counts(labels, label, docs).collect()}
    n = [sum(r["y"] == c for r in rows) for c in (0, 1)]
    per = [share.get(c, 0) / max(1, k) for c, k in enumerate(n)]
    scale = len(rows) / max(1, sum(share.values()))
    examples = [
        (np.frombuffer(r["idx"], np.int32), np.frombuffer(r["wt"], np.float32), r["y"], per[r["y"]] * scale)
        for r in rows
    ]
    return train(examples)


def _scores(model: Model, texts: list) -> np.ndarray:
    return np.array([model.score(t or "") for t in texts], float)


def quality(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every whole text."""
    model = fit(docs, labels, **options)

    def run(batches):
        for b in slices(batches):
            s = _scores(model, b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s)], names=["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def good_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The input's rows and columns without those predicted to be of low quality."""
    model = fit(docs, labels, **options)

    def run(batches):
        for b in slices(batches):
            texts = b.column(b.schema.get_field_index("text")).to_pylist()
            yield b.filter(pa.array(_scores(model, texts) >= THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
