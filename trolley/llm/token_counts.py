"""Token counts per section by offset-mapped attribution.

A document is encoded once, as a whole. Its tokens' character spans are then joined to the spans of its sections
(an interval join of two sorted lists inside the document), and a token that crosses a section's border is
allocated by an explicit rule:

* ``start``: to the section that holds its first character;
* ``majority``: to the section that holds most of its characters (the earlier one on a tie);
* ``split``: to each section by its share of the characters (the counts are then fractions).

Sections partition the text, so under every rule the sections' counts add up to the document's.

Defined cases: a NULL or empty text has one empty section without tokens; a token without characters of its own
(a later byte of a character) has the span of that character; repeated rows give repeated results; very long
texts are encoded whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import ship_package
from trolley.llm.tokens import encoder

SCHEMA = (
    "doc_id long, section int, char_start long, char_end long, n_tokens long, n_crossing long, n_tokens_split double"
)
RULES = ("start", "majority")


def line_sections(text: str) -> list[int]:
    """Section starts: one section per line, its line break included."""
    starts, at = [0], text.find("\n")
    while at >= 0:
        if at + 1 < len(text):
            starts.append(at + 1)
        at = text.find("\n", at + 1)
    return starts


def attribute(spans: np.ndarray, starts: np.ndarray, n_chars: int, rule: str) -> tuple[np.ndarray, ...]:
    """(tokens by ``rule``, tokens that cross the section's end, tokens by characters' shares) per section."""
    k = len(starts)
    if not len(spans):
        return np.zeros(k, np.int64), np.zeros(k, np.int64), np.zeros(k)
    lo, hi = spans[:, 0].astype(np.int64), spans[:, 1].astype(np.int64)
    hi = np.maximum(hi, lo + 1)
    a = np.searchsorted(starts, lo, side="right") - 1
    z = np.searchsorted(starts, hi - 1, side="right") - 1
    ends = np.append(starts[1:], n_chars)
    owner, crosses = a.copy(), np.flatnonzero(z > a)
    split = np.bincount(a[z == a], minlength=k).astype(float)
    crossing = np.bincount(a[crosses], minlength=k)
    for t in crosses:  # few: most tokens lie inside one section
        best, own = 0, a[t]
        for s in range(a[t], z[t] + 1):
            part = min(ends[s], hi[t]) - max(starts[s], lo[t])
            split[s] += part / (hi[t] - lo[t])
            if part > best:
                best, own = part, s
        if rule == "majority":
            owner[t] = own
    return np.bincount(owner, minlength=k), crossing, split


def token_counts(
    docs: DataFrame, tokenizer: str, *, rule: str = "start", sections: Callable[[str], list[int]] = line_sections
) -> DataFrame:
    """A row per document and section (SCHEMA). ``sections`` maps a text to the ascending starts, first 0."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}; n_tokens_split always follows the shares")
    ship_package(docs.sparkSession)

    def run(batches):
        for b in batches:
            out = [[] for _ in range(7)]
            enc = encoder(tokenizer)
            for key, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                t = t or ""
                starts = np.asarray(sections(t), np.int64)
                n, cross, split = attribute(enc.spans(t), starts, len(t), rule)
                k = len(starts)
                for c, v in zip(
                    out,
                    ([key] * k, range(k), starts.tolist(), [*starts[1:].tolist(), len(t)], n.tolist(),
                     cross.tolist(), split.tolist()),
                ):
                    c.extend(v)
            kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 4, pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, kinds)], names=[c.split()[0] for c in SCHEMA.split(", ")]
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, SCHEMA)
