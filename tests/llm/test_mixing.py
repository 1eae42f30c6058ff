import re

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import awkward_docs, empty_docs
from trolley.llm.mixing import fill_targets, mix, mixed_documents, sainte_lague


def highest_quotients(votes, seats, most=None):
    got = [0] * len(votes)
    for _ in range(seats):
        free = [i for i, v in enumerate(votes) if v > 0 and (most is None or got[i] < most[i])]
        if not free:
            break
        i = max(free, key=lambda i: (votes[i] / (2 * got[i] + 1), -i))
        got[i] += 1
    return got


@pytest.mark.parametrize("votes,seats", [([5, 3, 1], 9), ([100, 1, 1, 0], 50), ([1, 1, 1], 4), ([7.5, 2.25, 9.0], 300), ([0, 0], 5), ([], 3)])
def test_sainte_lague_is_seat_by_seat(votes, seats):
    got = sainte_lague(votes, seats)
    assert got == highest_quotients(votes, seats)


def test_sainte_lague_with_bounds():
    assert sainte_lague([10, 10, 1], 12, [3, 20, 20]) == highest_quotients([10, 10, 1], 12, [3, 20, 20])
    assert sum(sainte_lague([1, 1], 10, [2, 2])) == 4


def test_fill_targets_reshares_the_excess():
    got = fill_targets([10, 100, 100], [3, 1, 2], 150, 2)
    assert got == pytest.approx([20, 130 / 3, 260 / 3])
    assert fill_targets([0, 10], [3, 1], 15, 2) == pytest.approx([0, 15])
    assert fill_targets([], [], 0, 2) == []


def test_mix_contract(spark):
    docs = awkward_docs(spark)
    rows = mix(docs).collect()
    text = sorted((r["doc_id"] is None, r["doc_id"] or 0, len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))) for r in docs.collect())
    assert text == sorted((r["doc_id"] is None, r["doc_id"] or 0, r["size"]) for r in rows)
    sizes = {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    target = dict(zip(order, fill_targets([sizes[s] for s in order], [(3, 1, 2)[i % 3] for i in range(len(order))], 1.5 * sum(sizes.values()), 2)))
    taken = dict.fromkeys(order, 0)
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"] and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]])
        taken[r["source"]] += r["taken"]
    for s in order:
        assert abs(taken[s] - target[s]) <= max(3, 0.03 * target[s])
    again = mix(docs.repartition(5)).collect()
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["size"], r["taken"])
    assert sorted(map(key, rows)) == sorted(map(key, again))


def test_mixed_documents_keep_columns(spark):
    docs = awkward_docs(spark)
    out = mixed_documents(docs)
    assert out.columns == docs.columns
    assert 0 < out.count() <= 2 * docs.count() and out.where(F.length("text") == 0).count() == 0


def test_empty(spark):
    assert mix(empty_docs(spark)).count() == 0
    assert mixed_documents(empty_docs(spark)).count() == 0
