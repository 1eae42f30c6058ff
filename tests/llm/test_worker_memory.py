"""What Python workers hold at a time is bounded by rows, not by a task's batches or by the stages before."""

import tracemalloc

import numpy as np
import pyarrow as pa

from trolley.llm import near_dedup
from trolley.llm.common import KEPT, SLICE_ROWS, slices, small_batches, store


def test_slices_hold_all_rows_few_at_a_time():
    sizes = (0, 1, SLICE_ROWS, 3 * SLICE_ROWS + 7)
    batches = [pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64())], names=["i"]) for n in sizes]
    got = list(slices(batches))
    assert max(b.num_rows for b in got) == SLICE_ROWS
    assert [i for b in got for i in b.column(0).to_pylist()] == [i for n in sizes for i in range(n)]


def test_a_stage_lets_go_what_another_kept():
    KEPT["vocabulary"] = object()
    list(slices([], keep=True))
    assert "vocabulary" in KEPT
    list(slices([]))
    assert not KEPT


def test_stored_text_stages_get_small_batches(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)

    def rows_of(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], names=["n"])

    with small_batches(spark):
        stored = store(spark.range(0, 5000, 1, 1).mapInArrow(rows_of, "n long"), "batch-rows")
    seen = stored.collect()
    assert sum(r["n"] for r in seen) == 5000 and max(r["n"] for r in seen) <= 2 * SLICE_ROWS
    assert spark.conf.get(key) == before


def test_overlaps_of_different_sets_are_counted_in_little_memory():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 1 << 62, 300)) for _ in range(2 * near_dedup.TILE)]
    left, right = sets[: near_dedup.TILE], [*sets[near_dedup.TILE : -1], np.sort(np.concatenate([s[:9] for s in sets[:20]]))]
    tracemalloc.start()
    try:
        got = near_dedup._overlaps(left, right)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert got.sum() == 180 and got[:20, -1].tolist() == [9] * 20
    assert peak < 60e6  # one incidence matrix of all shingles: over 300 MB
