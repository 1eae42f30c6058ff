"""What the operators share: stage tables in the shared folder, code shipping, tables and label folds."""

from __future__ import annotations

import ctypes
import os
import uuid
from collections.abc import Iterable, Iterator
from contextlib import AbstractContextManager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trolley.session import ensure_checkpoint_dir, settings, ship_package  # noqa: F401 - the operators' way to it

#: A word: a run of characters other than space and the ASCII controls tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows of a batch that are Python objects at a time; a whole batch of texts takes several times its size as such.
SLICE_ROWS = 512

#: What a worker process keeps for the next tasks of a stage (``tokens.encoder``), until one of another stage begins.
KEPT: dict = {}

def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for one stage below the session's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/trolley-llm/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write a stage as Parquet in the shared folder and read it back: lineage ends at the files."""
    spark = df.sparkSession
    path = stage_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> AbstractContextManager:
    """While stages are stored whose tasks hand texts or sets to Python: batches have few rows, on both sides."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    return settings(spark, {key: str(min(now, 2 * SLICE_ROWS) if now > 0 else 2 * SLICE_ROWS)})


def slices(batches: Iterable[pa.RecordBatch], keep: bool = False) -> Iterator[pa.RecordBatch]:
    """All rows of a task's batches, ``SLICE_ROWS`` at a time.

    Workers are reused: what tasks of other stages left in ``KEPT`` goes first (unless ``keep``), and unused memory is
    given back at the end, so that a worker's size is that of its stage and not of all stages before.
    """
    if KEPT and not keep:
        KEPT.clear()
        give_back()
    for b in batches:
        for at in range(0, b.num_rows, SLICE_ROWS):
            yield b.slice(at, SLICE_ROWS)
    give_back()


def give_back() -> None:
    """Return the process's free memory to the system, where the allocators can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """True for the quarter of documents whose labels are never learnt: crc32(doc_id as text) mod 4 is 2.

    A NULL doc_id has no text to hash; it counts as not held out.
    """
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learnable(labels: DataFrame, label: str, docs: DataFrame | None = None) -> DataFrame:
    """(doc_id, y) of the labels outside the held-out fold; with ``docs``, of those whose document is there."""
    if docs is not None:
        labels = labels.join(docs.select("doc_id"), "doc_id", "left_semi")
    return (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .where(~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max((F.col(label) > 0).cast("int")).alias("y"))
    )


def label_counts(labels: DataFrame, label: str, docs: DataFrame | None = None) -> DataFrame:
    """(y, n): how many labels of each class may be learnt."""
    return learnable(labels, label, docs).groupBy("y").agg(F.count(F.lit(1)).alias("n"))


def labelled(docs: DataFrame, labels: DataFrame, label: str, per_class: int | None = None, seed: int = 7) -> DataFrame:
    """(doc_id, text, y) of the documents whose label may be learnt; y is 0 or 1.

    Rows with a NULL label or key are left out; a doc_id labelled twice takes its largest label, and a doc_id
    that occurs in several document rows gives one example per row. ``per_class`` bounds the sample: of each
    class the doc_ids with the smallest seeded hashes, the same ones on every run.
    """
    y = learnable(labels, label, docs)
    if per_class:
        order = [F.xxhash64(F.lit(seed), F.col("doc_id")), F.col("doc_id")]
        y = y.where("y = 0").orderBy(*order).limit(per_class).unionByName(
            y.where("y = 1").orderBy(*order).limit(per_class)
        )
        y = F.broadcast(y)  # at most 2 * per_class rows
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return d.join(y, "doc_id")


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 7) -> DataFrame:
    """At most ``n`` different rows, those with the smallest seeded hash of ``key`` (the same rows on every run).

    Hashes alone are ranked; then only the chosen rows are read with all their columns.
    """
    at, row = free_names(df, "at", "row")
    hashed = df.withColumns({at: F.xxhash64(F.lit(seed), F.col(key)), row: F.xxhash64(*df.columns)})
    few = store(hashed.select(at, row).distinct().orderBy(at, row).limit(n), "sample-keys")
    return hashed.join(F.broadcast(few), [at, row], "left_semi").dropDuplicates([at, row]).drop(at, row)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Column names like the given ones that ``df`` does not use (names differ by more than their case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n in taken:
            n += "_"
        taken.add(n)
        out.append(n)
    return out


def one_blas_thread() -> None:
    """Let numpy's OpenBLAS use one thread in this process.

    Its thread pool does not survive the fork that starts the JVM: a later threaded call on the driver waits
    for ever. The fits on the driver are small, one thread is enough. Other BLAS builds are left alone.
    """
    import glob

    import numpy as np

    folder = os.path.join(os.path.dirname(os.path.dirname(np.__file__)), "numpy.libs")
    for lib in glob.glob(os.path.join(folder, "*openblas*")):
        handle = ctypes.CDLL(lib)
        for name in ("scipy_openblas_set_num_threads64_", "openblas_set_num_threads64_", "openblas_set_num_threads"):
            if hasattr(handle, name):
                getattr(handle, name)(1)
                break
