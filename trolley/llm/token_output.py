"""Token-ID output as Arrow IPC files of fixed-size lists, and reading them back.

Every range partition of the documents (ascending doc_id) becomes one *shard*: an Arrow IPC file whose record
batches hold two fixed-size-list columns of ``seq_len`` items, ``ids`` (uint16 where the vocabulary fits into it, else
uint32) and ``mask`` (boolean, one bit each: true for an id, false for padding at the shard's end). All batches but the last have ``batch_rows`` sequences, so sequence ``i`` is row
``i % batch_rows`` of batch ``i // batch_rows`` and id ``j`` of the shard is item ``j % seq_len`` of sequence
``j // seq_len``: random access is arithmetic, and on a memory map no byte is copied.

Beside the shards an index (Parquet) says for each document its shard and its place there. The token stream of
the corpus is the shards in order; a shard's start is the sum of the ids before it.

File names hold the task attempt and the index names the file of the attempt that succeeded, so a retried or
speculative task never mixes with another one's output.

Defined cases: a NULL text is empty (the document is its end id alone); NULL doc_ids come first, repeated
doc_ids stand in the order of their texts; an empty table gives no files and no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trolley.llm.common import ship_package, stage_path
from trolley.llm.tokens import encoder

SEQ_LEN = 1024
BATCH_ROWS = 64
END_ID = 1
INDEX_SCHEMA = "doc_id long, shard int, path string, local_start long, n_tokens long"


def filesystem(uri: str):
    """(pyarrow file system, path) of a folder in the shared store."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


class ShardWriter:
    """Appends ids to one Arrow IPC file; holds at most one batch of sequences."""

    def __init__(self, folder: str, name: str, seq_len: int, batch_rows: int, dtype: str = "<u4"):
        self.fs, base = filesystem(folder)
        self.fs.create_dir(base, recursive=True)
        self.path = f"{folder.rstrip('/')}/{name}"
        self.seq_len, self.batch_rows = seq_len, batch_rows
        self.dtype = np.dtype(dtype)
        self.item = self.dtype.itemsize
        self.kind = pa.from_numpy_dtype(self.dtype)
        self.schema = pa.schema([("ids", pa.list_(self.kind, seq_len)), ("mask", pa.list_(pa.bool_(), seq_len))])
        self.out = self.fs.open_output_stream(f"{base.rstrip('/')}/{name}")
        self.writer = pa.ipc.new_file(self.out, self.schema)
        self.parts: list[bytes] = []
        self.held = 0  # bytes not written yet
        self.n = 0  # ids so far

    def append(self, ids: bytes) -> int:
        """Add ids given in the file's type; returns the place of the first one."""
        start, unit = self.n, self.item * self.seq_len * self.batch_rows
        self.n += len(ids) // self.item
        self.parts.append(ids)
        self.held += len(ids)
        if self.held >= unit:
            self._flush(unit)
        return start

    def _flush(self, unit: int) -> None:
        data = b"".join(self.parts)
        whole = len(data) // unit * unit
        for at in range(0, whole, unit):
            n = unit // self.item
            self._write(np.frombuffer(data, self.dtype, n, at), n)
        self.parts, self.held = [data[whole:]], len(data) - whole

    def _write(self, ids: np.ndarray, real: int) -> None:
        mask = pa.array(np.arange(len(ids)) < real)
        cols = [
            pa.FixedSizeListArray.from_arrays(pa.array(ids, self.kind), self.seq_len),
            pa.FixedSizeListArray.from_arrays(mask, self.seq_len),
        ]
        self.writer.write_batch(pa.record_batch(cols, schema=self.schema))

    def close(self) -> None:
        if self.held:
            self._flush(self.item * self.seq_len * self.batch_rows)
            rest = np.frombuffer(b"".join(self.parts), self.dtype)
            if len(rest):
                padded = np.zeros(-(-len(rest) // self.seq_len) * self.seq_len, self.dtype)
                padded[: len(rest)] = rest
                self._write(padded, len(rest))
        self.writer.close()
        self.out.close()


class ShardReader:
    """Random access to one shard: memory-mapped where the file is local, ranged reads elsewhere."""

    def __init__(self, path: str, seq_len: int = SEQ_LEN):
        fs, p = filesystem(path)
        self.source = pa.memory_map(p) if fs.type_name == "local" else fs.open_input_file(p)
        self.file = pa.ipc.open_file(self.source)
        self.seq_len = self.file.schema.field("ids").type.list_size
        self.batch_rows = self.file.get_batch(0).num_rows if self.file.num_record_batches else 0
        self._at, self._batch = -1, None

    def batch_ids(self, k: int) -> np.ndarray:
        if k != self._at:
            self._at, self._batch = k, self.file.get_batch(k)
        col = self._batch.column(0)
        return col.flatten().to_numpy(zero_copy_only=True)

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, mask) of sequence ``i``: a view into the file where it is mapped, and an Arrow boolean array."""
        b = self.file.get_batch(i // self.batch_rows)
        r, n = i % self.batch_rows, self.seq_len
        ids = b.column(0).flatten().to_numpy(zero_copy_only=True)
        return ids[r * n : (r + 1) * n], b.column(1).flatten().slice(r * n, n)

    def slice(self, start: int, n: int) -> Iterator[np.ndarray]:
        """Ids [start, start + n) of the shard, as views, batch by batch."""
        per = self.batch_rows * self.seq_len
        while n > 0:
            k, at = divmod(start, per)
            part = self.batch_ids(k)[at : at + n]
            yield part
            start, n = start + len(part), n - len(part)

    def close(self) -> None:
        self._batch = None
        self.source.close()


def write_tokens(
    docs: DataFrame, tokenizer: str, folder: str, *, end_id: int = END_ID, seq_len: int = SEQ_LEN,
    batch_rows: int = BATCH_ROWS,
) -> DataFrame:
    """Write the shards and the index below ``folder``; returns the stored index (INDEX_SCHEMA)."""
    spark = docs.sparkSession
    ship_package(spark)

    def run(batches):
        ctx = TaskContext.get()
        writer, shard = None, ctx.partitionId()
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1).to_pylist()
            enc = encoder(tokenizer)
            end = enc.pack(end_id)
            writer = writer or ShardWriter(
                f"{folder}/shards", f"shard-{shard:06d}-{ctx.taskAttemptId()}.arrow", seq_len, batch_rows, enc.dtype
            )
            at, n = [], []
            for made in enc.encode_all(t or "" for t in texts):
                ids = made + end
                at.append(writer.append(ids))
                n.append(len(ids) // writer.item)
            rows = len(n)
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array([shard] * rows, pa.int32()), pa.array([writer.path] * rows),
                 pa.array(at, pa.int64()), pa.array(n, pa.int64())],
                names=["doc_id", "shard", "path", "local_start", "n_tokens"],
            )
        if writer:
            writer.close()

    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        # The text's hash parts the rows of one doc_id (or of none) that is on many rows.
        .withColumn("mark", F.xxhash64("text"))
        .repartitionByRange("doc_id", "mark")
        .sortWithinPartitions("doc_id", "mark", "text")
        .select("doc_id", "text")
    )
    index = f"{folder}/index"
    ordered.mapInArrow(run, INDEX_SCHEMA).write.parquet(index)
    return spark.read.schema(INDEX_SCHEMA).parquet(index)


def read_documents(index: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""
    spark = index.sparkSession
    ship_package(spark)
    # One row per shard file; the window is over that small table.
    shards = index.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = shards.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_start"))

    def crc(batches):
        path, reader = None, None
        for b in batches:
            cols = {n: b.column(n) for n in ("path", "local_start", "n_tokens")}
            out = []
            for p, at, n in zip(*(c.to_pylist() for c in cols.values())):
                if p != path:
                    if reader:
                        reader.close()
                    path, reader = p, ShardReader(p)
                c = 0
                for part in reader.slice(at, n):
                    c = zlib.crc32(np.ascontiguousarray(part, "<u4"), c)
                out.append(c)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("shard"), b.column("local_start"), b.column("n_tokens"),
                 pa.array(out, pa.int64())],
                names=["doc_id", "shard", "local_start", "n_tokens", "ids_crc32"],
            )

    got = index.mapInArrow(crc, "doc_id long, shard int, local_start long, n_tokens long, ids_crc32 long")
    return got.join(starts, "shard").select(
        "doc_id", (F.col("shard_start") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_files(spark: SparkSession, docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write ``docs`` as token files in the shared folder and return the digest read from them."""
    return read_documents(write_tokens(docs, tokenizer, stage_path(spark, "tokens")))
