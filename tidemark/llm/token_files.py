"""Token ids in Arrow files of equal-length sequences.

Documents are ordered by key and cut into ranges; each range becomes one Arrow
file (the random-access IPC format) whose record batches hold a fixed-size-list
column ``ids`` (``length`` unsigned integers) and, as only a sequence's end can be
padding, ``valid``, how many of its ids are tokens; a mask is a view of one constant
run of ones and zeros. The ids of a range run on from sequence to sequence and only the last
sequence is padded. A second Arrow file beside it holds each document's key,
start and length. Both are uncompressed, so a reader maps them and takes slices
without copying.

A task writes under a name of its own and the table of files names only those of
tasks that ended, so a repeated or speculative task does no harm.

Nulls and edge cases: null and empty texts have the end id alone; null keys come
first. Rows with equal keys stay, ordered by a hash of their texts. Keys may have any
type that Spark can order. An empty table gives no file and no row. Extra columns
are dropped.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import scratch, tokens

FILES = "shard int, file string, n_docs bigint, n_ids bigint, key_type string"


def open_input(uri: str):
    """A random-access file; local ones are mapped into memory."""
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)
    return pa.memory_map(path) if isinstance(system, fs.LocalFileSystem) else system.open_input_file(path)


def _open_output(uri: str):
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)
    if isinstance(system, fs.LocalFileSystem):
        system.create_dir(path.rpartition("/")[0], recursive=True)
    return system.open_output_stream(path)


class _Sequences:
    """Writes a run of ids as batches of ``rows`` sequences."""

    def __init__(self, uri: str, length: int, rows: int, dtype: np.dtype):
        self.length, self.rows, self.dtype = length, rows, dtype
        kind = pa.from_numpy_dtype(dtype)
        self.schema = pa.schema([("ids", pa.list_(kind, length)), ("valid", pa.int32())])
        self.sink = _open_output(uri)
        self.writer = pa.ipc.new_file(self.sink, self.schema)
        self.pending: list[np.ndarray] = []
        self.held = self.total = 0

    def add(self, ids: np.ndarray) -> None:
        self.pending.append(ids)
        self.held += len(ids)
        self.total += len(ids)
        if self.held >= self.length * self.rows:
            ids = np.concatenate(self.pending)
            n = self.length * self.rows
            for i in range(0, len(ids) - n + 1, n):
                self._write(ids[i : i + n], n)
            self.pending = [ids[len(ids) // n * n :].copy()]
            self.held = len(self.pending[0])

    def _write(self, ids: np.ndarray, known: int) -> None:
        valid = np.clip(known - np.arange(0, len(ids), self.length), 0, self.length).astype(np.int32)
        self.writer.write_batch(pa.record_batch([pa.FixedSizeListArray.from_arrays(pa.array(ids), self.length), pa.array(valid)], schema=self.schema))

    def close(self) -> None:
        if self.held:
            ids = np.concatenate(self.pending)
            self._write(np.concatenate((ids, np.zeros(-len(ids) % self.length, self.dtype))), len(ids))
        self.writer.close()
        self.sink.close()


class SequenceFile:
    """Random access to a written file: sequences, masks and runs of ids."""

    def __init__(self, uri: str):
        self.reader = pa.ipc.open_file(open_input(uri))
        self.length = self.reader.schema.field("ids").type.list_size
        self.rows = self.reader.get_batch(0).num_rows if self.reader.num_record_batches else 1
        self._at, self._ids = -1, np.zeros(0)
        self._masks = np.repeat(np.array([1, 0], dtype=np.uint8), self.length)

    def batch(self, i: int) -> np.ndarray:
        if i != self._at:
            self._at, self._ids = i, self.reader.get_batch(i).column(0).flatten().to_numpy()
        return self._ids

    def sequence(self, row: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a sequence and its mask, both without a copy."""
        batch = self.reader.get_batch(row // self.rows)
        k = row % self.rows
        valid = batch.column(1)[k].as_py()
        return batch.column(0)[k].values.to_numpy(), self._masks[self.length - valid : 2 * self.length - valid]

    def ids(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from position ``start``; a view, if they lie in one batch."""
        size, parts = self.length * self.rows, []
        while n > 0:
            ids = self.batch(start // size)
            parts.append(ids[start % size : start % size + n])
            start, n = start + len(parts[-1]), n - len(parts[-1])
        return parts[0] if len(parts) == 1 else np.concatenate(parts or [np.zeros(0, np.uint16)])


def write(docs: DataFrame, folder: str, tokenizer: str, key: str = "doc_id", text: str = "text", length: int = 2048, rows: int = 256, end_id: int = tokens.END_ID, partitions: int | None = None) -> DataFrame:
    """Write the files below ``folder``; return the table of files (shard, file, n_docs, n_ids)."""
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = docs.schema[key].dataType.simpleString()
    ordered = (
        docs.select(F.col(key).alias("k"), F.col(text).alias("t"), F.xxhash64(F.col(text)).alias("h"))
        .repartitionByRange(n, F.col("k").asc_nulls_first(), F.col("h"))
        .sortWithinPartitions(F.col("k").asc_nulls_first(), "h")
        .select("k", "t")
    )

    def store(batches):
        shard, out = TaskContext.get().partitionId(), None
        keys, sizes = [], []
        for batch in batches:
            if batch.num_rows and out is None:
                name = f"{folder}/part-{shard:06d}-{uuid.uuid4().hex}"
                out = _Sequences(f"{name}.arrow", length, rows, tokens.encoder(tokenizer).dtype)
            for ids in tokens.encode_array(batch.column(1), tokenizer, end_id):
                out.add(ids)
                sizes.append(len(ids))
            keys.append(batch.column(0))
        tokens.release()
        if out is None:
            return
        out.close()
        sizes = np.array(sizes, dtype=np.int64)
        table = pa.table({"key": pa.chunked_array(keys), "start": np.cumsum(sizes) - sizes, "n": sizes})
        with _open_output(f"{name}.index.arrow") as sink, pa.ipc.new_file(sink, table.schema) as writer:
            writer.write_table(table, max_chunksize=1 << 16)
        yield pa.record_batch({"shard": pa.array([shard], pa.int32()), "file": [name], "n_docs": pa.array([len(sizes)], pa.int64()), "n_ids": pa.array([out.total], pa.int64()), "key_type": [kind]})

    return scratch.cut(ordered.mapInArrow(store, FILES), "token-files")


def documents(files: DataFrame, key: str = "doc_id", key_type: str = "long") -> DataFrame:
    """Per document, from the files: ``key, start, n_tokens, ids_crc32``; ``start`` counts all ids before it.

    The key has the type that was written; ``key_type`` is that of an empty table.
    """
    written = files.select("key_type").first()
    key_type = written[0] if written else key_type
    before = F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))  # a row per file
    spread = files.select("shard", "file", F.coalesce(before, F.lit(0)).alias("base")).repartition(int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def read(batches):
        for batch in batches:
            for name, base in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                ids = SequenceFile(f"{name}.arrow")
                index = pa.ipc.open_file(open_input(f"{name}.index.arrow"))
                for i in range(index.num_record_batches):
                    part = index.get_batch(i)
                    starts, sizes = part.column(1).to_numpy(), part.column(2).to_numpy()
                    sums = [zlib.crc32(ids.ids(a, n).astype("<u4")) for a, n in zip(starts.tolist(), sizes.tolist())]
                    yield pa.record_batch([part.column(0), pa.array(starts + base), part.column(2), pa.array(sums, pa.int64())], names=["key", "start", "n_tokens", "ids_crc32"])

    schema = f"key {key_type}, start long, n_tokens long, ids_crc32 long"
    return spread.mapInArrow(read, schema).withColumnRenamed("key", key)


def new_folder(spark: SparkSession) -> str:
    """A new shared folder for files that go when the driver ends."""
    return scratch.lasting(spark, "sequences")
