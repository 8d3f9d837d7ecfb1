"""Ranked lexical search: the best documents of a corpus for each item of a query set.

1. Index. Each task turns its documents into shards of about ``SHARD_BYTES`` of text.
   A shard numbers its documents by ascending key and holds, for each term that some
   item asks for, the numbers of its documents as gaps and the term's occurrences in
   each, both as variable-length bytes. The shards are written to the shared folder.
2. Statistics. Documents, terms and document frequencies are summed over all shards;
   what reaches the driver is a row per term of the items.
3. Search. A task reads its shards one after another. For an item, a cursor per term
   decodes its postings block by block; a heap keyed by the last document of the
   decoded blocks tells up to which document all cursors are known, and the documents
   up to there are scored together and compared with the item's bounded heap of
   results, keyed by score and then document. The heaps live as long as the task.
4. Merge. The tasks' results are merged per item, in two levels.

Items are taken in blocks of at most ``BLOCK_BYTES`` of terms, so that what is
broadcast is bounded however many items there are; each block is searched in all
documents. A single item with more terms than that is a block of its own.

Scores, in 64-bit integers: with N documents that have a term, L terms in all, n terms
of a document, a term's weight w = floor(1000 ln((2N + 2) / (2 df + 1))) and
m = 50 + (50 n N) div L, a document's score is the sum of
w ((10^9 tf) div (1000 tf + 20 m)) over the item's distinct terms.

Nulls and edge cases: null and empty texts have no terms; they count nowhere and are
never found. Keys are integers; a document without a key counts and can be found, after
all others of its score. Rows with equal keys are separate documents. Every row of the
items is an item of its own, also where ids repeat or are null; an item without terms
has no rows. Without documents or items there are no rows. Terms are identified by
64-bit hashes and lengths.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from tidemark.llm import kernels as K
from tidemark.llm import scratch

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SHARD_BYTES = 32 << 20
BLOCK_BYTES = 4 << 20
POSTINGS = 4096  # decoded at once
MERGE_PARTS = 64

_BETWEEN = np.ones(256, dtype=bool)  # bytes of no term
_BETWEEN[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False

_INDEX = "ids array<bigint>, lengths binary, terms array<int>, dfs array<int>, ends array<bigint>, postings binary, n_docs long, n_terms long"


def varints(values: np.ndarray) -> np.ndarray:
    """Bytes of non-negative integers, seven bits each, the last of a value below 128."""
    values = values.astype(np.uint64)
    size = np.ones(len(values), dtype=np.int64)
    for k in range(1, 10):
        size += values >= np.uint64(1 << (7 * k))
    ends = np.cumsum(size)
    out = np.empty(int(ends[-1]) if len(ends) else 0, dtype=np.uint8)
    for k in range(int(size.max(initial=0))):
        has = size > k
        low = (values[has] >> np.uint64(7 * k)).astype(np.uint8) & 127
        out[ends[has] - size[has] + k] = low | np.where(size[has] > k + 1, 128, 0).astype(np.uint8)
    return out


def integers(raw: np.ndarray) -> np.ndarray:
    """The values of :func:`varints`."""
    last = np.flatnonzero(raw < 128)
    starts = np.concatenate([[0], last[:-1] + 1]) if len(last) else last
    at = np.arange(len(raw)) - np.repeat(starts, last - starts + 1)
    return np.add.reduceat((raw & 127).astype(np.int64) << (7 * at), starts) if len(last) else np.zeros(0, np.int64)


# ------------------------------------------------------------------ index


class _Shard:
    """Documents of one shard while it grows."""

    def __init__(self):
        self.ids, self.lengths, self.pairs, self.bytes = [], [], [], 0

    def add(self, ids: pa.Array, data: np.ndarray, offsets: np.ndarray, hashes: np.ndarray, sizes: np.ndarray) -> None:
        starts, ends, first = K.word_bounds(data, offsets, _BETWEEN)
        found = K.word_hashes(data, starts, ends, fold_case=True)
        at = np.minimum(np.searchsorted(hashes, found), len(hashes) - 1)
        hit = np.flatnonzero((hashes[at] == found) & (sizes[at] == ends - starts))
        doc = np.repeat(np.arange(len(ids)), np.diff(first))[hit]
        key, tf = np.unique(doc * len(hashes) + at[hit], return_counts=True)
        self.pairs.append((key // len(hashes) + len(self.ids), key % len(hashes), tf))
        self.ids += ids.to_pylist()
        self.lengths.append(np.diff(first))
        self.bytes += len(data)

    def batch(self) -> pa.RecordBatch:
        lengths = np.concatenate(self.lengths)
        order = sorted((i for i, n in enumerate(lengths.tolist()) if n), key=lambda i: (self.ids[i] is None, self.ids[i]))
        number = np.zeros(len(lengths), np.int64)
        number[order] = np.arange(len(order))
        doc, term, tf = (np.concatenate(x) for x in zip(*self.pairs))
        doc = number[doc]
        by = np.lexsort((doc, term))
        doc, term, tf = doc[by], term[by], tf[by]
        terms, starts, dfs = np.unique(term, return_index=True, return_counts=True)
        postings, ends, total = [], [], 0
        for a, n in zip(starts, dfs):
            both = varints(np.column_stack([np.diff(doc[a : a + n], prepend=-1), tf[a : a + n]]).ravel())
            total += len(both)
            postings.append(both)
            ends.append(total)
        row = [[[self.ids[i] for i in order]], [varints(lengths[order]).tobytes()], [terms.tolist()], [dfs.tolist()], [ends], [b"".join(x.tobytes() for x in postings)], [len(order)], [int(lengths.sum())]]
        kinds = [pa.list_(pa.int64()), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.binary(), pa.int64(), pa.int64()]
        return pa.record_batch([pa.array(v, k) for v, k in zip(row, kinds)], names=["ids", "lengths", "terms", "dfs", "ends", "postings", "n_docs", "n_terms"])


def index(docs: DataFrame, key: str, text: str, terms: list[str]) -> DataFrame:
    """A row per shard with the postings of ``terms``, which are known by their places in this list."""
    data, offsets = K.string_buffers(pa.array(terms, pa.string()))
    hashes = K.word_hashes(data, offsets[:-1], offsets[1:], fold_case=False)
    order = np.argsort(hashes)
    wanted = docs.sparkSession.sparkContext.broadcast((hashes[order], np.diff(offsets)[order], order))

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, sizes, places = wanted.value
        shard = _Shard()
        for batch in batches:
            for i, j in K.blocks(batch.column(1), 2 * K.BLOCK_BYTES):
                shard.add(batch.column(0).slice(i, j - i), *K.string_buffers(batch.column(1).slice(i, j - i)), hashes, sizes)
                if shard.bytes >= SHARD_BYTES:
                    yield named(shard.batch(), places)
                    shard = _Shard()
        if shard.ids:
            yield named(shard.batch(), places)
        K.trim()

    def named(row: pa.RecordBatch, places: np.ndarray) -> pa.RecordBatch:
        own = pa.array([places[row.column(2)[0].values.to_numpy()].tolist()], pa.list_(pa.int32()))
        return row.set_column(2, "terms", own)

    columns = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").alias("t"))
    return columns.mapInArrow(shards, _INDEX)


# ------------------------------------------------------------------ search


class _Cursor:
    """A term's postings in one shard, decoded in blocks: documents and what each adds to a score."""

    def __init__(self, raw: np.ndarray, n: int, weight: int, length_part: np.ndarray):
        self.raw, self.weight, self.length_part = raw, weight, length_part
        self.cuts = np.flatnonzero(raw < 128)[2 * POSTINGS - 1 : 2 * n - 1 : 2 * POSTINGS] + 1  # where blocks end, but for the last
        self.decoded: list[tuple[np.ndarray, np.ndarray]] = []

    def block(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.decoded) <= i:  # a block's first gap counts from the last document before it; items share what is decoded
            k = len(self.decoded)
            ends = [0, *self.cuts, len(self.raw)]
            both = integers(self.raw[ends[k] : ends[k + 1]])
            docs = np.cumsum(both[::2]) + (self.decoded[-1][0][-1] if k else -1)
            tf = both[1::2]
            self.decoded.append((docs, self.weight * ((1_000_000_000 * tf) // (1000 * tf + self.length_part[docs]))))
        return self.decoded[i]

    def more(self, i: int) -> bool:
        return i < len(self.cuts)


def merge(cursors: list[_Cursor], n_docs: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first document, scores) of consecutive ranges of a shard's documents, in order.

    The heap holds the cursors with further blocks, by the last document of the
    current one: up to the least of these all cursors are decoded.
    """
    at = [0] * len(cursors)  # block of each cursor
    used = [0] * len(cursors)  # postings of the block that are scored
    heap = [(int(c.block(0)[0][-1]), i) for i, c in enumerate(cursors) if c.more(0)]
    heapq.heapify(heap)
    first = 0
    while first < n_docs:
        last = heap[0][0] if heap else n_docs - 1
        scores = np.zeros(last + 1 - first, dtype=np.int64)
        for i, c in enumerate(cursors):
            docs, adds = c.block(at[i])
            end = len(docs) if docs[-1] <= last else int(np.searchsorted(docs, last, side="right"))
            scores[docs[used[i] : end] - first] += adds[used[i] : end]
            used[i] = end
        yield first, scores
        while heap and heap[0][0] == last:
            i = heap[0][1]
            at[i], used[i] = at[i] + 1, 0
            if cursors[i].more(at[i]):
                heapq.heapreplace(heap, (int(cursors[i].block(at[i])[0][-1]), i))
            else:
                heapq.heappop(heap)
        first = last + 1


def keep(results: list[tuple], ids: list, first: int, scores: np.ndarray, k: int) -> None:
    """Put what belongs to the best ``k`` on the heap of results: (score, minus the key), the worst on top; no key is worse than any."""
    full = len(results) == k
    some = np.flatnonzero(scores >= results[0][0] if full and results[0][0] > 0 else scores > 0)
    if len(some) > k:  # what is below the k-th of these cannot stay
        some = some[scores[some] >= np.partition(scores[some], len(some) - k)[len(some) - k]]
    for i in some.tolist():
        key = ids[first + i]
        entry = (int(scores[i]), -math.inf if key is None else -key, key)
        if len(results) < k:
            heapq.heappush(results, entry[:2])
        elif entry[:2] > results[0]:
            heapq.heapreplace(results, entry[:2])


def _length_part(lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """20 m of each document."""
    if int(lengths.max(initial=0)) * 50 * n_docs < 1 << 63:
        return 20 * (50 + lengths * (50 * n_docs) // n_terms)
    return np.array([20 * (50 + 50 * n * n_docs // n_terms) for n in lengths.tolist()], dtype=np.int64)


def search_shards(shards: DataFrame, asked: list[list[int]], weights: dict[int, int], n_docs: int, n_terms: int, k: int) -> DataFrame:
    """``q, part, score, id``: the best of each task's shards for each item."""
    spark = shards.sparkSession
    wanted = spark.sparkContext.broadcast((asked, weights))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, weights = wanted.value
        best: list[list[tuple]] = [[] for _ in asked]
        for batch in batches:
            for row in range(batch.num_rows):
                ids = batch.column(0)[row].as_py()
                part = _length_part(integers(np.frombuffer(batch.column(1)[row].as_py(), np.uint8)), n_docs, n_terms)
                terms, dfs = batch.column(2)[row].as_py(), batch.column(3)[row].as_py()
                ends, raw = [0, *batch.column(4)[row].as_py()], np.frombuffer(batch.column(5)[row].as_py(), np.uint8)
                cursors = {t: _Cursor(raw[a:b], n, weights[t], part) for t, n, a, b in zip(terms, dfs, ends, ends[1:])}
                for results, own in zip(best, asked):
                    if here := [cursors[t] for t in own if t in cursors]:
                        for first, scores in merge(here, len(ids)):
                            keep(results, ids, first, scores, k)
        task = TaskContext.get().partitionId()
        rows = [(q, task % MERGE_PARTS, score, None if key == -math.inf else -key) for q, results in enumerate(best) for score, key in results]
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 4, (pa.int32(), pa.int32(), pa.int64(), pa.int64()))], names=["q", "part", "score", "id"])
        K.trim()

    return shards.select("ids", "lengths", "terms", "dfs", "ends", "postings").mapInArrow(found, "q int, part int, score long, id long")


def best(found: DataFrame, k: int) -> DataFrame:
    """``q, rank, id, score``: the best ``k`` of each item; tasks are merged in groups first."""
    order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    some = found.withColumn("rank", F.row_number().over(Window.partitionBy("q", "part").orderBy(*order))).where(F.col("rank") <= k)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(*order))).where(F.col("rank") <= k).select("q", "rank", "id", "score")


def item_blocks(items: DataFrame, item: str, text: str) -> Iterator[list[Row]]:
    """Blocks of items (item, terms), by hashes; a block that is too large falls apart."""
    lower = F.translate(F.coalesce(F.col(f"`{text}`"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rows = items.select(F.col(f"`{item}`").alias("item"), F.array_distinct(F.regexp_extract_all(lower, F.lit(TERM), F.lit(0))).alias("terms"))
    rows = rows.where(F.size("terms") > 0).withColumn("spot", F.xxhash64("item", "terms"))
    pending = [(1, 0)]
    while pending:
        n, i = pending.pop()
        block = rows.where(F.pmod("spot", F.lit(n)) == i)
        size, spots = block.agg(F.coalesce(F.sum(F.length(F.array_join("terms", " "))), F.lit(0)), F.countDistinct("spot")).first()
        if size > BLOCK_BYTES and spots > 1:
            parts = max(2, math.ceil(size / BLOCK_BYTES))
            pending += [(n * parts, i + n * p) for p in range(parts)]
        elif size:
            yield block.collect()


def search(docs: DataFrame, items: DataFrame, k: int = 50, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """``item, rank, key, score``: of each item the ``k`` documents with the highest scores above 0, equal scores by ascending key."""
    spark = docs.sparkSession
    kind = items.schema[item].dataType.simpleString()
    parts = []
    with scratch.lean(spark):
        for block in item_blocks(items, item, item_text):
            terms = sorted({t for row in block for t in row["terms"]})
            number = {t: i for i, t in enumerate(terms)}
            shards = scratch.cut(index(docs, key, text, terms), "shards")
            n_docs, n_terms = shards.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
            dfs = shards.select(F.explode(F.arrays_zip("terms", "dfs")).alias("t")).groupBy("t.terms").agg(F.sum("t.dfs")).collect()
            weights = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for t, df in dfs}
            found = search_shards(shards, [[number[t] for t in row["terms"]] for row in block], weights, n_docs, max(n_terms, 1), k)
            ranked = scratch.cut(best(found, k), "ranked")
            scratch.drop(shards)
            names = spark.createDataFrame([(q, row["item"]) for q, row in enumerate(block)], f"q int, `{item}` {kind}")
            parts.append(ranked.join(F.broadcast(names), "q").select(item, "rank", F.col("id").alias(key), "score"))  # a row per item of the block
    if not parts:
        return spark.createDataFrame([], f"`{item}` {kind}, rank int, `{key}` long, score long")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
