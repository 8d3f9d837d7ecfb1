"""Best-fit packing with certified bin counts.

Documents become token pieces of at most ``capacity`` ids. Pieces are dealt over
parts of bounded size and each part packs its own by best fit decreasing. A lower
bound from dual feasible functions certifies each part: a part with as many bins as
its bound cannot do better. The histogram of all lengths gives the table's bound.

Where best fit decreasing leaves a gap, a part is also packed from the largest piece
down with those one or two pieces that leave the least room beside it, and by best fit
decreasing on lengths with a seeded disturbance that is new in each round; the packing
with the fewest bins stays.

Parts with a gap exchange documents and run again. While the table has more bins
than its bound, whole bins are pooled and dealt anew over parts of ``pool_rows``
pieces: those of parts with a gap that are not full, and of all other parts the
loosest, at first only those below 98 %, at last all. A pool's part takes its new
packing only if that has fewer bins, or as many and fuller ones, so no exchange
loses anything. A level that hardly gains gives way to the next; the exchange ends
at the bound, or when a deal of the whole table hardly gains. :func:`certificates`
states what is left of each part's gap, :func:`certificate` that of the table.

Nulls and edge cases: null and empty texts are one piece, the end id alone.
Repeated rows are packed one by one; null keys stay null. An empty table gives no
rows. Only documents of more than ``capacity`` ids are cut, all but the last piece
full. Extra columns are dropped.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import scratch, tokens

PIECES = "uid long, doc_id {key}, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long, part long, bin_fill long, part_bins long, part_bound long"


def pieces(docs: DataFrame, tokenizer: str, capacity: int, key: str = "doc_id", text: str = "text", end_id: int = tokens.END_ID) -> DataFrame:
    """One row per piece of each document's ids."""
    kind = docs.schema[key].dataType.simpleString()

    def cut(batches):
        at = TaskContext.get().partitionId() << 40
        try:
            for batch in batches:
                owner, number, start, length, sums = [], [], [], [], []
                for row, ids in enumerate(tokens.encode_array(batch.column(1), tokenizer, end_id)):
                    wide = ids.astype("<u4")
                    for k in range(0, len(wide), capacity):
                        part = wide[k : k + capacity]
                        owner.append(row)
                        number.append(k // capacity)
                        start.append(k)
                        length.append(len(part))
                        sums.append(zlib.crc32(part))
                n = len(owner)
                yield pa.record_batch(
                    [pa.array(np.arange(at, at + n)), batch.column(0).take(pa.array(owner, pa.int64())), pa.array(number, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, sums))],
                    names=["uid", "doc_id", "piece", "start", "length", "ids_crc32"],
                )
                at += n
        finally:
            tokens.release()

    return docs.select(F.col(key).alias("doc_id"), F.col(text).alias("t")).mapInArrow(cut, PIECES.format(key=kind))


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each piece, and the number of bins. Of equally full bins, the latest opened takes the piece."""
    return _best_fit(sizes, np.argsort(-sizes, kind="stable"), capacity)


def _best_fit(sizes: np.ndarray, order: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Each piece, in this order, into the fullest bin that has room for it."""
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    open_bins: dict[int, list[int]] = {}
    free = 0  # bit r: an open bin has room for exactly r more
    count = 0
    for i, size in zip(order.tolist(), sizes[order].tolist()):
        fits = free >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            stack = open_bins[room]
            b = stack.pop()
            if not stack:
                free ^= 1 << room
        else:
            room, b = capacity, count
            count += 1
        bins[i], offsets[i] = b, capacity - room
        room -= size
        if room:
            open_bins.setdefault(room, []).append(b)
            free |= 1 << room
    return bins, offsets, count


def best_company(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """As :func:`best_fit_decreasing`; a bin opens with the largest piece left and takes, again and again, the piece or pair that leaves it the least room."""
    order = np.argsort(-sizes, kind="stable")
    left: dict[int, list[int]] = {}
    present = 0  # bit s: a piece of size s is left
    for i, size in zip(order[::-1].tolist(), sizes[order[::-1]].tolist()):
        left.setdefault(size, []).append(i)
        present |= 1 << size
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    count = 0

    def take(size: int) -> int:
        nonlocal present
        stack = left[size]
        i = stack.pop()
        if not stack:
            present ^= 1 << size
        return i

    def largest(most: int) -> int:
        return (present & ((1 << (most + 1)) - 1)).bit_length() - 1

    while present:
        size, at = present.bit_length() - 1, 0
        while size > 0:
            i = take(size)
            bins[i], offsets[i] = count, at
            at += size
            room = capacity - at
            size = one = largest(room) if room else -1
            if one > 0 and one < room:  # a pair may leave less
                best, first = room - one, one
                while first > 0 and best:
                    again = len(left[first]) == 1
                    if again:
                        present ^= 1 << first
                    second = largest(min(first, room - first)) if room > first else -1
                    if again:
                        present |= 1 << first
                    if second > 0 and room - first - second < best:
                        best, size = room - first - second, first
                    first = largest(first - 1) if 2 * (first - 1) >= room - best else -1  # smaller firsts leave more
        count += 1
    return bins, offsets, count


def best_packing(sizes: np.ndarray, capacity: int, seed: int, bound: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The packing with the fewest bins of several; the first that reaches the bound."""
    best = best_fit_decreasing(sizes, capacity)
    if best[2] > bound:
        best = min(best, best_company(sizes, capacity), key=lambda p: p[2])
    if best[2] > bound:
        noise = np.random.default_rng(seed).uniform(0.9, 1.1, len(sizes))
        order = np.argsort(-sizes * noise, kind="stable")
        bins, offsets, count = _best_fit(sizes, order, capacity)
        best = min(best, (bins, offsets, count), key=lambda p: p[2])
    return best


def lower_bound(values: np.ndarray, capacity: int, counts: np.ndarray | None = None) -> int:
    """The best of two families of dual feasible functions: no packing has fewer bins."""
    if not len(values):
        return 0
    if counts is None:
        values, counts = np.unique(values, return_counts=True)
    best = -(-int((values * counts).sum()) // capacity)
    above = np.concatenate(([0], np.cumsum(counts)))
    weight = np.concatenate(([0], np.cumsum(values * counts)))
    for k in range(1, capacity // 2 + 1, max(1, capacity // 512)):
        # sizes above capacity - k count whole, those below k not at all, the others by their share
        low, high = np.searchsorted(values, k), np.searchsorted(values, capacity - k, side="right")
        best = max(best, int(above[-1] - above[high]) - (-int(weight[high] - weight[low]) // capacity))
    for k in range(1, 33):
        # (k + 1) x / capacity rounded down, or x k / capacity where that product is whole
        scaled = (k + 1) * values
        whole = scaled % capacity == 0
        total = int((counts * np.where(whole, values * k, scaled // capacity * capacity)).sum())
        best = max(best, -(-total // (k * capacity)))
    return best


_KEPT = ("uid", "doc_id", "piece", "start", "length", "ids_crc32")


def _pack_parts(rows: DataFrame, capacity: int, round_no: int, key_type: str) -> DataFrame:
    """Each part's best packing: of rows without a place, by best fit decreasing; of placed ones, the old one where that is no worse."""
    placed = "sequence_id" in rows.columns

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("uid", "ascending")])
        sizes = table["length"].to_numpy()
        bound = lower_bound(sizes, capacity)
        part = table["part"][0].as_py()
        bins, offsets, count = best_packing(sizes, capacity, (round_no << 32) + part, bound)
        ids = bins + ((round_no << 56) + (part << 32))
        if placed:
            before, old = np.unique(table["sequence_id"].to_numpy(), return_inverse=True)
            full = [float((np.bincount(b, weights=sizes) ** 2).sum()) for b in (old, bins)]
            if (len(before), -full[0]) <= (count, -full[1]):
                bins, offsets, count, ids = old, table["offset"].to_numpy(), len(before), table["sequence_id"].to_numpy()
        fill = np.bincount(bins, weights=sizes, minlength=count).astype(np.int64)
        n = table.num_rows
        columns = {c: table[c] for c in _KEPT}
        columns |= {"sequence_id": ids, "offset": offsets, "part": np.full(n, (round_no << 32) + part), "bin_fill": fill[bins]}
        columns |= {"part_bins": np.full(n, count), "part_bound": np.full(n, bound)}
        return pa.table(columns)

    return rows.groupBy("part").applyInArrow(pack, PACKED.format(key=key_type))


def table_bound(rows: DataFrame, capacity: int) -> int:
    """The lower bound of all pieces, from at most ``capacity`` lengths and counts."""
    found = sorted(tuple(r) for r in rows.groupBy("length").count().collect())
    return lower_bound(np.array([v for v, _ in found], dtype=np.int64), capacity, np.array([c for _, c in found], dtype=np.int64))


def certificates(packed: DataFrame, capacity: int) -> DataFrame:
    """(part, bins, bound, certified) of each part as it stands."""

    def certify(table: pa.Table) -> pa.Table:
        sizes, bins = table["length"].to_numpy(), len(np.unique(table["sequence_id"].to_numpy()))
        bound = lower_bound(sizes, capacity)
        return pa.table({"part": table["part"][:1], "bins": [bins], "bound": [bound], "certified": [bins == bound]})

    return packed.select("part", "length", "sequence_id").groupBy("part").applyInArrow(certify, "part long, bins long, bound long, certified boolean")


@dataclass(frozen=True)
class Certificate:
    """No packing has fewer than ``bound`` bins; this one has ``bins``."""

    bins: int
    bound: int

    @property
    def gap(self) -> int:
        return self.bins - self.bound


def _bins(packed: DataFrame) -> int:
    return packed.where("offset = 0").count()  # one piece of each bin


def _pack(docs: DataFrame, tokenizer: str, capacity: int, key: str, text: str, part_rows: int, pool_rows: int, levels: tuple[float, ...], least_gain: float) -> tuple[DataFrame, Certificate, list[DataFrame]]:
    """The packed pieces, the table's certificate, and the tables that hold the pieces: each round writes only the bins that it opens."""
    key_type = docs.schema[key].dataType.simpleString()
    cut = scratch.cut(pieces(docs, tokenizer, capacity, key, text), "pieces")
    parts = max(1, -(-cut.count() // part_rows))
    bound = table_bound(cut, capacity)
    dealt = cut.withColumn("part", F.pmod(F.xxhash64(F.lit(0), "uid"), F.lit(parts)).cast("int"))
    packed = scratch.cut(_pack_parts(dealt, capacity, 0, key_type), "packed")
    scratch.drop(cut)
    tables = [packed]
    bins, round_no, level = _bins(packed), 0, 0
    while bins > bound and level < len(levels):
        round_no += 1
        open_ = (F.col("bin_fill") < F.lit(capacity * levels[level])) | ((F.col("part_bins") > F.col("part_bound")) & (F.col("bin_fill") < capacity))
        n = packed.where(open_).count()
        pools = max(1, -(-n // pool_rows))
        whole_bins = F.pmod(F.xxhash64(F.lit(round_no), "sequence_id"), F.lit(pools)).cast("int")
        opened = packed.where(open_).select(*_KEPT, "sequence_id", "offset", whole_bins.alias("part"))
        again = scratch.cut(_pack_parts(opened, capacity, round_no, key_type), f"packed-{round_no}")
        tables.append(again)
        packed, before = packed.where(~open_).unionByName(again), bins
        bins = _bins(packed)
        if before - bins < least_gain * (before - bound) or pools == 1:  # one pool has nothing to deal again
            level += 1
    return packed, Certificate(bins, bound), tables


def pack_parts(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 4096,
    key: str = "doc_id",
    text: str = "text",
    part_rows: int = 25_000,
    pool_rows: int = 25_000,
    levels: tuple[float, ...] = (0.98, 0.995, 1.0, 2.0),
    least_gain: float = 0.05,
) -> tuple[DataFrame, Certificate]:
    """(pieces with place, part and the part's bins and bound when it was packed; the table's certificate)."""
    return _pack(docs, tokenizer, capacity, key, text, part_rows, pool_rows, levels, least_gain)[:2]


def certificate(docs: DataFrame, tokenizer: str, capacity: int = 4096, key: str = "doc_id", text: str = "text", part_rows: int = 25_000, pool_rows: int = 25_000, levels: tuple[float, ...] = (0.98, 0.995, 1.0, 2.0), least_gain: float = 0.05) -> Certificate:
    """Only the certificate of :func:`pack`."""
    _, found, tables = _pack(docs, tokenizer, capacity, key, text, part_rows, pool_rows, levels, least_gain)
    for table in tables:
        scratch.drop(table)
    return found


def pack(docs: DataFrame, tokenizer: str, capacity: int = 4096, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per piece with its ``sequence_id`` and ``offset``."""
    packed, _ = pack_parts(docs, tokenizer, capacity, key, text, **options)
    return packed.select(F.col("doc_id").alias(key), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
