"""Greedy batches under a budget, without gathering a group in one task.

Where a batch begins depends on how full the batch before it was, back to the first row
of the group. But whatever is in a batch when a block of rows begins, only the first row
that overflows it matters: from there on all goes on alike. So a block of sorted rows is a
function from what a batch holds at its start to what the last one holds at its end and
how many were opened; it has a piece for each row that can be the first to overflow.
These functions are composed along the blocks of a partition, and along partitions (a row
for each), which tells every block where it begins; the blocks are then numbered apart.

Only rows of a group that goes on from one partition to the next take that way. Groups
that begin within a partition are numbered as the sorted rows stream by.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import scratch

NONE = -1  # no batch is open: the group begins


class Fill:
    """What a run of rows does to a batch: from each fill at its start to the fill at its end, and batches opened.

    From 0 to below ``room`` a fill grows by ``more`` and opens none. Constant pieces
    begin at ``low`` (ascending, the first is that of NONE): ``fill`` and ``opened``.
    A batch over the budget counts as full with one more than the budget.
    """

    def __init__(self, low, fill, opened, room: int = 0, more: int = 0):
        self.low, self.fill, self.opened = (np.asarray(x, dtype=np.int64) for x in (low, fill, opened))
        self.room, self.more = room, more

    @classmethod
    def constant(cls, fill: int, opened: int) -> Fill:
        return cls([NONE], [fill], [opened])

    @classmethod
    def nothing(cls, budget: int) -> Fill:
        return cls([NONE], [NONE], [0], budget + 2)

    @classmethod
    def of(cls, sizes: np.ndarray, budget: int) -> Fill:
        n = len(sizes)
        ends = np.cumsum(sizes)
        before = ends - sizes
        # the first row of the next batch after one that begins at a row; doubling these steps finds the last
        to = np.append(np.maximum(np.searchsorted(ends, before + budget, side="right"), np.arange(n) + 1), n)
        last, count = np.arange(n + 1), np.append(np.ones(n, np.int64), 0)
        while (to < n).any():
            last, count, to = np.where(to < n, last[to], last), count + count[to], to[to]
        held = np.minimum(ends[-1] - before, budget + 1)[last[:n]]
        _, first = np.unique(ends, return_index=True)  # rows that can be the first to overflow, with the greatest fills that they do not
        first = first[np.concatenate([[-1], ends[first][:-1]]) <= budget][::-1]
        low = np.maximum(budget + 1 - ends[first], 0)
        return cls([NONE, *low], [held[0], *held[first]], [count[0] - 1, *count[first]], max(0, int(budget + 1 - ends[-1])), int(ends[-1]))

    def __call__(self, fill, opened) -> tuple[np.ndarray, np.ndarray]:
        fill, opened = np.asarray(fill, dtype=np.int64), np.asarray(opened, dtype=np.int64)
        at = np.searchsorted(self.low, fill, side="right") - 1
        passes = (fill >= 0) & (fill < self.room)
        return np.where(passes, fill + self.more, self.fill[at]), opened + np.where(passes, 0, self.opened[at])

    def then(self, after: Fill) -> Fill:
        """This run and then another one."""
        room = max(0, min(self.room, after.room - self.more))
        inside = (after.low != NONE) & (after.low < self.room + self.more)
        inside[:-1] &= (after.low[1:] > self.more + room) | (after.low[:-1] >= self.more + room)
        inside &= self.room > room
        low = np.maximum(after.low[inside] - self.more, room)
        fill, opened = after(self.fill, self.opened)
        low = np.concatenate([self.low[:1], low, self.low[1:]])
        fill = np.concatenate([fill[:1], after.fill[inside], fill[1:]])
        opened = np.concatenate([opened[:1], after.opened[inside], opened[1:]])
        new = np.ones(len(low), bool)  # equal neighbours are one piece, and of pieces that begin alike the last counts
        new[2:] = (fill[2:] != fill[1:-1]) | (opened[2:] != opened[1:-1])
        low, fill, opened = low[new], fill[new], opened[new]
        last = np.append(low[1:] != low[:-1], True)
        return Fill(low[last], fill[last], opened[last], room, self.more + after.more if room else 0)

    def row(self) -> tuple:
        return self.low.tolist(), self.fill.tolist(), self.opened.tolist(), self.room, self.more


_FILL = "low array<long>, fill array<long>, opened array<long>, room long, more long"
_FILL_KINDS = [("low", pa.list_(pa.int64())), ("fill", pa.list_(pa.int64())), ("opened", pa.list_(pa.int64())), ("room", pa.int64()), ("more", pa.int64())]
_STATE_KINDS = [("kind", pa.int32()), ("part", pa.int64()), ("block", pa.int64()), ("first_key", pa.string()), ("last_key", pa.string()), *_FILL_KINDS]
_STATE = f"kind int, part long, block long, first_key string, last_key string, {_FILL}"
_ROW, _BLOCK, _PART = 0, 1, 2


def _changes(batch: pa.RecordBatch, width: int) -> np.ndarray:
    """Rows that begin another group than the row before, the first included."""
    new = np.zeros(batch.num_rows, dtype=bool)
    new[0] = True
    for i in range(width):
        a, b = batch.column(i).slice(0, batch.num_rows - 1), batch.column(i).slice(1)
        other = pc.or_(pc.fill_null(pc.not_equal(a, b), False), pc.xor(pc.is_null(a), pc.is_null(b)))
        new[1:] |= other.to_numpy(zero_copy_only=False)
    return np.flatnonzero(new)


def _key(batch: pa.RecordBatch, width: int, row: int) -> str:
    return repr(tuple(batch.column(i)[row].as_py() for i in range(width)))


def numbered(sizes: list[int], starts: set[int], fill: int, batch: int, budget: int) -> tuple[list[int], int, int]:
    """Batch of each row, from the fill and number of the batch that is open; rows in ``starts`` begin a group."""
    out = []
    for i, n in enumerate(sizes):
        if i in starts:
            fill, batch = NONE, 0
        if fill == NONE:
            fill = n
        elif fill + n > budget:
            fill, batch = n, batch + 1
        else:
            fill += n
        out.append(batch)
    return out, fill, batch


def _blocks(batches: Iterator[pa.RecordBatch], width: int, budget: int) -> Iterator[pa.RecordBatch]:
    """Sorted rows with their batches where these are known, and the functions of blocks and of the partition where not."""
    part, block = TaskContext.get().partitionId(), -1
    so_far, first_key, last_key = Fill.nothing(budget), None, None
    fill, batch = NONE, 0  # once the first group is over
    for rows in batches:
        if not rows.num_rows:
            continue
        block += 1
        begins = _changes(rows, width).tolist()
        key = _key(rows, width, 0)
        first_key = key if first_key is None else first_key
        if last_key == key:
            begins = begins[1:]
        sizes = np.maximum(pc.fill_null(rows.column(width + 1), 0).to_numpy(zero_copy_only=False).astype(np.int64), 0)
        unknown = (begins[0] if begins else rows.num_rows) if key == first_key else 0  # rows of the first group
        if block == 0:
            unknown, begins = (begins[1] if len(begins) > 1 else rows.num_rows), begins[1:]
        state = []
        if unknown:
            state.append((_BLOCK, part, block, None, None, *so_far.row()))
            so_far = so_far.then(Fill.of(sizes[:unknown], budget))
        numbers, fill, batch = numbered(sizes[unknown:].tolist(), {b - unknown for b in begins}, fill, batch, budget)
        yield _with_state(rows, [None] * unknown + numbers, [(_ROW, part, block, None, None, None, None, None, None, None)] * rows.num_rows)
        if state:
            yield _with_state(rows.slice(0, 1), [None], state)
        last_key = _key(rows, width, rows.num_rows - 1)
    if first_key is not None:
        exit_ = so_far if last_key == first_key else Fill.constant(min(fill, budget + 1), batch)
        yield _with_state(rows.slice(0, 1), [None], [(_PART, part, block, first_key, last_key, *exit_.row())])


def _with_state(rows: pa.RecordBatch, numbers: list, state: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(c, kind) for c, (_, kind) in zip(zip(*state), _STATE_KINDS)]
    arrays = [*rows.columns, pa.array(numbers, pa.int32()), *columns]
    return pa.RecordBatch.from_arrays(arrays, names=[*rows.schema.names, "batch", *[n for n, _ in _STATE_KINDS]])


def _entries(batches: Iterator[pa.RecordBatch], budget: int) -> Iterator[pa.RecordBatch]:
    """From the functions of all partitions in order: what is open where each begins."""
    key, fill, batch = None, NONE, 0
    for rows in batches:
        out = []
        for r in rows.to_pylist():
            if r["first_key"] != key:
                fill, batch = NONE, 0
            out.append((r["part"], fill, batch))
            after, opened = Fill(r["low"], r["fill"], r["opened"], r["room"], r["more"])(fill, batch if r["first_key"] == r["last_key"] else 0)
            key, fill, batch = r["last_key"], int(after), int(opened)
        yield pa.record_batch([pa.array([x[i] for x in out], pa.int64()) for i in range(3)], names=["part", "entry_fill", "entry_batch"])


def budget_batches(df: DataFrame, group: Sequence[str], order: Column, size: Column, budget: int) -> DataFrame:
    """Greedy batches per group: a row that would pass the budget of a batch with rows opens the next.

    ``(group..., ord, size, batch)``. A null or negative size counts as 0; rows of equal
    order are taken by size. Groups are told apart by the values of their columns.
    """
    spark, width = df.sparkSession, len(group)
    kinds = {f.name: f.dataType.simpleString() for f in df.select(*group).schema}
    rows = df.select(*group, order.cast("long").alias("ord"), size.cast("long").alias("size"))
    rows = rows.repartitionByRange(*group, "ord", "size").sortWithinPartitions(*group, "ord", "size")
    plain = ", ".join([f"`{g}` {kinds[g]}" for g in group] + ["ord long", "size long", "batch int"])
    path = scratch.folder(spark, "budgets")
    rows.mapInArrow(lambda batches: _blocks(batches, width, budget), f"{plain}, {_STATE}").write.parquet(path)
    table = spark.read.parquet(path)
    columns = [*group, "ord", "size", "batch"]

    parts = table.where(F.col("kind") == _PART).select("part", "first_key", "last_key", "low", "fill", "opened", "room", "more")
    entries = parts.repartition(1).sortWithinPartitions("part").mapInArrow(lambda batches: _entries(batches, budget), "part long, entry_fill long, entry_batch long")  # a row per partition
    begin = table.where(F.col("kind") == _BLOCK).select("part", "block", "low", "fill", "opened", "room", "more").join(F.broadcast(entries), "part")
    begin = begin.withColumnsRenamed({"part": "p", "block": "b"})
    open_rows = table.where((F.col("kind") == _ROW) & F.col("batch").isNull()).select(*columns, "part", "block")

    def finish(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        by = pc.sort_indices(left, sort_keys=[("ord", "ascending"), ("size", "ascending")], null_placement="at_start")
        left, r = left.take(by).select(columns), right.to_pylist()[0]
        fill, batch = Fill(r["low"], r["fill"], r["opened"], r["room"], r["more"])(r["entry_fill"], r["entry_batch"])
        sizes = np.maximum(pc.fill_null(left["size"], 0).to_numpy(), 0).tolist()
        numbers, _, _ = numbered(sizes, set(), int(fill), int(batch), budget)
        return left.set_column(left.num_columns - 1, "batch", pa.array(numbers, pa.int32()))

    finished = open_rows.groupBy("part", "block").cogroup(begin.groupBy("p", "b")).applyInArrow(finish, plain)
    return table.where((F.col("kind") == _ROW) & F.col("batch").isNotNull()).select(*columns).unionByName(finished)
