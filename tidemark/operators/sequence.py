"""Order-dependent operators: batches, renumbering, running totals."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import scratch


#: Bits of a row's number that count within its partition; those above number the partition.
_WITHIN = 33


def _before(parts: DataFrame, value: str) -> DataFrame:
    """``part`` and ``start``, the total of ``value`` over the partitions before it; a row per partition."""
    over = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select("part", F.coalesce(F.sum(value).over(over), F.lit(0)).cast("long").alias("start"))


def placed(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """``place``: the position of each row in the order of the whole table, from 0.

    The rows are dealt by ranges, sorted within these and written once; the ranges' counts
    (a row per range) then say where each begins, so no task sees more than its range.
    """
    spark, path = df.sparkSession, scratch.folder(df.sparkSession, "placed")
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows.withColumn("__id", F.monotonically_increasing_id()).write.parquet(path)
    dealt = spark.read.parquet(path).withColumn("part", F.shiftright("__id", _WITHIN))
    starts = _before(dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n")), "n")
    place = F.col("start") + F.col("__id").bitwiseAND((1 << _WITHIN) - 1)
    return dealt.join(F.broadcast(starts), "part").withColumn("place", place).select(*[F.col(f"`{c}`") for c in df.columns], "place")


def fixed_batches(df: DataFrame, order: Sequence[str], size: int, group: Sequence[str] = ()) -> DataFrame:
    """``batch`` numbers for every ``size`` rows in order, within ``group`` or, without one, over the whole table (see :func:`placed`)."""
    if group:
        at = F.row_number().over(Window.partitionBy(*group).orderBy(*order)) - 1
        return df.withColumn("batch", F.floor(at / size).cast("long"))
    return placed(df, order).withColumn("batch", F.floor(F.col("place") / size).cast("long")).drop("place")


def offsets(df: DataFrame, order: str, value: str, path: str) -> DataFrame:
    """``order``, ``value`` and ``before``, the total of ``value`` over all rows that come earlier, without a global sort.

    The rows (unique numbers in ``order``) are dealt by ranges and written to ``path`` once,
    in order and with their running total; the totals of the ranges (a row each) say where each begins.
    """
    rows = df.select(order, value).repartitionByRange(order).sortWithinPartitions(order)

    def running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total = TaskContext.get().partitionId(), 0
        for batch in batches:
            values = pc.fill_null(batch.column(1), 0).to_numpy(zero_copy_only=False).astype("int64")
            ends = values.cumsum() + total
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ends - values), pa.array([part] * len(ends), pa.int64())], names=[order, value, "within", "part"])
            total = int(ends[-1]) if len(ends) else total

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    rows.mapInArrow(running, f"`{order}` {kinds[order]}, `{value}` {kinds[value]}, within long, part long").write.parquet(path)
    dealt = df.sparkSession.read.parquet(path)
    starts = _before(dealt.groupBy("part").agg(F.sum(value).alias("n")), "n")
    return dealt.join(F.broadcast(starts), "part").select(order, value, (F.col("start") + F.col("within")).alias("before"))


def snapped_batches(placed: DataFrame, size: int) -> DataFrame:
    """``batch`` for whole parents of :func:`offsets`: all items of a parent are in the batch in which its first one falls."""
    return placed.withColumn("batch", F.floor(F.col("before") / size).cast("long"))


def renumber(df: DataFrame, group: Sequence[str], order: Sequence[str], name: str = "number") -> DataFrame:
    """1..n within each group, by order."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order)).cast("long"))


def running(df: DataFrame, group: Sequence[str], order: Sequence[str], value: Column, name: str = "running") -> DataFrame:
    """Running total of ``value`` within each group."""
    over = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.sum(value).over(over))


def first_valid(candidates: DataFrame, keys: Sequence[str], valid: Column, order: Sequence[str], value: str) -> DataFrame:
    """The value of each key's first valid candidate; null if none is valid."""
    return candidates.groupBy(*keys).agg(F.min_by(F.when(valid, F.col(value)), F.when(valid, F.struct(*order))).alias(value))
