"""Snapshots in parts by a hash of their keys, of which an update writes only those that change.

A part is a folder ``part=n``. An update joins its values with the parts that their keys
can lie in, keeps the parts in which a value really differs, and overwrites these alone.
Spark stages the new parts and puts them in place when all of them are written, so a
failure leaves the snapshot as it was; a repeated update finds nothing to change.

Nulls: a key column may be null and is then a value of its own. Updates of keys that the
snapshot lacks are ignored, as in ``writers.update_by_key``. Of several updates of a key,
keep one first (``relational.last_wins``).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PART = "part"


def part_of(keys: Sequence[str], parts: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(parts)).cast("int")


def write(df: DataFrame, path: str, keys: Sequence[str], parts: int = 64) -> None:
    """A new snapshot; it has no column named ``part``."""
    df.withColumn(PART, part_of(keys, parts)).repartition(PART).write.partitionBy(PART).mode("errorifexists").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(PART)


def update(spark: SparkSession, path: str, updates: DataFrame, keys: Sequence[str], column: str, parts: int = 64) -> list[int]:
    """Set ``column`` to its value in ``updates`` (keys, column); the numbers of the parts that were written, ``parts`` at most."""
    new = updates.select(*[F.col(f"`{k}`") for k in keys], F.col(f"`{column}`").alias("__new"), F.lit(True).alias("__hit")).withColumn("__part", part_of(keys, parts))
    asked = sorted(r[0] for r in new.select("__part").distinct().collect())
    if not asked:
        return []
    old = spark.read.parquet(path)

    def joined(numbers: list[int]) -> DataFrame:
        there, here = old.where(F.col(PART).isin(numbers)), new.where(F.col("__part").isin(numbers)).withColumnsRenamed({k: f"__{i}" for i, k in enumerate(keys)})
        same = reduce(lambda a, b: a & b, [F.col(f"`{k}`").eqNullSafe(F.col(f"__{i}")) for i, k in enumerate(keys)])
        return there.join(here, (F.col(PART) == F.col("__part")) & same, "left")

    differs = F.coalesce(F.col("__hit"), F.lit(False)) & ~F.col("__new").eqNullSafe(F.col(f"`{column}`"))
    touched = sorted(r[0] for r in joined(asked).where(differs).select(PART).distinct().collect())
    if touched:
        changed = joined(touched).withColumn(column, F.when(F.col("__hit"), F.col("__new")).otherwise(F.col(f"`{column}`")))
        changed.select(*old.columns).repartition(PART).write.partitionBy(PART).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    return touched
