"""Joins, set operations and reconciliation over keyed texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def build_key(*parts: Column) -> Column:
    return F.concat_ws(":", *[p.cast("string") for p in parts])


def parse_key(key: Column) -> Column:
    """Array of the integers of an 'a:b' key."""
    return F.transform(F.split(key, ":"), lambda x: x.try_cast("int"))


def range_spec(spec: str, column: Column) -> Column:
    """'all', '1-10', '114' or '1,2,3' as a predicate."""
    spec = spec.strip().lower()
    if spec == "all":
        return column.isNotNull()
    if "-" in spec:
        low, high = map(int, spec.split("-", 1))
        return column.between(low, high)
    return column.isin([int(x) for x in spec.split(",")])


def last_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Of the rows of each key the last by ``order``; aggregated, so a hot key is pre-combined."""
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("__row")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"__row.`{c}`").alias(c) for c in rest])


def left_default(left: DataFrame, right: DataFrame, keys: Sequence[str], defaults: dict) -> DataFrame:
    """Left join; missing columns take their defaults."""
    out = left.join(right, list(keys), "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def strict_join(left: DataFrame, right: DataFrame, keys: Sequence[str], what: str = "key") -> DataFrame:
    """Inner join that fails on a row of ``left`` without a partner."""
    out = left.join(right.withColumn("__hit", F.lit(True)), list(keys), "left")
    checked = F.when(F.col("__hit"), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit(f"{what} not found: "), F.concat_ws(":", *keys))))
    return out.where(checked).drop("__hit")


def changed(old: Column, new: Column) -> Column:
    return ~old.eqNullSafe(new)


def reconcile(master: DataFrame, replica: DataFrame, keys: Sequence[str], column: str, full: bool = False) -> DataFrame:
    """Rows whose replica differs or is missing; with ``full`` also those that only the replica has."""
    joined = master.select(*keys, F.col(column).alias("expected")).join(replica.select(*keys, F.col(column).alias("found")), list(keys), "full" if full else "left")
    return joined.where(changed(F.col("expected"), F.col("found")))


def missing_numbers(df: DataFrame, group: str, number: str, expected: DataFrame) -> DataFrame:
    """(group, number) of 1..expected that ``df`` lacks; ``expected`` has (group, n)."""
    wanted = expected.select(group, F.explode(F.sequence(F.lit(1), F.col("n"))).alias(number))
    return wanted.join(df.select(group, number).distinct(), [group, number], "left_anti")


def count_check(df: DataFrame, group: str, expected: DataFrame, strict: bool = False) -> DataFrame:
    """Counts per group against ``expected`` (group, n); groups without rows count only if ``strict``."""
    counts = df.groupBy(group).agg(F.count(F.lit(1)).alias("actual"))
    out = expected.join(counts, group, "left" if strict else "inner").withColumn("actual", F.coalesce("actual", F.lit(0)))
    return out.withColumn("ok", F.col("actual") == F.col("n"))
