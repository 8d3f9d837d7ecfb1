"""Reports on a whole corpus: validation against expected counts, and comparison of two versions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import kernels
from tidemark.functions import text as T
from tidemark.operators import relational as R


def validate_corpus(items: DataFrame, group: str, text: str, n_notes: Column, expected: DataFrame, layouts: dict[str, DataFrame] | None = None) -> DataFrame:
    """One row: groups present and expected, items, notes, empty texts, groups with another count than ``expected`` (group, n), and whether each other layout has as many rows."""
    empty = F.col(text).isNull() | (F.col(text) == "")
    totals = items.agg(
        F.countDistinct(group).alias("groups"), F.count(F.lit(1)).alias("items"), F.coalesce(F.sum(n_notes), F.lit(0)).cast("long").alias("notes"), F.count_if(empty).alias("empty_texts")
    )
    checked = R.count_check(items.select(group), group, expected)
    wrong = checked.agg(F.count_if(~F.col("ok")).alias("wrong_groups"))
    wanted = expected.agg(F.count(F.lit(1)).alias("groups_expected"))
    parts = [totals, wrong, wanted] + [df.agg(F.count(F.lit(1)).alias(f"rows_{name}")) for name, df in (layouts or {}).items()]
    whole = reduce(lambda a, b: a.crossJoin(F.broadcast(b)), parts)  # one row each
    same = reduce(lambda a, b: a & b, [F.col(f"rows_{name}") == F.col("items") for name in layouts or {}], F.lit(True))
    return whole.withColumn("layouts_agree", same).withColumn("valid", (F.col("wrong_groups") == 0) & (F.col("empty_texts") == 0) & F.col("layouts_agree"))


def empty_texts(items: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    """Keys of items without text."""
    return items.where(F.col(text).isNull() | (F.col(text) == "")).select(*keys)


def version_pairs(left: DataFrame, right: DataFrame, keys: Sequence[str], text: str = "text") -> DataFrame:
    """Each text of ``left`` (keys, text) beside that of ``right``: raw, clean (no markers), other, markers, ratio; a missing other is '' with ratio 0."""
    joined = left.select(*keys, F.col(text).alias("raw")).join(right.select(*keys, F.col(text).alias("other")), list(keys), "left")
    joined = joined.select(*keys, "raw", T.strip_markers(F.col("raw")).alias("clean"), T.trim_ws(F.coalesce("other", F.lit(""))).alias("other"), F.regexp_count("raw", F.lit(T.MARKER)).alias("markers"))
    # equal texts need no comparison
    ratio = kernels.similarity(F.when(F.col("clean") != F.col("other"), F.col("clean")), F.col("other"))
    return joined.withColumn("ratio", F.when(F.col("other") == "", 0.0).otherwise(F.coalesce(ratio, F.lit(1.0))))


def compare_versions(pairs: DataFrame) -> DataFrame:
    """One row of totals over :func:`version_pairs`."""
    return pairs.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("raw") == F.col("other")).alias("exact"),
        F.count_if(F.col("clean") == F.col("other")).alias("clean_exact"),
        F.round(F.avg("ratio"), 9).alias("similarity"),
        F.count_if(F.col("markers") > 0).alias("marked"),
        F.coalesce(F.sum("markers"), F.lit(0)).cast("long").alias("markers"),
    )


def unlike(pairs: DataFrame, keys: Sequence[str], below: float = 0.98, n: int = 5) -> DataFrame:
    """A sample of ``n`` pairs, first by keys, whose ratio is lower than ``below``."""
    return pairs.where((F.col("ratio") < below) & (F.col("other") != "")).orderBy(*keys).limit(n)
