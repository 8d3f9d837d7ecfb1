"""Connected components by alternating large-star and small-star steps.

Each step is a minimum per node and a join back, so no neighbourhood is gathered
in one row; each round is cut to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import scratch


def _star(edges: DataFrame, large: bool) -> DataFrame:
    if large:  # all neighbours of a node; the larger ones move to the least of all
        around = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:  # the smaller neighbours of a node move to the least of them
        around = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = around.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low"))
    moved = around.join(least, "a")
    if large:
        return moved.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.where("b != low").select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(least.select("a", F.col("low").alias("b")))


def components(edges: DataFrame, label: str = "stars") -> DataFrame:
    """From edges (a, b), rows (node, low): each node and the least node that it reaches, but for least nodes themselves."""
    stars = edges.select("a", "b").where("a != b")
    before, kept = None, None
    while True:
        step = _star(_star(stars, large=True), large=False).where("a != b").distinct()
        cut = scratch.cut(step, label)
        mark = cut.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        scratch.drop(kept)
        stars = kept = cut
        if mark == before:
            out = cut.select(F.col("a").alias("node"), F.col("b").alias("low"))
            out.tidemark_path = cut.tidemark_path  # for scratch.drop()
            return out
        before = mark
