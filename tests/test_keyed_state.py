"""Runs that remember their keys: restarts, repeated requests, re-work by mode and version, state of one row per key."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions import fixed_values as V
from tidemark.operators import rules
from tidemark.scratch import folder
from tidemark.streaming import resume


@pytest.mark.parametrize("mode", ["", "rejected", "mismatches", "both", "targets", "optimized", "all", "1:2,3:4"])
def test_modes_are_those_of_the_column_rule(spark, mode):
    statuses = ["", V.CHARACTER_MISMATCH, V.SPACING_CHANGED, V.SPACING_CLEAN]
    rows = [(done, s, v, k) for done in (True, False) for s in statuses for v in ("v1", "v2", None) for k in ("1:2", "9:9")]
    df = spark.createDataFrame(rows, "done boolean, status string, version string, k string")
    got = df.select("*", rules.rework_needed(mode, F.col("done"), F.col("status"), F.col("version"), "v2", F.col("k")).alias("r")).collect()
    assert all(bool(r.r) == resume.needs_work(mode, r.done, r.status, r.version, "v2", r.k) for r in got)


def test_runs_and_restarts(spark):
    source, target, state = (folder(spark, x) for x in ("asked", "kept", "state"))

    def ask(rows):
        spark.createDataFrame(rows, "k long, g string, status string").coalesce(1).write.mode("append").parquet(source)

    def run(version, mode="", outcome=lambda df: df):
        return resume.run_keyed(spark, source, "k long, g string, status string", ["k", "g"], outcome, state, target, version, mode, files_per_trigger=1)

    def kept():
        return sorted(map(tuple, spark.read.parquet(target).collect()), key=str)

    ask([(1, "a", "CLEAN"), (2, "a", "REJECTED_X"), (2, "a", "CLEAN"), (None, "a", "CLEAN")])
    ask([(1, "a", "REJECTED_X"), (3, None, "CLEAN")])
    progress = run("v1")
    first = [(1, "a", "CLEAN", "v1"), (2, "a", "REJECTED_X", "v1"), (3, None, "CLEAN", "v1"), (None, "a", "CLEAN", "v1")]
    assert kept() == sorted(first, key=str)
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in progress if p["stateOperators"]) == 4
    run("v1")  # nothing new
    assert kept() == sorted(first, key=str)

    ask([(4, "a", "CLEAN"), (5, "a", "CLEAN")])
    with pytest.raises(Exception, match="broken"):  # fails in the middle
        run("v1", outcome=lambda df: df.withColumn("status", F.when(F.col("k") == 5, F.raise_error(F.lit("broken"))).otherwise(F.col("status"))))
    assert kept() == sorted(first, key=str)
    run("v1")
    second = [*first, (4, "a", "CLEAN", "v1"), (5, "a", "CLEAN", "v1")]
    assert kept() == sorted(second, key=str)

    ask([(k, g, "CLEAN") for k, g, *_ in second])
    progress = run("v2", "both")  # only what was rejected, by version
    assert kept() == sorted([*second, (2, "a", "CLEAN", "v2")], key=str)
    ask([(k, g, "CLEAN") for k, g, *_ in second])
    progress = run("v2", "both")
    assert kept() == sorted([*second, (2, "a", "CLEAN", "v2")], key=str)
    assert progress[-1]["stateOperators"][0]["numRowsTotal"] == 6  # one row per key, however often it was asked for
