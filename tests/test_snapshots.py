"""Updates of snapshots write the parts that change, and no others."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from tidemark.sources import snapshots


def files(path):
    return {part: sorted(os.listdir(part)) for part in glob.glob(f"{path}/part=*")}


@pytest.fixture
def snapshot(spark, tmp_path):
    path = f"{tmp_path}/s"
    rows = [(i if i % 50 else None, f"g{i % 3}", f"v{i}", i) for i in range(1, 400)]
    snapshots.write(spark.createDataFrame(rows, "k int, g string, v string, other int"), f"file://{path}", ["k", "g"], 16)
    return path, {r[3]: r for r in rows}


def content(spark, path):
    return {r.other: tuple(r) for r in snapshots.read(spark, f"file://{path}").collect()}


def test_only_touched_parts_are_written(spark, snapshot):
    path, rows = snapshot
    before = files(path)
    updates = spark.createDataFrame([(7, "g1", "new"), (8, "g2", None), (9, "g0", "v9"), (7, "g2", "no such key"), (1000, "g0", "x"), (None, "g1", "null key")], "k int, g string, v string")
    touched = snapshots.update(spark, f"file://{path}", updates, ["k", "g"], "v", 16)
    want = {i: (k, g, "new" if i == 7 else None if i == 8 else "null key" if k is None and g == "g1" else v, i) for i, (k, g, v, _) in rows.items()}
    assert content(spark, path) == want
    after = files(path)
    assert {int(p.rpartition("=")[2]) for p in after if after[p] != before[p]} == set(touched) and set(after) == set(before)
    changed = spark.createDataFrame([(7, "g1"), (8, "g2"), (None, "g1")], "k int, g string").select(snapshots.part_of(["k", "g"], 16).alias("p"))
    assert set(touched) == {r.p for r in changed.collect()} and len(touched) < len(before)
    assert snapshots.update(spark, f"file://{path}", updates, ["k", "g"], "v", 16) == [] and files(path) == after  # a replay
    assert snapshots.update(spark, f"file://{path}", updates.where("false"), ["k", "g"], "v", 16) == []


def test_a_failure_leaves_the_old_snapshot(spark, snapshot):
    path, rows = snapshot
    before = files(path)
    updates = spark.createDataFrame([(i, f"g{i % 3}", "new") for i in range(1, 100)], "k int, g string, v string")
    calls = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def breaks(v, k):
        calls.add(1)
        if k == 77:
            raise ValueError("broken")
        return v

    with pytest.raises(Exception, match="broken"):
        snapshots.update(spark, f"file://{path}", updates.withColumn("v", breaks("v", "k")), ["k", "g"], "v", 16)
    assert calls.value > 0 and files(path) == before and content(spark, path) == rows


def test_a_failure_while_parts_are_written(spark, snapshot, monkeypatch):
    path, rows = snapshot
    before = files(path)
    updates = spark.createDataFrame([(i, f"g{i % 3}", "new") for i in range(1, 100)], "k int, g string, v string")
    seen = []

    def broken(keys, parts, real=snapshots.part_of):
        seen.append(1)
        return real(keys, parts)

    monkeypatch.setattr(snapshots, "part_of", broken)
    frame = type(updates)
    real = frame.repartition

    def late(self, *args):
        out = real(self, *args)
        return out.withColumn("v", F.when(F.col("other") == 77, F.raise_error(F.lit("broken"))).otherwise(F.col("v"))).select(*self.columns) if args == ("part",) else out

    monkeypatch.setattr(frame, "repartition", late)
    with pytest.raises(Exception, match="broken"):
        snapshots.update(spark, f"file://{path}", updates, ["k", "g"], "v", 16)
    assert seen and files(path) == before and content(spark, path) == rows
