"""Batches and positions that no single task computes: against plain loops, over many partitions."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import budgets, sequence
from tidemark.operators.budgets import NONE, Fill
from tidemark.plans import QUERIES


def greedy(sizes, budget, used=NONE, opened=0):
    batches = []
    for n in sizes:
        n = max(n or 0, 0)
        if used == NONE:
            used = n
        elif used + n > budget:
            used, opened = n, opened + 1
        else:
            used += n
        batches.append(opened)
    return batches, min(used, budget + 1), opened


def some_sizes(rng, n):
    return [rng.choice([0, 0, 1, 2, 3, 5, rng.randrange(25)]) for _ in range(n)]


def test_functions_of_runs_compose():
    rng = random.Random(1)
    for _ in range(600):
        budget = rng.randrange(15)
        runs = [some_sizes(rng, rng.randrange(1, 9)) for _ in range(rng.randrange(1, 5))]
        made = Fill.nothing(budget)
        for run in runs:
            made = made.then(Fill.of(np.array(run, dtype=np.int64), budget))
        for used in range(NONE, budget + 2):
            fill, opened = made(used, 7)
            assert (int(fill), int(opened)) == greedy(sum(runs, []), budget, used, 7)[1:]


def test_functions_stay_small():
    rng = random.Random(2)
    made = Fill.nothing(1000)
    for _ in range(20):
        made = made.then(Fill.of(np.array([rng.randrange(60) for _ in range(5000)]), 1000))
    assert len(made.low) < 60


@pytest.fixture
def many_partitions(spark):
    names = {"spark.sql.shuffle.partitions": "13", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.execution.arrow.maxRecordsPerBatch": "37"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("budget", [0, 9, 10_000])
def test_budget_batches_of_hot_and_small_groups(spark, many_partitions, budget):
    rng = random.Random(budget)
    groups = {("hot", 1): some_sizes(rng, 3000), (None, None): some_sizes(rng, 40), ("b", None): [0, 0, 30, 0, None, -3, 2], ("b", 2): [5]}
    groups |= {("s", i): some_sizes(rng, rng.randrange(1, 6)) for i in range(150)}
    rows = [(*k, i, n) for k, sizes in groups.items() for i, n in enumerate(sizes)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, h int, o int, s int").withColumn("clash", F.lit(1))
    out = budgets.budget_batches(df, ["g", "h"], F.col("o"), F.col("s"), budget)
    assert out.columns == ["g", "h", "ord", "size", "batch"]
    want = {(*k, i): (n, b) for k, sizes in groups.items() for i, (n, b) in enumerate(zip(sizes, greedy(sizes, budget)[0]))}
    got = out.collect()
    assert len(got) == len(rows) and {(r.g, r.h, r.ord): (r.size, r.batch) for r in got} == want


def test_budget_batches_without_rows(spark):
    df = spark.createDataFrame([], "g string, o int, s int")
    assert budgets.budget_batches(df, ["g"], F.col("o"), F.col("s"), 5).count() == 0


def test_places_are_those_of_a_global_sort(spark, many_partitions):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None]), i, rng.random()) for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, i int, x double").repartition(7)
    got = sequence.placed(df, ["k", "i"]).orderBy("place").collect()
    assert [(r.k, r.i, r.x) for r in got] == sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1])) and [r.place for r in got] == list(range(2000))
    assert sequence.placed(df.where("false"), ["k"]).count() == 0


def test_one_group_runs_over_all_partitions(spark, many_partitions):
    df = spark.range(20_000).select(F.lit("one").alias("g"), F.col("id").alias("o"), (F.col("id") % 7).alias("s"))
    out = budgets.budget_batches(df, ["g"], F.col("o"), F.col("s"), 50)
    tasks = out.select("ord", F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert len(tasks) > 6 and max(r["count"] for r in tasks) < 8000
    want = greedy([i % 7 for i in range(20_000)], 50)[0]
    assert [r.batch for r in out.orderBy("ord").collect()] == want


def test_objects_of_any_size_are_streamed(spark, many_partitions, tmp_path):
    import glob
    import json

    from tidemark.sources import readers, writers

    rng = random.Random(9)
    odd = ['say "x"', "a\nb", "{}", ",", "", None, "ก\u2028\\", "}"]
    rows = [(0 if i % 3 else i % 17, i, rng.choice(odd) if i % 5 == 0 else f"t{i}") for i in range(3000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g int, o int, text string")
    key = F.concat_ws(":", "g", "o")
    writers.json_flat_stream(df, f"file://{tmp_path}/flat", "g", ["o"], key, "text")
    want = {f"{g}:{o}": t for g, o, t in rows}
    assert {r.key: r.text for r in readers.json_flat_stream(spark, f"file://{tmp_path}/flat").collect()} == want
    files, found, spread = sorted(glob.glob(f"{tmp_path}/flat/part-*")), [], set()
    for name in files:
        text, at, groups = open(name).read(), 0, []
        while text[at:].strip():
            value, end = json.JSONDecoder().raw_decode(text, at + (len(text[at:]) - len(text[at:].lstrip())))
            at = end
            assert len({k.split(":")[0] for k in value}) == 1  # an object holds one group
            groups.append(next(iter(value)).split(":")[0])
            found += value.items()
        assert len(groups) == len(set(groups))  # and a group is one object in a file
        spread |= {name} if "0" in groups else set()
    assert dict(found) == want and len(found) == len(rows) and len(spread) > 3
    empty = df.where("false")
    writers.json_flat_stream(empty, f"file://{tmp_path}/none", "g", ["o"], key, "text")
    assert readers.json_flat_stream(spark, f"file://{tmp_path}/none").count() == 0


def test_fixed_batches_of_words_are_not_sorted_by_batch(spark, tmp_path, many_partitions):
    rng = random.Random(4)
    texts = [rng.choice(["", " \n", None, *["word " * k for k in (1, 3, 99, 100, 101, 250, 430)]]) for _ in range(60)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    made = QUERIES["win_fixed_batches"](spark, str(tmp_path))
    keys = [f"{i}:{pos}" for i, text in enumerate(texts) for pos in range(len((text or "").split()))]
    wanted = [(k // 100, len(keys[k : k + 100]), keys[k], keys[k : k + 100][-1]) for k in range(0, len(keys), 100)]
    assert sorted((r.batch, r.n, r.first_key, r.last_key) for r in made.collect()) == wanted
    assert "SortAggregate" not in made._jdf.queryExecution().toString()  # which sorts all words of a task at once
