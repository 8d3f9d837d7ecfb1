"""Incremental runs: resume by key, by cursor, or as a file stream with a checkpoint.

The reference capability is batch resume; the stream is its natural form in Spark.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.functions import fixed_values as V


def pending(items: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys are not in ``done`` yet."""
    return items.join(done.select(*keys).distinct(), list(keys), "left_anti")


def next_batches(batched: DataFrame, cursor: int, n: int, batch: str = "batch") -> DataFrame:
    """The ``n`` batches from ``cursor`` on."""
    return batched.where((F.col(batch) >= cursor) & (F.col(batch) < cursor + n))


def run_available(spark: SparkSession, source: str, schema: str, checkpoint: str, target: str, transform: Callable[[DataFrame], DataFrame], files_per_trigger: int = 64) -> None:
    """Process the files that are new since the last call, exactly once, and append to ``target``."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(source)
    query = transform(stream).writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def needs_work(mode: str, done: bool, status: str, version: str | None, current: str, key: str) -> bool:
    """``rules.rework_needed`` for the state of one key."""
    rejected, optimized = "REJECTED" in status, status == V.SPACING_CHANGED
    again = version != current and (optimized or rejected)
    if mode in ("rejected", "mismatches"):
        return rejected
    if mode in ("both", "targets", "yes", "true"):
        return again
    if mode == "optimized":
        return version != current and optimized
    if mode == "all":
        return not done or again
    return key in mode.split(",") if ":" in mode else not done


def run_keyed(spark: SparkSession, source: str, schema: str, keys: Sequence[str], outcome: Callable[[DataFrame], DataFrame], checkpoint: str, target: str, current: str, mode: str = "", files_per_trigger: int = 64) -> list[dict]:
    """Process what is asked for in new files and not done yet, by a state of one small row per key; returns the progress of the batches.

    ``source`` gets files of requests, a key as often as one likes. ``outcome`` adds a
    ``status`` to requests. Those of keys that need work in this ``mode`` (as in
    ``rules.rework_needed``) are appended to ``target`` as (keys, status, version), each
    exactly once, and their keys remember status and version ``current``. A run that
    stops goes on where it was; the history is never read again. Of several requests of
    a key in a batch the one with the greatest status counts; null keys are keys.
    """
    kinds = {f.name: f.dataType.simpleString() for f in spark.createDataFrame([], schema).schema}
    columns = list(keys)

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        status = max(s for frame in frames for s in frame["status"].fillna(""))
        done, before, version = state.get if state.exists else (False, "", None)
        if needs_work(mode, done, before, version, current, ":".join(map(str, key))):
            state.update((True, status, current))
            yield pd.DataFrame([[*key, status, current]], columns=[*columns, "status", "version"])

    out = ", ".join([f"`{k}` {kinds[k]}" for k in keys] + ["status string", "version string"])
    stream = outcome(spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(source)).select(*columns, "status")
    kept = stream.groupBy(*columns).applyInPandasWithState(step, out, "processed boolean, status string, version string", "append", GroupStateTimeout.NoTimeout)
    query = kept.writeStream.outputMode("append").format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return [json.loads(p.json) for p in query.recentProgress]
