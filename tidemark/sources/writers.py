"""Writers for the corpus layouts. Paths are on any file system Spark writes to."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def json_array(df: DataFrame, path: str, order: Sequence[str] = (), pretty: bool = False) -> None:
    """Each part file is one JSON array; non-ASCII characters stay. ``pretty`` indents by two spaces."""
    options = {"ignoreNullFields": "false", "pretty": "true" if pretty else "false"}
    value = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), options)
    if pretty:  # one level deeper, inside the array
        value = F.concat(F.lit("  "), F.replace(value, F.lit("\n"), F.lit("\n  ")))
    rows = (df.orderBy(*order) if order else df).select(value.alias("value"))

    def arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead = "["
        for batch in batches:
            values = batch.column(0).to_pylist()
            if values:
                yield pa.record_batch([pa.array([lead + values[0], *("," + v for v in values[1:])])], names=["value"])
                lead = ","
        yield pa.record_batch([pa.array(["]" if lead == "," else "[]"])], names=["value"])

    rows.mapInArrow(arrays, "value string").write.text(path)


def json_flat_maps(df: DataFrame, path: str, group: str, key: Column, text: str) -> None:
    """A line {"a:b": text, ...} per group."""
    entries = F.map_from_entries(F.array_sort(F.collect_list(F.struct(key.alias("k"), F.col(text).alias("v")))))
    df.groupBy(group).agg(F.to_json(entries).alias("value")).select("value").write.text(path)


def json_flat_stream(df: DataFrame, path: str, group: str, order: Sequence[str], key: Column, text: str) -> None:
    """Objects {"a:b": text, ...}, an entry per line, for groups of any size: no group is held in a row or a task.

    Rows are dealt by ranges of (group, order) and each task writes as it reads. A file is
    a sequence of JSON objects; a group that goes on in the next file goes on there as
    another object. ``readers.json_flat_stream`` reads line by line, so files split.
    """
    entry = F.to_json(F.create_map(key, F.col(f"`{text}`")), {"ignoreNullFields": "false"})
    by = [F.col(f"`{c}`") for c in (group, *order)]
    rows = df.repartitionByRange(*by).sortWithinPartitions(*by).select(F.col(f"`{group}`").cast("string").alias("g"), F.substring(entry, 2, F.length(entry) - 2).alias("e"))

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, begun = None, False
        for batch in batches:
            out = []
            for g, e in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if begun and g == last:
                    out.append("," + e)
                else:
                    out += ["}"] * begun + ["{" + e]
                last, begun = g, True
            yield pa.record_batch([pa.array(out, pa.string())], names=["value"])
        yield pa.record_batch([pa.array(["}"] * begun, pa.string())], names=["value"])

    rows.mapInArrow(lines, "value string").write.text(path)


def json_nested_maps(df: DataFrame, path: str, group: str, item: str, text: str, inner: str = "verses") -> None:
    """A line {"a": {inner: {"b": text, ...}}} per group."""
    entries = F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(item).cast("string").alias("k"), F.col(text).alias("v")))))
    nested = df.groupBy(F.col(group).cast("string").alias("g")).agg(entries.alias("m"))
    nested.select(F.to_json(F.create_map("g", F.struct(F.col("m").alias(inner)))).alias("value")).write.text(path)


def json_lines(df: DataFrame, path: str) -> None:
    """Minified JSON, a line per row."""
    df.write.option("ignoreNullFields", "false").json(path)


def csv_bom(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """CSV with header, fixed column order, and a byte-order mark before each part's header."""
    first, *rest = columns
    named = df.select(F.col(first).alias("﻿" + first), *rest)
    named.write.option("header", True).option("escape", '"').option("quoteAll", False).csv(path)


def array_cell(column: str | Column, separator: str = " | ") -> Column:
    return F.array_join(F.transform(column, lambda x: x.cast("string")), separator)


def append_csv(df: DataFrame, path: str) -> None:
    df.write.mode("append").option("header", True).option("escape", '"').csv(path)


def fan_out(df: DataFrame, writers: Sequence[Callable[[DataFrame], None]]) -> None:
    """One computed snapshot to several layouts."""
    df = df.persist()
    try:
        for write in writers:
            write(df)
    finally:
        df.unpersist()


def update_by_key(df: DataFrame, updates: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """The next snapshot of ``df`` with new values where ``updates`` (keys, column) has them."""
    new = updates.select(*keys, F.col(column).alias("__new"), F.lit(True).alias("__hit"))
    return df.join(new, list(keys), "left").withColumn(column, F.when(F.col("__hit"), F.col("__new")).otherwise(F.col(column))).select(*df.columns)


def update_like(df: DataFrame, column: str, old: str, new: str) -> tuple[DataFrame, Column]:
    """Literal replacement where the text holds it, and the predicate of the rows it changes."""
    return df.withColumn(column, F.replace(column, F.lit(old), F.lit(new))), F.contains(column, F.lit(old))


def split(df: DataFrame, sheets: dict[str, Sequence[str]], root: str) -> dict[str, str]:
    """One table as several: below ``root`` a folder per sheet with only its columns; returns their paths."""
    paths = {name: f"{root.rstrip('/')}/{name}" for name in sheets}
    fan_out(df, [lambda rows, n=name: rows.select(*sheets[n]).write.parquet(paths[n]) for name in sheets])
    return paths


def write_version(df: DataFrame, root: str, version: int) -> str:
    """A snapshot in a folder of its own; a version that exists is never overwritten."""
    path = f"{root.rstrip('/')}/version={version:08d}"
    df.write.mode("errorifexists").parquet(path)
    return path


def latest_version(spark, root: str) -> int:
    """The greatest version with a finished snapshot; 0 without any."""
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/version=*/_SUCCESS")
    found = fs_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(fs_path) or []
    return max((int(f.getPath().getParent().getName().partition("=")[2]) for f in found), default=0)


def next_version(current: Column) -> Column:
    """A snapshot version that only grows."""
    return F.coalesce(F.max(current), F.lit(0)) + 1


def markdown(df: DataFrame, group: str, order: str, line: Column) -> DataFrame:
    """(group, markdown): a heading and a bullet per row, in order."""
    items = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), line.alias("l")))), lambda x: F.concat(F.lit("- "), x["l"])), "\n")
    return df.groupBy(group).agg(items.alias("items")).select(group, F.concat(F.lit("## "), F.col(group).cast("string"), F.lit("\n\n"), "items").alias("markdown"))
