"""Readers for the corpus layouts; all return flat rows with explicit types."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def json_records(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """Files that are JSON arrays of records."""
    return spark.read.schema(schema).json(path, multiLine=True)


def json_nested(spark: SparkSession, path: str, schema: str | StructType, array: str, keep: Sequence[str] = ()) -> DataFrame:
    """Records with an array of structs, one row per element."""
    return spark.read.schema(schema).json(path).select(*keep, F.inline(array))


def json_flat_maps(spark: SparkSession, path: str) -> DataFrame:
    """Lines that are objects {"a:b": text}: (key, text)."""
    lines = spark.read.text(path)
    return lines.select(F.explode(F.from_json("value", "map<string,string>")).alias("key", "text"))


def json_flat_stream(spark: SparkSession, path: str) -> DataFrame:
    """(key, text) of the entries of ``writers.json_flat_stream``, a line each."""
    lines = spark.read.text(path).where("value != '}'")
    return lines.select(F.explode(F.from_json(F.concat(F.lit("{"), F.substring("value", 2, 2**31 - 1), F.lit("}")), "map<string,string>")).alias("key", "text"))


def json_nested_maps(spark: SparkSession, path: str, inner: str = "verses") -> DataFrame:
    """Lines that are objects {"a": {inner: {"b": text}}}: (outer, item, text)."""
    lines = spark.read.text(path).select(F.explode(F.from_json("value", f"map<string,struct<`{inner}`:map<string,string>>>")).alias("outer", "v"))
    return lines.select("outer", F.explode(F.col(f"v.`{inner}`")).alias("item", "text"))


def json_glob(spark: SparkSession, pattern: str, schema: str | StructType) -> DataFrame:
    """All files that match, with the file each row is from."""
    return spark.read.schema(schema).json(pattern).withColumn("file", F.col("_metadata.file_path"))


def csv_header(spark: SparkSession, path: str, schema: str | StructType | None = None) -> DataFrame:
    """CSV with a header; quoted cells may hold newlines and doubled quotes; a byte-order mark is ignored."""
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("lineSep", "\n")
    return (reader.schema(schema) if schema else reader).csv(path)


def csv_positional(spark: SparkSession, path: str, names: dict[int, str]) -> DataFrame:
    """CSV addressed by position: header names may repeat, so the header line is skipped and columns are picked by index."""
    rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("enforceSchema", True)
    width = len(spark.read.option("multiLine", True).option("escape", '"').csv(path).columns)
    rows = rows.schema(", ".join(f"_c{i} string" for i in range(width))).csv(path)
    return rows.select(*[F.col(f"_c{i}").alias(n) for i, n in names.items()])


def csv_bodies(df: DataFrame, body: str, keys: Sequence[str], names: dict[int, str]) -> DataFrame:
    """Rows of CSV texts in a column, such as exported sheets, addressed by position; each text's header line is skipped, and cells hold no newlines."""
    rows = df.select(*keys, F.posexplode(F.split(F.regexp_replace(F.col(body), "\\A\ufeff", ""), "\r?\n")).alias("__i", "__line")).where("__i > 0 and __line != ''")
    schema = ", ".join(f"_c{i} string" for i in range(max(names) + 1))
    parsed = rows.withColumn("__row", F.from_csv("__line", schema, {"escape": '"', "mode": "PERMISSIVE"}))
    return parsed.select(*keys, *[F.col(f"__row._c{i}").alias(n) for i, n in names.items()])


def lines(spark: SparkSession, path: str, comment: str = "#") -> DataFrame:
    """Text lines, without blank ones and comments."""
    return spark.read.text(path).where((F.trim("value") != "") & ~F.col("value").startswith(comment))


def whole_text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True)


def key_values(df: DataFrame, column: str) -> DataFrame:
    """'k=v' lines: split at the first '='."""
    parts = F.split(F.col(column), "=", 2)
    return df.where(F.contains(F.col(column), F.lit("="))).select(F.trim(parts[0]).alias("key"), F.trim(parts[1]).alias("value"))


def exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def optional(spark: SparkSession, paths: Sequence[str], schema: str | StructType) -> DataFrame:
    """The first Parquet path that exists, else an empty table."""
    for path in paths:
        if exists(spark, path):
            return spark.read.parquet(path)
    return spark.createDataFrame([], schema)


def catalog(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, column_name, ordinal) of the given tables."""
    spark = next(iter(tables.values())).sparkSession
    rows = [(t, c, i + 1) for t, df in tables.items() for i, c in enumerate(df.columns)]
    return spark.createDataFrame(rows, "table_name string, column_name string, ordinal int")
