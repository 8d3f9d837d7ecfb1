"""Sources and sinks: each query writes a layout to a scratch folder and reads it back."""

from __future__ import annotations

import sqlite3
import tempfile
import uuid
from contextlib import closing

from pyspark.sql import functions as F

from tidemark.functions import text as T
from tidemark.operators import relational as R
from tidemark.plans.registry import query
from tidemark.scratch import folder, put
from tidemark.sources import landing, readers, snapshots, writers
from tidemark.streaming import resume

TURNS = "SELECT conv_id, turn, role, text FROM conversations"
KEYED = "SELECT conv_id || ':' || turn AS key, text FROM conversations"
NATIONS = "SELECT n_nationkey, n_name, n_regionkey FROM nation"
TURN_SCHEMA = "conv_id long, turn long, role string, text string"


@query("scan_json_records", TURNS)
def _(t):
    writers.json_array(t.conversations, path := folder(t.spark, "array"), pretty=True)
    return readers.json_records(t.spark, path, TURN_SCHEMA)


query("sink_json_array", TURNS)(_)


@query("scan_json_nested", TURNS)
def _(t):
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns")
    writers.json_lines(t.conversations.groupBy("conv_id").agg(turns), path := folder(t.spark, "nested"))
    return readers.json_nested(t.spark, path, "conv_id long, turns array<struct<turn:long,role:string,text:string>>", "turns", ["conv_id"])


@query("scan_json_flatmap", KEYED)
def _(t):
    writers.json_flat_maps(t.conversations, path := folder(t.spark, "flat"), "conv_id", R.build_key(F.col("conv_id"), F.col("turn")), "text")
    return readers.json_flat_maps(t.spark, path)


query("sink_json_flatmap", KEYED)(_)


@query("sink_json_flat_stream", KEYED)
def _(t):
    writers.json_flat_stream(t.conversations, path := folder(t.spark, "flat-stream"), "conv_id", ["turn"], R.build_key(F.col("conv_id"), F.col("turn")), "text")
    return readers.json_flat_stream(t.spark, path)


@query("scan_json_nestedmap", "SELECT CAST(conv_id AS VARCHAR) AS \"outer\", CAST(turn AS VARCHAR) AS item, text FROM conversations")
def _(t):
    writers.json_nested_maps(t.conversations, path := folder(t.spark, "nested-map"), "conv_id", "turn", "text")
    return readers.json_nested_maps(t.spark, path)


query("sink_json_nestedmap", "SELECT CAST(conv_id AS VARCHAR) AS \"outer\", CAST(turn AS VARCHAR) AS item, text FROM conversations")(_)


@query("scan_json_poly", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def _(t):
    shape = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("["), F.col("props"), F.lit("]"))).otherwise(F.col("props"))
    items = t.events.select("event_id", F.explode(T.json_items(shape)).alias("v"))
    return items.select("event_id", F.try_variant_get("v", "$.k", "bigint").alias("k"))


@query("scan_glob", "SELECT n_nationkey, n_name, true AS named FROM nation")
def _(t):
    t.nation.repartition(3, "n_nationkey").write.json(path := folder(t.spark, "glob"))
    rows = readers.json_glob(t.spark, f"{path}/*.json", "n_nationkey int, n_name string, n_regionkey int")
    return rows.select("n_nationkey", "n_name", F.col("file").endswith(".json").alias("named"))


@query("scan_csv_header", TURNS)
def _(t):
    writers.csv_bom(t.conversations, path := folder(t.spark, "csv"), ["conv_id", "turn", "role", "text"])
    return readers.csv_header(t.spark, path, TURN_SCHEMA)


query("sink_csv_bom", TURNS)(_)


@query("scan_csv_positional", "SELECT CAST(n_nationkey AS VARCHAR) AS k, n_name AS name FROM nation")
def _(t):
    t.nation.select("n_nationkey", F.lit("").alias("comments"), "n_name").write.option("header", True).csv(path := folder(t.spark, "positional"))
    return readers.csv_positional(t.spark, path, {0: "k", 2: "name"})


@query("scan_sqlite", NATIONS)
def _(t):
    from tidemark.sources import sqlite

    path = f"{folder(t.spark, 'sqlite')}/dim-{uuid.uuid4().hex}.db"  # executors keep files by name
    with tempfile.TemporaryDirectory() as local:
        with closing(sqlite3.connect(f"{local}/dim.db")) as db, db:  # a dimension of 25 rows
            db.execute("CREATE TABLE nation (n_nationkey INTEGER, n_name TEXT, n_regionkey INTEGER)")
            db.executemany("INSERT INTO nation VALUES (?, ?, ?)", [tuple(r) for r in t.nation.select("n_nationkey", "n_name", "n_regionkey").toLocalIterator()])
        put(t.spark, f"{local}/dim.db", path)
    rows = sqlite.read(t.spark, path, "nation")
    return rows.select(F.col("n_nationkey").cast("int"), "n_name", F.col("n_regionkey").cast("int"))


@query("scan_catalog", "SELECT * FROM (VALUES ('nation', 'n_nationkey', 1), ('nation', 'n_name', 2), ('nation', 'n_regionkey', 3), ('region', 'r_regionkey', 1), ('region', 'r_name', 2)) v(table_name, column_name, ordinal)")
def _(t):
    return readers.catalog({"nation": t.nation, "region": t.region})


def _landed(df, key: str, body: str, kind: str):
    """Bodies fetched from URLs; the test tables have no servers, so the URLs carry their data."""
    urls = df.select(key, F.concat(F.lit(f"data:{kind};base64,"), F.base64(F.encode(body, "UTF-8"))).alias("url"))
    return landing.land(urls, keys=[key], per_minute=60_000_000)


@query("scan_http_html", "SELECT page_id, url, length(html) AS size FROM pages")
def _(t):
    bodies = _landed(t.pages.select("page_id", "html"), "page_id", "html", "text/html").select("page_id", F.length("body").cast("long").alias("size"))
    return t.pages.select("page_id", "url").join(bodies, "page_id")


@query("scan_http_json", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def _(t):
    return _landed(t.events.select("event_id", "props"), "event_id", "props", "application/json").select("event_id", F.from_json("body", "k long")["k"].alias("k"))


@query("sink_http_upsert", "SELECT n_nationkey, n_name = 'nobody' AS failed FROM nation")
def _(t):
    rows = t.nation.select("n_nationkey", "n_name")
    sent = landing.push(rows, ["n_nationkey"], "n_name", lambda target, rows: None, "memory://sink")  # a service that takes everything
    return sent.select("n_nationkey", F.col("error").isNotNull().alias("failed"))


@query("rate_limit", "SELECT n_nationkey, CAST(n_nationkey * 6 AS DOUBLE) AS begins FROM nation")
def _(t):
    begins = F.array(*map(F.lit, landing.schedule(25, 10, 6.0)))  # ten calls a minute, six seconds apart
    return t.nation.select("n_nationkey", F.get(begins, F.col("n_nationkey")).alias("begins"))


@query("scan_http_csv", "SELECT CAST(r_regionkey AS VARCHAR) AS k, r_name AS name FROM region")
def _(t):
    sheet = F.concat(F.lit("key,name,name\n"), F.to_csv(F.struct("r_regionkey", "r_name", F.lit("x, y").alias("c"))), F.lit("\n"))
    bodies = _landed(t.region.select("r_regionkey", sheet.alias("csv")), "r_regionkey", "csv", "text/csv")
    return readers.csv_bodies(bodies, "body", [], {0: "k", 1: "name"})


@query("scan_lines_comment", "SELECT n_name AS value FROM nation WHERE n_nationkey % 3 = 1")
def _(t):
    shape = F.col("n_nationkey") % 3
    t.nation.select(F.when(shape == 0, F.concat(F.lit("# "), "n_name")).when(shape == 1, F.col("n_name")).otherwise("").alias("value")).write.text(path := folder(t.spark, "lines"))
    return readers.lines(t.spark, path)


@query("scan_wholetext", "SELECT string_agg(r_name || chr(10), '' ORDER BY r_regionkey) AS value FROM region")
def _(t):
    t.region.coalesce(1).orderBy("r_regionkey").coalesce(1).select("r_name").write.text(path := folder(t.spark, "whole"))
    return readers.whole_text(t.spark, path)


@query("scan_kv_env", "SELECT event_type || event_id AS key, 'a=' || props AS value FROM events")
def _(t):
    lines = t.events.select(F.concat("event_type", F.col("event_id").cast("string"), F.lit(" = a="), "props").alias("line"))
    return readers.key_values(lines, "line")


@query("scan_optional", NATIONS)
def _(t):
    return readers.optional(t.spark, [folder(t.spark, "none"), f"{t.sf_dir}/nation.parquet"], "n_nationkey int, n_name string, n_regionkey int")


@query("sink_json_min", NATIONS)
def _(t):
    writers.json_lines(t.nation, path := folder(t.spark, "min"))
    return t.spark.read.schema("n_nationkey int, n_name string, n_regionkey int").json(path)


@query("sink_csv_array_cell", "SELECT l_orderkey, string_agg(l_partkey, ' | ' ORDER BY l_partkey) AS parts FROM lineitem GROUP BY l_orderkey")
def _(t):
    return t.lineitem.groupBy("l_orderkey").agg(writers.array_cell(F.array_sort(F.collect_list("l_partkey"))).alias("parts"))


@query("sink_csv_append", f"{NATIONS} UNION ALL {NATIONS}")
def _(t):
    path = folder(t.spark, "append")
    writers.append_csv(t.nation, path)
    writers.append_csv(t.nation, path)
    return readers.csv_header(t.spark, path, "n_nationkey int, n_name string, n_regionkey int")


@query("sink_split", "SELECT n_nationkey AS a, n_name AS b, 'full' AS sheet FROM nation UNION ALL SELECT n_nationkey, NULL, 'single' FROM nation")
def _(t):
    rows = t.nation.select(F.col("n_nationkey").alias("a"), F.col("n_name").alias("b"))
    paths = writers.split(rows, {"full": ["a", "b"], "single": ["a"]}, folder(t.spark, "split"))
    full, single = (t.spark.read.parquet(paths[n]) for n in ("full", "single"))
    return full.withColumn("sheet", F.lit("full")).unionByName(single.select("a", F.lit(None).cast("string").alias("b"), F.lit("single").alias("sheet")))


@query("sink_fanout", "SELECT 2 * CAST(count(*) AS BIGINT) AS n FROM nation")
def _(t):
    a, b = folder(t.spark, "fan-a"), folder(t.spark, "fan-b")
    writers.fan_out(t.nation, [lambda df: df.write.parquet(a), lambda df: writers.json_lines(df, b)])
    return t.spark.read.parquet(a).select("n_name").union(t.spark.read.json(b).select("n_name")).agg(F.count(F.lit(1)).alias("n"))


@query("sink_update_by_key", "SELECT doc_id, CASE WHEN quality = 0 THEN 'low' ELSE lang END AS lang FROM documents LEFT JOIN labels USING (doc_id)")
def _(t):
    updates = t.labels.where("quality = 0").select("doc_id", F.lit("low").alias("lang"))
    return writers.update_by_key(t.documents.select("doc_id", "lang"), updates, ["doc_id"], "lang")


@query("sink_update_parts", "SELECT doc_id, CASE WHEN quality = 0 THEN 'low' ELSE lang END AS lang FROM documents LEFT JOIN labels USING (doc_id)")
def _(t):
    path = folder(t.spark, "snapshot")
    snapshots.write(t.documents.select("doc_id", "lang"), path, ["doc_id"], 16)
    updates = t.labels.where("quality = 0").select("doc_id", F.lit("low").alias("lang"))
    for _ in range(2):  # the second finds nothing to change
        snapshots.update(t.spark, path, updates, ["doc_id"], "lang", 16)
    return snapshots.read(t.spark, path)


@query("sink_update_like", "SELECT CAST(count(*) AS BIGINT) AS n, CAST(count_if(contains(text, 'the ')) AS BIGINT) AS changed, CAST(sum(length(replace(text, 'the ', 'DER '))) AS BIGINT) AS chars FROM documents")
def _(t):
    updated, hit = writers.update_like(t.documents, "text", "the ", "DER ")
    return t.documents.agg(F.count(F.lit(1)).alias("n"), F.count_if(hit).alias("changed")).crossJoin(F.broadcast(updated.agg(F.sum(F.length("text")).alias("chars"))))  # one row each


@query("sink_checkpoint_atomic", "SELECT doc_id, quality = 1 AS is_processed FROM labels")
def _(t):
    source, target, done = folder(t.spark, "in"), folder(t.spark, "out"), folder(t.spark, "progress")
    t.labels.write.parquet(source)
    for _ in range(2):  # the second call finds nothing new
        resume.run_available(t.spark, source, "doc_id long, quality int, toxic int", done, target, lambda df: df.select("doc_id", (F.col("quality") == 1).alias("is_processed")))
    return t.spark.read.parquet(target)


query("inc_flush", "SELECT doc_id, quality = 1 AS is_processed FROM labels")(_)


KEYED_STATUS = "CASE WHEN toxic = 1 THEN 'REJECTED_CHARACTER_MISMATCH' WHEN quality = 1 THEN 'SPACING_OPTIMIZED' ELSE 'CLEAN' END"


@query("inc_resume_state", f"""WITH s AS (SELECT doc_id, {KEYED_STATUS} AS status FROM labels)
SELECT doc_id, status, 'v1' AS version FROM s UNION ALL SELECT doc_id, status, 'v2' FROM s WHERE contains(status, 'REJECTED') OR status = 'SPACING_OPTIMIZED'""")
def _(t):
    source, target, done = folder(t.spark, "asked"), folder(t.spark, "kept"), folder(t.spark, "state")
    status = lambda df: df.withColumn("status", F.expr(KEYED_STATUS))
    asked = t.labels.select("doc_id", "quality", "toxic")
    for version, mode, rows in (("v1", "", asked.where("quality = 1")), ("v1", "", asked), ("v2", "both", asked), ("v2", "all", asked)):  # new ones, the rest, re-work by version, nothing left
        rows.write.mode("append").parquet(source)
        resume.run_keyed(t.spark, source, "doc_id long, quality int, toxic int", ["doc_id"], status, done, target, version, mode)
    return t.spark.read.parquet(target)


@query("sink_version_bump", "SELECT CAST(max(turn) AS BIGINT) + 1 AS version, 'userVersion = ' || (max(turn) + 1) || ';' AS line FROM conversations")
def _(t):
    root = folder(t.spark, "versions")
    current = t.conversations.agg(F.max("turn").alias("v")).first().v
    writers.write_version(t.conversations.select("conv_id", "turn"), root, current)
    bumped = writers.latest_version(t.spark, root) + 1
    writers.write_version(t.conversations.select("conv_id", "turn"), root, bumped)
    line = F.regexp_replace(F.lit("userVersion = 7;"), F.lit(r"(userVersion\s*=\s*)\d+"), F.concat(F.lit("$1"), F.col("version").cast("string")))
    return t.spark.range(1).select(F.lit(writers.latest_version(t.spark, root)).cast("long").alias("version")).select("version", line.alias("line"))


@query("sink_markdown", "SELECT n_regionkey, '## ' || n_regionkey || chr(10) || chr(10) || string_agg('- ' || n_name, chr(10) ORDER BY n_nationkey) AS markdown FROM nation GROUP BY n_regionkey")
def _(t):
    return writers.markdown(t.nation, "n_regionkey", "n_nationkey", F.col("n_name"))
