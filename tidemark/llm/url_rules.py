"""URL filters as a sort-merge range join (native DataFrame functions only).

A rule (host, path) fits its host and all subdomains when the URL's path starts
with the rule's path; the longest fitting rule decides. Each URL is looked up
under every suffix of its host that has rules. Within one suffix, the key
``reversed host, U+0001, path`` turns a rule into the interval of keys that it
prefixes. Prefix intervals nest or are disjoint, so one sorted sweep over rule
openings, rule closings and URLs suffices: the running count of open rules is
the height of the stack, and the rule on top is the last one opened at that height.

The sorted sequence of all events is dealt by ranges of (suffix, key, host), so a
hot suffix, and even a hot key, spreads over as many parts as its share asks for,
and no rule is repeated per part. A part begins with the rules that are still open
where it starts: those of its first suffix whose keys are prefixes of its first
key. These are found by joining its prefixes, no longer than the longest rule, with the
rules' keys, and their number is the nesting depth.

Nulls and edge cases: a null URL or one without ``://`` has host and path ``''``.
Repeated rows stay. Of rules with equal host and path, ``block`` wins. With no
rule the verdict is ``default``. Extra input columns are dropped.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import scratch

OPEN, POINT, CLOSE = 1, 2, 3
SEPARATOR = "\u0001"
ALLOW, BLOCK = "allow", "block"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def rule_table(spark: SparkSession, rules: Iterable[tuple[str, str, str]]) -> DataFrame:
    """(verdict, host, path) triples as a DataFrame of literals."""
    rows = [F.struct(*[F.lit(x).cast("string").alias(n) for n, x in zip(("verdict", "host", "path"), r)]) for r in rules]
    kind = "array<struct<verdict:string,host:string,path:string>>"
    return spark.range(1).select(F.inline(F.array(*rows).cast(kind)))


def split_url(url) -> tuple:
    """Columns (host, path) of a URL column."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    raw = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(raw) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(raw, _UPPER, _LOWER), path


def _reversed(host):
    return F.array_join(F.reverse(F.split(host, r"\.")), ".")


def judge(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = ALLOW) -> DataFrame:
    """Return ``key, host, path, rule, verdict`` for every row of ``pages``."""
    spark = pages.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    host, path = split_url(F.col(url))
    rows = pages.select(F.col(key).alias(key), host.alias("host"), path.alias("path"))

    kept = (
        rules.where(F.col("host").isNotNull() & F.col("verdict").isin(ALLOW, BLOCK))
        .groupBy(F.translate("host", _UPPER, _LOWER).alias("suffix"), F.coalesce("path", F.lit("")).alias("rule_path"))
        .agg(F.max("verdict").alias("verdict"))  # 'block' sorts after 'allow'
        .select("suffix", "rule_path", "verdict", F.concat(_reversed(F.col("suffix")), F.lit(SEPARATOR), "rule_path").alias("pos"))
    )
    kept = scratch.cut(kept, "rules")  # of known size, so the optimizer can choose to broadcast it
    labels = F.split("host", r"\.")
    looked_up = (
        rows.where("host != ''")
        .select("host", "path")
        .distinct()
        .withColumn("labels", labels)
        .withColumn("k", F.explode(F.sequence(F.lit(1), F.size("labels"))))
        .withColumn("suffix", F.array_join(F.slice("labels", F.col("k"), F.size("labels")), "."))
        .drop("labels", "k")
        .join(kept.select("suffix"), "suffix", "left_semi")
    )
    none = F.lit(None).cast("string")
    points = looked_up.select(
        "suffix", F.concat(_reversed(F.col("suffix")), F.lit(SEPARATOR), "path").alias("pos"), F.lit(POINT).alias("kind"), "host", "path", none.alias("rule"), none.alias("verdict")
    )
    opens = kept.select("suffix", "pos", F.lit(OPEN).alias("kind"), F.lit("").alias("host"), none.alias("path"), F.concat("suffix", "rule_path").alias("rule"), "verdict")
    # A key that starts with "pos" is below pos || U+10FFFF U+10FFFF in byte order.
    closes = kept.select("suffix", F.concat("pos", F.lit("\U0010ffff" * 2)).alias("pos"), F.lit(CLOSE).alias("kind"), F.lit("").alias("host"), none.alias("path"), none.alias("rule"), none.alias("verdict"))

    order = ["suffix", "pos", "kind", "host"]
    events = points.unionByName(opens).unionByName(closes).repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id())
    events = scratch.cut(events, "events")  # what stands in a part must not change any more
    starts = events.groupBy("part").agg(F.min(F.struct("suffix", "pos", "kind")).alias("at"))  # a row per part
    starts = starts.select("part", F.col("at.suffix").alias("suffix"), F.col("at.pos").alias("first"), F.col("at.kind").alias("first_kind"))
    begun = (F.col("pos") < F.col("first")) | ((F.col("pos") == F.col("first")) & (F.col("first_kind") > OPEN))
    longest = kept.agg(F.coalesce(F.max(F.length("pos")), F.lit(0)).alias("longest"))  # one row
    lengths = F.sequence(F.lit(0), F.least(F.length("first"), "longest"))
    prefixes = starts.crossJoin(F.broadcast(longest)).withColumn("n", F.explode(lengths)).select("part", "suffix", "first", "first_kind", F.expr("left(first, n)").alias("pos"))
    still = kept.join(prefixes, ["suffix", "pos"]).where(begun)  # a part's first key has as many prefixes as characters, not as rules
    still = still.select("suffix", "pos", F.lit(OPEN).alias("kind"), F.lit("").alias("host"), none.alias("path"), F.concat("suffix", "rule_path").alias("rule"), "verdict", "part")

    step = F.when(F.col("kind") == OPEN, 1).when(F.col("kind") == CLOSE, -1).otherwise(0)
    sweep = Window.partitionBy("part", "suffix").orderBy("pos", "kind", F.length("pos")).rowsBetween(Window.unboundedPreceding, 0)
    level = Window.partitionBy("part", "suffix", "height").orderBy("pos", "kind").rowsBetween(Window.unboundedPreceding, 0)
    opened = F.when(F.col("kind") == OPEN, F.struct("rule", "verdict"))
    found = (
        events.unionByName(still)
        .repartition(parts, "part", "suffix")
        .withColumn("height", F.sum(step).over(sweep))
        .where((F.col("kind") != CLOSE) & (F.col("height") > 0))
        .withColumn("top", F.last(opened, ignorenulls=True).over(level))
        .where(F.col("kind") == POINT)
        .groupBy("host", "path")
        .agg(F.max_by("top", F.struct(F.length("top.rule"), F.col("top.verdict"), F.col("top.rule"))).alias("top"))
    )
    found = scratch.cut(found, "fits")  # read plainly, so that a hot URL's rows can be split
    scratch.drop(events)
    scratch.drop(kept)
    return rows.join(found.hint("merge"), ["host", "path"], "left").select(  # it grows with the pages, so it is never broadcast
        key,
        "host",
        "path",
        F.col("top.rule").alias("rule"),
        F.coalesce(F.col("top.verdict"), F.lit(default)).alias("verdict"),
    )
