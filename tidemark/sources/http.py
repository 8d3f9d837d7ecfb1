"""Data sources over HTTP: numbered pages to read, in batch or as a stream, and rows to upsert into a service.

``http_pages`` fetches the pages ``first`` to ``last`` of a URL ``template`` with ``{}`` for
the number. Options: ``per_task`` pages in a partition, ``per_batch`` pages in a batch of
the stream, ``attempts``, ``timeout``, ``pause`` (seconds before the second attempt, doubled
after that), ``headers`` (JSON). A row per page: page, url, body, error; a page that keeps
failing has a null body. As a stream its offset is the next page, so a query that
starts again on its checkpoint goes on with the first page that is not committed;
:func:`land_pages` does that until the last page, and then fetches failed pages again.

``http_upsert`` sends rows to ``url``: each batch of ``batch`` rows by POST; where the
service answers 409 (it has some of the keys), by PUT, which replaces. An answer that got lost is
asked for again; since a repeated POST of known keys turns into a PUT, a replay of a
task, or of all, changes nothing. When all tasks are done, ``version_url`` gets a PATCH
with ``version`` and the number of rows: readers of the service take the new content by it, and
a failed write leaves the old version in force. :func:`differing` reads back.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.utils import AnalysisException


class Refused(Exception):
    """An answer that no further attempt changes."""

    def __init__(self, status: int, text: str):
        super().__init__(f"HTTP {status}: {text}")
        self.status = status


def call(method: str, url: str, body: bytes | None, headers: dict[str, str], timeout: float) -> str:
    """The text of an answer; answers from 400 to 499 but for 408 and 429 are :class:`Refused`."""
    request = urllib.request.Request(url, data=body, headers=headers, method=method)
    try:
        with urllib.request.urlopen(request, timeout=timeout) as answer:
            return answer.read().decode("utf-8")
    except urllib.error.HTTPError as e:
        if 400 <= e.code < 500 and e.code not in (408, 429):
            raise Refused(e.code, e.reason) from None
        raise


def persistent(do: Callable[[], str], attempts: int, pause: float) -> str:
    """The result of the first attempt that does not fail; the last failure is raised, a refusal at once."""
    for n in range(attempts):
        try:
            return do()
        except Refused:
            raise
        except Exception:
            if n + 1 == attempts:
                raise
            time.sleep(pause * 2**n)
    raise ValueError("no attempts")


class _Call:
    """How to call, from a source's options."""

    def __init__(self, options: dict):
        self.attempts, self.pause = int(options.get("attempts", 3)), float(options.get("pause", 1.0))
        self.timeout = float(options.get("timeout", 25.0))
        self.headers = {"User-Agent": "Mozilla/5.0", **json.loads(options.get("headers", "{}"))}

    def __call__(self, method: str, url: str, value=None) -> str:
        headers = self.headers if value is None else {**self.headers, "Content-Type": "application/json"}
        body = None if value is None else json.dumps(value, ensure_ascii=False).encode()
        return persistent(lambda: call(method, url, body, headers, self.timeout), self.attempts, self.pause)


# ------------------------------------------------------------------ pages


class _Pages(InputPartition):
    def __init__(self, first: int, end: int):
        self.first, self.end = first, end


def _fetched(options: dict, numbers: range) -> Iterator[tuple]:
    ask = _Call(options)
    for page in numbers:
        url = options["template"].replace("{}", str(page))
        try:
            yield page, url, ask("GET", url), None
        except Exception as e:  # a page's failure is its own row's
            yield page, url, None, f"{type(e).__name__}: {e}"


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self):
        first, end, step = int(self.options["first"]), int(self.options["last"]) + 1, int(self.options.get("per_task", 16))
        return [_Pages(i, min(i + step, end)) for i in range(first, end, step)] or [_Pages(first, first)]

    def read(self, partition):
        return _fetched(self.options, range(partition.first, partition.end))


class _StreamReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.options = options
        self.next = int(options.get("from", options["first"]))  # what is known to be landed ends here

    def initialOffset(self):
        return {"page": int(self.options["first"])}

    def latestOffset(self):
        return {"page": max(self.next, min(self.next + int(self.options.get("per_batch", 1024)), int(self.options["last"]) + 1))}

    def partitions(self, start, end):
        self.next = end["page"]
        step = int(self.options.get("per_task", 16))
        return [_Pages(i, min(i + step, end["page"])) for i in range(start["page"], end["page"], step)]

    def read(self, partition):
        return _fetched(self.options, range(partition.first, partition.end))


class HttpPages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "http_pages"

    def schema(self) -> str:
        return "page long, url string, body string, error string"

    def reader(self, schema):
        return _Reader(dict(self.options))

    def streamReader(self, schema):
        return _StreamReader(dict(self.options))


def pages(spark: SparkSession, **options) -> DataFrame:
    """The pages of a template, in one go."""
    spark.dataSource.register(HttpPages)
    return spark.read.format("http_pages").options(**options).load()


def _table(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException:  # nothing is landed yet
        return None


def landed(spark: SparkSession, target: str) -> DataFrame:
    """The pages of :func:`land_pages`, each once: as it came, or else its last error."""
    rows = _table(spark, f"{target}/pages")
    if (again := _table(spark, f"{target}/again")) is not None:
        rows = rows.unionByName(again)
    best = F.max_by(F.struct("url", "body", "error"), F.struct(F.col("error").isNull(), F.col("round")))
    return rows.groupBy("page").agg(best.alias("r")).select("page", "r.*")


def land_pages(spark: SparkSession, target: str, first: int, last: int, rounds: int = 2, **options) -> DataFrame:
    """Land all pages below ``target`` and return :func:`landed`; a call after a failure goes on where the last one stopped.

    Batches of the stream are committed one by one. Pages that failed are fetched again in up to ``rounds`` rounds.
    """
    spark.dataSource.register(HttpPages)
    options |= {"first": first, "last": last}
    while True:
        done = _table(spark, f"{target}/pages")
        upto = None if done is None else done.agg(F.max("page")).first()[0]
        upto = first if upto is None else upto + 1
        if upto > last:
            break
        stream = spark.readStream.format("http_pages").options(**options, **{"from": upto}).load().withColumn("round", F.lit(0))
        query = stream.writeStream.format("parquet").option("path", f"{target}/pages").option("checkpointLocation", f"{target}/progress").trigger(availableNow=True).start()
        query.awaitTermination()
    for n in range(1, rounds + 1):
        failed = landed(spark, target).where("error IS NOT NULL").select("page")
        if failed.isEmpty():
            break
        fetch = dict(options)

        def again(batches: Iterator, fetch=fetch, n=n) -> Iterator:
            import pyarrow as pa

            for batch in batches:
                rows = [(*row, n) for page in batch.column(0).to_pylist() for row in _fetched(fetch, range(page, page + 1))]
                columns = zip(*rows) if rows else [[]] * 5
                yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int32()))], names=["page", "url", "body", "error", "round"])

        failed.mapInArrow(again, "page long, url string, body string, error string, round int").write.mode("append").parquet(f"{target}/again")
    return landed(spark, target)


# ------------------------------------------------------------------ upserts


class _Sent(WriterCommitMessage):
    def __init__(self, rows: int):
        self.rows = rows


class _Writer(DataSourceWriter):
    def __init__(self, options: dict):
        self.options = options

    def write(self, iterator):
        ask, size, url = _Call(self.options), int(self.options.get("batch", 500)), self.options["url"]
        rows, held = 0, []

        def send() -> None:
            try:
                ask("POST", url, held)
            except Refused as e:
                if e.status != 409:
                    raise
                ask("PUT", url, held)

        for row in iterator:
            held.append(row.asDict(recursive=True))
            if len(held) == size:
                send()
                rows, held = rows + size, []
        if held:
            send()
        return _Sent(rows + len(held))

    def commit(self, messages):
        if where := self.options.get("version_url"):
            _Call(self.options)("PATCH", where, {"version": self.options["version"], "rows": sum(m.rows for m in messages if m)})

    def abort(self, messages):
        """Nothing is taken back: the version that readers ask for is still the old one, and the next write replaces the rows."""


class HttpUpsert(DataSource):
    @classmethod
    def name(cls) -> str:
        return "http_upsert"

    def writer(self, schema, overwrite):
        return _Writer(dict(self.options))


def upsert(df: DataFrame, url: str, **options) -> None:
    """Send all rows, whose columns JSON can hold; of rows with equal keys only one should be left (``relational.last_wins``)."""
    df.sparkSession.dataSource.register(HttpUpsert)
    df.write.format("http_upsert").options(url=url, **options).mode("append").save()


def differing(df: DataFrame, key: str, value: str, live: DataFrame) -> DataFrame:
    """``key, mine, live``: keys whose values differ between ``df`` and what a service gives back (key, value), or that one side lacks."""
    mine = df.select(F.col(key).cast("string").alias("key"), F.col(value).alias("mine"), F.lit(True).alias("here"))
    theirs = live.select(F.col("key").cast("string"), F.col("value").alias("live"), F.lit(True).alias("there"))
    both = mine.join(theirs, "key", "full")
    return both.where(F.col("here").isNull() | F.col("there").isNull() | ~F.col("mine").eqNullSafe(F.col("live"))).select("key", "mine", "live")
