"""HTTP sources against a local server that fails, delays, repeats, and drops answers."""

import json
import threading
import time
from collections import Counter
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlparse

import pytest
from pyspark.sql import functions as F

from tidemark.sources import http


class Service:
    """Pages by number, and rows by key; ``broken`` pages fail, others fail at first."""

    def __init__(self):
        self.calls, self.rows, self.version, self.log = Counter(), {}, {}, []
        self.broken, self.flaky, self.slow, self.lossy = set(), set(), set(), 0
        self.lock = threading.Lock()
        service = self

        class Handler(BaseHTTPRequestHandler):
            def log_message(self, *args):
                pass

            def answer(self, status, text=""):
                body = text.encode()
                self.send_response(status)
                self.send_header("Content-Length", str(len(body)))
                self.end_headers()
                self.wfile.write(body)

            def do_GET(self):
                path = urlparse(self.path)
                if path.path == "/rows":
                    chunk = int(parse_qs(path.query)["chunk"][0])
                    return self.answer(200, json.dumps([{"key": str(k), "value": v} for k, v in service.rows.items() if k % 3 == chunk]))
                page = int(path.path.rsplit("/", 1)[1])
                with service.lock:
                    service.calls[page] += 1
                    n = service.calls[page]
                if page in service.slow:
                    time.sleep(0.3)
                if page in service.broken or (page in service.flaky and n == 1):
                    return self.answer(404 if page % 2 else 503)
                self.answer(200, f"หน้า {page}")

            def body(self):
                return json.loads(self.rfile.read(int(self.headers["Content-Length"])))

            def do_POST(self):
                rows = self.body()
                with service.lock:
                    known = [r for r in rows if r["k"] in service.rows]
                    service.log.append(("POST", len(rows)))
                    if any(r["v"] == "poison" for r in rows):
                        return self.answer(422)
                    if known:
                        return self.answer(409)
                    service.rows.update({r["k"]: r["v"] for r in rows})
                    service.lossy -= 1
                    lost = service.lossy >= 0
                if lost:  # taken, but the caller never hears of it
                    return self.connection.close()
                self.answer(201)

            def do_PUT(self):
                rows = self.body()
                with service.lock:
                    service.log.append(("PUT", len(rows)))
                    service.rows.update({r["k"]: r["v"] for r in rows})
                self.answer(200)

            def do_PATCH(self):
                service.version = self.body()
                self.answer(204)

        self.server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        self.url = f"http://127.0.0.1:{self.server.server_address[1]}"
        threading.Thread(target=self.server.serve_forever, daemon=True).start()


@pytest.fixture
def service():
    made = Service()
    yield made
    made.server.shutdown()


def test_pages_in_batch(spark, service):
    service.flaky, service.broken, service.slow = {4, 6}, {5, 8}, {1}
    got = http.pages(spark, template=f"{service.url}/page/{{}}", first=1, last=9, per_task=2, attempts=2, pause=0.01, timeout=5)
    assert got.rdd.getNumPartitions() == 5
    rows = {r.page: (r.body, r.error) for r in got.collect()}
    assert set(rows) == set(range(1, 10)) and {p for p, (b, e) in rows.items() if e} == {5, 8}
    assert rows[4] == ("หน้า 4", None) and rows[8][0] is None and "503" in rows[8][1] and "404" in rows[5][1]
    assert service.calls[4] == 2 and service.calls[8] == 2 and service.calls[5] == 1  # a refusal is not repeated
    assert http.pages(spark, template=f"{service.url}/page/{{}}", first=3, last=2).count() == 0
    assert http.pages(spark, template=f"{service.url}/page/{{}}", first=1, last=1, timeout=0.05, attempts=1).first().error is not None  # too slow


def test_landing_goes_on_where_it_stopped(spark, service, tmp_path):
    options = {"template": f"{service.url}/page/{{}}", "per_task": 2, "per_batch": 5, "attempts": 1, "pause": 0.01}
    http.land_pages(spark, f"file://{tmp_path}/t", 1, 5, rounds=0, **options)  # as if stopped after a batch
    before = dict(service.calls)
    assert sorted(before) == [1, 2, 3, 4, 5]
    service.broken, service.flaky = {13}, {7, 8, 16}
    rows = {r.page: r.error for r in http.land_pages(spark, f"file://{tmp_path}/t", 1, 17, **options).collect()}
    assert sorted(rows) == list(range(1, 18)) and {p for p, e in rows.items() if e} == {13}
    assert all(service.calls[p] == 1 for p in range(1, 18) if p not in (7, 8, 13, 16))  # none twice
    assert service.calls[7] == service.calls[8] == service.calls[16] == 2 and service.calls[13] == 3  # failed pages again, in two rounds
    service.broken = set()
    again = http.land_pages(spark, f"file://{tmp_path}/t", 1, 17, **options)
    assert again.where("error is null").count() == 17 and sum(service.calls.values()) == 17 + 3 + 2 + 1


def test_upserts_and_replays(spark, service):
    df = spark.range(40).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("v")).repartition(3)
    options = {"batch": 7, "attempts": 3, "pause": 0.01, "version_url": f"{service.url}/version"}
    service.lossy = 2  # the first two answers get lost: the rows are there, and the repeated insert is refused
    http.upsert(df, f"{service.url}/rows", version="1", **options)
    want = {i: f"v{i}" for i in range(40)}
    assert service.rows == want and service.version == {"version": "1", "rows": 40} and ("PUT", 7) in service.log
    http.upsert(df, f"{service.url}/rows", version="2", **options)  # a replay
    assert service.rows == want and service.version["version"] == "2"
    changed = df.withColumn("v", F.when(F.col("k") % 10 == 0, "new").otherwise(F.col("v"))).union(spark.createDataFrame([(99, None)], "k long, v string"))
    http.upsert(changed, f"{service.url}/rows", version="3", **options)
    assert service.rows == want | {k: "new" for k in range(0, 40, 10)} | {99: None}

    bodies = http.pages(spark, template=f"{service.url}/rows?chunk={{}}", first=0, last=2, per_task=1)
    live = bodies.select(F.inline(F.from_json("body", "array<struct<key string, value string>>")))
    assert http.differing(changed, "k", "v", live).count() == 0
    service.rows[3], service.rows[77] = "else", "more"
    del service.rows[4]
    assert {tuple(r) for r in http.differing(changed, "k", "v", live).collect()} == {("3", "v3", "else"), ("4", "v4", None), ("77", None, "more")}


def test_failed_writes_keep_the_version(spark, service):
    http.upsert(spark.createDataFrame([(1, "a")], "k long, v string"), f"{service.url}/rows", version="1", version_url=f"{service.url}/version")
    bad = spark.createDataFrame([(2, "b"), (3, "poison")], "k long, v string")
    with pytest.raises(Exception, match="422"):
        http.upsert(bad, f"{service.url}/rows", version="2", version_url=f"{service.url}/version", pause=0.01)
    assert service.version["version"] == "1"
