"""Lexical search, the point-in-time join and SimHash trees against brute force, and their edge cases."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.test_operators import SCHEMA, WORD, nasty_rows
from tests.test_oracles import of_spark, of_sql
from tidemark.llm import interval_join, lexical_search, queries, simhash_trees

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def nasty(spark):
    return spark.createDataFrame(nasty_rows(), SCHEMA)


# ------------------------------------------------------------------ lexical search


def ranking(docs, items, k):
    bags = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    n_docs, n_terms = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text in items:
        scores = []
        for i, bag, n in bags:
            m = 100 - 50 + (50 * n * n_docs) // n_terms
            terms = set(TERM.findall((text or "").translate(LOWER)))
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * bag[t]) // (1000 * bag[t] + 20 * m)) for t in terms if t in bag)
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, rank, x[3], -x[0]) for rank, x in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


ITEMS = [(1, "One two THREE"), (2, None), (3, ""), (4, "é Ünï \U0001f600"), (1, "mit license"), (None, "id six five"), (5, "alpha1 beta2 gamma3 delta4 " * 50), (5, "alpha1 beta2 gamma3 delta4 " * 50), (6, "...!")]


@pytest.mark.parametrize("k", [1, 3, 50])
def test_search_equals_brute_force(spark, nasty, k, monkeypatch):
    monkeypatch.setattr(lexical_search, "SHARD_BYTES", 40)
    items = spark.createDataFrame(ITEMS, "item_id int, text string")
    got = lexical_search.search(nasty.repartition(3), items, k)
    assert got.dtypes == [("item_id", "int"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, got.collect()), key=str) == ranking([r[:2] for r in nasty_rows()], ITEMS, k)


def test_search_in_blocks_of_items_and_ties(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "BLOCK_BYTES", 30)
    rng = random.Random(3)
    docs = [(i % 150, " ".join(rng.choices("abcdefgh", k=rng.randrange(1, 9)))) for i in range(300)]
    items = [(j, " ".join(rng.choices("abcdefghij", k=4))) for j in range(12)]
    got = lexical_search.search(spark.createDataFrame(docs, "doc_id int, text string").repartition(5), spark.createDataFrame(items, "item_id long, text string"), 7)
    assert sorted(map(tuple, got.collect()), key=str) == ranking(docs, items, 7)


def test_search_without_rows(spark, nasty):
    some = spark.createDataFrame(ITEMS, "item_id int, text string")
    assert lexical_search.search(nasty.where("false"), some).count() == 0
    assert lexical_search.search(nasty, some.where("false")).count() == 0
    assert lexical_search.search(nasty.where("text is null"), some).count() == 0


def test_postings_and_merge(monkeypatch):
    monkeypatch.setattr(lexical_search, "POSTINGS", 4)
    values = np.array([0, 1, 127, 128, 300, 2**14, 2**35, 2**62])
    assert lexical_search.integers(lexical_search.varints(values)).tolist() == values.tolist()
    assert len(lexical_search.integers(lexical_search.varints(values[:0]))) == 0
    rng = np.random.default_rng(1)
    n, length_part = 300, np.full(300, 2000)
    for sizes in ([1], [4, 8], [300, 1, 5, 299, 33], [12, 12, 12]):
        cursors, want = [], np.zeros(n, np.int64)
        for w, size in enumerate(sizes, 1):
            docs, tf = np.sort(rng.choice(n, size, replace=False)), rng.integers(1, 200, size)
            raw = lexical_search.varints(np.column_stack([np.diff(docs, prepend=-1), tf]).ravel())
            cursors.append(lexical_search._Cursor(raw, size, w, length_part))
            want[docs] += w * ((1_000_000_000 * tf) // (1000 * tf + 2000))
        for _ in range(2):  # the second item finds decoded blocks
            pieces = list(lexical_search.merge(cursors, n))
            assert [first for first, _ in pieces] == np.cumsum([0, *(len(s) for _, s in pieces)])[:-1].tolist()
            assert (np.concatenate([s for _, s in pieces]) == want).all()
        assert len(pieces) > 1 or max(sizes) <= 4


# ------------------------------------------------------------------ point in time


def test_stabbed_intervals_equal_brute_force(monkeypatch):
    monkeypatch.setattr(interval_join, "_OPEN", 50)
    rng = np.random.default_rng(2)
    sizes = np.array([0, 1, 2, 37, 200, 0, 8])
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    start = np.concatenate([np.sort(rng.integers(0, 100, n)) for n in sizes])
    stop = start + rng.integers(-5, 40, len(start))
    forest = interval_join.Forest(start, stop, bounds)
    tree, time = rng.integers(0, len(sizes), 300), rng.integers(-5, 150, 300)
    got = sorted((int(q), int(r)) for qs, rs in forest.stabbed(tree, time) for q, r in zip(qs, rs))
    assert got == sorted((q, r) for q in range(300) for r in range(bounds[tree[q]], bounds[tree[q] + 1]) if start[r] <= time[q] < stop[r])


@pytest.mark.parametrize("span, chunk", [(1024, 8192), (7, 3)])
def test_latest_valid_equals_brute_force(spark, monkeypatch, span, chunk):
    monkeypatch.setattr(interval_join, "SPAN", span)
    monkeypatch.setattr(interval_join, "CHUNK", chunk)
    rng = random.Random(5)

    def some(*values):
        return None if rng.random() < 0.05 else rng.choice(values)

    versions = [(some("a", "a", "b", ""), some(*range(60)), some(*range(0, 120, 3), 10**12), some(1, 2), i % 90, some(1, 2), some("x", "y"), "clash") for i in range(400)] * 2
    questions = [(i, some("a", "b", "", "c"), some(*range(-5, 130)), "v", "w") for i in range(200)] + [(0, "a", 30, "v", "w")] * 2
    v = spark.createDataFrame(versions, "source string, start long, stop long, e int, id long, n int, lang string, t string")
    q = spark.createDataFrame(questions, "id long, source string, t long, v string, z string")
    got = interval_join.latest_valid(q.repartition(3), v.repartition(3), "source", "t", "start", "stop", ["e", "id"], ["n", "lang"])
    low = lambda x: tuple((y is not None, y if y is not None else 0) for y in x[:3]) + ((x[3] is not None, x[3] or ""),)
    want = []
    for row in questions:
        fit = [x[3:7] for x in versions if None not in (x[0], x[1], x[2], row[2]) and x[0] == row[1] and x[1] <= row[2] < x[2]]
        want.append((*row, max(fit, key=low) if fit else None))
    assert sorted(((*r[:5], tuple(r[5]) if r[5] else None) for r in got.collect()), key=str) == sorted(want, key=str)
    assert interval_join.latest_valid(q, v.where("false"), "source", "t", "start", "stop", ["e", "id"]).where("winner is not null").count() == 0
    assert interval_join.latest_valid(q.where("false"), v, "source", "t", "start", "stop", ["e", "id"]).count() == 0


def test_point_in_time_query_on_odd_rows(spark, tmp_path):
    rows = [(i, "t", "en" if i % 3 else None, "s" if i % 7 else None, i % 5 or None, "x") for i in range(3000)] + [(None, "t", "en", "s", 1, "x")] * 2 + [(5, "t", "de", "s", 2, "x")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, event string").write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1) for i in range(0, 3000, 2)] + [(None, 1), (10**9, 0), (4, 1), (4, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    got = of_spark(queries.op12_point_in_time_join(spark, str(tmp_path)))
    assert got == of_sql(con.sql(queries.OP12_SQL)) and len(got[1]) == len(labels)
    at = got[0].index("status")
    assert {r[at] for r in got[1]} == {"none", "stale", "fresh"}


# ------------------------------------------------------------------ SimHash


def simhash(text):
    words = WORD.findall((text or "").translate(LOWER))
    grams = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def least_keys(prints, radius=2):
    """prints: [(key, fingerprint)]; the least key of each row's class."""
    low = list(range(len(prints)))

    def root(i):
        while low[i] != i:
            i = low[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= radius:
                low[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (key, _) in enumerate(prints):
        if key is not None:
            least[root(i)] = min(key, least.get(root(i), key))
    return [least.get(root(i)) for i in range(len(prints))]


def test_fingerprints_equal_brute_force(spark, nasty):
    texts = [r[1] for r in nasty_rows()]
    assert simhash_trees.fingerprints(pa.array(texts)).tolist() == [simhash(t) for t in texts]
    got = simhash_trees.link(nasty.repartition(3))
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    rows = nasty_rows()
    prints = [simhash(r[1]) for r in rows]
    want = [(r[0], f"{p:016x}", c) for r, p, c in zip(rows, prints, least_keys([(r[0], p) for r, p in zip(rows, prints)]))]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert simhash_trees.link(nasty.where("false")).count() == 0


def clusters(rng, n):
    """Random fingerprints, and chains and balls of near ones, near the edges of bands as well."""
    out = {rng.getrandbits(64) for _ in range(n)} | {0, 1, 2**63, 2**64 - 1}
    for _ in range(8):
        at = rng.getrandbits(64)
        for _ in range(n // 8):
            out.add(at)
            for _ in range(rng.randrange(1, 5)):
                at ^= 1 << rng.randrange(64)
    return sorted(out)


@pytest.mark.parametrize("shard, tree", [(2048, 16384), (16, 10)])
def test_links_equal_brute_force(spark, monkeypatch, shard, tree):
    monkeypatch.setattr(simhash_trees, "SHARD", shard)
    monkeypatch.setattr(simhash_trees, "TREE", tree)
    prints = clusters(random.Random(11), 300)
    signed = [p - (p >> 63 << 64) for p in prints]
    edges = simhash_trees.links(spark.createDataFrame([(x,) for x in signed], "fp long").repartition(3)).collect()
    place = {x: i for i, x in enumerate(signed)}
    low = np.arange(len(prints))
    simhash_trees.join_classes(low, np.array([place[e.a] for e in edges], np.int64), np.array([place[e.b] for e in edges], np.int64))
    assert low.tolist() == least_keys(list(enumerate(prints)))


def test_trees_follow_the_edges_within_the_radius(monkeypatch):
    monkeypatch.setattr(simhash_trees, "_PAIRS", 64)
    rng = random.Random(4)
    prints = np.array(clusters(rng, 200), np.uint64)
    group = np.array([rng.randrange(3) for _ in prints])
    trees = simhash_trees.Trees(prints, group)
    assert len(trees.root) == 3 and len(trees.child) == len(prints) - 3
    parent, edge = trees.edges // 65, trees.edges % 65
    assert (np.bitwise_count(prints[parent] ^ prints[trees.child]) == edge).all() and len(set(trees.edges.tolist())) == len(trees.edges)
    asks = np.array([int(p) ^ (1 << rng.randrange(64)) for p in prints], np.uint64)
    got = sorted((int(a), int(b)) for x, y in trees.near(asks, group, 2) for a, b in zip(x, y))
    assert got == sorted((i, j) for i in range(len(asks)) for j in range(len(prints)) if group[i] == group[j] and int(asks[i] ^ prints[j]).bit_count() <= 2)
