"""SimHash near-duplicates: classes of documents linked by fingerprints of few differing bits.

Words are lower-cased (A-Z); a fingerprint counts over all word shingles of a text,
repeats included, how often each bit of the shingle's XXH64 (seed 42) is set, and has
those bits that are set in over half of them.

Only distinct fingerprints are compared. They are dealt into shards, each fingerprint
into ``radius + 1`` of them: its bits are cut into that many bands, and two fingerprints
that differ in ``radius`` bits at most agree on a band. A shard holds the fingerprints
that agree on a prefix of one band, as long a prefix as makes shards of about ``SHARD``
fingerprints, so no pair that can be linked is lost and most others never meet.

The fingerprints of a shard form BK-trees: the children of a node are keyed by their
Hamming distance to it, so a search around a fingerprint at distance d from a node
follows only the edges from d - radius to d + radius. A shard of more than ``TREE``
fingerprints is several trees, and each tree is sent to all blocks of its shard. Trees
travel to the tasks that search them by a shuffle: a broadcast would take the
fingerprints of all documents through the driver. A task returns one edge for each
fingerprint that is linked to a smaller one in its trees, not all pairs; the classes of
all shards are then joined by connected components.

Nulls and edge cases: null and empty texts and those without words have the fingerprint
zero, linked like any other; a text with fewer words than a shingle is one shingle. Rows
with equal keys are separate rows; a null key is a document that only others' keys can
name. An empty table has no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import kernels as K
from tidemark.llm import scratch
from tidemark.llm.components import components

SHINGLE = 3
RADIUS = 2
SEED = 42
SHARD = 2048
TREE = 16384
_PAIRS = 1 << 20  # (fingerprint, node) looked at together

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _spaced(data: np.ndarray, offsets: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The texts' words in lower case with one space between, their starts and ends in this, and each text's first word."""
    starts, ends, first = K.word_bounds(data, offsets)
    sizes = ends - starts
    new = np.cumsum(sizes + 1) - sizes - 1
    out = np.full(int((sizes + 1).sum()), 0x20, dtype=np.uint8)
    inside = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[np.repeat(new, sizes) + inside] = _LOWER[data[np.repeat(starts, sizes) + inside]]
    return out.tobytes(), new, new + sizes, first


def fingerprints(texts: pa.Array, n: int = SHINGLE) -> np.ndarray:
    """The fingerprint of each text."""
    data, offsets = K.string_buffers(texts)
    raw, starts, ends, first = _spaced(data, offsets)
    counts = np.diff(first)
    width = np.minimum(counts, n)  # words of a shingle
    shingles = np.where(counts > 0, counts - width + 1, 0)
    row = np.repeat(np.arange(len(counts)), shingles)
    at = np.arange(len(row)) - np.repeat(np.cumsum(shingles) - shingles, shingles) + first[row]
    digest, view = xxhash.xxh64_intdigest, memoryview(raw)
    hashes = np.fromiter((digest(view[a:b], SEED) for a, b in zip(starts[at].tolist(), ends[at + width[row] - 1].tolist())), np.uint64, len(at))
    out = np.zeros(len(counts), dtype=np.uint64)
    some = np.flatnonzero(shingles)
    begins = (np.cumsum(shingles) - shingles)[some]
    for bit in range(64 if len(some) else 0):
        ones = np.add.reduceat(((hashes >> np.uint64(bit)) & np.uint64(1)).astype(np.int32), begins)
        out[some] |= (2 * ones > shingles[some]).astype(np.uint64) << np.uint64(bit)
    return out


def fingerprint(text: Column, n: int = SHINGLE) -> Column:
    """The fingerprint of each text, as a long."""

    @F.arrow_udf("long")
    def computed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = [fingerprints(texts.slice(i, j - i), n) for i, j in K.blocks(texts)]
            yield pa.array(np.concatenate([np.zeros(0, np.uint64), *found]).view(np.int64))
        K.trim()

    return computed(text)


# ------------------------------------------------------------------ trees


class Trees:
    """BK-trees over distinct fingerprints, one for each value of ``group``; the first of a group is its root."""

    def __init__(self, prints: np.ndarray, group: np.ndarray):
        self.prints = prints
        members = np.argsort(group, kind="stable")
        _, begins, place = np.unique(group[members], return_index=True, return_inverse=True)
        self.root = members[begins]  # of each group
        parent, edge = np.full(len(prints), -1, np.int64), np.zeros(len(prints), np.int64)
        node = self.root[place]
        while True:  # all trees grow by a level: who is no node yet goes down an edge, and the first there is a node
            rest = members != node
            members, node = members[rest], node[rest]
            if not len(members):
                break
            key = node * 65 + np.bitwise_count(prints[members] ^ prints[node])
            by = np.argsort(key, kind="stable")
            members, key = members[by], key[by]
            _, begins, place = np.unique(key, return_index=True, return_inverse=True)
            new = members[begins]
            parent[new], edge[new] = key[begins] // 65, key[begins] % 65
            node = new[place]
        below = np.flatnonzero(parent >= 0)
        self.child = below[np.argsort(parent[below] * 65 + edge[below])]  # by parent and edge
        self.edges = parent[self.child] * 65 + edge[self.child]

    def near(self, prints: np.ndarray, tree: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(place in ``prints``, member) of all members of each one's tree within ``radius``, in pieces."""
        pending = [(np.arange(len(prints)), self.root[tree])]
        while pending:
            asks, node = pending.pop()
            if len(asks) > _PAIRS:
                half = len(asks) // 2
                pending += [(asks[:half], node[:half]), (asks[half:], node[half:])]
                continue
            d = np.bitwise_count(prints[asks] ^ self.prints[node]).astype(np.int64)
            hit = d <= radius
            if hit.any():
                yield asks[hit], node[hit]
            low = np.searchsorted(self.edges, node * 65 + np.maximum(d - radius, 0))
            n = np.searchsorted(self.edges, node * 65 + np.minimum(d + radius, 64), side="right") - low
            if total := int(n.sum()):
                at = np.arange(total) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
                pending.append((np.repeat(asks, n), self.child[at]))


def join_classes(low: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Make ``low``, the least known place of each one's class, hold for links (a, b) as well."""
    while len(a):
        x, y = low[a], low[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(low, np.maximum(x, y), np.minimum(x, y))
        while (low[low] != low).any():
            low[:] = low[low]


def linked(prints: np.ndarray, shard: np.ndarray, in_tree: np.ndarray, radius: int) -> np.ndarray:
    """The least place of each fingerprint's class, from the trees of each shard; all of a shard search its trees."""
    low = np.arange(len(prints))
    members = np.flatnonzero(in_tree)
    trees = Trees(prints[members], shard[members])
    names = shard[members[trees.root]]
    tree = np.minimum(np.searchsorted(names, shard), max(len(names) - 1, 0))
    asks = np.flatnonzero(names[tree] == shard) if len(names) else np.zeros(0, np.int64)
    for a, b in trees.near(prints[asks], tree[asks], radius):
        join_classes(low, asks[a], members[b])
    return low


# ------------------------------------------------------------------ links


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (a, b) over distinct fingerprints ``fp`` whose classes are those of all pairs within ``radius`` bits."""
    cuts = [64 * i // (radius + 1) for i in range(radius + 2)]
    n = distinct.count()
    bits = min(max((n // SHARD).bit_length(), 0), min(b - a for a, b in zip(cuts, cuts[1:])))
    bands = F.array(*[F.struct(F.lit(i).alias("band"), F.shiftrightunsigned("fp", 64 - cuts[i] - bits).bitwiseAND((1 << bits) - 1).alias("prefix")) for i in range(radius + 1)])
    rows = distinct.select("fp", F.explode(bands).alias("at")).select("fp", "at.*")
    # a large shard is some trees, and each of them meets all blocks of the shard
    parts = rows.groupBy("band", "prefix").agg(F.ceil(F.count(F.lit(1)) / TREE).cast("int").alias("parts"))
    rows = rows.join(parts, ["band", "prefix"]).withColumn("own", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    pair = F.struct(F.least("own", "other").alias("tree"), F.greatest("own", "other").alias("block"))
    sent = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("band", "prefix", pair.alias("p"), "own", "fp")
    sent = sent.select("band", "prefix", "p.tree", "p.block", (F.col("own") == F.col("p.tree")).alias("in_tree"), "fp")

    def search(table: pa.Table) -> pa.Table:
        prints = table["fp"].to_numpy().view(np.uint64)
        low = linked(prints, np.zeros(len(prints), np.int64), table["in_tree"].to_numpy(), radius)
        joined = np.flatnonzero(low != np.arange(len(low)))
        return pa.table({"a": prints[joined].view(np.int64), "b": prints[low[joined]].view(np.int64)})

    return sent.groupBy("band", "prefix", "tree", "block").applyInArrow(search, "a long, b long")


def link(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``key, fingerprint, component_id``: the fingerprint in 16 hex digits, and the smallest key that each document reaches by links."""
    with scratch.lean(docs.sparkSession):
        rows = scratch.cut(docs.select(F.col(f"`{key}`").alias("key"), fingerprint(F.col(f"`{text}`"), n).alias("fp")), "fingerprints")
        distinct = scratch.cut(rows.groupBy("fp").agg(F.min("key").alias("least")), "distinct")
        edges = scratch.cut(links(distinct.select("fp"), radius), "edges")
        reached = components(edges, "print-stars")
        scratch.drop(edges)
        classes = distinct.join(reached, distinct["fp"] == reached["node"], "left").select("fp", "least", F.coalesce("low", "fp").alias("low"))
        lowest = classes.groupBy("low").agg(F.min("least").alias("component_id"))
        named = classes.join(lowest, "low").select("fp", "component_id")
        hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
        return rows.join(named, "fp").select(F.col("key").alias(key), hexed, F.coalesce("component_id", "key").alias("component_id"))
