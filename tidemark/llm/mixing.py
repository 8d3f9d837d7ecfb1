"""Mixing overlapping sources to target weights by min-cost flow.

Documents are aggregated by membership pattern (the set of sources that hold
them). A flow routes each pattern's words to its sources' quotas: every pass over
a pattern's documents is an arc of its size, and the cost of an arc grows with
the number of the pass, so repetition is convex and comes last. The flow's total
per pattern is then met with whole documents: all of them for each full pass, and
for the rest those first in a seeded order, up to the document that comes nearest.

The seeded order is found without sorting a source: sizes are summed by hash
range, and only documents of the range that the quota ends in are ordered.

Nulls and edge cases: a null source is a source of its own, the last; a null text
has size 0. Repeated rows count one by one. Ties in the seeded order fall to the
key, then the size. Sources without words have target 0. The driver holds a row for
each distinct set of sources, and no more. A null array of sources is empty, and its
document is not taken. Extra columns are dropped unless ``carry`` names them.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import scratch

WEIGHTS = (5, 2, 1)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: list[int], weights: list[float], share: float = 1.5, most: float = 2.0) -> list[float]:
    """Quotas: ``share`` of all sizes by weight, none above ``most`` times its size; the excess is dealt by weight."""
    total = share * sum(sizes)
    caps = [most * s for s in sizes]
    order = sorted(range(len(sizes)), key=lambda i: (caps[i] / weights[i], i))
    out, left, weight = [0.0] * len(sizes), total, sum(weights)
    for at, i in enumerate(order):
        if left * weights[i] <= caps[i] * weight:  # nobody from here on is above its cap
            for j in order[at:]:
                out[j] = left * weights[j] / weight
            break
        out[i] = caps[i]
        left -= caps[i]
        weight -= weights[i]
    return out


def max_flow(n: int, ends: list[int], room: list[int], graph: list[list[int]], source: int, sink: int) -> None:
    """Augment ``room`` (arc 2i and its reverse 2i + 1) to a greatest flow: blocking flows on level graphs."""
    while True:
        level = [-1] * n
        level[source] = 0
        waiting = deque([source])
        while waiting and level[sink] < 0:
            x = waiting.popleft()
            for e in graph[x]:
                if room[e] > 0 and level[ends[e]] < 0:
                    level[ends[e]] = level[x] + 1
                    waiting.append(ends[e])
        if level[sink] < 0:
            return
        at, path, x = [0] * n, [], source
        while True:
            if x == sink:
                step = min(room[e] for e in path)
                for e in path:
                    room[e] -= step
                    room[e ^ 1] += step
                full = next(i for i, e in enumerate(path) if not room[e])
                x = ends[path[full] ^ 1]
                del path[full:]
                continue
            arcs = graph[x]
            while at[x] < len(arcs) and not (room[arcs[at[x]]] > 0 and level[ends[arcs[at[x]]]] == level[x] + 1):
                at[x] += 1
            if at[x] < len(arcs):
                path.append(arcs[at[x]])
                x = ends[path[-1]]
            elif path:
                x = ends[path.pop() ^ 1]
                at[x] += 1
            else:
                break


def route(patterns: list[tuple[tuple[int, ...], int]], quotas: list[float], passes: int = 2) -> list[int]:
    """Words to take from each (sources, size) pattern, ``passes`` times its size at most.

    Only the arcs into patterns cost anything (the square of the pass), so a
    cheapest augmenting path is one into the cheapest pass left: passes are
    opened one after the other and each is saturated by a greatest flow.
    """
    p, s = len(patterns), len(quotas)
    graph: list[list[int]] = [[] for _ in range(p + s + 2)]
    ends, room = [], []

    def arc(a: int, b: int, capacity: int) -> None:
        for x, y, c in ((a, b, capacity), (b, a, 0)):
            graph[x].append(len(ends))
            ends.append(y)
            room.append(c)

    for i in range(p):
        arc(0, 1 + i, 0)
    for i, (members, size) in enumerate(patterns):
        for j in members:
            arc(1 + i, 1 + p + j, passes * size)
    for j, q in enumerate(quotas):
        arc(1 + p + j, 1 + p + s, int(q + 0.5))
    for _ in range(passes):
        for i, (_, size) in enumerate(patterns):
            room[2 * i] += size
        max_flow(p + s + 2, ends, room, graph, 0, p + s + 1)
    return [room[2 * i + 1] for i in range(p)]


def mix(docs: DataFrame, members: Column, key: str = "doc_id", text: str = "text", weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, passes: int = 2, seed: str = "mix", carry: list[str] | None = None) -> DataFrame:
    """Per document: key, ``size``, ``sources`` (array), ``copies``, ``taken``, and for its first source ``source_size`` and ``target``.

    ``members`` is an array column of the sources that hold a document; ``carry`` names more columns to keep.
    """
    spark = docs.sparkSession
    kept = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry or [])]
    spot = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    sources = F.array_sort(F.array_distinct(F.coalesce(members, F.array().cast("array<string>"))))
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t"), sources.alias("m"), spot.alias("at"), *kept)
    rows = rows.withColumns({"p": F.to_json(F.struct("m")), "bin": F.substring("at", 1, 3)})

    def sized(df: DataFrame) -> DataFrame:
        return df.withColumn("size", word_count(F.col("t"))) if kept else df

    if not kept:  # a narrow table is read again more cheaply than texts are counted again
        rows = scratch.cut(rows.withColumn("size", word_count(F.col("t"))).drop("t"), "sizes")
    # a row for each pattern and hash range, from one pass over the texts
    bins = scratch.cut(sized(rows).groupBy("p", "m", "bin").agg(F.sum("size").alias("in_bin")), "bins")
    patterns = [(r["p"], tuple(r["m"]), r["size"]) for r in bins.groupBy("p", "m").agg(F.sum("in_bin").alias("size")).orderBy("p").toLocalIterator()]
    names = sorted({s for _, m, _ in patterns for s in m}, key=lambda s: (s is None, (s or "").encode("utf-32-be")))
    index = {s: i for i, s in enumerate(names)}
    sizes = [0] * len(names)
    for _, m, size in patterns:
        for s in m:
            sizes[index[s]] += size
    quotas = targets(sizes, [weights[i % len(weights)] for i in range(len(names))], share, float(passes))
    take = route([(tuple(index[s] for s in m), size) for _, m, size in patterns], quotas, passes)
    plan = [(p, t // size if size else 0, t % size if size else 0, sizes[index[m[0]]] if m else 0, quotas[index[m[0]]] if m else 0.0) for (p, m, size), t in zip(patterns, take)]
    plan = spark.createDataFrame(plan, "p string, whole int, rest long, source_size long, target double")  # a row per pattern

    # Sums by range grow with the range: those below the one that the rest ends in are taken whole, those above not at all.
    until = F.sum("in_bin").over(Window.partitionBy("p").orderBy("bin"))
    ends = bins.withColumn("until", until).join(plan, "p").where("until > rest").groupBy("p").agg(F.min("bin").alias("edge"), F.min_by(F.col("until") - F.col("in_bin"), "bin").alias("before"))
    plan = scratch.cut(plan.join(ends, "p", "left").select("p", "whole", "rest", "source_size", "target", F.coalesce("edge", F.lit("~")).alias("edge"), "before"), "plan")
    scratch.drop(bins)
    placed = rows.join(plan, "p")
    seeded = Window.partitionBy("p", "bin").orderBy("at", "k", "size").rowsBetween(Window.unboundedPreceding, 0)
    columns = ["k", "size", "m", "source_size", "target", "whole", *(f"c{i}" for i in range(len(kept)))]
    settled = sized(placed.where("bin != edge")).select(*columns, (F.col("bin") < F.col("edge")).cast("int").alias("extra"))
    edge = sized(placed.where("bin = edge")).withColumn("sum", F.col("before") + F.sum("size").over(seeded))
    edge = edge.select(*columns, (2 * F.col("sum") - F.col("size") <= 2 * F.col("rest")).cast("int").alias("extra"))
    copies = (F.col("whole") + F.when(F.col("size") > 0, F.col("extra")).otherwise(0)).cast("int")
    copies = F.when(F.col("size") > 0, copies).otherwise(0)
    return settled.unionByName(edge).select(
        F.col("k").alias(key), "size", F.col("m").alias("sources"), copies.alias("copies"), (copies * F.col("size")).cast("long").alias("taken"), "source_size", "target", *(F.col(f"c{i}").alias(c) for i, c in enumerate(carry or []))
    )
