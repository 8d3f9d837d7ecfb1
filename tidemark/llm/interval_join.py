"""Point-in-time join: of the versions that are valid at a time, the last one.

A version of a source is known from ``start`` on and until before ``stop``. Versions are
dealt into chunks: those of one source that start in one span of ``SPAN`` seconds, cut by
a hash of their ids into parts of about ``CHUNK`` versions where there are more, so a
source with most of the rows is many chunks. A row per chunk states how late its versions
are valid; each question goes to the chunks of its source that can hold an answer, once
for all rows that ask for the same source and time.

In a chunk, versions form a balanced tree keyed by start, each node with the greatest
stop below it. A question walks it from the root: it enters a subtree only if something
there stops after the question's time, and goes right only if the node starts by then.
All versions that it meets and that are valid are enumerated; the greatest in the order
of the ranking columns wins, in the chunk and then over chunks.

Nulls and edge cases: versions and questions without source or time take part in nothing;
a question without an answer keeps its row with null columns. Versions that stop before
they start are never valid. Equal versions are one. Equal questions all have their rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import kernels as K

SPAN = 1024  # seconds; so many questions of a source meet in a span at most
CHUNK = 8192
_OPEN = 1 << 20  # nodes looked at together


class Forest:
    """Balanced interval trees, one per run of rows in ``[bounds[i], bounds[i + 1])``, which are sorted by start."""

    def __init__(self, start: np.ndarray, stop: np.ndarray, bounds: np.ndarray):
        self.start, self.stop = start, stop
        self.latest = np.empty_like(stop)  # greatest stop below a node
        low, high = bounds[:-1], bounds[1:]
        self.roots = (low, high)
        levels = []
        while len(low):  # a node is the middle of its range of rows
            low, high = low[high > low], high[high > low]
            middle = (low + high) // 2
            levels.append((low, middle, high))
            low, high = np.concatenate([low, middle + 1]), np.concatenate([middle, high])
        for low, middle, high in reversed(levels):
            self.latest[middle] = stop[middle]
            for a, b in ((low, middle), (middle + 1, high)):
                has = b > a
                child = (a[has] + b[has]) // 2
                self.latest[middle[has]] = np.maximum(self.latest[middle[has]], self.latest[child])

    def stabbed(self, tree: np.ndarray, time: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(question, row) of every row of its tree that each question's time stabs, in pieces."""
        pending = [(np.arange(len(time)), self.roots[0][tree], self.roots[1][tree])]
        while pending:
            asks, low, high = pending.pop()
            if len(asks) > _OPEN:
                half = len(asks) // 2
                pending += [(asks[:half], low[:half], high[:half]), (asks[half:], low[half:], high[half:])]
                continue
            some = high > low
            asks, low, high = asks[some], low[some], high[some]
            middle = (low + high) // 2
            some = self.latest[middle] > time[asks]
            asks, low, middle, high = asks[some], low[some], middle[some], high[some]
            if not len(asks):
                continue
            begun = self.start[middle] <= time[asks]
            hit = begun & (self.stop[middle] > time[asks])
            if hit.any():
                yield asks[hit], middle[hit]
            pending.append((np.concatenate([asks, asks[begun]]), np.concatenate([low, middle[begun] + 1]), np.concatenate([middle, high[begun]])))


def winners(forest: Forest, rank: np.ndarray, tree: np.ndarray, time: np.ndarray) -> np.ndarray:
    """The row of highest rank that each question stabs, or -1."""
    best = np.full(len(time), -1, dtype=np.int64)
    for asks, rows in forest.stabbed(tree, time):
        np.maximum.at(best, asks, rank[rows])
    best[best >= 0] = np.argsort(rank)[best[best >= 0]]
    return best


def latest_valid(questions: DataFrame, versions: DataFrame, by: str, at: str, start: str, stop: str, order: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """All columns of ``questions``, and ``winner``: a struct of ``order`` and ``carry`` of the version that wins, or null.

    Versions are valid where ``by`` is equal and ``start <= at < stop`` (whole seconds). Of
    these the one with the greatest ``order`` (integers; a null is least) wins, ties by ``carry``.
    """
    span = F.floor(F.col("a") / SPAN).cast("long")
    fields = [*order, *carry]
    kind = {f.name: f.dataType for f in versions.schema}
    ranked = F.struct(*[F.col(f"`{c}`") for c in fields])
    known = versions.select(F.col(f"`{by}`").alias("s"), F.col(f"`{start}`").cast("long").alias("a"), F.col(f"`{stop}`").cast("long").alias("z"), ranked.alias("v"))
    known = known.where("s is not null and a < z").withColumn("span", span)
    asked = questions.select(F.col(f"`{by}`").alias("s"), F.col(f"`{at}`").cast("long").alias("t")).where("s is not null and t is not null").distinct()

    # a row per source and span of starts: how many parts, and until when something is valid
    spans = known.groupBy("s", "span").agg(F.count(F.lit(1)).alias("n"), F.max("z").alias("until"))
    spans = spans.select("s", "span", F.ceil(F.col("n") / CHUNK).cast("int").alias("parts"), "until")
    times = asked.groupBy("s").agg(F.max("t").alias("last"))  # beyond the last question, no span matters
    covered = spans.join(times, "s").withColumn("to", F.floor((F.least("until", F.col("last") + 1) - 1) / SPAN).cast("long")).where("to >= span")
    covered = covered.select("s", "span", "parts", "until", F.explode(F.sequence("span", "to")).alias("here"))
    sent = asked.withColumn("here", F.floor(F.col("t") / SPAN).cast("long")).join(covered, ["s", "here"]).where("t < until")
    sent = sent.select("s", "span", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "t")

    dealt = known.join(spans.select("s", "span", "parts"), ["s", "span"])
    dealt = dealt.select("s", "span", F.pmod(F.xxhash64("v"), F.col("parts")).cast("int").alias("part"), "a", "z", "v")
    empty = F.lit(None).cast(known.schema["v"].dataType)
    both = dealt.select("s", "span", "part", F.col("a").alias("t"), "z", "v").unionByName(sent.select("s", "span", "part", "t", F.lit(None).cast("long").alias("z"), empty.alias("v")))
    both = both.select("s", "span", "part", "z", "t", "v").repartition("s", "span", "part").sortWithinPartitions("s", "span", "part", F.col("z").isNull(), "t")
    schema = f"s {kind[by].simpleString()}, t long, v {known.schema['v'].dataType.simpleString()}"
    found = both.mapInArrow(lambda batches: _answers(batches), schema)
    best = found.groupBy("s", "t").agg(F.max("v").alias("winner"))
    return questions.join(best.select(F.col("s").alias("__s"), F.col("t").alias("__t"), "winner"), (F.col(f"`{by}`") == F.col("__s")) & (F.col(f"`{at}`") == F.col("__t")), "left").drop("__s", "__t")


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole chunks of sorted rows, several at once: first their versions, then their questions."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        cut = int(_changes(batch)[-1])  # the last chunk may go on in the next batch
        if held and (cut or not _same(held[-1], batch)):
            yield _chunks([*held, batch.slice(0, cut)])
            held = []
        elif cut:
            yield _chunks([batch.slice(0, cut)])
        held.append(batch.slice(cut))
    if held:
        yield _chunks(held)
    K.trim()


def _changes(batch: pa.RecordBatch) -> np.ndarray:
    """Rows at which a chunk begins."""
    new = np.zeros(batch.num_rows, dtype=bool)
    new[0] = True
    for i in range(3):
        c = batch.column(i)
        new[1:] |= pa.compute.not_equal(c.slice(1), c.slice(0, len(c) - 1)).to_numpy(zero_copy_only=False)
    return np.flatnonzero(new)


def _same(a: pa.RecordBatch, b: pa.RecordBatch) -> bool:
    return all(a.column(i)[-1] == b.column(i)[0] for i in range(3))


def _chunks(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    batch = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
    chunk = np.repeat(np.arange(len(begins := _changes(batch))), np.diff([*begins, batch.num_rows]))
    question = np.asarray(batch.column(3).is_null())
    rows = np.flatnonzero(~question)
    time = batch.column(4).to_numpy()
    versions = batch.column(5).take(pa.array(rows))
    bounds = np.searchsorted(chunk[rows], np.arange(len(begins) + 1))
    forest = Forest(time[rows], batch.column(3).take(pa.array(rows)).to_numpy(), bounds)
    # ranks in the order of all fields, nulls first; places among equal rows don't matter
    names = [f"c{i}" for i in range(versions.type.num_fields)]
    flat = pa.table(versions.flatten(), names=names)
    by = pa.compute.sort_indices(flat, sort_keys=[(c, "ascending") for c in names], null_placement="at_start").to_numpy()
    rank = np.empty(len(by), np.int64)
    rank[by] = np.arange(len(by))
    asks = np.flatnonzero(question)
    best = winners(forest, rank, chunk[asks], time[asks])
    got = best >= 0
    return pa.record_batch([batch.column(0).take(pa.array(asks[got])), pa.array(time[asks[got]]), versions.take(pa.array(best[got]))], names=["s", "t", "v"])
