"""Quality classifier: logistic regression on hashed word n-grams, trained with FTRL-proximal updates.

Words are runs of letters, digits and non-ASCII bytes, or runs of punctuation;
their n-grams (1 to ``orders``) are hashed to ``1 << bits`` slots. A document is
a sparse vector of damped counts with unit length, and its score is the logistic
function of a sparse dot product with the weights.

Training reads at most ``max_rows`` labelled documents and ``max_bytes`` of text,
in the order of seeded hashes of their ids; these bounds keep the sequential pass in
one task, which holds the documents' vectors and not their texts, and do not depend
on the corpus. Scoring reads every text whole, in blocks of about a megabyte.

Nulls and edge cases: rows with a null id or label teach nothing; an id with
several labels or texts teaches the greatest of each. Null and empty texts score
by the bias alone. Without labelled rows all weights are 0 and scores are 0.5.
Repeated rows score alike; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import kernels as K

_CLASS = np.full(256, 2, dtype=np.uint8)
_CLASS[K.IS_SPACE] = 0
_CLASS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1


@dataclass(frozen=True)
class Settings:
    bits: int = 18
    orders: int = 2
    epochs: int = 4
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.5
    max_rows: int = 8000
    max_bytes: int = 32 << 20
    seed: int = 20


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    kind = _CLASS[data]
    if len(kind) == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    change = np.empty(len(kind) + 1, dtype=bool)
    change[0] = change[-1] = True
    change[1:-1] = kind[1:] != kind[:-1]
    change[offsets] = True
    edges = np.flatnonzero(change)
    starts, ends = edges[:-1], edges[1:]
    solid = kind[starts] > 0
    starts, ends = starts[solid], ends[solid]
    return starts, ends, np.searchsorted(starts, offsets)


def sparse_block(texts: pa.Array, settings: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text numbers, slots and values of a block, ordered by text; slot 0 is the bias and not listed.

    Slots are hashes of word n-grams. A word equal to the one before it also
    counts in one slot of its own, so that repetition shows for any word.
    """
    data, offsets = K.string_buffers(texts)
    starts, ends, first = _tokens(data, offsets)
    hashes = K.word_hashes(data, starts, ends, fold_case=False)
    text = np.repeat(np.arange(len(offsets) - 1, dtype=np.uint64), np.diff(first))
    mask, shift = np.uint64((1 << settings.bits) - 1), np.uint64(settings.bits)
    keys = []
    for n in range(1, settings.orders + 1):
        if len(hashes) < n:
            continue
        inside = text[: len(text) - n + 1] == text[n - 1 :]
        keys.append(((text[: len(inside)] << shift) | (K.rolling(hashes, n) & mask))[inside])
    same = text[1:][(hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])]
    keys.append((same << shift) | np.uint64(1))
    found, counts = np.unique(np.concatenate(keys), return_counts=True)
    slots = (found & mask).astype(np.int64)
    text, slots, counts = (found >> shift).astype(np.int64)[slots > 0], slots[slots > 0], counts[slots > 0]
    values = 1 + np.log(counts)
    norms = np.sqrt(np.bincount(text, values**2, minlength=len(offsets) - 1))
    return text, slots, values / norms[text]


def vectors(texts: pa.Array, settings: Settings):
    """(slots, values) of each text, with the bias."""
    for i, j in K.blocks(texts):
        text, slots, values = sparse_block(texts.slice(i, j - i), settings)
        at = np.searchsorted(text, np.arange(j - i + 1))
        for a, b in zip(at, at[1:]):
            yield np.concatenate(([0], slots[a:b])).astype(np.int32), np.concatenate(([1.0], values[a:b])).astype(np.float32)


def score_array(texts: pa.Array, weights: np.ndarray, settings: Settings) -> np.ndarray:
    dots = [np.zeros(0)]
    for i, j in K.blocks(texts):
        text, slots, values = sparse_block(texts.slice(i, j - i), settings)
        dots.append(weights[0] + np.bincount(text, weights[slots] * values, minlength=j - i))
    return 1 / (1 + np.exp(-np.clip(np.concatenate(dots), -35, 35)))


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, settings: Settings) -> np.ndarray:
    """FTRL-proximal over the examples in the given order, ``epochs`` times."""
    size = 1 << settings.bits
    z, n = np.zeros(size), np.zeros(size)

    def weights(zi, ni, bias):
        lasso = np.where(bias, 0.0, settings.l1)
        return np.where(np.abs(zi) <= lasso, 0.0, (np.sign(zi) * lasso - zi) / ((settings.beta + np.sqrt(ni)) / settings.alpha + settings.l2))

    for _ in range(settings.epochs):
        for (slots, values), y in zip(rows, labels):
            zi, ni = z[slots], n[slots]
            w = weights(zi, ni, slots == 0)
            p = 1 / (1 + np.exp(-np.clip(w @ values, -35, 35)))
            g = (p - y) * values
            more = ni + g * g
            z[slots] = zi + g - (np.sqrt(more) - np.sqrt(ni)) / settings.alpha * w
            n[slots] = more
    return weights(z, n, np.arange(size) == 0).astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), key: str = "doc_id", text: str = "text", label: str = "quality") -> np.ndarray:
    """Weights learned from the documents that ``labels`` (key, label) marks."""
    chosen = (
        labels.where(F.col(key).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(key).alias("id"))
        .agg(F.max(F.col(label).cast("int")).alias("y"))
        .withColumn("at", F.xxhash64(F.lit(settings.seed), F.col("id")))
        .orderBy("at", "id")
        .limit(settings.max_rows)
    )
    one_text = (
        docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("x"))
        .join(F.broadcast(chosen), "id")  # at most max_rows rows
        .groupBy("id", "at", "y")
        .agg(F.max("x").alias("x"))
    )

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(3)
            for i, j in K.blocks(texts):
                rows = list(vectors(texts.slice(i, j - i), settings))
                slots = pa.array([r[0].tobytes() for r in rows], pa.binary())
                values = pa.array([r[1].tobytes() for r in rows], pa.binary())
                yield pa.RecordBatch.from_arrays([*(batch.column(k).slice(i, j - i) for k in range(3)), K.lengths(texts.slice(i, j - i)), slots, values], names=["id", "at", "y", "size", "slots", "values"])
        K.trim()

    kind = docs.schema[key].dataType.simpleString()
    sample = one_text.select("id", "at", "y", "x").mapInArrow(described, f"id {kind}, at long, y int, size long, slots binary, values binary")
    before = F.sum("size").over(Window.orderBy("at", "id").rowsBetween(Window.unboundedPreceding, -1))  # max_rows rows at most
    sample = sample.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < settings.max_bytes)

    def one(table: pa.Table) -> pa.Table:
        order = pc.sort_indices(table.select(["at", "id"]), [("at", "ascending"), ("id", "ascending")]).to_pylist()
        slots, values = table["slots"], table["values"]  # views, not copies
        rows = [(np.frombuffer(slots[i].as_buffer(), np.int32), np.frombuffer(values[i].as_buffer(), np.float32)) for i in order]
        weights = train(rows, table["y"].to_numpy()[order], settings)
        return pa.table({"weights": pa.array([weights.tobytes()], pa.binary())})

    found = sample.groupBy(F.lit(0).alias("g")).applyInArrow(one, "weights binary").collect()
    return np.frombuffer(found[0][0], dtype=np.float32) if found else np.zeros(1 << settings.bits, np.float32)


def score(spark, text: Column, weights: np.ndarray, settings: Settings = Settings()) -> Column:
    """Score column of a text column; the weights (a fixed ``4 << bits`` bytes) are broadcast."""
    shared = spark.sparkContext.broadcast(weights)

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(score_array(texts, shared.value, settings), pa.float64())
        K.trim()

    return scored(text)
