"""Kernels whose results are large take a batch in slices and hand on each result before the next is made."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.functions import alignment, kernels, keyed_pages
from tidemark.functions import fixed_values as V
from tidemark.functions.slices import SLICE_BYTES, sliced, slices


@pytest.fixture
def kernel(spark, monkeypatch):
    """The function that a column expression would run in a task."""

    def of(build):
        made = []
        with monkeypatch.context() as m:
            m.setattr(F, "arrow_udf", lambda returns: lambda f: made.append(f) or (lambda *_: F.lit(None).cast(returns)))
            build()
        return made[0]

    return of


def parts_of(run, *columns):
    """What a kernel yields for one batch: the rows, none of its arrays for more text than a slice has."""
    sizes = [max(len(str(c[i].as_py() or "").encode()) for c in columns) for i in range(len(columns[0]))]
    rows = []
    for part in run(iter([columns[0] if len(columns) == 1 else columns])):
        assert len(part) == 1 or sum(sizes[len(rows) : len(rows) + len(part)]) <= SLICE_BYTES
        rows += part.to_pylist()
    return rows


def test_slices_are_the_rows_in_order():
    for texts in ([], ["", None, ""], ["x" * SLICE_BYTES, "y", None, "z" * (SLICE_BYTES + 1), "é" * (SLICE_BYTES // 2), "w"] * 3):
        column = pa.array(["cut off", *texts], pa.string()).slice(1)
        parts = list(slices([column, pa.array(range(len(texts)), pa.int64())]))
        assert sum((a.to_pylist() for a, _ in parts), []) == texts and sum((b.to_pylist() for _, b in parts), []) == list(range(len(texts)))
        assert all(len(a) == 1 or sum(len(x.encode()) for x in a.to_pylist() if x) <= SLICE_BYTES for a, _ in parts)


def test_slices_of_a_task(spark):
    bytes_of = sliced(lambda a, b: pa.array([a.nbytes + b.nbytes] * len(a), pa.int64()), "long")
    rows = spark.range(400, numPartitions=1).withColumn("x", F.repeat(F.lit("x"), F.lit(10000)))
    seen = [r[0] for r in rows.select(bytes_of(F.col("x"), F.col("x"))).collect()]
    assert len(seen) == 400 and max(seen) < 1.01 * SLICE_BYTES


def test_letter_maps_leave_in_slices(kernel):
    texts = ["a b\n" * 60000, None, "", " ", "x\U0001f600 y", "é" * 300000, *["c d"] * 9, "e " * 400000]
    rows = parts_of(kernel(lambda: kernels.letter_maps(F.col("x"))), pa.array(texts, pa.string()))
    assert len(rows) == len(texts)
    for text, row in zip(texts, rows):
        if text is None:
            assert row is None
            continue
        before = [0]
        for c in text:
            before.append(before[-1] + (not c.isspace()))
        first = {n: at for at, n in reversed(list(enumerate(before)))}
        first[before[-1]] = len(text)
        assert row == {"letters": before, "places": [first[n] for n in range(before[-1] + 1)]}


def test_aligned_markers_leave_in_slices(kernel):
    base = ["word " * 60000 + str(i) for i in range(7)] + [None, "", "one two"]
    marked = [f"{b[:40]}(1){b[40:]}" if b else b for b in base]
    run = kernel(lambda: alignment.align_markers(F.col("x"), F.col("y")))
    rows = parts_of(run, pa.array(marked), pa.array(base), pa.nulls(len(base), pa.map_(pa.string(), pa.string())))
    assert [(r["annotated"], [tuple(p.values()) for p in r["placements"]]) for r in rows] == [(t, [(at, n, d) for at, n, d in p]) for t, p in (alignment.carry(m or "", b or "") for m, b in zip(marked, base))]


def test_keyed_pages_leave_in_slices(kernel, spark):
    box = f'<div wire:key="{V.BOX_KEY_PREFIX}x"><p class="font-extrabold tracking-tight">%d:1</p><p><span>Translation</span>: %s</p></div>'
    pages = [box % (i, "word " * 60000) for i in range(7)] + [None, "", box % (9, "short")]
    frame = spark.createDataFrame([], "page_id long, html string")
    rows = parts_of(kernel(lambda: keyed_pages.parse_keyed_pages(frame, "page_id", "html")), pa.array(range(10), pa.int32()), pa.array(pages))
    assert rows == [keyed_pages.keyed_items(p, i) for i, p in enumerate(pages)] and [len(r) for r in rows] == [1] * 7 + [0, 0, 1]
