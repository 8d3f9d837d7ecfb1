"""Arrow kernels that take a batch in slices, so that a task holds the values made for a slice and not those for a batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

#: Bytes of text of a slice; a row with more is a slice of its own.
SLICE_BYTES = 1 << 20


def slices(columns: Sequence[pa.Array]) -> Iterator[list[pa.Array]]:
    """The rows of a batch in order, a few at a time; of an empty batch, one empty slice."""
    rows = len(columns[0])
    sizes = np.zeros(rows, dtype=np.int64)
    for c in columns:
        if pa.types.is_string(c.type) or pa.types.is_large_string(c.type):
            sizes += pc.fill_null(pc.binary_length(c), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, start, done = np.cumsum(sizes), 0, 0
    while start < rows or not rows:
        stop = max(start + 1, int(np.searchsorted(ends, done + SLICE_BYTES, side="right")))
        yield [c.slice(start, stop - start) for c in columns]
        if stop >= rows:
            return
        start, done = stop, int(ends[stop - 1])


def sliced(kernel: Callable[..., pa.Array], returns: str):
    """A column function of ``kernel`` (arrays of one length to an array of that length), which gets slices and whose results leave as they are made."""

    @F.arrow_udf(returns)
    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for columns in batches:
            for part in slices(columns if isinstance(columns, tuple) else (columns,)):
                yield kernel(*part)

    return run
