"""Functions that no native expression gives, as Arrow kernels."""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions import text as T
from tidemark.functions.matching import sequence_ratio
from tidemark.functions.slices import sliced, slices


def nfc(text: Column) -> Column:
    """Unicode normalisation form C."""

    @F.arrow_udf("string")
    def normalized(texts: pa.Array) -> pa.Array:
        return pa.concat_arrays([pa.array([None if x is None else unicodedata.normalize("NFC", x) for x in part.to_pylist()], pa.string()) for part, in slices([texts])])

    # ASCII is in form C; only other texts go to Python
    return F.coalesce(normalized(F.when(F.octet_length(text) != F.char_length(text), text)), text)


def same_letters(original: Column, *others: Column) -> Column:
    """Array of booleans: whether each other text has the original's characters, in normal form C and then without white space."""

    def key(text: str) -> str:
        return "".join((text if text.isascii() else unicodedata.normalize("NFC", text)).split())

    @F.arrow_udf("array<boolean>")
    def compared(first: pa.Array, *rest: pa.Array) -> pa.Array:
        rows = []
        for a, *bs in ([x.as_py() for x in row] for row in zip(first, *rest)):
            k = None if a is None else key(a)
            rows.append([None if k is None or b is None else a == b or key(b) == k for b in bs])
        return pa.array(rows, pa.list_(pa.bool_()))

    return compared(original, *others)


def similarity(a: Column, b: Column, autojunk: bool = True) -> Column:
    """Ratcliff-Obershelp ratio; null if either side is. ``autojunk`` ignores very frequent characters of long texts."""

    @F.arrow_udf("double")
    def ratio(x: pa.Array, y: pa.Array) -> pa.Array:
        both = ((p.as_py(), q.as_py()) for p, q in zip(x, y))  # one pair of texts at a time
        return pa.array([None if p is None or q is None else sequence_ratio(p, q, autojunk) for p, q in both], pa.float64())

    return ratio(a, b)


_IS_WS = np.zeros(max(map(ord, T.WS_CHARS)) + 2, dtype=bool)  # by code point; all beyond are none
_IS_WS[[ord(c) for c in T.WS_CHARS]] = True


def _letters(text: str, marker: re.Pattern | None = None) -> np.ndarray:
    """Letters before each place of a text, its end included: what is neither white space nor within a marker."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = ~_IS_WS[np.minimum(codes, len(_IS_WS) - 1)]
    for m in marker.finditer(text) if marker else ():
        letter[m.start() : m.end()] = False
    return np.concatenate([[0], np.cumsum(letter)])


def _maps(texts: pa.Array) -> pa.Array:
    """Kernel of :func:`letter_maps`: both arrays of all texts end to end, and where each begins."""
    ends = ([0], [0])
    made = ([np.empty(0, np.int32)], [np.empty(0, np.int32)])
    for x in texts:
        if (t := x.as_py()) is not None:
            before = _letters(t)
            places = np.concatenate([[0], np.flatnonzero(np.diff(before)) + 1])
            places[-1] = len(t)
            for parts, values in zip(made, (before, places)):
                parts.append(values.astype(np.int32))
        for at, parts in zip(ends, made):
            at.append(at[-1] + (len(parts[-1]) if t is not None else 0))
    lists = [pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(np.concatenate(parts))) for at, parts in zip(ends, made)]
    return pa.StructArray.from_arrays(lists, ["letters", "places"], mask=texts.is_null())


def letter_maps(text: Column) -> Column:
    """Struct of two arrays: ``letters`` before each character and the end (letters are characters other than white
    space), and the first ``place`` that has 0, 1, ... letters before it; of all letters, the end. Null for a null."""
    return sliced(_maps, "struct<letters:array<int>,places:array<int>>")(text)


def letters_before(text: Column, places: Column, marker: str) -> Column:
    """For an array of 1-based places of a text, the letters before each, markers not counted; 0 for a place of 0."""
    pattern = re.compile(marker.replace("(?U)", ""))

    @F.arrow_udf("array<long>")
    def counted(texts: pa.Array, asked: pa.Array) -> pa.Array:
        rows = []
        for x, at in ((t.as_py(), p.as_py()) for t, p in zip(texts, asked)):
            before = _letters(x, pattern) if x is not None and at else None
            rows.append(None if at is None else [None if before is None else int(before[max(i - 1, 0)]) for i in at])
        return pa.array(rows, pa.list_(pa.int64()))

    return counted(text, places)


def cursor_find(text: Column, needles: Column) -> Column:
    """1-based places of an array of needles, each sought after the one before, else anywhere; 0 if absent."""

    def place(state: Column, needle: Column) -> Column:
        after = F.call_function("locate", needle, text, state["at"])
        found = F.when(after > 0, after).otherwise(F.instr(text, needle))
        at = F.when(after > 0, after + F.length(needle)).otherwise(state["at"])
        return F.struct(at.alias("at"), F.concat(state["places"], F.array(found)).alias("places"))

    start = F.struct(F.lit(1).alias("at"), F.array().cast("array<int>").alias("places"))
    return F.aggregate(needles, start, place, lambda s: s["places"])
