"""Repetition coverage rules.

Each text is cut into words (runs of anything but space and 0x09-0x0D). Rolling
hashes of several n-gram lengths mark the words that lie in duplicated n-grams,
and the verdict compares the covered characters with a limit per length; the
characters of repeated lines and the share of repeated lines have limits too.

Nulls and edge cases: a null or empty text has no words and fails the base rule.
Repeated rows are judged row by row; texts of any length are measured whole. Extra
columns are dropped by :func:`judge` and kept by :func:`keep`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import kernels as K

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True

REPORT = (
    "struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,n_repeat_words:bigint,"
    "dup_line_share:double,dup_line_chars:double,top_ngram_chars:array<double>,dup_ngram_chars:array<double>,symbol_share:double,"
    "base_failed:boolean,kept:boolean>"
)


@dataclass(frozen=True)
class Limits:
    """A text is rejected when a measure is above its limit (shares of word characters or lines)."""

    min_words: int = 50
    repeat_words_percent: int = 50
    #: n-gram length -> characters of all occurrences of one n-gram, the most covering
    top_ngram: tuple[tuple[int, float], ...] = ((2, 0.20), (3, 0.18), (4, 0.16))
    #: n-gram length -> share of characters inside any duplicated n-gram, its first occurrence included
    dup_ngram: tuple[tuple[int, float], ...] = ((5, 0.30), (6, 0.28), (7, 0.26), (8, 0.24), (9, 0.22), (10, 0.20))
    dup_lines: float = 0.30
    dup_line_chars: float = 0.20
    symbols: float = 0.10


def _window_ends(first: np.ndarray) -> np.ndarray:
    """For each word, the end of its text."""
    return np.repeat(first[1:], np.diff(first))


def _duplicated(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose hash occurs twice or more, ordered by hash, and the starts of their groups."""
    order = np.argsort(hashes)
    ordered = hashes[order]
    fresh = np.ones(len(ordered) + 1, dtype=bool)
    fresh[1:-1] = ordered[1:] != ordered[:-1]
    keep = ~(fresh[:-1] & fresh[1:])
    return order[keep], np.flatnonzero(fresh[:-1][keep])


def _per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(values)))
    return sums[first[1:]] - sums[first[:-1]]


class Windows:
    """Duplicated windows of growing length over a block of texts.

    A window of n words can only be duplicated where its first n - 1 words are,
    so each length looks at the survivors of the one before.
    """

    def __init__(self, hashes: np.ndarray, first: np.ndarray):
        self.hashes, self.first = hashes, first
        self.stop = _window_ends(first)
        self.text = np.repeat(np.arange(len(first) - 1), np.diff(first))
        self.at = np.arange(len(hashes))
        # the text's number is part of the hash: equal windows of two texts differ
        self.acc = K.mix64(self.text.astype(np.uint64) + np.uint64(1)) + hashes
        self.n = 1
        self.groups = np.zeros(0, np.int64)

    def grow(self) -> None:
        self.n += 1
        fits = self.at + self.n <= self.stop[self.at] if len(self.at) else np.zeros(0, bool)
        self.at, self.acc = self.at[fits], self.acc[fits]
        self.acc = K.mix64(self.acc * np.uint64(0x2545F4914F6CDD1D) + self.hashes[self.at + self.n - 1])
        order, self.groups = _duplicated(self.acc)
        self.at, self.acc = self.at[order], self.acc[order]

    def covered(self) -> np.ndarray:
        """Mask of the words inside duplicated windows."""
        n = len(self.hashes)
        steps = np.bincount(self.at, minlength=n + 1) - np.bincount(self.at + self.n, minlength=n + 1)
        return np.cumsum(steps[:n]) > 0

    def top(self, chars: np.ndarray) -> np.ndarray:
        """Per text, the characters of all occurrences of the n-gram that has most of them."""
        out = np.zeros(len(self.first) - 1)
        if len(self.at):
            ends = np.concatenate(([0], np.cumsum(chars)))
            sums = np.add.reduceat(ends[self.at + self.n] - ends[self.at], self.groups)
            np.maximum.at(out, self.text[self.at[self.groups]], sums)
        return out


def _lines(text: str) -> tuple[int, int, int, int]:
    """Lines with a word, those equal to an earlier one, and the characters of both."""
    seen: set[str] = set()
    n_lines = n_dup = all_chars = dup_chars = 0
    for line in text.split("\n"):
        if not line.strip(" \t\n\r\x0b\x0c"):
            continue
        n_lines += 1
        all_chars += len(line)
        if line in seen:
            n_dup += 1
            dup_chars += len(line)
        seen.add(line)
    return n_lines, n_dup, all_chars, dup_chars


def _measure_block(texts: pa.Array, limits: Limits) -> list[np.ndarray]:
    data, offsets = K.string_buffers(texts)
    starts, ends, first = K.word_bounds(data, offsets)
    hashes = K.word_hashes(data, starts, ends, fold_case=False)
    points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    chars = points[ends] - points[starts]
    symbols = np.concatenate(([0], np.cumsum(_SYMBOL[data])))
    n, total = np.diff(first), _per_text(chars, first)
    n_symbols = symbols[offsets[1:]] - symbols[offsets[:-1]]
    lines = np.array([_lines(data[a:b].tobytes().decode()) for a, b in zip(offsets, offsets[1:])], dtype=np.int64).reshape(-1, 4)
    some = np.maximum(total, 1)

    tops, dups, repeat = dict(limits.top_ngram), dict(limits.dup_ngram), np.zeros(len(n), np.int64)
    top, dup = [], []
    windows = Windows(hashes, first)
    while windows.n < max(3, *tops, *dups):
        windows.grow()
        if windows.n == 3 or windows.n in dups:
            mask = windows.covered()
            if windows.n == 3:
                repeat = _per_text(mask, first)
            if windows.n in dups:
                dup.append(_per_text(chars * mask, first) / some)
        if windows.n in tops:
            top.append(np.minimum(windows.top(chars) / some, 1.0))
    line_share = lines[:, 1] / np.maximum(lines[:, 0], 1)
    line_chars = lines[:, 3] / np.maximum(lines[:, 2], 1)
    share = n_symbols / some
    base_failed = (n < limits.min_words) | (100 * repeat > limits.repeat_words_percent * n)
    failed = base_failed | (line_share > limits.dup_lines) | (line_chars > limits.dup_line_chars) | (share > limits.symbols)
    for values, limit in [*zip(top, tops.values()), *zip(dup, dups.values())]:
        failed = failed | (values > limit)
    return [n, total, n_symbols, lines[:, 1], repeat, line_share, line_chars, np.stack(top, 1), np.stack(dup, 1), share, base_failed, ~failed]


def measure_array(texts: pa.Array, limits: Limits) -> pa.Array:
    names = [x.split(":")[0] for x in REPORT[7:-1].split(",")]
    ranges = list(K.blocks(texts)) or [(0, 0)]
    return pa.concat_arrays([pa.StructArray.from_arrays([_column(c) for c in _measure_block(texts.slice(i, j - i), limits)], names=names) for i, j in ranges])


def _column(values: np.ndarray) -> pa.Array:
    if values.ndim == 2:
        return pa.ListArray.from_arrays(np.arange(0, values.size + 1, values.shape[1], dtype=np.int32), pa.array(values.ravel(), pa.float64()))
    return pa.array(values)


def report(text: Column, limits: Limits = Limits()) -> Column:
    """A struct column with all measures, ``base_failed`` and ``kept``."""

    @F.arrow_udf(REPORT)
    def measured(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield measure_array(texts, limits)
        K.trim()

    return measured(text)


def judge(docs: DataFrame, limits: Limits = Limits(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and all measures, one row per document; shares are named by n-gram length."""
    found = docs.select(F.col(key), report(F.col(text), limits).alias("r"))
    lists = {"top_ngram_chars": [f"top_{n}" for n, _ in limits.top_ngram], "dup_ngram_chars": [f"dup_{n}" for n, _ in limits.dup_ngram]}
    shown = []
    for field in REPORT[7:-1].split(","):
        name = field.split(":")[0]
        shown += [F.col(f"r.{name}")[i].alias(n) for i, n in enumerate(lists[name])] if name in lists else [F.col(f"r.{name}")]
    return found.select(key, *shown)


def keep(docs: DataFrame, limits: Limits = Limits(), text: str = "text") -> DataFrame:
    """The documents that pass, with their own columns."""
    names = docs.columns
    return docs.withColumn("__kept", report(F.col(text), limits)["kept"]).where("__kept").select(*[F.col(f"`{c}`") for c in names])
