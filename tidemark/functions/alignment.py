"""Carrying numbered markers of an annotated text over to a plain base text.

The annotated text is read once into markers, each with the letters before it and
the words around it. Sources of evidence propose places in the base, each proposal
with a rank and a distance in letters, and the least (rank, distance) is taken:

* a phrase known to precede the marker, or the end of the text;
* places after characters equal to those before the marker (left), or before
  characters equal to those after it (right); a left place within ``SURE`` letters
  outranks the right ones, within ``NEAR`` the nearer of both wins, and one within
  ``FAR`` counts where there is nothing on the right;
* the place with the marker's share of letters, moved to a word boundary.

No place lies before that of the marker before it, within combining marks, or
before a closing bracket or quote.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions import fixed_values as V
from tidemark.functions.slices import sliced

SURE, NEAR, FAR = 5, 7, 15
CONTEXT, SNAP = 10, 8
PIECES = (10, 8, 6)  # characters of a context that are sought, the most first
LEAST_PIECE = 4

_MARKER = re.compile(r"\((\d+)\)")
_ANY_MARKER = re.compile(r"[\[(]\d+[\])]")
_NOISE = re.compile(r"[\sๆฯ.,!?()\-:;]+")
_IGNORED = str.maketrans("", "", V.IGNORED_MARKS)
_CLOSING = re.compile(f"[{V.COMBINING_MARKS}]*[)\\]\"']?")
_KNOWN, _BESIDE, _BETWEEN, _ASIDE, _BY_SHARE = range(5)


def bare(text: str) -> str:
    """A comparison form without markers, punctuation, white space and ignored marks."""
    return _NOISE.sub("", _ANY_MARKER.sub("", text)).translate(_IGNORED)


@dataclass
class Marker:
    number: str
    letters: int  # before it
    before: str
    after: str
    ends: bool  # only punctuation follows


def read_markers(text: str) -> tuple[list[Marker], int]:
    """The markers of an annotated text, and all its letters."""
    parts = _MARKER.split(text)
    plain, numbers = parts[0::2], parts[1::2]
    afters, rest = [], ""
    for segment in reversed(plain[1:]):
        rest = segment + rest
        shown = rest.lstrip()
        afters.append(shown[:CONTEXT].strip())
        rest = rest[: len(rest) - len(shown) + CONTEXT]
    out, letters, held = [], 0, ""
    for number, segment, after in zip(numbers, plain, reversed(afters)):
        letters += len("".join(segment.split()))
        held += segment
        shown = held.rstrip()
        out.append(Marker(number, letters, shown[-CONTEXT:].strip(), after, False))
        held = held[max(0, len(shown) - CONTEXT) :]
    if out:
        out[-1].ends = all(c.isspace() or c in ".,!?" for c in plain[-1])
    return out, letters + len("".join(plain[-1].split()))


class Base:
    """A plain text with its letters counted."""

    def __init__(self, text: str):
        self.text = text
        self.blanks = [m.start() for m in re.finditer(r"\s", text)]
        self.total = len(text) - len(self.blanks)

    def letters(self, at: int) -> int:
        """Letters before a place."""
        return at - bisect_left(self.blanks, at)

    def place(self, letters: int) -> int:
        """The first place with so many letters before it; the end for all of them."""
        if letters >= self.total:
            return len(self.text)
        return bisect_left(range(len(self.text)), letters, key=self.letters)

    def past(self, at: int) -> int:
        """Past combining marks and one closing character."""
        return _CLOSING.match(self.text, at).end()

    def boundary(self, at: int) -> int:
        """A place within a word moves to the nearest space within ``SNAP`` characters; the earlier of two."""
        text, size = self.text, len(self.text)
        if at <= 0 or at >= size:
            return min(max(at, 0), size)
        at = self.past(at)
        if at == size or text[at] in ".,!?:;)]" or text[at - 1 : at + 1].strip() != text[at - 1 : at + 1]:
            return at
        spaces = [i for i in (text.rfind(" ", max(0, at - SNAP), at), text.find(" ", at, at + SNAP)) if i >= 0]
        return self.past(min(spaces, key=lambda i: abs(i - at))) if spaces else at

    def stands(self, piece: str) -> Iterator[int]:
        at = self.text.find(piece)
        while at >= 0:
            yield at
            at = self.text.find(piece, at + 1)

    def beside(self, context: str, follows: bool, least: int) -> list[int]:
        """Places from ``least`` on after the end of ``context`` (or, if it ``follows``, before its beginning), by its longest piece with any."""
        wanted = bare(context)
        for size in PIECES:
            piece = wanted[:size] if follows else wanted[-size:]
            if len(piece) < LEAST_PIECE or bare(piece) != piece:
                continue
            places = (self.past(len(self.text[:i].rstrip()) if follows and self._spaced(i) else i if follows else i + len(piece)) for i in self.stands(piece))
            if found := [at for at in places if at >= least]:
                return found
        return []

    def _spaced(self, at: int) -> bool:
        return at > 0 and self.text[at - 1].isspace()


def _proposals(base: Base, marker: Marker, whole: int, least: int, phrases: dict[str, str]) -> Iterator[tuple[int, int, int]]:
    """(rank, distance, place), those of a better rank first."""

    def apart(at: int) -> int:
        return abs(marker.letters - base.letters(at))

    phrase = phrases.get(marker.number)
    if phrase and phrase in base.text:
        yield _KNOWN, apart(at := base.past(base.text.index(phrase) + len(phrase))), at
        return
    if marker.ends:
        yield _KNOWN, apart(len(base.text)), len(base.text)
        return
    left = min(((apart(at), at) for at in base.beside(marker.before, False, least)), key=lambda x: x[0], default=None)
    right = min(((apart(at), at) for at in base.beside(marker.after, True, least)), key=lambda x: x[0], default=None)
    for found, rank in ((left, _ASIDE if left and left[0] > NEAR else _BETWEEN if left and left[0] > SURE else _BESIDE), (right, _BETWEEN)):
        if found and (rank != _ASIDE or found[0] <= FAR):
            yield rank, found[0], base.past(found[1])
    share = base.total / whole if whole else 1.0
    at = max(least, base.boundary(base.place(min(base.total, round(marker.letters * share)))))
    yield _BY_SHARE, apart(at), base.past(at)


def carry(annotated: str, plain: str, phrases: dict[str, str] | None = None) -> tuple[str, list[tuple[int, str, int]]]:
    """The base with [n] markers, and for each marker its (position, number, letter distance)."""
    markers, whole = read_markers(annotated)
    base, placed = Base(plain), []
    for marker in markers:
        _, distance, at = min(_proposals(base, marker, whole, placed[-1][0] if placed else 0, phrases or {}), key=lambda p: p[:2])
        placed.append((at, marker.number, distance))
    out, done = [], 0
    for at, number, _ in sorted(placed, key=lambda p: p[0]):
        out += [plain[done:at], f"[{number}]"]
        done = at
    return "".join([*out, plain[done:]]), placed


def snap_boundary(text: Column, position: Column) -> Column:
    """An offset moved out of a word to a space within eight characters, and past combining marks."""

    @F.arrow_udf("int")
    def snapped(texts: pa.Array, at: pa.Array) -> pa.Array:
        return pa.array([None if t is None or p is None else Base(t).boundary(p) for t, p in ((x.as_py(), y.as_py()) for x, y in zip(texts, at))], pa.int32())

    return snapped(text, position.cast("int"))


ALIGNED = "struct<annotated:string,placements:array<struct<position:int,note_id:string,letter_delta:int>>>"


def align_markers(annotated: Column, base: Column, phrases: Column | None = None) -> Column:
    """Struct column (annotated, placements); ``phrases`` is a map from note id to the phrase that it follows."""
    kind = pa.struct([("annotated", pa.string()), ("placements", pa.list_(pa.struct([("position", pa.int32()), ("note_id", pa.string()), ("letter_delta", pa.int32())])))])

    def aligned(texts: pa.Array, bases: pa.Array, known: pa.Array) -> pa.Array:
        rows = []
        for t, b, k in zip(texts, bases, known):
            text, places = carry(t.as_py() or "", b.as_py() or "", dict(k.as_py() or []))
            rows.append({"annotated": text, "placements": [dict(zip(("position", "note_id", "letter_delta"), p)) for p in places]})
        return pa.array(rows, kind)

    return sliced(aligned, ALIGNED)(annotated, base, phrases if phrases is not None else F.lit(None).cast("map<string,string>"))
