"""Items of pages made of keyed boxes, read in one pass.

A page becomes its text, once, and a list of elements in the order of their start tags.
An element is a range of that text and of that list, so what lies in a box, and the text
of whatever holds a label, are slices; nothing is walked twice and nesting costs nothing.
The few kinds of elements that matter are found for each box by bisection.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import fixed_values as V
from tidemark.functions import text as T
from tidemark.functions.slices import sliced

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SILENT = frozenset(["script", "style", "template"])
_KEY = re.compile(r"(\d+):(\d+)")


class _Ranges(HTMLParser):
    """The text of a page and the ranges of its elements."""

    def __init__(self, page: str):
        super().__init__(convert_charrefs=True)
        self.pieces: list[str] = []
        self.starts: list[int] = []  # of the pieces in the text
        self.length = 0
        self.elements: list[tuple[str, dict, int, int]] = []  # tag, attributes, place in the text, parent
        self.last: list[int] = []  # the last element within each
        self.until: list[int] = []  # where its text ends
        self.stack: list[int] = []
        self.open: dict[str, list[int]] = {}  # by tag, heights in the stack
        self.feed(page)
        self.close()
        self._pop(0)
        self.text = "".join(self.pieces)

    def handle_starttag(self, tag, attrs):
        i = len(self.elements)
        self.elements.append((tag, {k: v or "" for k, v in attrs}, self.length, self.stack[-1] if self.stack else -1))
        self.last.append(i)
        self.until.append(self.length)
        if tag not in _VOID:
            self.open.setdefault(tag, []).append(len(self.stack))
            self.stack.append(i)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self._pop(len(self.stack) - 1)

    def handle_endtag(self, tag):
        if heights := self.open.get(tag):  # else nothing of this name is open
            self._pop(heights[-1])

    def handle_data(self, data):
        if not any(self.open.get(tag) for tag in _SILENT):
            self.pieces.append(data)
            self.starts.append(self.length)
            self.length += len(data)

    def _pop(self, height: int) -> None:
        while len(self.stack) > height:
            i = self.stack.pop()
            self.open[self.elements[i][0]].pop()
            self.last[i], self.until[i] = len(self.elements) - 1, self.length

    def of(self, i: int) -> str:
        return self.text[self.elements[i][2] : self.until[i]]

    def stripped(self, i: int) -> str:
        """The text of an element, each piece without white space around it."""
        a, b = (bisect_left(self.starts, x) for x in (self.elements[i][2], self.until[i]))
        return "".join(p.strip() for p in self.pieces[a:b])


class _Places(list):
    """Ascending numbers; those from a first to a last one."""

    def within(self, first: int, last: int) -> list[int]:
        return self[bisect_left(self, first) : bisect_left(self, last + 1)]

    def first(self, first: int, last: int) -> int | None:
        i = bisect_left(self, first)
        return self[i] if i < len(self) and self[i] <= last else None


def _spare_item(page: _Ranges, mentions: _Places, start: int, end: int, prefix: str) -> int | None:
    """The number of the first ``group:number`` that stands alone between two places of the text."""
    for at in mentions[bisect_left(mentions, start) :]:
        if at >= end:
            return None
        digits = re.compile(r"\d+").match(page.text, at + len(prefix), end)
        if digits and all(i in (start - 1, end) or not re.match(r"\w", page.text[i]) for i in (at - 1, digits.end())):
            return int(digits[0])
    return None


def keyed_items(html: str | None, group: int) -> list[dict]:
    """Items of a page (group, item, key, text, notes), ordered by item; boxes without a key are left out. Null has none."""
    page = _Ranges(html or "")
    tags = [(i, tag, attrs) for i, (tag, attrs, _, _) in enumerate(page.elements) if tag in ("div", "p", "span")]
    boxes = [i for i, tag, attrs in tags if tag == "div" and attrs.get("wire:key", "").startswith(V.BOX_KEY_PREFIX)]
    boxes = boxes or [i for i, tag, attrs in tags if tag == "div" and V.BOX_CLASS in attrs.get("class", "")]
    if not boxes:
        return []
    keys = _Places(i for i, tag, attrs in tags if tag == "p" and all(c in attrs.get("class", "") for c in V.KEY_CLASSES))
    named = {label: re.compile(rf"\s*{label}\s*", re.I) for label in (V.TEXT_LABEL, V.NOTE_LABEL)}
    labels = {label: _Places(i for i, tag, _ in tags if tag == "span" and pattern.fullmatch(page.text, page.elements[i][2], page.until[i])) for label, pattern in named.items()}
    plain = f"{V.TEXT_LABEL} :"
    spots = _Places(m.start() for m in re.finditer(re.escape(plain), page.text))
    told = _Places(i for i, tag, _ in tags if tag == "p" and spots.first(page.elements[i][2], page.until[i] - len(plain)) is not None)
    mentions = _Places(m.start() for m in re.finditer(rf"(?={group}:)", page.text))

    def held(label: str, i: int) -> str:
        """The text of what holds a label, without the label."""
        whole = page.of(page.elements[i][3])
        m = re.match(rf"\s*{label}\s*:\s*", whole, re.I)
        return whole[m.end() :] if m else whole

    out = []
    for box in boxes:
        inside = (box + 1, page.last[box])
        key = keys.first(*inside)
        if m := _KEY.search(page.stripped(key) if key is not None else ""):
            g, item = int(m[1]), int(m[2])
        elif (item := _spare_item(page, mentions, page.elements[box][2], page.until[box], f"{group}:")) is not None:
            g = group
        else:
            continue
        if (i := labels[V.TEXT_LABEL].first(*inside)) is not None:
            text = held(V.TEXT_LABEL, i)
        elif (i := told.first(*inside)) is not None:
            text = page.of(i).split(plain, 1)[1].strip()
        else:
            text = ""
        notes = [held(V.NOTE_LABEL, i) for i in labels[V.NOTE_LABEL].within(*inside)]
        out.append({"group": g, "item": item, "key": f"{g}:{item}", "text": text, "notes": notes})
    return sorted(out, key=lambda x: x["item"])


def parse_keyed_pages(pages: DataFrame, group: str, html: str) -> DataFrame:
    """One row per item of each page (group, item, key, text, notes), with clean texts and without empty notes."""
    kind = pa.list_(pa.struct([("group", pa.int32()), ("item", pa.int32()), ("key", pa.string()), ("text", pa.string()), ("notes", pa.list_(pa.string()))]))

    def parsed(groups: pa.Array, texts: pa.Array) -> pa.Array:
        return pa.array([keyed_items(t.as_py(), g.as_py()) for g, t in zip(groups, texts)], kind)

    returns = "array<struct<group:int,item:int,key:string,text:string,notes:array<string>>>"
    items = pages.select(F.inline(sliced(parsed, returns)(F.col(group).cast("int"), F.col(html))))
    return items.select("group", "item", "key", T.clean_text(F.col("text")).alias("text"), _filled(F.transform("notes", T.clean_text)).alias("notes"))


def _filled(notes: Column) -> Column:
    return F.filter(notes, lambda x: x != "")
