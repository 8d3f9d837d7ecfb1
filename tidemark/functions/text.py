"""Scalar text functions as native columns.

White space is the set that Unicode-aware tools strip (``WS``), spelled out, as
engines disagree on ``\\s``. Null texts stay null unless a function says otherwise.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions import fixed_values as V

#: Inside a character class: all Unicode white space and the separators U+001C to U+001F.
WS_SET = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WS, NOT_WS = f"[{WS_SET}]", f"[^{WS_SET}]"
#: The same characters one by one.
WS_CHARS = "".join(chr(c) for c in [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
MARKER = r"\((?U)\d+\)"
BRACKET_MARKER = r"\[(?U)\d+\]"


def replace_all(text: Column, old: str, new: str) -> Column:
    return F.replace(text, F.lit(old), F.lit(new))


def trim_ws(text: Column) -> Column:
    return F.btrim(text, F.lit(WS_CHARS))


def trim_word(text: Column) -> Column:
    """:func:`trim_ws` for words, of which few need it."""
    return F.when(text.rlike(rf"\A{WS}|{WS}\z"), trim_ws(text)).otherwise(text)


#: All wide white space lies in this range; Java matches one range, or a class below U+0100, much faster than a union.
WIDE, NARROW_WS = r"[\u1680-\u3000]", r"[\t-\r\x1c-\x20\x85\xa0]"


def strip_ws(text: Column) -> Column:
    """Without any white space; spaces, which are most of it, go first and fast."""
    bare = F.replace(text, F.lit(" "), F.lit(""))
    return F.when(bare.rlike(WIDE), F.regexp_replace(bare, f"{WS}+", "")).otherwise(F.regexp_replace(bare, f"{NARROW_WS}+", ""))


def _squeeze(text: Column, blanks: str) -> Column:
    """Runs of these blanks become one space; single spaces, which are most, are not touched."""
    return F.regexp_replace(text, rf"[{blanks}]{{2,}}|[{blanks[1:]}]", " ")


def collapse_blanks(text: Column) -> Column:
    """Runs of spaces and tabs become one space; ends trimmed."""
    return trim_ws(_squeeze(text, r" \t"))


def clean_text(text: Column) -> Column:
    """Horizontal space collapses, blank lines go, ends trimmed; null becomes ''."""
    flat = _squeeze(F.coalesce(text, F.lit("")), r" \t\r\f\x0b")
    return trim_ws(F.regexp_replace(flat, rf"\n{WS}*\n", "\n"))


def typography(text: Column) -> Column:
    """Without western punctuation, blanks collapsed; null becomes ''."""
    bare = reduce(lambda x, mark: replace_all(x, mark, ""), "“”‘’—", F.coalesce(text, F.lit("")))
    return collapse_blanks(F.regexp_replace(bare, r"[.,?!:;\"\-_/\\#@$%^&*]", ""))


def any_of(words: Iterable[str]) -> str:
    """A pattern for texts that hold any of these words: a tree by common beginnings, behind a class of first characters."""
    tree: dict = {}
    for word in words:
        node = tree
        for c in word:
            node = node.setdefault(c, {})
        node[""] = {}

    def branch(node: dict) -> str:
        if "" in node:  # a shorter word is enough
            return ""
        parts = [re.escape(c) + branch(below) for c, below in node.items()]
        return parts[0] if len(parts) == 1 else f"(?:{'|'.join(parts)})"

    firsts = "".join(re.escape(c) for c in tree)
    return f"(?=[{firsts}]){branch(tree)}" if tree and "" not in tree else ""


def canonicalize(text: Column, pairs: Iterable[tuple[str, str]] = V.SPELLING_PAIRS, endings: Iterable[tuple[str, str]] = V.SPELLING_ENDINGS, keep_null: bool = False) -> Column:
    """Ordered literal replacements; null becomes '' unless ``keep_null``.

    Where no pair fires, none can by what another one made: one look for any of the
    words tells the texts that stay as they are from those that go through the pairs.
    """
    start = text if keep_null else F.coalesce(text, F.lit(""))
    return in_order(start, [*pairs, *endings])


def in_order(text: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    """Literal replacements one after another, in texts that hold any of the words."""
    replaced = reduce(lambda x, p: replace_all(x, *p), pairs, text)
    return F.when(text.rlike(any_of(old for old, _ in pairs)), replaced).otherwise(text) if len(pairs) > 3 else replaced


def replace_first(text: Column, target: Column, replacement: Column) -> Column:
    """The first occurrence replaced; an empty target prepends the replacement."""
    at = F.instr(text, target)
    return F.when(at > 0, F.concat(F.substring(text, F.lit(1), at - 1), replacement, F.substring(text, at + F.length(target), F.length(text)))).otherwise(text)


def occurrences(text: Column, needle: str) -> Column:
    return F.floor((F.length(text) - F.length(replace_all(text, needle, ""))) / len(needle)).cast("long")


def strip_markers(text: Column) -> Column:
    """Without (n) markers; horizontal space collapsed, ends trimmed."""
    return trim_ws(_squeeze(F.regexp_replace(text, MARKER, ""), r" \t\r\f\x0b"))


def note_text(note: Column) -> Column:
    """A note without its leading ((n))."""
    return trim_ws(F.regexp_replace(note, rf"^\(+(?U)\d+\)+{WS}*", ""))


def note_id(note: Column) -> Column:
    """The number of a leading ((n)); '' without one."""
    return F.regexp_extract(note, r"^\(+((?U)\d+)\)+", 1)


def norm_token(text: Column, more: str = r"\-:;") -> Column:
    """For comparison: no markers, punctuation, white space or ignored marks."""
    bare = F.regexp_replace(text, r"[\[(](?U)\d+[\])]", "")
    return F.translate(F.regexp_replace(bare, rf"[{WS_SET}ๆฯ.,!?(){more}]+", ""), V.IGNORED_MARKS, "")


def sup_to_marker(text: Column) -> Column:
    """<sup foot_note=X>Y</sup> becomes [Y]."""
    return F.regexp_replace(text, r"(?i)<sup\s+[^>]*foot_note=\"?(\d+)\"?[^>]*>([^\n]*?)</sup>", "[$2]")


def sup_parse(text: Column) -> Column:
    """Array of (orig_id, rel): a note's id and its number, or its place where that is no number."""
    pattern = r"(?i)<sup\s+[^>]*foot_note=\"?(\d+)\"?[^>]*>([^\n]*?)</sup>"
    ids, numbers = F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), F.regexp_extract_all(text, F.lit(pattern), F.lit(2))
    numbered = F.transform(numbers, lambda x, i: F.coalesce(F.when(x.rlike(r"^\d+$"), x.cast("int")), i + 1))
    return F.zip_with(ids, numbered, lambda a, b: F.struct(a.cast("long").alias("orig_id"), b.alias("rel")))


def strip_tags(text: Column, tags: tuple[str, ...] = ("span", "i", "b", "em", "strong", "u", "p", "div", "a")) -> Column:
    """Without tags whose names begin with one of ``tags``; blanks collapsed."""
    return collapse_blanks(F.regexp_replace(text, f"(?i)</?(?:{'|'.join(tags)})[^>]*>", ""))


def json_clean(text: Column) -> Column:
    """Without a code fence; from the first '[' to the last ']' if there are both."""
    bare = trim_ws(text)
    bare = F.when(bare.startswith("```"), F.regexp_replace(F.regexp_replace(bare, rf"^```(?:json)?{WS}*", ""), rf"{WS}*```\z", "")).otherwise(bare)
    first = F.instr(bare, "[")
    last = F.length(bare) - F.instr(F.reverse(bare), "]") + 1
    return F.when((first > 0) & F.contains(bare, F.lit("]")) & (last >= first), F.substring(bare, first, last - first + 1)).otherwise(bare)


def json_items(text: Column) -> Column:
    """Array of VARIANT: a list's items, the items of a dict's ``findings`` or ``results``, or the lone value."""
    value = F.try_parse_json(text)
    parts = [F.try_variant_get(value, path, "array<variant>") for path in ("$", "$.findings", "$.results")]
    return F.coalesce(*parts, F.when(value.isNotNull(), F.array(value)))


def percent(value: Column, digits: int = 1) -> Column:
    """A double as a percentage with ``digits`` (1 to 3) decimals, rounded by its exact binary value, ties to even; null for a null.

    The product with the power of ten and its rounding error are kept apart, so nothing
    is rounded twice. From 2^52 on, divided by that power, digits are those of Spark's cast to decimal.
    """
    ten = float(10**digits)
    x = F.abs(value)
    p = x * ten
    big = x * 134217729.0  # 2^27 + 1: a part of 26 bits, whose product with the power is exact, and the rest
    high = big - (big - x)
    error = (high * ten - p) + (x - high) * ten
    whole = F.floor(p).cast("double")
    over = (p - whole) - 0.5
    up = (over > 0) | ((over == 0) & ((error > 0) | ((error == 0) & (whole % 2 == 1))))
    n = whole.cast("long") + up.cast("long")
    body = F.lpad(n.cast("string"), F.greatest(F.length(n.cast("string")), F.lit(digits + 1)), "0")
    body = F.concat(F.left(body, F.length(body) - digits), F.lit("."), F.right(body, F.lit(digits)))
    body = F.when(p < float(1 << 52), body).otherwise(F.concat(x.cast("decimal(38,0)").cast("string"), F.lit("." + "0" * digits)))
    sign = F.when(value.cast("string").startswith("-"), "-").otherwise("")
    finite = F.concat(sign, body, F.lit("%"))
    return F.when(F.isnan(value), "nan%").when(x == float("inf"), F.concat(sign, F.lit("inf%"))).otherwise(finite)


def count_char(text: Column, char: str) -> Column:
    return (F.length(text) - F.length(replace_all(text, char, ""))).cast("long")


def char_share(text: Column, char: str) -> Column:
    """How much of a text is one character, in percent; NaN for a text without characters, null for a null.

    The count is in no branch: Spark moves what is computed from a ``when`` with a literal into its
    branches, and would count anew wherever that names the share.
    """
    return F.coalesce(F.try_divide(100.0 * count_char(text, char), F.length(text)), F.when(F.length(text) == 0, float("nan")))


def context(text: Column, position: Column, width: int = 25) -> Column:
    """Up to ``width`` characters before a 1-based position, trimmed."""
    start = F.greatest(F.lit(1), position - width)
    return trim_ws(F.substring(text, start, position - start))


def context_after(text: Column, position: Column, length: Column | int = 1, width: int = 25) -> Column:
    """Up to ``width`` characters after something of ``length`` characters at a 1-based position, trimmed."""
    return trim_ws(F.substring(text, position + length, F.lit(width)))


def find_all(text: Column, pattern: str, group: int = 0) -> Column:
    """Array of (position, match) of all matches, with 1-based positions of whole matches."""
    parts, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    shown = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    start = F.struct(F.lit(1).alias("at"), F.array().cast("array<struct<position:int,match:string>>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        at = s["at"] + F.length(x["part"])
        return F.struct((at + F.length(x["found"])).alias("at"), F.concat(s["out"], F.array(F.struct(at.alias("position"), x["shown"].alias("match")))).alias("out"))

    zipped = F.arrays_zip(F.slice(parts, 1, F.size(found)).alias("part"), found.alias("found"), shown.alias("shown"))
    return F.aggregate(zipped, start, step, lambda s: s["out"])


def letter_count(text: Column, marker: str = MARKER) -> Column:
    """Characters that are neither markers nor white space."""
    return F.length(strip_ws(F.regexp_replace(text, marker, ""))).cast("long")


def rewrite_markers(text: Column, pattern: str = BRACKET_MARKER) -> Column:
    """The k-th marker becomes [k]."""
    parts = F.split(text, pattern, -1)
    return F.array_join(F.transform(parts, lambda x, i: F.when(i == 0, x).otherwise(F.concat(F.lit("["), i.cast("string"), F.lit("]"), x))), "")


def insert_markers(text: Column, places: Column) -> Column:
    """[id] inserted at the character offsets of an array of (position, note_id); equal offsets keep their order, those beyond the text stand at its end."""
    ordered = F.reverse(F.array_sort(F.transform(places, lambda p, i: F.struct(p["position"].alias("at"), i.alias("i"), p["note_id"].cast("string").alias("id")))))

    def put(done: Column, p: Column) -> Column:
        at = F.least(p["at"], F.length(text))  # what is put after the text is none of it
        return F.concat(F.substring(done, F.lit(1), at), F.lit("["), p["id"], F.lit("]"), F.substring(done, at + 1, F.length(done)))

    return F.aggregate(ordered, text, put)


def mechanical_spacing(text: Column) -> Column:
    """Zero-width characters, repetition marks and brackets get regular spaces, blanks collapse.

    Rules are not tried on texts that lack what they need: a bracket, the repetition
    mark, or, for letters and zero-width characters, anything beyond ASCII.
    """
    parts = {"ws": WS, "word": NOT_WS, "thai": V.THAI, "gap": f"[{WS_SET}&&[^{V.THAI[1:]}]"}
    rules = [(p.format(**parts), new) for p, new in V.SPACING_RULES]
    no_mark = [r for r in rules if V.REPETITION not in r[0]]
    brackets = [r for r in no_mark if V.THAI not in r[0]]

    def by(start: Column, chain: list[tuple[str, str]]) -> Column:
        return _squeeze(reduce(lambda x, r: F.regexp_replace(x, *r), chain, start), r" \t")

    spaced = reduce(lambda x, c: replace_all(x, c, " "), V.NO_WIDTH, text)
    ascii_only = F.octet_length(text) == F.char_length(text)
    bracketed = F.contains(text, F.lit("(")) | F.contains(text, F.lit(")"))
    marked = F.contains(text, F.lit(V.REPETITION))
    return trim_ws(F.when(ascii_only & ~bracketed, by(text, [])).when(ascii_only, by(text, brackets)).when(~marked & ~bracketed, by(spaced, [])).when(~marked, by(spaced, no_mark)).otherwise(by(spaced, rules)))
