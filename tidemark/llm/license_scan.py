"""Licence scan by a positional rare-token index (native DataFrame functions only).

Words are runs of letters a-z (A-Z lower-cased), digits and non-ASCII characters. Base
labels come from fixed phrases whose words stand consecutively. Further labels come from
"templates", which are notices and paragraphs of licence texts with mandatory key
phrases. A template stands at a place of a file if, from that place on, at least half of
its words stand in the file at their own relative positions, and all of its key phrases
stand consecutively within its span, stretched by a quarter of its length on both sides.
Key phrases alone, or spread over a file, give no label. Such places are found by

1. Rare words. Inverse document frequencies of all template words are counted over the
   whole corpus. Of each template the positions of the words with the highest are
   indexed: half of them and two more, so that at least two of these are among any half
   that is in place. Of a file those of its licence words are looked up that have postings.
2. Relative positions. Each hit of a word's postings (template, position) gives the place
   where the template would begin; only places that two hits share stay.
3. Verification. All words of the template are compared in place, and the key phrases
   are sought in the span.

The frequencies decide which positions are indexed and so the cost, never the result: a
file's labels and score depend on its own words alone. Only the templates' vocabulary
reaches the driver.

Nulls and edge cases: a null or empty text has no words, no labels and score 0.
Repeated rows are scanned one by one; extra columns are dropped. ``first_word`` and
``last_word`` are null without a base phrase; occurrences that overlap all count.
The score is the best template's share of words in place, and 0.5 at least where a base
phrase stands, which only names a licence.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

AGREE = 2  # indexed words in place that make a place worth a look
NAMED = 0.5  # the score of a base phrase alone

BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)


@dataclass(frozen=True)
class Template:
    """The words of a notice or paragraph (three or more), and phrases of it that must stand within its span."""

    label: str
    words: str
    keys: tuple[str, ...]


_FREE = "is free software you can redistribute it and or modify it under the terms of the"
_LATER = "as published by the free software foundation either"
_OPTION = "of the license or at your option any later version"

#: Short notices and paragraphs of public licence texts: fixed values.
TEMPLATES = (
    Template("gpl-3.0", "this work is licensed under the gnu general public license version 3", ("gnu general public license", "version 3")),
    Template("gpl-notice", f"this program {_FREE} gnu general public license {_LATER} version 3 {_OPTION}", ("free software", "general public license")),
    Template("gpl-notice", "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details", ("in the hope that it will be useful", "see the gnu general public license for more details")),
    Template("gpl-notice", "you should have received a copy of the gnu general public license along with this program if not see https www gnu org licenses", ("you should have received a copy", "gnu general public license along with this program")),
    Template("lgpl", f"this library {_FREE} gnu lesser general public license {_LATER} version 2 1 {_OPTION}", ("gnu lesser general public license",)),
    Template("agpl-3.0", f"this program {_FREE} gnu affero general public license {_LATER} version 3 {_OPTION}", ("gnu affero general public license",)),
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license", "version 2 0")),
    Template("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0", ("apache license", "version 2 0")),
    Template("apache-terms", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license", ("required by applicable law or agreed to in writing", "specific language governing permissions and limitations")),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc", "4 0")),
    Template("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa", "4 0")),
    Template("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license", ("creative commons attribution", "4 0 international")),
    Template("cc0-1.0", "the person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law including all related and neighboring rights to the extent allowed by law", ("associated a work with this deed", "public domain by waiving all")),
    Template("mit-notice", "released under the mit license", ("released under", "mit license")),
    Template("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions", ("permission is hereby granted", "free of charge")),
    Template("mit-text", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software", ("merchantability fitness for a particular purpose and noninfringement", "or other dealings in the software")),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer", ("redistribution and use", "binary forms")),
    Template("bsd", "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage", ("provided by the copyright holders and contributors", "procurement of substitute goods or services")),
    Template("bsd-3-clause", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", ("names of its contributors", "endorse or promote products derived from this software")),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", ("permission to use copy modify", "for any purpose with or without fee is hereby granted")),
    Template("zlib", "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions", ("permission is granted to anyone to use this software", "to alter it and redistribute it freely")),
    Template("bsl-1.0", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following", ("any person or organization obtaining a copy", "covered by this license")),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license", "2 0")),
    Template("unlicense", "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means", ("unencumbered software", "public domain")),
)


def words(text: Column) -> Column:
    """Array of the text's words; one more, empty, stands before or after them where the text begins or ends with a separator.

    Lower case beyond A-Z cannot make a word equal to one of ASCII letters but for
    the two characters that are put out of the way first.
    """
    low = F.lower(F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("\u0130"), F.lit("\xdf")), F.lit("\u212a"), F.lit("\xdf")))
    return F.split(low, SEPARATORS, -1)


def _spaces(text: Column) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))).cast("long")


def _quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _literals(values: Iterable[str]) -> Column:
    return F.expr(f"cast(array({', '.join(map(_quoted, values))}) as array<string>)")


def _nested(rows: list[Iterable[str]]) -> Column:
    inner = ", ".join(f"array({', '.join(map(_quoted, r))})" for r in rows)
    return F.expr(f"cast(array({inner}) as array<array<string>>)")


def _numbers(values: list[int]) -> Column:
    return F.expr(f"cast(array({', '.join(map(str, values))}) as array<int>)")


def _occurrences(padded: Column, n_words: Column, phrase: str) -> Column:
    """Count, first and last start of a phrase in '| w0 w1 ... '; null where it does not stand."""
    parts = F.split(padded, f"(?= {phrase} )", -1)  # cut before each start, so overlapping ones count
    found = F.struct(
        (F.size(parts) - 1).cast("long").alias("n"),
        _spaces(F.get(parts, F.lit(0))).alias("first"),
        (n_words + 1 - _spaces(F.get(parts, F.size(parts) - 1))).alias("last"),
    )
    return F.when(F.contains(padded, F.lit(f" {phrase} ")), found)


def frequencies(docs: DataFrame, text: str, vocabulary: list[str]) -> dict[str, int]:
    """Number of documents with each vocabulary word."""
    held = docs.select(F.explode(F.array_intersect(words(F.col(text)), _literals(vocabulary))).alias("w"))
    return {r["w"]: r["count"] for r in held.groupBy("w").count().collect()}  # a row per vocabulary word


def _rarest(places: list[tuple[str, int]], df: dict[str, int], n: int) -> list[tuple[str, int]]:
    """The ``n`` (word, position) whose words have the highest inverse document frequencies."""
    return sorted(places, key=lambda x: (df.get(x[0], 0), x[1]))[:n]


def least_in_place(n: int) -> int:
    """How many of a template's ``n`` words must be in place."""
    return (n + 1) // 2


def stretch(n: int) -> int:
    """By how many words a template's span is stretched on either side for its key phrases."""
    return max(2, n // 4)


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", templates: tuple[Template, ...] = TEMPLATES, base: tuple[tuple[str, str], ...] = BASE) -> DataFrame:
    """``key, n_words, n_base, first_word, last_word, base_labels, labels, score`` for every document."""
    spelled = [t.words.split() for t in templates]
    if any(len(ws) < 3 for ws in spelled):
        raise ValueError("a template needs three words or more")
    df = frequencies(docs, text, sorted({w for ws in [*spelled, *(p.split() for p, _ in base)] for w in ws}))
    postings: dict[str, list[tuple[int, int]]] = {}
    for i, ws in enumerate(spelled):
        n = len(ws)
        for w, place in _rarest([(w, p) for p, w in enumerate(ws)], df, n - least_in_place(n) + AGREE):
            postings.setdefault(w, []).append((i, place))
    asked_base = [_rarest([(w, i) for i, w in enumerate(p.split())], df, 1)[0][0] for p, _ in base]

    rows = docs.select(F.col(key).alias("k"), words(F.col(text)).alias("w"))
    lead, trail = (F.get("w", F.lit(0)) == "").cast("int"), (F.element_at("w", -1) == "").cast("int")
    n_words = F.greatest(F.size("w") - lead - trail, F.lit(0)).cast("long")
    rows = rows.select("k", "w", n_words.alias("n_words"), lead.alias("lead"), F.array_intersect("w", _literals(sorted({*postings, *asked_base}))).alias("held"))

    # licence words of the file with their places, and for each the templates' places for it
    none = F.array().cast("array<struct<t:int,off:int>>")
    starts = none
    if postings:
        entries = (f"{_quoted(w)}, array({', '.join(f"struct({t} as t, {p} as p)" for t, p in at)})" for w, at in sorted(postings.items()))
        posted = F.expr(f"map({', '.join(entries)})")
        hits = F.filter(F.transform("w", lambda w, i: F.struct(w.alias("w"), (i - F.col("lead")).alias("i"))), lambda x: x["w"].isin(sorted(postings)))
        places = F.flatten(F.transform(hits, lambda x: F.transform(F.element_at(posted, x["w"]), lambda p: F.struct(p["t"].alias("t"), (x["i"] - p["p"]).alias("off")))))
        starts = F.when(F.arrays_overlap("held", _literals(sorted(postings))), F.array_sort(places)).otherwise(none)
    base_asked = F.arrays_overlap("held", _literals(sorted(set(asked_base)))) if base else F.lit(False)
    padded = F.when(base_asked, F.concat(F.lit("| "), F.trim(F.array_join("w", " ")), F.lit(" ")))
    rows = rows.select("k", "w", "n_words", "lead", padded.alias("padded"), starts.alias("starts"))
    found = [_occurrences(F.col("padded"), F.col("n_words"), phrase).alias(f"b{i}") for i, (phrase, _) in enumerate(base)]
    # sorted, a place shared by so many hits stands that often in a row
    agreed = F.filter(F.transform("starts", lambda x, i: F.when(F.get("starts", i + AGREE - 1) == x, x)), lambda x: x.isNotNull())
    rows = rows.select("k", "w", "n_words", "lead", *found, F.when(F.size("starts") >= AGREE, F.array_distinct(agreed)).otherwise(none).alias("places"))

    keys, texts = _nested([[f" {k} " for k in t.keys] for t in templates]), _nested(spelled)
    least, more = _numbers([least_in_place(len(ws)) for ws in spelled]), _numbers([stretch(len(ws)) for ws in spelled])
    names = _literals(t.label for t in templates)

    def in_place(x: Column) -> Column:
        same = F.transform(F.get(texts, x["t"]), lambda v, i: (x["off"] + i >= 0) & F.coalesce(F.get("w", x["off"] + F.col("lead") + i) == v, F.lit(False)))
        return F.size(F.filter(same, lambda y: y))

    def span(x: Column) -> Column:
        first = F.greatest(x["off"] - F.get(more, x["t"]), F.lit(0))
        end = x["off"] + F.size(F.get(texts, x["t"])) + F.get(more, x["t"])
        return F.concat(F.lit(" "), F.array_join(F.slice("w", first + F.col("lead") + 1, F.greatest(end - first, F.lit(0))), " "), F.lit(" "))

    counted = F.transform("places", lambda x: F.struct(x["t"].alias("t"), x["off"].alias("off"), in_place(x).alias("n")))
    rows = rows.withColumn("places", F.filter(counted, lambda x: x["n"] >= F.get(least, x["t"])))
    spans = F.transform("places", lambda x: F.struct(x["t"].alias("t"), (x["n"] / F.size(F.get(texts, x["t"]))).alias("share"), span(x).alias("span")))
    rows = rows.withColumn("places", F.filter(spans, lambda x: F.forall(F.get(keys, x["t"]), lambda k: F.contains(x["span"], k))))
    best = F.coalesce(F.array_max(F.transform("places", lambda x: x["share"])), F.lit(0.0))
    own = F.array_distinct(F.transform("places", lambda x: F.get(names, x["t"])))

    hit = [F.col(f"b{i}") for i in range(len(base))]
    labels = F.array_sort(F.array_distinct(F.array_compact(F.array(*[F.when(b.isNotNull(), F.lit(label)) for b, (_, label) in zip(hit, base)]).cast("array<string>"))))
    n_base = reduce(lambda a, b: a + b, [F.coalesce(b["n"], F.lit(0)) for b in hit], F.lit(0)).cast("long")
    none_yet = [F.lit(None).cast("long")] * 2  # least and greatest need two columns
    firsts, lasts = [b["first"] for b in hit] + none_yet, [b["last"] for b in hit] + none_yet
    return rows.select(
        "k",
        "n_words",
        n_base.alias("n_base"),
        F.least(*firsts).alias("first_word"),
        F.greatest(*lasts).alias("last_word"),
        labels.alias("base"),
        own.alias("own"),
        best.alias("best"),
    ).select(
        F.col("k").alias(key),
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", "own")), ",").alias("labels"),
        F.greatest("best", F.when(F.col("n_base") > 0, NAMED).otherwise(0.0)).alias("score"),
    )
