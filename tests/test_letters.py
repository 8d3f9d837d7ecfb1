"""Letter maps, percentages as text, replacements in order, and sheets, against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions import fixed_values as V
from tidemark.functions import kernels
from tidemark.functions import text as T
from tidemark.operators import notes
from tidemark.sources import readers


def maps(text):
    before, first, n = [], {}, 0
    for i, c in enumerate(text):
        before.append(n)
        first.setdefault(n, i)
        n += not c.isspace()
    first[n] = len(text)
    return [*before, n], [first[k] for k in range(n + 1)]


def test_letter_maps(spark):
    rng = random.Random(1)
    texts = ["", " ", "a", " a b\n", "กั x\U0001f600 　y", *["".join(rng.choices("ab \n\x1c é", k=rng.randrange(60))) for _ in range(50)]]
    rows = spark.createDataFrame(list(enumerate([*texts, None])), "i int, t string").select("i", kernels.letter_maps(F.col("t")).alias("m")).collect()
    got = {r.i: r.m and (r.m.letters, r.m.places) for r in rows}
    assert got == {i: maps(t) for i, t in enumerate(texts)} | {len(texts): None}


def test_letters_before_places(spark):
    text = "a (1) bc(22)d ( 3) (4"
    places = list(range(len(text) + 2))
    row = spark.createDataFrame([(text, places), (None, [1]), (text, None)], "t string, p array<int>").select(kernels.letters_before(F.col("t"), F.col("p"), T.MARKER).alias("n"))
    got = [r.n for r in row.collect()]
    inside = [i for i in range(len(text)) if i in range(2, 5) or i in range(8, 12)]
    assert got[0] == [sum(not text[k].isspace() and k not in inside for k in range(max(p - 1, 0))) for p in places]
    assert got[1:] == [[None], None]


def test_audit_of_many_notes_in_one_text(spark):
    words = [f"w{i}" for i in range(3000)]
    ids = [str(i) for i in range(3000)]
    source = " ".join(f"{w}({i})" for w, i in zip(words, ids))
    annotated = " ".join(f"{w}[{i}]" for w, i in zip(words, ids))
    df = spark.createDataFrame([("k", source, annotated, " ".join(words), ids)], "key string, s string, a string, b string, ids array<string>")
    got = {r.note_id: (r.source_letters, r.base_letters, r.status) for r in notes.placement_audit(df, ["key"], "s", "a", "b", "ids").collect()}
    letters = 0
    for i, w in zip(ids, words):
        letters += len(w)
        assert got[i] == (letters, letters, "PERFECT")


@pytest.mark.parametrize("digits", [1, 2, 3])
def test_percentages_round_exact_values(spark, digits):
    rng = random.Random(digits)
    values = [0.0, -0.0, 0.05, 0.15, 0.25, 0.35, 0.45, -0.04, -0.05, 0.125, 2.675, 1.005, 99.95, 99.949999999999, 1e-300, 5e-324, 12345678.25, 1e12 + 0.25, float("nan"), float("inf"), float("-inf")]
    values += [rng.uniform(-200, 200) for _ in range(20_000)] + [rng.randrange(10**7) / 2 ** rng.randrange(1, 14) for _ in range(40_000)] + [round(rng.uniform(0, 100), digits) + 0.5 * 10**-digits for _ in range(40_000)]
    values += [rng.randrange(2**50) / 16 / 10**digits for _ in range(5000)]
    got = spark.createDataFrame([(v,) for v in [*values, None]], "x double").select("x", T.percent(F.col("x"), digits).alias("s")).collect()
    assert [r.s for r in got[:-1]] == [f"{v:.{digits}f}%" for v in values] and got[-1].s is None


def test_pairs_fire_in_order_even_on_what_pairs_made(spark):
    rng = random.Random(6)
    pairs = [("".join(rng.choices("abc", k=rng.randrange(1, 4))), "".join(rng.choices("abcd", k=rng.randrange(4)))) for _ in range(40)] + [(".*", "x"), ("[a]", "y"), ("a|", "b")]
    texts = ["", "zzz", "d", ".*", "[a]", "ba|", *["".join(rng.choices("abcd.*[]|z", k=rng.randrange(30))) for _ in range(300)]]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", T.in_order(F.col("t"), pairs).alias("out"), T.canonicalize(F.col("t")).alias("same")).collect()
    for r in rows:
        want = r.t
        for old, new in pairs:
            want = want.replace(old, new)
        assert (r.out, r.same) == (want, r.t)
    chained = [a + b for a, _ in V.SPELLING_PAIRS for b, _ in V.SPELLING_PAIRS[:10]] + [old[: len(old) // 2] + new + old[len(old) // 2 :] for old, new in V.SPELLING_PAIRS]
    for r in spark.createDataFrame([(t,) for t in chained], "t string").select("t", T.canonicalize(F.col("t")).alias("out")).collect():
        want = r.t
        for old, new in (*V.SPELLING_PAIRS, *V.SPELLING_ENDINGS):
            want = want.replace(old, new)
        assert r.out == want


def test_sheets_in_bodies(spark):
    df = spark.createDataFrame([(1, '﻿h,h,h\r\n1,"a, ""b""",x\r\n2,,\r\n'), (2, "h"), (3, None)], "k int, body string")
    assert [tuple(r) for r in readers.csv_bodies(df, "body", ["k"], {0: "n", 1: "v"}).collect()] == [(1, "1", 'a, "b"'), (1, "2", None)]
