"""Each operator against brute force, exact round trips, and its edge cases."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import html_extract, license_scan, media, mixing, ngram_join, packing, quality_model, repetition, scratch, token_files, tokens, url_rules
from tidemark.llm import kernels as K

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, size string, node string, k string, at string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def nasty_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows; extra columns with clashing names."""
    rng = random.Random(7)
    long_text = " ".join(rng.choice(["alpha", "beta", "gamma", "Delta", "é", "##"]) + str(rng.randrange(5000)) for _ in range(60_000))
    texts = [None, "", "   \n\t ", "one", "one two three four", "one two three four five", long_text, long_text, "MIT License applies here\x00and\x1fthere", "퟿\U0001f600 emoji", "a\r\nb\x0bc\x0cd"]
    rows = [(i, t, "en" if i % 2 else None, "s" if i % 3 else None, None, "x", "y", "z", "k", "a") for i, t in enumerate(texts)]
    return rows + [rows[5], rows[5], (None, "no id at all", None, None, None) + (None,) * 5]


@pytest.fixture(scope="module")
def nasty(spark):
    return spark.createDataFrame(nasty_rows(), SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# ------------------------------------------------------------------ kernels


def test_words_and_hashes_match_python(monkeypatch):
    monkeypatch.setattr(K, "BLOCK_BYTES", 64)
    texts = [r[1] for r in nasty_rows()][:6] + ["Aa aA  bb\tAa", "x" * 500 + " y", "ünï cödé"]
    data, offsets = K.string_buffers(pa.array(texts))
    starts, ends, first = K.word_bounds(data, offsets)
    raw = data.tobytes()
    for k, t in enumerate(texts):
        got = [raw[a:b].decode() for a, b in zip(starts[first[k] : first[k + 1]], ends[first[k] : first[k + 1]])]
        assert got == WORD.findall(t or "")
    exact, folded = K.word_hashes(data, starts, ends, False), K.word_hashes(data, starts, ends, True)
    words = [raw[a:b] for a, b in zip(starts, ends)]
    for hashes, norm in ((exact, lambda w: w), (folded, bytes.lower)):
        seen = {}
        for w, h in zip(words, hashes):
            assert seen.setdefault(norm(w), h) == h
        assert len(set(seen.values())) == len(seen)


# ------------------------------------------------------------------ media


@pytest.mark.parametrize("filters", [(0,), (1,), (2,), (3,), (4,), (0, 1, 2, 3, 4)])
def test_png_filters_round_trip(filters):
    rng = np.random.default_rng(3)
    smooth = (np.add.outer(np.arange(37), np.arange(64)) * 3 % 256).astype(np.uint8)
    for rows in (smooth, rng.integers(0, 256, (9, 64), dtype=np.uint8), smooth[:1]):
        raw = np.frombuffer(media.filter_rows(rows, filters), dtype=np.uint8).reshape(len(rows), 65)
        assert (media.unfilter(raw[:, 1:], raw[:, 0]) == rows).all()
        assert (media.decode(media.encode(rows.tobytes(), filters=filters)) == rows).all()


@pytest.mark.parametrize("width", [1, 7, 64])
def test_mixed_filters_against_plain_loops(width, monkeypatch):
    monkeypatch.setattr(media, "BAND", 5)
    rng = np.random.default_rng(width)
    raw, kinds = rng.integers(0, 256, (60, width), dtype=np.uint8), rng.integers(0, 5, 60)
    want = np.zeros((60, width), dtype=int)
    for r in range(60):
        for c in range(width):
            a, b, x = want[r, c - 1] if c else 0, want[r - 1, c] if r else 0, want[r - 1, c - 1] if r and c else 0
            p = a + b - x
            paeth = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - x), 2, x))[2]
            want[r, c] = (int(raw[r, c]) + (0, a, b, (a + b) // 2, paeth)[kinds[r]]) % 256
    assert (media.unfilter(raw, kinds.astype(np.uint8)) == want).all()


def test_inflating_stops_at_the_stated_size():
    rows = np.zeros((3, 64), dtype=np.uint8)
    head = media.struct.pack(">IIBBBBB", 64, 3, 8, 0, 0, 0, 0)
    for body in (zlib.compress(bytes(100_000_000)), zlib.compress(bytes(3 * 65)) + b"x", zlib.compress(bytes(3 * 65))[:-2]):
        blob = media.SIGNATURE + media._chunk(b"IHDR", head) + media._chunk(b"IDAT", body) + media._chunk(b"IEND", b"")
        with pytest.raises(media.MediaError):
            media.decode(blob)
    assert (media.decode(media.encode(rows.tobytes())) == rows).all()


def test_hash_against_plain_cosine_transform():
    for h, w, seed in ((5, 64, 1), (40, 64, 2), (33, 20, 3)):
        image = np.random.default_rng(seed).integers(0, 256, (h, w)).astype(np.uint8)
        big = np.kron(image.astype(float), np.ones((32, 32)))  # area averages by whole cells
        small = big.reshape(32, h, 32, w).mean(axis=(1, 3))
        low = np.zeros((8, 8))
        for u in range(8):
            for v in range(8):
                low[u, v] = sum(small[y, x] * np.cos(np.pi * u * (2 * y + 1) / 64) * np.cos(np.pi * v * (2 * x + 1) / 64) for y in range(32) for x in range(32))
        low = np.round(low, 6).ravel()
        ordered = np.sort(low)
        bits = "".join("1" if 2 * x > ordered[31] + ordered[32] else "0" for x in low)
        assert media.perceptual_hash(image) == int(bits, 2)


def test_damaged_media_are_refused():
    blob = media.encode(media.padded(b"some text " * 40))
    for i in range(0, len(blob), 7):
        with pytest.raises(media.MediaError):
            media.decode(blob[:i] + bytes([blob[i] ^ 1]) + blob[i + 1 :])
    with pytest.raises(media.MediaError):
        media.decode(blob[:-3])


def test_headers_that_lie_are_refused():
    import struct

    def chunk(kind, body):
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    def png(*parts):
        return b"\x89PNG\r\n\x1a\n" + b"".join(chunk(k, b) for k, b in parts)

    def header(width, height):
        return b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)

    data, end = zlib.compress(b"\0abc\0def"), (b"IEND", b"")
    whole = png(header(3, 2), (b"IDAT", data[:4]), (b"IDAT", data[4:]), end)
    assert media.decode(whole).tolist() == [[97, 98, 99], [100, 101, 102]]
    bad = [
        png((b"IHDR", b"abc"), (b"IDAT", data), end),
        png(header(3, 0), (b"IDAT", zlib.compress(b"")), end),
        png(header(0, 2), (b"IDAT", zlib.compress(b"\0\0")), end),
        png(header(3, 2), (b"IDAT", data[:4]), (b"tEXt", b"between"), (b"IDAT", data[4:]), end),
        png(header(3, 2), end),
        png(header(3, 3), (b"IDAT", data), end),
    ]
    for blob in bad:
        with pytest.raises(media.MediaError):
            media.decode(blob)


def test_hash_follows_the_picture():
    x = np.kron(np.random.default_rng(0).integers(0, 256, (8, 8), dtype=np.uint8), np.ones((8, 8), np.uint8))
    near = np.clip(x.astype(int) + np.random.default_rng(1).integers(-2, 3, x.shape), 0, 255).astype(np.uint8)
    far = np.random.default_rng(2).integers(0, 256, x.shape, dtype=np.uint8)
    distance = lambda a, b: bin(media.perceptual_hash(a) ^ media.perceptual_hash(b)).count("1")
    assert distance(x, x) == 0 and distance(x, near) < distance(x, far)


def test_media_columns(nasty, empty):
    stored = nasty.select("doc_id", "text", media.text_to_media(F.col("text")).alias("m"))
    for r in stored.select("text", "m", media.media_features(F.col("m")).alias("f")).collect():
        payload = media.padded((r.text or "").encode())
        assert (r.f.payload_bytes, r.f.payload_sha256, r.f.tail_crc32) == (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        assert (r.f.media_bytes, r.f.media_sha256) == (len(r.m), hashlib.sha256(r.m).hexdigest())
    assert empty.select(media.media_features(media.text_to_media(F.col("text")))).count() == 0


# ------------------------------------------------------------------ html


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("just text &amp; more", "just text & more"),
        ("<p>only", "only"),
        ("<article><h1>T&eacute;st</h1><p>One  <b>two</b>\n three.</article><footer>x</footer>", "Tést\nOne two three."),
        ('<nav><a href="/">Home</a></nav><div class="ad">Buy, now, this, here.</div><article><p>Body, text.</p><div class="comments"><p>I, too, think so, much.</p></div></article>', "Body, text."),
        ("<article><script>var a='</p><p>no';</script><p>yes, indeed</p><form>mail</form></article>", "yes, indeed"),
        ("<main><p>cut off at the end, here <b>and then &am", "cut off at the end, here and then &am"),
        ("<main><p>cut in a tag, so</p><p cla", "cut in a tag, so"),
        ("<article><p>one</p><!-- <p>no</p> --><aside>side</aside><p>two</p></article>", "one\ntwo"),
    ],
)
def test_main_text(page, text):
    assert html_extract.main_text(page) == text


def test_pages_without_article_marks():
    menu = "".join(f'<li><a href="/{i}">Entry number {i}</a></li>' for i in range(30))
    body = "".join(f"<p>This is sentence {i}, which has commas, stops, and words.</p>" for i in range(12))
    found = html_extract.main_text(f"<html><body><div><ul>{menu}</ul></div><div><h1>Head</h1>{body}<p>Short.</p></div><div>Copyright</div></body></html>")
    assert found.split("\n")[0] == "Head" and found.split("\n")[-1] == "Short." and "Entry" not in found and "Copyright" not in found


def test_content_beside_content_stays():
    body = "".join(f"<p>This is sentence {i}, which has commas, stops, and words.</p>" for i in range(12))
    page = f"<body><div class='post'><h1>Head</h1><p>A lead, of some words, that stands before.</p><div class='entry'>{body}</div></div><div class='comments'>{body}</div><p class='sidebar'>x, y</p></body>"
    lines = html_extract.main_text(page).split("\n")
    assert lines[:2] == ["Head", "A lead, of some words, that stands before."] and len(lines) == 14
    assert html_extract.main_text(f"<div><h2>Head</h2><div>{body}</div></div>").startswith("Head\nThis is")
    assert html_extract.main_text("<nav><a href='/'>Home</a></nav><footer>all rights, reserved</footer>") == ""
    wrapped = html_extract.main_text(f"<div class='page-with-sidebar'><div><a href='/'>menu</a></div>{body}</div>")
    assert wrapped.startswith("This is sentence 0") and "menu" not in wrapped  # a name that covers all says nothing


def bare_markup(page):
    """A page whose markup says nothing: no class names, and no tags that tell an article from the rest."""
    return re.sub(r"<(/?)(article|nav|footer|main|aside)\b", r"<\1div", re.sub(r'\sclass="[^"]*"', "", page))


def test_ratios_select_the_nodes(spark, monkeypatch):
    """With the priors kept: where markup has no names, ratios find the text, and constant or random ones don't."""
    pages = [r.html for r in spark.read.parquet(f"{SF}/pages.parquet").limit(200).collect()]
    right = [html_extract.main_text(p) for p in pages]
    bare = [bare_markup(p) for p in pages]
    assert all(right)

    def same():
        return sum(html_extract.main_text(p) == x for p, x in zip(bare, right))

    assert same() >= 0.93 * len(pages)
    rng = np.random.default_rng(3)
    for made, most in ((lambda paths, texts: (np.ones(len(paths)), np.ones(len(paths))), 0.02), (lambda paths, texts: tuple(rng.uniform(0.5, 2, (2, len(paths)))), 0.7)):
        monkeypatch.setattr(html_extract, "path_ratios", made)
        assert same() < most * len(pages)


def test_names_weigh_less_than_clear_ratios(spark, monkeypatch):
    body = "".join(f"<p>This is sentence {i}, which has commas, stops, and words.</p>" for i in range(40))
    page = f"<div class='header'>{body}</div><div><p>Some short, plain line.</p></div>"
    assert html_extract.main_text(page).startswith("This is sentence 0")  # misnamed, but it is the text
    pages = [r.html for r in spark.read.parquet(f"{SF}/pages.parquet").limit(200).collect()]
    right = [html_extract.main_text(p) for p in pages]
    monkeypatch.setattr(html_extract, "_OTHER_WORDS", frozenset())
    assert sum(html_extract.main_text(p) == x for p, x in zip(pages, right)) > 0.85 * len(pages)  # adverts longer than the article


def test_path_ratios_against_brute_force():
    page = "<div><p>one, two.</p><p>three</p><ul class='a'><li>x<li>y, z</ul><ul class='b'><li>long, longer, longest!</ul></div>"
    nodes = [(e, t.strip()) for e, _, t in html_extract.text_nodes(page) if t.strip()]
    lengths, marks = html_extract.path_ratios([e.path for e, _ in nodes], [t for _, t in nodes])
    named = {"one, two.": "p", "three": "p", "x": "a", "y, z": "a", "long, longer, longest!": "b"}
    for (_, t), a, b in zip(nodes, lengths, marks):
        same = [u for u in named if named[u] == named[t]]
        assert a == sum(map(len, same)) / len(same) ** 0.5 and b == sum(u.count(",") + u.count(".") + u.count("!") for u in same)


def test_html_edge_cases(spark):
    deep = "<div class='x'>a, b" * 100_000
    assert len(html_extract.main_text(deep).split("\n")) == 100_000
    assert len(html_extract.main_text("<div>a" * 30_000 + "</section></i>" * 30_000).split("\n")) == 30_000
    long = "<article>" + "<p>some words, and more</p>" * 50_000 + "</article>"
    rows = [(1, None, "c"), (2, "", "c"), (3, long, "c"), (3, long, "c"), (None, "<p>text", None)]
    df = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = df.select("page_id", html_extract.extract(F.col("html")).alias("x")).collect()
    assert sorted((r.page_id or 0, len(r.x)) for r in got) == [(0, 4), (1, 0), (2, 0), (3, 50_000 * 21 - 1), (3, 50_000 * 21 - 1)]
    assert df.limit(0).select(html_extract.extract(F.col("html")).alias("x")).count() == 0


# ------------------------------------------------------------------ n-gram join


def brute_components(rows):
    sets = []
    for _, text in rows:
        w = [x.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for x in WORD.findall(text or "")]
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)]) if w else frozenset())
    low = list(range(len(rows)))

    def root(i):
        while low[i] != i:
            i = low[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                x, y = root(i), root(j)
                low[max(x, y)] = min(x, y)
    least = {}
    for i, (key, _) in enumerate(rows):
        r = root(i)
        least[r] = key if least.get(r) is None else least[r] if key is None else min(least[r], key)
    return sorted((key, len(sets[i]), least[root(i)] if sets[i] else key) for i, (key, _) in enumerate(rows) if key is not None)


def as_tuples(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in df.collect() if r.doc_id is not None)


def test_join_of_copies_and_near_copies(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "SHORT_LIST", 3)
    monkeypatch.setattr(ngram_join, "KNOWN_LIST", 4)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for g in range(4):
        base = [rng.choice(words) for _ in range(60 + 20 * g)]
        for _ in range(40):
            copy = list(base)
            for _ in range(rng.randrange(5)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            if rng.random() < 0.3:
                copy = copy[: -rng.randrange(1, 8)]
            rows.append(" ".join(copy))
    rows += [" ".join(rng.choice(words) for _ in range(rng.randrange(9))) for _ in range(40)]
    rows = list(enumerate(rows, start=1))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert as_tuples(ngram_join.link(df)) == brute_components(rows)


def test_join_of_sets_that_share_frequent_shingles_only(spark, monkeypatch):
    """Long lists that no pivot breaks up."""
    monkeypatch.setattr(ngram_join, "SHORT_LIST", 3)
    monkeypatch.setattr(ngram_join, "KNOWN_LIST", 4)
    rng = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    frame = [rng.choice(words) for _ in range(40)]
    rows = []
    for _ in range(60):
        own = [rng.choice(words) for _ in range(16)]
        rows.append(" ".join(frame + own))
        if rng.random() < 0.3:
            rows.append(" ".join(frame + own[:-1] + [rng.choice(words)]))
    rows = list(enumerate(rows, start=1))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert as_tuples(ngram_join.link(df)) == brute_components(rows)


def test_representatives_of_shared_ids(spark):
    base = " ".join(f"w{i}" for i in range(40))
    rows = [(5, base), (5, base), (5, "something else altogether, with other words"), (7, base + " x"), (3, "other " + "y " * 9), (None, base), (None, "no id at all here, five words"), (9, ""), (9, None), (9, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(((r.doc_id, r.text) for r in ngram_join.representatives(df).collect()), key=str)
    want = [(5, base), (5, rows[2][1]), rows[4], rows[6], (9, ""), (9, None), (9, None)]
    assert got == sorted(want, key=str)
    clashing = df.withColumns({"k": F.lit(1), "node": F.lit("n"), "own": F.lit(None).cast("string"), "class_id": F.lit(2)})
    assert sorted(((r.doc_id, r.text) for r in ngram_join.representatives(clashing).collect()), key=str) == got
    assert ngram_join.representatives(df.where("doc_id = 3 or doc_id = 7")).count() == 2
    assert ngram_join.representatives(df.limit(0)).count() == 0


def test_join_edge_cases(nasty, empty):
    rows = [(r[0], r[1]) for r in nasty_rows()]
    assert as_tuples(ngram_join.link(nasty)) == brute_components(rows)
    assert ngram_join.link(empty).count() == 0


# ------------------------------------------------------------------ classifier


def auc(labels, scores):
    order = np.argsort(np.argsort(scores, kind="stable"))
    pos = labels == 1
    return (order[pos].sum() - pos.sum() * (pos.sum() - 1) / 2) / (pos.sum() * (~pos).sum())


def test_classifier_held_out(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    weights = quality_model.fit(docs, labels.where(~held))
    assert (weights == quality_model.fit(docs.repartition(3), labels.where(~held))).all()
    scored = docs.join(labels, "doc_id").where(held).select("quality", quality_model.score(spark, F.col("text"), weights).alias("s")).toPandas()
    assert auc(scored.quality.to_numpy(), scored.s.to_numpy()) > 0.95


def test_training_against_plain_ftrl():
    """Weights slot by slot, as the update rule is written."""
    rng = np.random.default_rng(2)
    settings = quality_model.Settings(bits=6, epochs=2)
    rows = [(np.unique(np.concatenate(([0], rng.integers(1, 64, 9)))), None) for _ in range(80)]
    rows = [(s.astype(np.int32), rng.random(len(s)).astype(np.float32)) for s, _ in rows]
    labels = rng.integers(0, 2, 80)
    z, n = [0.0] * 64, [0.0] * 64

    def weight(i):
        lasso = 0.0 if i == 0 else settings.l1
        if abs(z[i]) <= lasso:
            return 0.0
        return (np.sign(z[i]) * lasso - z[i]) / ((settings.beta + n[i] ** 0.5) / settings.alpha + settings.l2)

    for _ in range(settings.epochs):
        for (slots, values), y in zip(rows, labels):
            w = {i: weight(i) for i in slots}
            p = 1 / (1 + np.exp(-sum(w[i] * float(v) for i, v in zip(slots, values))))
            for i, v in zip(slots, values):
                g = (p - y) * float(v)
                sigma = ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / settings.alpha
                z[i] += g - sigma * w[i]
                n[i] += g * g
    assert quality_model.train(rows, labels, settings) == pytest.approx([weight(i) for i in range(64)], abs=1e-5)


def test_training_is_bounded_by_bytes(spark):
    docs = spark.createDataFrame([(i, f"word{i} " * 50) for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    whole, few = (quality_model.fit(docs, labels, quality_model.Settings(max_bytes=b)) for b in (1 << 20, 1000))
    assert np.count_nonzero(whole) > np.count_nonzero(few) > 0


def test_classifier_edge_cases(spark, nasty, empty):
    labels = spark.createDataFrame([(3, 1), (3, 0), (5, 0), (None, 1), (4, None)], "doc_id long, quality int")
    weights = quality_model.fit(nasty, labels)
    scores = [r.s for r in nasty.select(quality_model.score(spark, F.col("text"), weights).alias("s")).collect()]
    assert len(scores) == 14 and all(0 <= s <= 1 for s in scores) and scores[0] == scores[1]
    none = quality_model.fit(empty, labels.limit(0))
    assert not none.any() and empty.select(quality_model.score(spark, F.col("text"), none)).count() == 0


# ------------------------------------------------------------------ repetition


def brute_repetition(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    starts = {}
    for i in range(len(words) - 2):
        starts.setdefault(tuple(words[i : i + 3]), []).append(i)
    inside = {i + k for at in starts.values() if len(at) > 1 for i in at for k in range(3)}
    n = len(words)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(inside), n < 50 or 100 * len(inside) > 50 * n


def test_repetition_base(spark, docs, nasty, empty):
    rng = random.Random(2)
    made = [" ".join(rng.choice("ab") for _ in range(rng.randrange(80))).replace("b a b", "b\na b") for _ in range(60)]
    extra = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
    for df in (docs, nasty, extra):
        for r in repetition.judge(df.select("doc_id", "text")).join(df.select("doc_id", "text").dropDuplicates(["doc_id"]), "doc_id").collect():
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_repetition(r.text)
            assert not (r.base_failed and r.kept)
    assert repetition.judge(empty).count() == 0 and repetition.keep(empty).columns == empty.columns


def brute_verdict(text):
    """``kept`` by plain counting."""
    words = WORD.findall(text or "")
    if brute_repetition(text)[5]:
        return False
    limits, total = repetition.Limits(), sum(map(len, words))

    def places(n):
        at = {}
        for i in range(len(words) - n + 1):
            at.setdefault(tuple(words[i : i + n]), []).append(i)
        return {g: x for g, x in at.items() if len(x) > 1}

    for n, limit in limits.top_ngram:
        if max((len(x) * len("".join(g)) for g, x in places(n).items()), default=0) / total > limit:
            return False
    for n, limit in limits.dup_ngram:
        inside = {i + k for x in places(n).values() for i in x for k in range(n)}
        if sum(len(words[i]) for i in inside) / total > limit:
            return False
    lines = [x for x in text.split("\n") if WORD.search(x)]
    again = [x for i, x in enumerate(lines) if x in lines[:i]]
    symbols = sum(c in "#*$%&|<>" for c in text) / total
    return not (len(again) / len(lines) > limits.dup_lines or sum(map(len, again)) / sum(map(len, lines)) > limits.dup_line_chars or symbols > limits.symbols)


def test_verdicts_against_brute_force(spark, docs):
    rng = random.Random(6)
    made = []
    for k in range(150):
        words = [rng.choice(["äß", "b", "cc", "ddé", "e#"]) + str(rng.randrange(rng.choice([20, 200, 2000]))) for _ in range(rng.randrange(40, 200))]
        if k % 2:
            at = rng.randrange(len(words))
            words += words[at : at + rng.randrange(5, 40)]
        lines = [" ".join(words[i : i + 9]) for i in range(0, len(words), 9)]
        lines += rng.choices(lines, k=rng.randrange(4))
        made.append("\n".join(lines))
    texts = made + [r.text for r in docs.limit(300).collect()]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.kept for r in repetition.judge(df).collect()}
    assert got == {i: brute_verdict(t) for i, t in enumerate(texts)} and 0 < sum(got.values()) < len(got)


def test_repetition_coverage():
    words = [f"w{i}" for i in range(100)]
    block = words[:30]
    r = repetition.measure_array(pa.array([" ".join(words + block), " ".join(words), None]), repetition.Limits()).to_pylist()
    share = 2 * len("".join(block)) / len("".join(words + block))
    assert r[0]["dup_ngram_chars"] == pytest.approx([share] * 6) and not r[0]["kept"]
    assert r[1]["dup_ngram_chars"] == [0.0] * 6 and r[1]["kept"] and not r[2]["kept"]


# ------------------------------------------------------------------ packing


def test_best_fit_and_bounds():
    rng = np.random.default_rng(4)
    for sizes, capacity in [(rng.integers(1, 101, 300), 100), (np.full(9, 51), 100), (np.array([34, 34, 34, 66, 66]), 100), (np.zeros(0, int), 100)]:
        bins, offsets, count = packing.best_fit_decreasing(sizes, capacity)
        assert packing.lower_bound(sizes, capacity) <= count
        for b in range(count):
            inside = np.flatnonzero(bins == b)
            at = inside[np.argsort(offsets[inside])]
            assert sizes[at].sum() <= capacity and (offsets[at] == np.cumsum(sizes[at]) - sizes[at]).all()
    assert packing.lower_bound(np.full(9, 51), 100) == 9


def test_packers_come_near_the_bound():
    rng = np.random.default_rng(5)
    cases = [(rng.integers(1200, 1500, 6000), 1.002), (rng.integers(900, 1100, 6000), 1.002), (rng.integers(700, 2300, 6000), 1.015), (rng.integers(1, 4097, 6000), 1.01), (np.full(100, 4096), 1), (np.array([4096, 1, 1]), 1), (rng.integers(1, 30, 500), 1)]
    for sizes, most in cases:
        bound = packing.lower_bound(sizes, 4096)
        for bins, offsets, count in (packing.best_company(sizes, 4096), packing.best_packing(sizes, 4096, 1, bound)):
            by = np.lexsort((offsets, bins))
            b, o, n = bins[by], offsets[by], sizes[by]
            first = np.concatenate([[True], b[1:] != b[:-1]])
            assert (o[first] == 0).all() and (o[1:][~first[1:]] == (o + n)[:-1][~first[1:]]).all() and (o + n).max() <= 4096 and len(np.unique(b)) == count
        assert bound <= count <= most * bound  # best fit decreasing alone has 1.08 x the bound on the first


def best_of_all(sizes, capacity):
    """The fewest bins, by trying every way."""
    best = [len(sizes)]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(rooms)
            return
        for r in sorted(set(rooms)):
            if r >= sizes[i]:
                again = list(rooms)
                again.remove(r)
                place(i + 1, [*again, r - sizes[i]])
        place(i + 1, [*rooms, capacity - sizes[i]])

    place(0, [])
    return best[0]


def test_packers_against_the_optimum():
    rng = np.random.default_rng(6)
    gaps = 0
    for _ in range(60):
        sizes = rng.integers(8, 50, 9)
        optimum = best_of_all(sorted(sizes.tolist(), reverse=True), 100)
        bound = packing.lower_bound(sizes, 100)
        count = packing.best_packing(sizes, 100, 0, bound)[2]
        assert bound <= optimum <= count <= optimum + 1
        gaps += count - optimum
    assert gaps <= 3


def check_packing(df, rows, capacity=4096):
    enc = tokens.encoder(tokens.default_file()).tokenizer
    out = df.toPandas()
    want = []
    for key, text in rows:
        ids = np.array(enc.encode(text or "", add_special_tokens=False).ids + [1], dtype="<u4")
        want += [(key, k // capacity, k, len(ids[k : k + capacity]), zlib.crc32(ids[k : k + capacity])) for k in range(0, len(ids), capacity)]
    got = [(None if r.doc_id != r.doc_id or r.doc_id is None else int(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in out.itertuples()]
    assert sorted(got, key=str) == sorted(want, key=str)
    ordered = out.sort_values(["sequence_id", "offset"])
    filled = ordered.groupby("sequence_id").length.cumsum()
    assert (filled - ordered.length == ordered.offset).all() and filled.max() <= capacity
    return ordered.sequence_id.nunique(), int(out.length.sum())


def test_packing(docs, nasty, empty):
    used, total = check_packing(packing.pack(docs, tokens.default_file(), part_rows=200), [(r.doc_id, r.text) for r in docs.collect()])
    assert used <= -(-total // 4096) + 1
    check_packing(packing.pack(nasty, tokens.default_file()), [(r[0], r[1]) for r in nasty_rows()])
    assert packing.pack(empty, tokens.default_file()).count() == 0


@pytest.mark.parametrize("parts", [20, 100])
def test_exchange_reaches_the_bound(spark, parts):
    big = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    packed, found = packing.pack_parts(big, tokens.default_file(), part_rows=-(-10_267 // parts))
    assert found.gap == 0 and found.bins == packed.select("sequence_id").distinct().count()
    certified = packing.certificates(packed, 4096).collect()
    assert sum(c.bins for c in certified) == found.bins and all(c.bins >= c.bound for c in certified)


def test_exchange_never_loses(docs):
    first, start = packing.pack_parts(docs, tokens.default_file(), part_rows=50, levels=())
    got = [packing.certificate(docs, tokens.default_file(), part_rows=50, pool_rows=60, levels=x) for x in ((0.98,), (0.98, 1.0))]
    assert start.gap > got[0].gap >= got[1].gap >= 0 and len({c.bound for c in (start, *got)}) == 1
    assert not all(c.certified for c in packing.certificates(first, 4096).collect()) or start.gap > 0


# ------------------------------------------------------------------ mixing


def test_targets_share_the_excess():
    got = mixing.targets([100, 10, 1000, 0], [5, 2, 1, 5])
    assert got[0] == 200 and got[1] == 20 and got[3] == 0 and sum(got) == pytest.approx(1665)


def test_flow_over_overlapping_sources():
    patterns = [((0,), 10), ((0, 1), 30), ((1,), 10)]
    taken = mixing.route(patterns, [40.0, 20.0])
    assert sum(taken) == 60 and all(t <= 2 * s for t, (_, s) in zip(taken, patterns))
    assert mixing.route([((0,), 10), ((0, 1), 30)], [10.0, 30.0]) == [10, 30]  # nothing is repeated while fresh words are left
    assert mixing.route([((0,), 10)], [15.0]) == [15] and mixing.route([], []) == []


def test_mixing(docs, nasty, empty):
    out = mixing.mix(docs, F.array("source")).toPandas()
    assert (out.taken <= 2 * out["size"]).all()
    for (_, target), part in out.groupby(["source_size", "target"]):
        assert abs(part.taken.sum() - target) <= part["size"].max()
    again = mixing.mix(docs.repartition(5), F.array("source")).toPandas()
    assert out.sort_values("doc_id").taken.tolist() == again.sort_values("doc_id").taken.tolist()
    odd = mixing.mix(nasty, F.array("source"), carry=["text", "size", "k"])
    assert odd.count() == 14
    assert mixing.mix(empty, F.array("source")).count() == 0


# ------------------------------------------------------------------ url rules


def test_url_rules_against_brute_force(spark):
    rng = random.Random(9)
    hosts = ["a.com", "b.a.com", "c.b.a.com", "com", "org", "x.org", "Xa.com"]
    paths = ["/", "/a", "/a/", "/a/b", "/ab", ""]
    rules = [(rng.choice(["allow", "block"]), rng.choice(hosts).lower(), rng.choice(paths)) for _ in range(25)]
    urls = [f"{rng.choice(['http', 'https'])}://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', 'x', '?q=1', '#f', '/z?u=http://com/'])}" for _ in range(300)]
    urls += [None, "", "no scheme", "://", "http://", "http://a.com", urls[0], urls[0]]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    best = {}
    for verdict, host, path in rules:
        best[host, path] = max(verdict, best.get((host, path), ""))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    judged = url_rules.judge(pages, url_rules.rule_table(spark, rules)).collect()
    for parts in ("1", "23"):  # a suffix in one range, and over many
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        assert sorted(map(str, url_rules.judge(pages, url_rules.rule_table(spark, rules)).collect())) == sorted(map(str, judged))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert all(r.rule is None and r.verdict == "block" for r in url_rules.judge(pages, url_rules.rule_table(spark, []), default="block").collect())
    for r in judged:
        url = urls[r.page_id] or ""
        rest = url.split("://", 1)[1] if "://" in url else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = host.lower()
        fits = [(len(h + p), v, h + p) for (h, p), v in best.items() if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert (r.host, r.path) == (host, path)
        assert (r.rule, r.verdict) == ((max(fits)[2], max(fits)[1]) if fits else (None, "allow")), url
    assert url_rules.judge(pages.limit(0), url_rules.rule_table(spark, rules)).count() == 0


# ------------------------------------------------------------------ token files


def test_token_files_round_trip(spark, docs, nasty, empty):
    enc = tokens.encoder(tokens.default_file()).tokenizer
    for df, rows in ((docs, [(r.doc_id, r.text) for r in docs.collect()]), (nasty, [(r[0], r[1]) for r in nasty_rows()])):
        files = token_files.write(df, token_files.new_folder(spark), tokens.default_file(), length=128, rows=7)
        got = token_files.documents(files).collect()
        want = [(k, np.array(enc.encode(t or "", add_special_tokens=False).ids + [1], dtype="<u4")) for k, t in rows]
        assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted((str(k), len(x), zlib.crc32(x)) for k, x in want)
        ordered = sorted(got, key=lambda r: r.start)
        assert [r.start for r in ordered] == np.concatenate(([0], np.cumsum([r.n_tokens for r in ordered])))[:-1].tolist()
        keys = [r.doc_id for r in ordered if r.doc_id is not None]
        assert keys == sorted(keys)
    name = files.first()["file"]
    file = token_files.SequenceFile(f"{name}.arrow")
    ids, mask = file.sequence(0)
    assert len(ids) == len(mask) == 128 and (file.ids(0, int(mask.sum())) == ids[mask == 1]).all()
    assert not ids.flags.owndata and not mask.flags.owndata and mask.dtype == np.uint8
    assert token_files.documents(token_files.write(empty, token_files.new_folder(spark), tokens.default_file())).count() == 0


def test_token_files_with_other_keys(spark):
    for kind, keys in (("string", ["b", "a", None]), ("int", [3, -1, None]), ("date", ["2024-02-01", "2023-01-01", None]), ("decimal(10,2)", ["2.50", "1.00", None])):
        df = spark.createDataFrame([(k if k is None else str(k), f"text {i}") for i, k in enumerate(keys)], "k string, t string").select(F.col("k").cast(kind).alias("k"), "t")
        files = token_files.write(df, token_files.new_folder(spark), tokens.default_file(), key="k", text="t", length=8, rows=2)
        got = token_files.documents(files, key="k")
        assert got.schema["k"].dataType == df.schema["k"].dataType
        assert [str(r.k) for r in got.orderBy("start").collect()] == ["None", str(keys[1]), str(keys[0])]


def test_encoder_equals_whole_texts():
    rng = random.Random(1)
    enc = tokens.encoder(tokens.default_file())
    pieces = list("ab Z\t\n\x1c\x85é́'!?12​　İΣßª×中") + ["<|endoftext|>", "'ll", "Word,", "THE "]
    texts = ["".join(rng.choice(pieces) for _ in range(50)) for _ in range(300)] + [None, ""]
    got = list(tokens.encode_array(pa.array(texts), tokens.default_file()))
    for t, ids in zip(texts, got):
        assert ids.tolist() == enc.tokenizer.encode(t or "", add_special_tokens=False).ids + [1], repr(t)


# ------------------------------------------------------------------ licences


def test_licence_base_and_labels(spark, docs, nasty, empty):
    made = ["MIT License, mit license; MIT-licenses", "gnu General\x00public  license cc by cc-by apache", "Released under the MIT License.", "mité license", "This work is licensed under the GNU General Public License, version 3."]
    extra = spark.createDataFrame([(i, t) for i, t in enumerate(made)], "doc_id long, text string")
    for df in (docs.select("doc_id", "text"), nasty, extra):
        for r in license_scan.scan(df).join(df.select("doc_id", "text").dropDuplicates(["doc_id"]), "doc_id").collect():
            low = re.sub("[A-Z]", lambda m: m[0].lower(), r.text or "")
            words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
            at, labels = [], set()
            for phrase, label in license_scan.BASE:
                p = phrase.split()
                found = [i for i in range(len(words)) if words[i : i + len(p)] == p]
                at += found
                labels |= {label} if found else set()
            assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(words), len(at), min(at, default=None), max(at, default=None))
            assert r.base_labels == ",".join(sorted(labels)) and labels <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1
    found = {r.doc_id: r.labels for r in license_scan.scan(extra).collect()}
    assert found[2] == "mit,mit-notice" and found[4] == "gpl,gpl-3.0" and found[3] == ""
    assert license_scan.scan(empty).count() == 0
    bare = license_scan.scan(extra, templates=(), base=()).collect()
    assert all((r.n_base, r.first_word, r.labels, r.score) == (0, None, "", 0.0) for r in bare)
    assert {r.doc_id: r.labels for r in license_scan.scan(extra, templates=()).collect()}[2] == "mit"


def test_notices_of_a_hot_source_keep_their_labels(spark):
    lines = ["Released under the MIT License.", "Licensed under the Apache License, Version 2.0", "plain text of the month"]
    hot = spark.createDataFrame([(i, f"{lines[i % 3]} number{i}") for i in range(30)], "doc_id long, text string")
    found = {r.doc_id: r.labels for r in license_scan.scan(hot).collect()}
    assert found == {i: ("mit,mit-notice", "apache,apache-2.0", "")[i % 3] for i in range(30)}


def test_all_notices_of_a_file_are_found(spark):
    four = "Licensed under the Apache License, Version 2.0. Licensed under CC BY-NC 4.0! Released under the MIT License. This work is licensed under the GNU General Public License, version 3."
    mpl = "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"
    stray = "redistribute obtaining charge lgpl merchantability unencumbered published binary forms granted hereby mozilla"
    texts = [four, f"{stray} {four} {stray}", mpl, f"{stray} {mpl}", "the mozilla public license 2 0", "in the of and", *(f"{stray} of the page {i}" for i in range(10)), *(f"plain {i}" for i in range(30))]
    made = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: (r.labels, r.score) for r in license_scan.scan(made).collect()}
    assert found[0] == found[1] == ("apache,apache-2.0,cc-by,cc-by-nc-4.0,gpl,gpl-3.0,mit,mit-notice", 1.0)
    assert found[2] == found[3] == ("mpl-2.0", 1.0)
    assert all(found[i] == ("", 0.0) for i in range(4, len(texts)))


def test_key_phrases_alone_give_no_label(spark):
    """Phrases spread over a file, or in another body, are no licence; half of a body without its phrases is none either."""
    nonsense = "It was released under a full moon, and if you read the MIT license. unencumbered software? keep it out of the public domain! version 3 of my essay on the GNU General Public License"
    isc = next(t for t in license_scan.TEMPLATES if t.label == "isc")
    body = isc.words.split()
    other = " ".join([*isc.keys[0].split(), *(f"other{i}" for i in range(20)), *isc.keys[1].split()])
    lost = isc.words.replace("for any purpose with or without fee is hereby granted", "for any purpose with or without fee is hereby refused")
    zlib_ = next(t for t in license_scan.TEMPLATES if t.label == "zlib")
    apart = f"{' '.join(zlib_.words.split()[:15])} {'x ' * 60} {zlib_.keys[1]}"  # half of the body, and a phrase far from it
    longer = " ".join([*body[:5], "quickly", *body[5:]])  # a word more: over half is still in place, the phrase within the span
    texts = [nonsense, "unencumbered software kept out of the public domain", other, lost, apart, isc.words, longer, "mit license"]
    made = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: (r.labels, r.score) for r in license_scan.scan(made).collect()}
    assert [found[i] for i in range(5)] == [("gpl,mit", license_scan.NAMED), ("", 0.0), ("", 0.0), ("", 0.0), ("", 0.0)]
    assert found[5] == ("isc", 1.0) and found[6][0] == "isc" and 0.5 < found[6][1] < 1 and found[7] == ("mit", license_scan.NAMED)


def test_postings_decide_which_templates_are_seen(spark, monkeypatch):
    texts = [t.words for t in license_scan.TEMPLATES]
    made = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    before = {r.doc_id: r.labels for r in license_scan.scan(made).collect()}
    assert all(t.label in before[i].split(",") for i, t in enumerate(license_scan.TEMPLATES))
    monkeypatch.setattr(license_scan, "_rarest", lambda places, df, n: sorted(places, key=lambda x: x[1])[:1])  # a position each: no two hits agree
    assert {r.labels for r in license_scan.scan(made).collect()} <= {"", "gpl", "mit", "apache", "cc-by"}


def brute_templates(text):
    """Labels of templates and the best share, by comparing every template at every place."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    labels, best = set(), 0.0
    for t in license_scan.TEMPLATES:
        own = t.words.split()
        around = max(2, len(own) // 4)
        for off in range(-len(own), len(words)):
            same = sum(1 for i, w in enumerate(own) if 0 <= off + i < len(words) and words[off + i] == w)
            span = words[max(off - around, 0) : max(off + len(own) + around, 0)]
            if 2 * same >= len(own) and all(any(span[i : i + len(p)] == p for i in range(len(span))) for p in (k.split() for k in t.keys)):
                labels.add(t.label)
                best = max(best, same / len(own))
    return labels, best


def test_templates_against_brute_force(spark, docs):
    rng = random.Random(8)
    texts = [r.text for r in docs.limit(60).collect()]
    for t in license_scan.TEMPLATES:
        own = t.words.split()
        texts += [t.words.upper(), f"...{t.words.replace(' ', ' -- ')}?!", " ".join(own[2:]), " ".join(own[:-3]) + " end", " ".join(["x\u0130", *own[: len(own) // 2], "new words here", *own[len(own) // 2 :]])]
        texts.append(" ".join(w for w in own if rng.random() < 0.9) + " " + " ".join(t.keys))
        texts += [" ".join(w if rng.random() < keep else "z" for w in own) for keep in (0.95, 0.8, 0.6)]
        texts.append(" and ".join(reversed(t.keys)) + " mit license")
    texts += ["li\u212aense mit licen\u017fe", " ".join(t.words for t in license_scan.TEMPLATES), None, "", " . "]
    for made in (texts, [license_scan.TEMPLATES[15].words], texts[-6:]):  # whole corpora and small ones give a file the same labels
        df = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
        for r in license_scan.scan(df).collect():
            labels, best = brute_templates(made[r.doc_id])
            assert set(r.labels.split(",")) - {""} == labels | set(r.base_labels.split(",")) - {""}, made[r.doc_id]
            assert r.score == max(best, license_scan.NAMED if r.n_base else 0.0)


def test_scratch_is_shared_folder(spark):
    assert scratch.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_many_rules_under_a_hot_suffix(spark):
    """A hundred thousand rules of one suffix: parts look their first keys' prefixes up, and no rule meets every part."""
    rules = spark.range(100_000).select(F.when(F.col("id") % 2 == 0, "allow").otherwise("block").alias("verdict"), F.lit("com").alias("host"), F.concat(F.lit("/p"), F.col("id").cast("string"), F.lit("/")).alias("path"))
    rules = rules.unionByName(spark.createDataFrame([("block", "com", "/p7/deep/"), ("allow", "com", "/")], "verdict string, host string, path string"))
    pages = spark.range(5000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://a.com/p"), (F.col("id") * 21 % 100_007).cast("string"), F.lit("/deep/x")).alias("url"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        judged = url_rules.judge(pages, rules)
        for r in judged.collect():
            n = r.page_id * 21 % 100_007
            want = ("com/p7/deep/", "block") if n == 7 else (f"com/p{n}/", "allow" if n % 2 == 0 else "block") if n < 100_000 else ("com/", "allow")
            assert (r.rule, r.verdict) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
