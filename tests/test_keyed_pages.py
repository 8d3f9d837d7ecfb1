"""Pages of keyed boxes: fall-backs, broken markup, deep nesting and long pages."""

import time

import pytest

from tidemark.functions import fixed_values as V
from tidemark.functions.keyed_pages import keyed_items, parse_keyed_pages

HEAD = f'<div wire:key="{V.BOX_KEY_PREFIX}1">'
KEY = '<p class="a tracking-tight font-extrabold">{}</p>'


def short(html, group=2):
    return [(x["key"], x["text"], x["notes"]) for x in keyed_items(html, group)]


@pytest.mark.parametrize(
    "html, want",
    [
        (HEAD + KEY.format("2:5") + "<p><span>Translation</span>: one</p></div>", [("2:5", "one", [])]),
        (HEAD + KEY.format("<b>2 </b>:<i> 5</i>") + "<p><span>TRANSLATION</span> : one</div>", [("2:5", "one", [])]),  # pieces are stripped, p stays open
        (HEAD + KEY.format("no key") + "see 12:7, 2:8x or 2:9</div>", [("2:9", "", [])]),
        (HEAD + "2:31</div>4", [("2:31", "", [])]),  # what follows the box is not part of its key
        ("1" + HEAD + "2:3</div>", [("2:3", "", [])]),
        (HEAD + "no number</div>", []),
        (HEAD + KEY.format("2:1") + "<p>x Translation : y Translation : z</p></div>", [("2:1", "y Translation : z", [])]),
        (HEAD + KEY.format("2:1") + "<p><span>Comment</span>: a</p><p>Comment</p><p><span>\ncomment</span>: b<script>var x;</script></p></div>", [("2:1", "", ["a", "b"])]),
        (HEAD + KEY.format("2:2") + "<p><span>Translation</span>: outer " + HEAD + KEY.format("2:1") + "<p><span>Translation</span>: inner</p></div></p></div>", [("2:1", "inner", []), ("2:2", "outer 2:1Translation: inner", [])]),
        (f'<div class="x {V.BOX_CLASS} y">{KEY.format("2:4")}</div></p></div></section>', [("2:4", "", [])]),
        (HEAD + KEY.format("2:6") + "<p>a<br>b<img src=x/><hr/>c</p><p/><p><span>Translation</span>: &lt;t&amp;&#233;</p>", [("2:6", "<t&é", [])]),  # never closed
        ("", []),
        (None, []),
    ],
)
def test_items(html, want):
    assert short(html) == want


def test_equal_items_keep_their_order():
    html = "".join(HEAD + KEY.format(f"{g}:3") + "</div>" for g in (9, 2, 5)) + HEAD + KEY.format("1:1") + "</div>"
    assert [x["key"] for x in keyed_items(html, 2)] == ["1:1", "9:3", "2:3", "5:3"]


@pytest.mark.parametrize("tag", ["div", "p", "span", HEAD[1:-1]])
def test_a_hundred_thousand_nested_tags(tag):
    n = 100_000
    name = tag.split()[0]
    html = f"<{tag}>" * n + HEAD + KEY.format("2:1") + "<p><span>Translation</span>: deep</p></div>" + f"</{name}>" * n + "</i>" * n
    began = time.process_time()
    found = keyed_items(html, 2)
    assert (found[-1]["key"], found[-1]["text"]) == ("2:1", "deep") and len(found) == (n + 1 if tag == HEAD[1:-1] else 1)
    assert time.process_time() - began < 30  # about 2


def test_clean_texts_in_rows(spark):
    html = HEAD + KEY.format("2:1") + "<p><span>Translation</span>:  a \t b\n \n c </p><p><span>Comment</span>: </p><p><span>Comment</span>: n  m</p></div>"
    rows = parse_keyed_pages(spark.createDataFrame([(2, html, "clash"), (3, None, ""), (None, "", "")], "g long, html string, text string"), "g", "html").collect()
    assert [tuple(r) for r in rows] == [(2, 1, "2:1", "a b\n c", ["n m"])]
