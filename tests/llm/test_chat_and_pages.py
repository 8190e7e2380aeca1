import hashlib
from collections import defaultdict

from hypothesis import given, settings, strategies as st

import pytest
from starmill.llm import chat
from starmill.llm.html_text import extract_text, main_text

TEXTS = st.text(alphabet="<|\\>star end\n äé漢", max_size=30)


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_escape_is_reversible_and_hides_controls(text):
    assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)


@pytest.fixture(scope="module")
def tokenizer():
    return chat.load_tokenizer(chat.tokenizer_path())


@settings(max_examples=80, deadline=None)
@given(turns=st.lists(st.tuples(st.sampled_from(["user", "assistant", "<|end|>"]), TEXTS), min_size=1, max_size=5))
def test_turns_and_loss_come_back(tokenizer, turns):
    import numpy as np

    text, spans = chat.render(turns)
    assert chat.turns_of(text) == turns
    found = tokenizer.encode(text, add_special_tokens=False)
    places = np.asarray(found.offsets).reshape(-1, 2)
    mask = chat.mask_of(places[:, 0], places[:, 1], spans)
    assert chat.text_under_mask(text, places[:, 0], places[:, 1], mask) == "".join(
        t for role, t in turns if role == "assistant")


def test_awkward_conversations(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, None, None, "last"), (2, 0, "assistant", None),
            (2, 0, "assistant", None), (None, 0, "user", "x"), (None, 0, "user", "x"), (3, 0, "assistant", "w " * 40_000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS n_turns")
    found = defaultdict(list)
    for r in chat.format_chats(turns, chat.tokenizer_path()).collect():
        found[r["conv_id"]].append((chat.turns_of(r["formatted"]), chat.text_under_mask(
            r["formatted"], r["token_starts"], r["token_ends"], r["loss_mask"])))
        assert len(r["token_ids"]) == len(r["loss_mask"])
    assert found[1] == [([("user", "a"), ("assistant", "b"), ("", "last")], "b")]
    assert found[2] == [([("assistant", ""), ("assistant", "")], "")]
    assert found[None] == [([("user", "x")], "")] * 2
    assert found[3][0][1] == "w " * 40_000
    assert chat.format_chats(turns.where("conv_id = 77"), chat.tokenizer_path()).collect() == []


PAGE = """<!DOCTYPE html><html><head><title>No title</title><style>p{}</style><script>var t="</p>";</script></head>
<body class="has-sidebar"><div class="site-header"><p>Site name, with a claim. And more, much more.</p></div>
<nav><ul><li><a href="/a">Menu</a></li></ul></nav><!-- <p>hidden</p> --><div class="ad">Buy this, now! Please, do.</div>
<article><h1>Title &amp; more</h1><p><b>First paragraph, a&nbsp;long one. With signs; and more.<br><p>Second
 paragraph, as long as the first. It has signs.<p>Short.<ul><li>entry<li>other</ul>
<aside>Beside, aside. Not this.</aside></article>
<form><p>Your mail, please. All of it.</p><input></form>
<section id="comments"><p>A reader says this, and that, at length. Really, at length it is said, again.</p></section>
<div style="display: none">Hidden, really. Not to be read.</div><footer>&copy; Somebody, 2020.</footer>"""


def test_article_without_the_rest():
    assert main_text(PAGE).split("\n\n") == [
        "Title & more", "First paragraph, a long one. With signs; and more.",
        "Second paragraph, as long as the first. It has signs.", "Short.", "entry", "other"]


def test_pages_without_article_tags():
    page = PAGE.replace("<article>", '<div class="entry-content">').replace("</article>", "</div>")
    assert main_text(page) == main_text(PAGE)
    assert main_text("only text, a < b &amp; c") == "only text, a < b & c"
    assert main_text("<p>") == main_text('<div class="x') == main_text("<nav>Menu, only.</nav>") == ""
    deep = "<div>" * 3000 + "<p>Deep, but there. Yes.</p>"
    assert main_text(deep) == "Deep, but there. Yes."


def test_awkward_pages(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (None, None, None), (2, "v", ""), (3, None, "<p>" + "word, " * 50_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS text", "0 AS n_chars")
    found = [(r["page_id"], len(r["text"]), r["n_chars"]) for r in extract_text(pages).collect()]
    assert len(found) == 5 and all(a == b for _, a, b in found)
    assert {p: n for p, n, _ in found} == {1: len(main_text(PAGE)), None: 0, 2: 0, 3: 299_999}
    assert extract_text(pages.where("page_id = 99")).collect() == []
