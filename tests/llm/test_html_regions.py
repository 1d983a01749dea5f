import random
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.llm import html_text as H


def sentence(rng, n):
    return " ".join(rng.choice(["stone", "river", "over", "the", "green", "hill", "walks"]) for _ in range(n)).capitalize() + "."


def page(seed, left, right):
    """(a page whose text stands between left and right, the text): menus, an advert, links, a footer without names around it."""
    rng = random.Random(seed)
    text = [sentence(rng, 6)] + [sentence(rng, rng.randint(15, 120)) for _ in range(rng.randint(2, 9))] + ["End."]
    links = lambda n: "".join(f'<li><a href="/{i}">{sentence(rng, 2)}</a></li>' for i in range(n))
    body = f"<h1>{text[0]}</h1>" + "".join(f"<p>{t}</p>" for t in text[1:])
    return f"<html><head><title>{text[0]}</title></head><body><div><ul>{links(6)}</ul></div><div><span>Home</span><span>News</span></div>{left}{body}{right}<div><ul>{links(9)}</ul></div><div>(c) Site</div></body></html>", "\n".join(text)


WRAPS = [
    ("<article>", "</article>"),
    ("<main><section>", "</section></main>"),
    ('<div class="page share"><article>', "</article></div>"),
    ('<div id="header-and-content">', "</div>"),
    ('<div class="sidebar-left widget">', "</div>"),
    ("<form action=x><div><div>", "</div></div></form>"),
    ("<div>", "</div>"),
    ("", ""),
    ("<table><tr><td>", "</td></tr></table>"),
    ("<![foo]>", "<![bar"),
]


@pytest.mark.parametrize("wrap", WRAPS)
def test_text_is_found_without_its_names(wrap):
    for seed in range(30):
        html, text = page(seed, *wrap)
        assert H.main_text(html) == text


def test_threshold_decides():
    for seed in range(30):
        html, text = page(seed, "", "")
        assert H.main_text(html, -1.0) != text  # with every line one of content, what stands around comes in
        assert H.main_text(html, 1e9) == ""


def test_inner_containers():
    rng = random.Random(1)
    p = lambda n: f"<p>{sentence(rng, n)}</p>"
    a, b, c, d = (p(40) for _ in range(4))
    plain = lambda *x: "\n".join(y[3:-4] for y in x)
    assert H.main_text(f'<article>{a}<div class="social history">{b}{c}</div>{d}</article>') == plain(a, b, c, d)
    assert H.main_text(f'<article>{a}<div class="social"><a href=x>Like</a> <a href=y>Send</a></div>{d}</article>') == plain(a, d)
    assert H.main_text(f'<article>{a}{b}</article><section class="comments"><article class="comment">{c}</article><article class="comment">{d}</article></section>') == plain(a, b)
    assert H.main_text(f'<body><div class="comments">{a}{b}</div></body>') == plain(a, b)  # nothing else is there
    assert H.main_text(f"<article>{a}<ul><li>one</li><li>two</li></ul><pre>x  y</pre>{b}</article>") == plain(a) + "\none\ntwo\nx y\n" + plain(b)
    assert H.main_text(f"<div><div><h1>Title</h1></div><div><div>{a}{b}{c}</div></div></div>") == "Title\n" + plain(a, b, c)


def test_time_is_linear():
    for html in ("<div>" * 20000 + "x" + "</span>" * 20000, "<div>a" * 20000, "<p>a<b>" * 20000, "<ul><li>" * 9000):
        start = time.time()
        H.main_text(html)
        assert time.time() - start < 3


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<div>", "</div>", "<p>", "<![", "<!", "<!--", "-->", "]]>", "<![CDATA[", "<?x", "&#xD800;", "&#99999999;", "&amp", "<a href=", '"', "'", ">", "<", "text more", "<script>", "</script>", "<article>", "</article>", "<h1>", "</", "<textarea>", "\x00", "é"]), max_size=30))
def test_no_markup_fails(parts):
    H.main_text("".join(parts))
