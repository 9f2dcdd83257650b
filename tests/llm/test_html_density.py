"""Main text by density: what decides, broken pages, and pages without article elements."""

import time

import pytest

from loanloom.llm import html_text
from loanloom.llm.html_text import main_text

STORY = "".join(f"<p>Sentence {i} of the story tells a little more, and a little more again.</p>" for i in range(8))
TOLD = " ".join(f"Sentence {i} of the story tells a little more, and a little more again." for i in range(8))
PAGE = f"<body><div><a href=/>Home</a><a href=/b>About</a></div><div>Buy this now.</div><div><h1>Title</h1>{STORY}</div><div>All rights kept.</div></body>"


def test_density_chooses_where_nothing_is_named(monkeypatch):
    assert main_text(PAGE) == "Title " + TOLD
    monkeypatch.setattr(html_text, "_chosen", lambda tags, parents, density, sums, body, c: [body])
    assert main_text(PAGE) == "HomeAbout Buy this now. Title " + TOLD + " All rights kept."


def test_a_name_does_not_outweigh_the_text():
    assert main_text(f"<body><div class=related><h1>Title</h1>{STORY}</div><p>Aside.</p></body>").startswith("Title " + TOLD)
    inside = f"<body><div><h1>Title</h1>{STORY}<div class=comments><p>I like it.</p><p>I do not.</p></div></div></body>"
    assert main_text(inside) == "Title " + TOLD
    assert main_text("<body><div class=ad>All there is</div></body>") == "All there is"


def test_article_in_two_containers_and_loose_paragraphs():
    assert main_text(f"<body><nav><a href=/>Home</a></nav><div>{STORY}</div><div>{STORY}</div></body>") == TOLD + " " + TOLD
    assert main_text(f"<body><nav><a href=/>Home</a></nav><h1>Title</h1>{STORY}<footer>End</footer></body>") == "Title " + TOLD


@pytest.mark.parametrize("source, want", [
    ("<p data-x=it's>Hello don't lose me</p><p>second</p>", "Hello don't lose me second"),
    ("<p title=\"open>text</p> more", "text more"),
    ("<p title='a > b'>text</p>", "text"),
    ("<div data-class=ad>text</div>", "text"),
    ("<script>var t = '<p'</script>kept <b>whole</b>", "kept whole"),
    ("text <a href=", "text"),
])
def test_quotes_and_broken_tags(source, want):
    assert main_text(source) == want


@pytest.mark.parametrize("source", [
    "<a" * 500_000, "<div>" * 100_000 + "</section>" * 100_000, "<b>" * 150_000 + "<p></p>" * 50_000, '<a ="' * 200_000, "<p x='" * 150_000,
    "<!--" * 200_000, "<script " * 100_000,
], ids=["tags", "deep", "inline", "quotes", "single", "comments", "raw"])
def test_broken_pages_take_time_by_length(source):
    began = time.perf_counter()
    main_text(source)
    assert time.perf_counter() - began < 10


def test_text_below_the_greatest_depth_stays():
    assert main_text("<div>" * 2000 + "deep" + "</div>" * 2000 + "<p>after") == "deep after"
