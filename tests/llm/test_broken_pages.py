"""Deep, broken and repetitive pages, and classes inside articles."""

import time

import pytest

from helixframe.llm import html_text

N = 100_000


@pytest.mark.parametrize(
    "page,text",
    [
        ("<div>" * N + "deep", "deep"),
        ("<b>" * N + "deep", "deep"),
        ("<ul><li>" * N + "deep", "deep"),
        ("<article>" * N + "deep", "deep"),
        ("x </p></i></div>" * N, " ".join("x" * N)),
        ("<p>a" * N, " ".join("a" * N)),
        ("<b><p>" * (N // 2) + "deep", "deep"),
        ("<!-- " * N, ""),
        ("<p>y</p>" + "<textarea>" * N, "y"),
    ],
)
def test_cost_is_the_length(page, text):
    began = time.process_time()
    assert html_text.main_text(page) == text
    assert time.process_time() - began < 20


@pytest.mark.parametrize("piece", ["<a b", "<a \"", "<a '", "<a b='x", "<a b=\"<"])
def test_open_tags(piece):
    began = time.process_time()
    got = html_text.main_text("<p>start</p>" + piece * 250_000)
    assert got.startswith("start") and time.process_time() - began < 20


def test_deep_wrappers_merge():
    pages = ["<div>" * 5000 + f"text {i}" + "</div>" * 5000 + "<p>same</p>" for i in range(4)]
    w = html_text.structure(html_text.parse(pages[0]))
    for p in pages[1:]:
        w = html_text.merge(w, html_text.structure(html_text.parse(p)))
    w = html_text.loaded(html_text.dumped(w))
    template = frozenset(html_text.template_paths(w))
    assert html_text.main_text(pages[2] + "<p>same</p>", template) == "text 2"


def test_dumped_wrapper_is_the_same():
    w = html_text.structure(html_text.parse("<body><h1>x</h1><div class=a>1<p>2</p></div><p>y</p></body>"))
    assert html_text.loaded(html_text.dumped(w)) == w


def test_weak_classes_inside_an_article():
    page = "<body><nav>n</nav><article><section class='legal'><p>Legal analysis of the case</p></section><p class='popular'>said</p><div class='ad'>buy</div><div class=comments>hi</div><header>Title</header></article></body>"
    assert html_text.main_text(page) == "Legal analysis of the case said Title"
    assert html_text.main_text("<body><div class='legal'>terms</div><p>text</p></body>") == "text"
