"""Blocks that are constant over a host's pages are template inside an article too."""

import pytest

from helixframe.llm import html_text


@pytest.mark.parametrize("wrap", ["article", "main", "section"])
def test_constant_blocks_in_and_outside_articles(wrap):
    page = lambda i: f"<body><{wrap}><h1>Title {i}</h1><div class='box'>Read our terms</div><p>text {i}</p>" + ("<div class='late'>Sent from afar</div>" if i % 2 else "") + f"</{wrap}></body>"
    w = html_text.structure(html_text.parse(page(0)))
    for i in range(1, 10):
        w = html_text.merge(w, html_text.structure(html_text.parse(page(i))))
    template = frozenset(html_text.template_paths(w))
    assert [html_text.main_text(page(i), template) for i in (2, 3)] == ["Title 2 text 2", "Title 3 text 3"]
