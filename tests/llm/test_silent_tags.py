"""Silent elements without their end tags: what the page holds after them is not lost."""

import pytest

from trolley.llm import html_text


def texts(page):
    return " ".join(t for _, t in html_text.parse(page).runs)


@pytest.mark.parametrize(
    "page,want",
    [
        ("<head><title>t</title><article><p>one</p><p>two</p></article>", "one two"),
        ("<html><head><title>t</title><meta charset=x><link rel=y>plain text<p>more</p>", "plain text more"),
        ("<head><title>t</title><style>s</style></head><body><p>a</p></body>", "a"),
        ("<p>a</p><datalist><option>x<option>y</datalist><p>b</p>", "a b"),
        ("<p>a <select><option>x<option>y</select> b</p>", "a b"),
        ("<div>a<option>x<option>y</div>b<p>c</p>", "a b c"),
        ("<article><p>a <button>press</p><p>b</p></article><p>c</p>", "a press b c"),
        ("<article><p>a <object>film</p><p>b</p></article>", "a film b"),
        ("<p>a <math><mi>x</mi><mo>=</mo><mn>1</mn></math> b</p>", "a x=1 b"),
        ("<p>a</p><noscript>no script<article><p>b</p></article>", "a b"),
        ("<div>a<noscript>no script</div>b", "a b"),
        ("<p>a</p><noscript><div>no script</div></noscript><p>b</p>", "a b"),
        ("<p>a</p><noscript>x<p>b</p><noscript><p>no script</p></noscript><p>c</p>", "a b c"),
        ("<head><noscript><div>x</div></noscript><title>t</title></head><p>a</p>", "a"),
        ("<p>a</p><svg><g>x<p>b</p>", "a b"),
        ("<p>a</p><svg><foreignObject><div>x</div></foreignObject></svg><p>b</p>", "a b"),
        ("<p>a</p><template><p>x</p></template><canvas>y<p>b</p>", "a b"),
    ],
)
def test_text_after_silent_tags(page, want):
    assert texts(page) == want
