"""Broken markup: what it gives, and that long runs of it take linear time."""

import time

import pytest

from tidewire.llm.extraction import extract

BODY = "<body><nav><a href='/'>home</a></nav><div id=text><p>" + "A sentence of the article. " * 20 + "</p>%s<p>" + "Another sentence of it. " * 20 + "</p></div></body>"


@pytest.mark.parametrize("broken", ["</i></b></span>", "<b", "<![CDATA[x", "<a title='x>y</a>", "<br <br>", "</p></p>", "<>"])
def test_text_around_broken_markup_stays(broken):
    text = extract(BODY % broken)
    assert text.startswith("A sentence of the article.") and text.endswith("Another sentence of it.") and "home" not in text


def test_unclosed_quotes_end_at_the_first_bracket():
    assert extract("<div><p>one <b title='x>two</b> three</p></div>") == "one two three"
    assert extract("<p>1 < 2 and 3 > 2</p>") == "1 < 2 and 3 > 2"
    assert extract("<p>it's <a href='/a>b' title=\"c>\">d</a></p>") == "it's d"


@pytest.mark.parametrize(
    "make",
    [
        lambda n: "<b>x" * n + "</i>" * n,
        lambda n: "<b><div>" + "<i>" * n + "</b>" * n,
        lambda n: "<p>" + "<span>" * n + "</p>" * n,
        lambda n: "<a href='x " * n,
        lambda n: '<a ">" ' * n + "'",
        lambda n: "<a " * n + "'>x",
        lambda n: "<![CDATA[x" * n,
        lambda n: "<a \"'>t" * n,
        lambda n: "<td><li>" * n + "</p></li>" * n,
    ],
)
def test_time_is_linear(make):
    def seconds(n):
        begin = time.process_time()
        extract(make(n))
        return time.process_time() - begin

    seconds(1000)
    # Quadratic work would take 64 times as long for eight times the page.
    assert seconds(40_000) < 24 * seconds(5000) + 0.5
