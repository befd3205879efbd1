import html
import re

import pytest

from tidewire.llm import extraction
from tidewire.llm.queries import table

from .test_extraction import STORY, page

TALE = "".join(f"<p>{STORY * 3}</p>" for _ in range(5))
TOLD = " ".join((STORY * 15).split())


def test_teasers_in_article_elements_lose_to_a_story_in_a_div():
    teasers = "".join(f"<article><h3><a href='/{i}'>Teaser number {i}</a></h3><p>Short words {i}.</p></article>" for i in range(8))
    assert extraction.extract(page(f"<div><h2>Part</h2>{TALE}</div><div>{teasers}</div>")) == f"Part {TOLD}"


@pytest.mark.parametrize("tag", ["article", "section", "div"])
def test_a_story_split_over_several_elements_is_whole(tag):
    links = "<ul>" + "".join(f"<li><a href='/{i}'>Some link text number {i}</a></li>" for i in range(20)) + "</ul>"
    assert extraction.extract(page(f"<{tag}>{TALE}</{tag}><div>{links}</div><{tag}>{TALE}</{tag}>")) == f"{TOLD} {TOLD}"


def test_headings_and_short_parts_of_the_element_around_the_core_stay():
    links = "<ul>" + "".join(f"<li><a href='/{i}'>Some link text number {i}</a></li>" for i in range(20)) + "</ul>"
    assert extraction.extract(page(f"<article><h1>Head</h1><p>By me</p><div>{TALE}</div></article><div>{links}</div>")) == f"Head By me {TOLD}"
    assert extraction.extract(page(f"<article><p>{STORY}</p></article><div>{links}</div>")) == STORY.strip()


def test_whole_table_without_article_elements(spark):
    for r in table(spark, "/root/testdata/sf0.01", "pages").collect():
        inside = re.search("<article>(.*?)</article>", r["html"], re.S)[1]
        wanted = " ".join(html.unescape(re.sub("<(?!/?b>)[^>]*>", " ", re.sub("</?b>", "", inside))).split())
        assert extraction.extract(re.sub("(</?)article>", r"\1div>", r["html"])) == wanted
        assert extraction.extract(r["html"]) == wanted
