import html
import re

import pytest

from tidewire.llm import extraction
from tidewire.llm.queries import table

STORY = "A long paragraph of the story that goes on for a while, with many words and no links at all. "


def page(inside, before="", after=""):
    return f"<html><head><title>t</title></head><body>{before}{inside}{after}</body></html>"


@pytest.mark.parametrize(
    ("given", "wanted"),
    [
        (None, ""), ("", ""), ("   ", ""), ("<p>only</p>", "only"), ("a < b &amp; c", "a < b & c"), ("<script>x</script>", ""), ("<div><p>cut off <a href='x", "cut off <a href='x"),
        (page("<article><h1>T</h1><p>a<b>b</b>c<br>d</p></article>"), "T abc d"),
        (page("<article><p>x&nbsp;&#233;&eacute;\n\t y</p></article>"), "x éé y"),
        (page("<article><p><b>Open.<br><p>Next.</p></article>", "<nav><a>m</a></nav>", "<footer>f</footer>"), "Open. Next."),
        (page("<article><p>x<script>if (a < b) { '</p>' }</script><style>p{}</style>y</p><!-- z --></article>"), "xy"),
        (page("<article><header><h1>Head</h1></header><p>one</p><form>f</form><aside>s</aside><div class='share-buttons'>s</div></article>", "<header>site</header>"), "Head one"),
        (page("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article>"), "a b c d"),
    ],
)
def test_small_pages(given, wanted):
    assert extraction.extract(given) == wanted


def test_without_semantic_elements_the_densest_part_wins():
    links = "<ul>" + "".join(f"<li><a href='/{i}'>Some link text number {i}</a></li>" for i in range(40)) + "</ul>"
    story = "".join(f"<p>{STORY * 3}</p>" for _ in range(5))
    got = extraction.extract(page(f"<div id='a'>{links}</div><div id='b'>{story}</div><div class='cookie-notice'>{STORY}</div><div id='comments'>{STORY * 30}</div>"))
    assert got == " ".join((STORY * 15).split())


def test_boilerplate_by_name():
    parts = [f"<div class='{c}'>{STORY * 9}</div>" for c in ("sidebar", "main-nav", "adBanner", "cookie consent", "post-comments", "newsletter")]
    for part in [*parts, f"<div role='banner'>{STORY}</div>", f"<div hidden>{STORY}</div>", f"<p style='display: none'>{STORY}</p>"]:
        assert extraction.extract(page(f"<main><p>Kept.</p>{part}<p>Also.</p></main>", part, part)) == "Kept. Also."


def test_layout_names_do_not_cut_the_article():
    assert extraction.extract("<body class='has-sidebar'><div class='with-nav'><article class='ad'><p>Kept.</p></article></div></body>") == "Kept."


def test_whole_table(spark):
    pages = table(spark, "/root/testdata/sf0.001", "pages")
    rows = extraction.extract_pages(pages).collect()
    source = {r["page_id"]: r for r in pages.collect()}
    assert len(rows) == len(source)
    for r in rows:
        inside = re.search("<article>(.*?)</article>", source[r["page_id"]]["html"], re.S)[1]
        assert r["text"] == " ".join(html.unescape(re.sub("<(?!/?b>)[^>]*>", " ", re.sub("</?b>", "", inside))).split())
        assert r["n_chars"] == len(r["text"]) and r["url"] == source[r["page_id"]]["url"]


def test_nulls_copies_long_pages_and_further_columns(spark):
    long = page("<article>" + f"<p>{STORY}</p>" * 20_000 + "</article>")
    deep = page("<div>" * 5000 + "deep" + "</div>" * 5000)
    rows = [(1, None, None), (None, "u", ""), (2, "u", long), (2, "u", long), (3, "u", deep), (4, "u", "<" * 2000), (5, "u", "<a '" * 500)]
    given = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")
    got = extraction.extract_pages(given).collect()
    assert sorted(r["n_chars"] for r in got)[-2:] == [len(" ".join((STORY * 20_000).split()))] * 2
    assert {r["page_id"]: r["text"] for r in got}[3] == "deep" and {r["page_id"]: r["text"] for r in got}[None] == ""
    assert extraction.extract_pages(given.limit(0)).count() == 0
