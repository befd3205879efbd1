import pytest

from tidewire.llm import extraction

from .test_extraction import STORY, page

TALE = "".join(f"<p>{STORY * 3}</p>" for _ in range(5))
TOLD = " ".join((STORY * 15).split())
WRAPPERS = ["layout-sidebar-right", "col-with-sidebar", "page-header-fixed", "elementor-widget elementor-widget-theme-post-content", "post social-science", "widget", "comments"]


@pytest.mark.parametrize("name", WRAPPERS)
def test_wrappers_of_the_text_stay(name):
    side = f"<div class='sidebar'><p>{STORY}</p></div>"
    for attribute in ("class", "id"):
        assert extraction.extract(page(f"<div {attribute}='{name}'>{TALE}</div>")) == TOLD
        assert extraction.extract(page(f"<div {attribute}='{name}'><article>{TALE}</article>{side}</div>")) == TOLD
        assert extraction.extract(page(f"<div {attribute}='{name}'><main><h1>Head</h1>{TALE}</main></div>", "<nav>n</nav>")) == f"Head {TOLD}"


def test_a_part_with_an_ambiguous_name_stays_unless_it_is_links():
    links = "".join(f"<a href='/{i}'>Link {i}</a>" for i in range(9))
    text = extraction.extract(page(f"<article>{TALE}<div class='section social-science'><p>{STORY}</p></div><div class='social-links'>{links}</div>{TALE}</article>"))
    assert text == f"{TOLD} {STORY}{TOLD}"


def test_boilerplate_without_the_text_goes():
    for name in ("sidebar", "widget", "main-nav", "social", "related", "cookie-notice", "post-comments"):
        assert extraction.extract(page(f"<article>{TALE}</article><div class='{name}'><p>{STORY * 3}</p></div>")) == TOLD
    replies = "".join(f"<article class='comment-body'><p>{STORY}</p></article>" for _ in range(20))
    assert extraction.extract(page(f"<article>{TALE}</article><div class='comment-list'>{replies}</div>")) == TOLD
