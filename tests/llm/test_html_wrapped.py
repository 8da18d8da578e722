"""Pages whose wrapper looks like something else by its element or name."""

import pytest

from tidemark.llm import html_text

LONG = " ".join(["word"] * 60)
ARTICLE = f"<article><header><h1>Head</h1></header><p>{LONG}</p><p>Short.</p></article>"
AROUND = "<nav><a href=/>Home</a></nav>{}<footer>Imprint and all the rest of it</footer>"
WANT = f"Head\n\n{LONG}\n\nShort."
WRAPPERS = ["form id=form1", *(f"div class={w}" for w in "widget search social tags notice related modal".split())]


@pytest.mark.parametrize("wrapper", WRAPPERS)
@pytest.mark.parametrize("inner", ["article", "main"])
def test_article_in_a_wrapper(wrapper, inner):
    body = AROUND.format(ARTICLE if inner == "article" else ARTICLE.replace("article>", "main>"))
    page = f"<body><{wrapper}>{body}</{wrapper.split()[0]}></body>"
    assert html_text.main_text(page) == WANT
    inside = f"<body><form action=x><{wrapper}>{body}</{wrapper.split()[0]}></form></body>"
    assert html_text.main_text(inside) == WANT


@pytest.mark.parametrize("wrapper", [w for w in WRAPPERS if "related" not in w])
def test_long_blocks_in_a_wrapper_without_an_article(wrapper):
    page = f"<{wrapper}><div class=cookie-notice><p>{LONG} x</p></div><div><p>{LONG}</p><p>{LONG}</p></div></{wrapper.split()[0]}>"
    assert html_text.main_text(page) == f"{LONG}\n\n{LONG}"


def test_what_stays_outside():
    card = f"<article><h3>Other</h3><p>{LONG[:99]}</p></article>"
    for wrapper in ("div class=related", "div class=sidebar", "aside", "div class=comments"):
        beside = f"<{wrapper}>{card}</{wrapper.split()[0]}>"
        assert html_text.main_text(ARTICLE + beside) == WANT
    for wrapper in ("div hidden", "aside", "nav"):
        assert html_text.main_text(f"<{wrapper}>{ARTICLE}</{wrapper.split()[0]}>") == ""
    assert html_text.main_text(f"<p>{LONG}</p><p>{LONG}</p><div class=footer><p>{LONG} x</p></div>") == f"{LONG}\n\n{LONG}"
    assert html_text.main_text(f"<article class=comment><p>{LONG}</p></article>") == ""
