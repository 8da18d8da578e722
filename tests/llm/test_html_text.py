import html
import re

from tidemark.llm import html_text
from tidemark.llm.common import load

SCHEMA = "page_id long, url string, html string"


def test_tree_knows_its_table():
    tree = html_text.train_tree()
    assert all(html_text.decide(tree, r[:-1]) == bool(r[-1]) for r in html_text.LABELLED)


def test_article_without_what_surrounds_it():
    page = """<html><head><title>no</title><style>p{}</style></head><body class="has-sidebar">
    <header><a href="/">Home</a></header><nav><ul><li><a href="/a">One</a><li><a href="/b">Two</a></ul></nav>
    <div class="cookie-notice"><p>We use cookies on this site to make it better for you every day.</p></div>
    <main><article><header><h1>Title &amp; more</h1></header>
    <p>Some <b>bold</b> text&nbsp;here,\n joined.<p>Short.<ul><li>item one</li><li>item two</li></ul>
    <div class=ad>Buy now</div><form><label>Name</label><input></form><!-- <p>no</p> -->
    <p>Last &lt;words&gt; &#233;&hellip;</p></article>
    <section class='comments'><p>Nice article, I really enjoyed reading it with my whole family.</p></section></main>
    <aside><p>Side text of some length which goes on and on without any links at all</p></aside>
    <footer>&copy; 2020</footer><script>var a = '<p>no</p>'"""
    assert html_text.main_text(page).split("\n\n") == [
        "Title & more", "Some bold text here, joined.", "Short.", "item one", "item two", "Last <words> é…",
    ]


def test_containers_by_name():
    page = """<div class="main-nav"><p>Go here and there and everywhere on this site today now</p></div>
    <div class="content with-sidebar"><div class="post-header"><h1>Head</h1></div><p>Body one.</p>
    <p class="advert">Buy this thing here now, it is very cheap for all of you</p><p>Body two.</p>
    <div hidden><p>Unseen words that nobody reads at all on this page, ever</p></div>
    <article class="comment"><p>I like it a lot and so does my whole family, thank you</p></article></div>"""
    assert html_text.main_text(page) == "Head\n\nBody one.\n\nBody two."


def test_special_pages(spark, clashing):
    long = "<article>" + "<p>" + "word " * 50_000 + "</p><p>x</p>" * 5000 + "</article>"
    pages = [
        (1, "u", None), (2, "u", ""), (3, "u", "<p>"), (4, None, "plain text of a page without any mark up at all, long enough"),
        (5, "u", "<article><p>open <b>never <p>closed <"), (5, "u", "<article><p>open <b>never <p>closed <"),
        (6, "u", "<article>a<!-- never closed <p>b"), (7, "u", "</div></p><article><p>one</article></nav>"),
        (8, "u", "<article><p title='a>b'>in \"quotes\"</p><p class=>two"), (None, "u", long),
    ]
    df = clashing(spark.createDataFrame(pages, SCHEMA))
    rows = html_text.extract(df).collect()
    texts = {str(r.page_id): r.text for r in rows}
    assert texts["1"] == texts["2"] == texts["3"] == ""
    assert texts["5"] == "open never\n\nclosed <" and texts["6"] == "a" and texts["7"] == "one"
    assert texts["8"] == 'in "quotes"\n\ntwo'
    assert texts["None"].count("\n\n") == 5000
    assert all(r.n_chars == len(r.text) for r in rows) and len(rows) == len(pages)


def test_whole_table_gives_the_articles(spark, data):
    source = load(spark, data, "pages")
    got = {r.page_id: r.text for r in html_text.extract(source).collect()}
    for r in source.collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        inner = re.sub(r"<[^>]*>", "", re.sub(r"<br>", " ", re.sub(r"</?(?:p|h1)>", "\0", inner)))
        parts = [" ".join(html.unescape(p).split()) for p in inner.split("\0")]
        assert got[r.page_id] == "\n\n".join(p for p in parts if p)


def test_empty_table(spark):
    assert html_text.extract(spark.createDataFrame([], SCHEMA)).count() == 0
