"""Pages without article elements or telling class names: link densities and lengths decide."""

from tidemark.llm import html_text

MENU = "<ul><li><a href=/>Home</a><li><a href=/a>About us</a></ul>"


def para(n, mark="w"):
    return f"<p>{' '.join([mark] * n)}</p>"


def links(*sizes):
    return "".join(f"<div><a href=/x>{' '.join(['l'] * n)}</a></div>" for n in sizes)


def text(page):
    return html_text.main_text(f"<html><body>{page}</body></html>").split("\n\n")


def words(*sizes):
    return [" ".join(["w"] * n) for n in sizes]


def test_last_paragraph_before_links():
    for last in (12, 16, 30, 51):
        assert text(MENU + para(65) + para(last) + links(3, 4, 5)) == words(65, last)


def test_paragraph_before_references():
    assert text(MENU + para(65) + para(20) + links(9, 12) + para(58) + para(21)) == words(65, 20, 58, 21)


def test_short_headings_before_short_paragraphs():
    page = MENU + "<h1>w w w</h1>" + para(30) + "<h2>w</h2>" + para(19) + "<h2>w w</h2>" + para(35) + links(2, 2)
    assert text(page) == words(3, 30, 1, 19, 2, 35)


def test_rows_of_many_link_words():
    for n in (6, 10, 17, 80):
        assert text(links(n) + para(50) + links(n) + para(40) + para(30)) == words(50, 40, 30)


def test_labels_between_links_go():
    assert text(links(4, 3) + para(4, "x") + links(6) + "<h3>x x</h3>" + links(5, 2)) == [""]


def test_one_paragraph_between_links():
    assert text(links(4, 3) + para(66) + links(6, 2)) == words(66)


def test_tree_uses_own_and_both_neighbours_densities():
    def used(tree):
        return set() if isinstance(tree, int) else {html_text.FEATURES[tree[0]]} | used(tree[2]) | used(tree[3])

    assert {"link_density", "link_density_before", "link_density_after"} <= used(html_text.train_tree())


def test_long_text_is_kept_and_link_rows_go_whatever_stands_beside():
    tree = html_text.train_tree()
    beside = [(0, 0.0), *((n, d) for n in (1, 5, 12, 40, 90) for d in (0.0, 0.3, 0.8, 1.0))]
    for before in beside:
        for after in beside:
            assert html_text.decide(tree, (90, 0.0, *before, *after, 0, 0))
            assert html_text.decide(tree, (90, 0.0, *before, *after, 0, 1))
            assert not html_text.decide(tree, (10, 1.0, *before, *after, 0, 0))
            assert not html_text.decide(tree, (90, 0.0, *before, *after, 1, -1))
