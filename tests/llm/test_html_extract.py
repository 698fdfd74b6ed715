import pytest

from medstrata.llm.html_extract import blocks_of, classify, extract, labelled_blocks, main_text

LONG = "The river is one of the longest in the land and it was the home of many people who came to it for water, for fish and for the fields on its banks."


@pytest.mark.parametrize("page, text", [
    ("", ""), ("   ", ""), ("plain words", "plain words"), ("a < b & c &lt; d", "a < b & c < d"), ("<p>one<p>two", "one\ntwo"),
    ("<script>var t='</p>';</script><p>x</p><style>p{}</style>", "x"), ("<!-- hidden <p>no</p> --><p>yes</p>", "yes"), ("<p>cut<", "cut<"), ("<p>cut</p", "cut"),
    ("<p>&amp;&#233;&eacute;&nbsp;x&amp</p>", "&éé x&"), ("<p>a\n  b\t<br>c <b>d</b>e</p>", "a b c de"), ("<title>t</title><p>x</p>", "x"),
    ("<p title='a > b'>x</p>", "x"), ("<p title=it's>x</p>", "x"), ("<textarea>no</textarea><p>x</p>", "x"), ("<script>never ends <p>x", ""),
])
def test_markup(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("around", [
    "<nav><ul><li><a href='/'>Home</a></ul></nav>{}<footer>&copy; the firm</footer>",
    "<header><h1>The site</h1><p>" + LONG + "</p></header><main>{}</main><aside><p>" + LONG + "</p></aside>",
    "<div class='cookie-notice'>We use cookies and so do you</div>{}<form><p>Your name</p><input></form>",
    "<div id=sidebar>" + LONG + "</div><div class='page with-sidebar'>{}</div><section class='comments'><article><p>" + LONG + "</p></article></section>",
    "<div role='banner'>" + LONG + "</div>{}<div class=ad>" + LONG + "</div><div style='display: none'>" + LONG + "</div>",
    "<table><tr><td><ul class=menu><li>" + LONG + "</ul><td>{}</table>",
])
def test_only_the_article(around):
    article = f"<article><h1>Rivers</h1><p>{LONG}</p><p>Short.</p><ul><li>First <li>Second</ul><p>{LONG} &amp; more</p></article>"
    assert main_text(f"<html><body>{around.format(article)}</body></html>") == f"Rivers\n{LONG}\nShort.\nFirst\nSecond\n{LONG} & more"


def test_second_pass_takes_the_nearest_label():
    page = f"<div><p>{LONG}</p><p>Near text</p><p><a href=x>A long list of links that lead the reader away from here to there</a></p><p>Near links</p></div>"
    assert [(b.text[:10], b.label) for b in classify(blocks_of(page))] == [(LONG[:10], "good"), ("Near text", "good"), ("A long lis", "bad"), ("Near links", "bad")]
    tied = f"<div><p>{LONG}</p><p>Between</p><p><a href=x>A long list of links that lead the reader away from here to there</a></p></div>"
    assert main_text(tied) == f"{LONG}\nBetween"


def test_deep_and_broken_markup_ends():
    assert main_text("<div>" * 5000 + "x" + "</b>" * 5000) == "x"
    assert main_text("<" * 20000).startswith("<")
    assert main_text("<a b='" * 2000 + "x") is not None
    assert main_text("<p>" + "w " * 100_000 + "</p>") == ("w " * 100_000).strip()


def test_tables(spark):
    rows = [(1, "u", f"<p>{LONG}</p>", "own"), (1, "u", f"<p>{LONG}</p>", "own"), (2, None, None, "own"), (None, "u", "", "own")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = sorted(map(tuple, extract(pages).collect()), key=repr)
    assert found == sorted([(1, "u", LONG, len(LONG)), (1, "u", LONG, len(LONG)), (2, None, "", 0), (None, "u", "", 0)], key=repr)
    assert extract(pages.limit(0)).count() == 0
    assert [r["label"] for r in labelled_blocks(pages).collect()] == ["good", "good"]


@pytest.mark.parametrize("page, text", [
    (f"<article class=card><h2>Also</h2><p>{LONG}</p></article><div><p>{LONG} 1</p><p>{LONG} 2</p><p>{LONG} 3</p></div>", f"Also\n{LONG}\n{LONG} 1\n{LONG} 2\n{LONG} 3"),
    *((f"<div class='{c}'><h1>Rivers</h1><p>{LONG}</p><p>Short.</p></div><nav><a href=x>Home</a></nav>", f"Rivers\n{LONG}\nShort.") for c in ("no-sidebar", "has-social", "with-widget", "widget", "comments")),
    (f"<form action=x><div><p>{LONG}</p></div><nav><a href=x>Home</a></nav></form>", LONG),
    (f"<article><p>{LONG} 1</p><p>{LONG} 2</p><div class='market-share'><p>{LONG} 3</p></div></article>", f"{LONG} 1\n{LONG} 2\n{LONG} 3"),
    (f"<p>{LONG}</p><div class=related-posts><p>Other rivers</p></div>", LONG),
    (f"<article><p>{LONG}</p></article><section class=comments><p>{LONG}</p><p>{LONG}</p></section>", LONG),
])
def test_markup_does_not_overrule_the_text(page, text):
    assert main_text(f"<html><body>{page}</body></html>") == text


def test_languages_without_stop_words():
    finnish = "Joki kuuluu maan pisimpiin, ja sen rannoille asettui jo varhain ihmisiä, jotka saivat siitä vettä, kalaa ja viljelysmaata."
    menu = "<ul><li><a href=x>Etusivu</a><li><a href=y>Uutiset</a></ul>"
    page = f"{menu}<div><h1>Joki</h1><p>{finnish}</p><p>{finnish}</p></div>{menu}"
    assert main_text(page).splitlines()[-2:] == [finnish, finnish]
    assert "Etusivu" not in main_text(page)


@pytest.mark.parametrize("mark", ["class=site-footer", "class=left-sidebar", "class=cookie-bar", "id=comment-list", "class='post-footer'", "class=acme-sidebar-2", "class='site-header'"])
@pytest.mark.parametrize("times", [1, 5])
def test_marked_blocks_outside_an_article(mark, times):
    marked = f"<div {mark}>" + f"<p>{LONG}</p>" * times + "</div>"
    article = f"<h1>Rivers</h1><p>{LONG} 1</p><p>{LONG} 2</p>"
    assert main_text(f"<body><article>{article}</article>{marked}</body>") == f"Rivers\n{LONG} 1\n{LONG} 2"
    if times == 1:
        assert main_text(f"<body>{marked}<div>{article}</div></body>") == f"Rivers\n{LONG} 1\n{LONG} 2"


@pytest.mark.parametrize("mark", ["class=ad-box", "class=related-articles", "class='share-bar'", "class=newsletter-box", "class=ad"])
def test_marked_blocks_inside_an_article(mark):
    page = f"<article><h1>Rivers</h1><p>{LONG} 1</p><div {mark}><p>{LONG} no</p></div><p>{LONG} 2</p></article>"
    assert main_text(page) == f"Rivers\n{LONG} 1\n{LONG} 2"


@pytest.mark.parametrize("mark", ["class=sidebar", "class=notice", "class='cookie-notice'", "class=comments", "class=consent"])
def test_a_marked_block_with_most_of_the_text(mark):
    marked = f"<div {mark}>" + f"<p>{LONG}</p>" * 9 + "</div>"
    assert main_text(f"<body>{marked}<article><p>A short one.</p></article></body>") == "A short one."
    assert main_text(f"<body><div><p>{LONG} 1</p></div>{marked}</body>") == f"{LONG} 1"
    assert main_text(f"<body>{marked}</body>").count(LONG) == 9  # nothing else is text


def test_linked_paragraphs_within_the_text():
    linked = f"<p><a href=x>{LONG} linked</a></p>"
    assert main_text(f"<article><p>{LONG} 1</p>{linked}<p>{LONG} 2</p></article>") == f"{LONG} 1\n{LONG} linked\n{LONG} 2"
    menu = "<ul><li><a href=x>One of many links to other pages</a><li><a href=y>Two</a></ul>"
    assert main_text(f"<article><p>{LONG} 1</p>{menu}</article>{linked}") == f"{LONG} 1"


def inherited_by_hand(labels):
    """The nearest decided label on either side, text if both are as near."""
    out = []
    for i, label in enumerate(labels):
        near = sorted((abs(i - j), other != "good", other) for j, other in enumerate(labels) if other != "ambiguous")
        out.append(label if label != "ambiguous" else near[0][2] if near else "good")
    return out


def test_second_pass_by_brute_force():
    import random

    from medstrata.llm.html_extract import Block, _inherit

    chance = random.Random(2)
    for _ in range(300):
        labels = [chance.choice(["good", "bad", "ambiguous", "ambiguous"]) for _ in range(chance.randint(0, 12))]
        blocks = [Block("x", 0, False, False, False, 0, label=label) for label in labels]
        _inherit(blocks, "good")
        assert [b.label for b in blocks] == inherited_by_hand(labels)
