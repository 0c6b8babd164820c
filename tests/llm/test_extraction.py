import pytest

from regista.llm import extraction

PAGE = """<!DOCTYPE html><html><head><title>Not &amp; this</title><style>p{}</style><script>var t="</p><p>no";</script></head>
<body><header><h1>Site</h1></header><nav><ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li></ul></nav><!-- <p>no</p> -->
<div class="cookie-notice">We use cookies to make this site as good as it can be for you.</div>
<article class="post"><header><h1>A title &eacute; &lt;b&gt;</h1></header><p>First&nbsp;paragraph of\n the text,<br>with <b>bold</b> and <a href="x">a link</a>.
<p>Short.<p><b>Unclosed bold text here<p>Last one &#8212; end</p>
<form><p>Subscribe to our letter</p><input name="q"></form><div id="comments"><p>I like this article very much, thank you for it.</p></div>
</article><aside><p>Related things to read on this very site</p></aside><footer>&copy; all rights</footer></body></html>"""
TEXT = "A title é <b> First paragraph of the text, with bold and a link. Short. Unclosed bold text here Last one — end"


@pytest.fixture(scope="module")
def tree():
    return extraction.train()


def test_article_of_a_page(tree):
    assert extraction.main_text(tree, PAGE) == TEXT


def test_the_tree_holds_its_table(tree):
    right = sum(extraction.is_main(tree, extraction._with_beside(row[:-1])) == bool(row[-1]) for row in extraction.LABELLED)
    assert right >= 0.95 * len(extraction.LABELLED)


def test_pages_without_an_article(tree):
    body = " ".join(["word"] * 40)
    page = f"<div class=sidebar>{body}</div><p>{body}</p><p>And {body}.</p><ul><li><a href=1>More</a><li><a href=2>Less</a></ul>"
    assert extraction.main_text(tree, page) == f"{body} And {body}."


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), (" \n ", ""), ("<p></p>", ""), ("<article><p>cut off <b>in the midd", "cut off in the midd"),
    ("<article><p>a < b & c &unknown; d</p>", "a < b & c &unknown; d"), ("<article><p>x<!-- open", "x"),
    ("<article><script>open <p>never", ""), ("<ARTICLE><P CLASS='a>b'>Case</P></ARTICLE>", "Case"),
    ("<article><p>1</p></article><p>" + "outside " * 50, "1"), ("<article></div></div><p>stray ends</p></article>", "stray ends")])
def test_awkward_pages(tree, page, text):
    assert extraction.main_text(tree, page) == text


def test_every_row_has_a_result(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "v", "<article><p>" + "long " * 60000)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "'x' AS text", "0 AS n_chars")
    got = sorted(map(tuple, extraction.extract(df).collect()), key=str)
    long = " ".join(["long"] * 60000)
    assert got == sorted([(1, "u", TEXT, len(TEXT))] * 2 + [(2, None, "", 0), (None, "v", long, len(long))], key=str)
    assert extraction.extract(df.limit(0)).count() == 0


@pytest.mark.parametrize("page", [
    "<body class='single has-sidebar'><article class='post comments-open'><p>{0}</p></article></body>",
    "<html class='sidebar' id='menu'><body class='no-sidebar widget'><main class='comments'><p>{0}</p></main></body></html>",
    "<body class=sidebar><div class='no-sidebar has-related'><article id='share'><p>{0}</p></article></div></body>",
    "<article><p>{0}</p><div class='cookie-notice'><p>{0}</p></div><div id=c class='x comment-list'><p>{0}</p></div></article>"])
def test_names_of_a_page_drop_none_of_its_text(tree, page):
    body = "one two three " * 9 + "end"
    assert extraction.main_text(tree, page.format(body)) == body


@pytest.mark.parametrize("drawing", ['<svg class="i"/>', "<SVG viewBox='0 > 1' />", "<math/>", '<svg class="i"><path d="M0"/></svg>'])
def test_a_drawing_ends_where_it_closes(tree, drawing):
    assert extraction.main_text(tree, f"<article><p>one {drawing} two</p><p>three {drawing}</p></article>") == "one two three"


LONG = "The river rose for three days before the town council met and decided to open the upper gates at night."
MORE = "Nobody had seen the water so high since the bridge was built, and the old mill stood in it up to the windows."


@pytest.mark.parametrize("page,text", [
    # a paragraph before a linked line, as first block, after a title, with links of its own
    (f"<article><p>{LONG}</p><p><a href=x>link</a></p></article>", f"{LONG} link"),
    (f"<article><h1>Flood</h1><p>{LONG}</p><p><a href=x>link</a></p></article>", f"Flood {LONG} link"),
    (f"<article><h1>The flood of the long spring</h1><p><a href=a>The river rose</a> {LONG}</p><p><a href=x>next part</a></p></article>",
     f"The flood of the long spring The river rose {LONG} next part"),
    (f"<article><p>{LONG}</p><p>Source: <a href=s>the town archive of the upper valley</a></p><p>{MORE}</p></article>",
     f"{LONG} Source: the town archive of the upper valley {MORE}"),
    # a list of links inside an article is a menu, one link is not
    (f"<article><p>{LONG}</p><ul><li><a href=1>One story</a><li><a href=2>Two stories</a><li><a href=3>Three</a></ul><p>{MORE}</p></article>",
     f"{LONG} {MORE}"),
    (f"<article><a href=x><h3>A linked title</h3></a><p>{LONG}</p></article>", f"A linked title {LONG}"),
    (f"<article><p>{LONG}</p><p><a href=1>Part one</a></p><p>Thank you all.</p><p><a href=2>Part two</a></p></article>",
     f"{LONG} Part one Thank you all. Part two"),
    # references are decoded part by part
    (f"<article><p>R&<b>reg</b> and &<i>amp;</i> {LONG}</p></article>", f"R&reg and &amp; {LONG}"),
])
def test_nothing_of_an_article_is_dropped(tree, page, text):
    assert extraction.main_text(tree, page) == text


@pytest.mark.parametrize("name", [
    "comment-body", "comments-wrapper", "ad-slot", "related-reading", "promo-box", "reader-comments", "post-share", "siteFooter",
    "newsletter-signup", "cookie_banner", "x related-posts", "sponsored-content", "social-links"])
def test_what_is_none_of_the_article_by_its_name(tree, name):
    page = f"<article><p>{LONG}</p><div class='{name}'><p>Read this also, you will like it very much.</p></div><p>{MORE}</p></article>"
    assert extraction.main_text(tree, page) == f"{LONG} {MORE}"


@pytest.mark.parametrize("name", ["banner-story", "notice-text", "social-history", "sidebar-left-layout", "widget-content", "has-comments", "ad-free"])
def test_a_name_that_misleads_does_not_drop_the_article(tree, name):
    assert extraction.main_text(tree, f"<article><div class='{name}'><p>{LONG}</p><p>{MORE}</p></div></article>") == f"{LONG} {MORE}"


#: ten layouts: (page, main text)
LAYOUTS = {
    "blog": (f"<body class='single has-sidebar'><header class=site><h1>My blog</h1></header><div id=content><article class='post-12 hentry'><h2>A title</h2>"
             f"<p>{LONG}</p><blockquote>{MORE}</blockquote><div class=post-share><a href=t>Tweet</a></div></article><div id=comments><p>Great post!</p></div>"
             "</div><aside class=sidebar><p>About me and my blog</p></aside></body>", f"A title {LONG} {MORE}"),
    "news": (f"<nav><a href=1>World</a> <a href=2>Sport</a></nav><main><h1>Flood</h1><p class=byline>By Ann Author</p><p>{LONG}</p><div class=ad-slot>Buy our boats now</div>"
             f"<p>{MORE}</p></main><footer>All news, all day</footer>", f"Flood By Ann Author {LONG} {MORE}"),
    "no article": (f"<div id=menu><a href=1>Home</a> | <a href=2>Shop</a></div><div id=text><p>{LONG}</p><p>{MORE}</p></div><p>© 2024 A Company. All rights reserved.</p>",
                   f"{LONG} {MORE}"),
    "tables": (f"<table><tr><td><a href=1>Home</a><br><a href=2>News</a></td><td><p>{LONG}</p><p>{MORE}</p></td></tr></table>", f"{LONG} {MORE}"),
    "manual": (f"<main role=main><h1>Install</h1><p>{LONG}</p><pre>make install</pre><ol><li>Open the gate.</li><li>Close it.</li></ol><p>{MORE}</p></main>",
               f"Install {LONG} make install Open the gate. Close it. {MORE}"),
    "recipe": (f"<article><header><h1>Soup</h1></header><ul><li>2 onions</li><li>1 leek</li></ul><p>{LONG}</p><section class=comments><p>Tasty!</p></section></article>",
               f"Soup 2 onions 1 leek {LONG}"),
    "encyclopedia": (f"<main><h1>Mill</h1><p>A <a href=1>mill</a> is a <a href=2>machine</a>. {LONG}</p><h2>History</h2><p>{MORE}</p></main><nav><a href=x>Talk</a></nav>",
                     f"Mill A mill is a machine. {LONG} History {MORE}"),
    "forum": (f"<article><h1>How high?</h1><p>{LONG}</p><div class='comment-body'><p>As high as the mill.</p></div><div class='comment-body'><p>No.</p></div></article>",
              f"How high? {LONG}"),
    "shop": (f"<header><p>Free delivery today</p></header><main><h1>Boat</h1><p>{LONG}</p><form><label>Amount</label><button>Buy</button></form><p>{MORE}</p></main>"
             "<div class='cookie-consent'><p>We use cookies</p></div>", f"Boat {LONG} {MORE}"),
    "letter": (f"<html><body><p>Dear reader,</p><p>{LONG}</p><p>{MORE}</p><p>Yours truly</p></body></html>", f"Dear reader, {LONG} {MORE} Yours truly"),
}


@pytest.mark.parametrize("layout", LAYOUTS)
def test_layouts(tree, layout):
    page, text = LAYOUTS[layout]
    assert extraction.main_text(tree, page) == text


def test_a_page_of_megabytes(tree):
    body = " ".join(["word"] * 400)
    page = "<nav><a href=x>Menu</a></nav><article>" + f"<p>{body}</p>" * 1500 + "</article>"
    assert extraction.main_text(tree, page) == " ".join([body] * 1500)
