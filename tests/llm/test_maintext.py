"""Main text extraction: labelled pages, an independent reading of the given table, and the scan."""

import html
import random
import re
import time

import pytest

from tallybook.llm import maintext, queries

SMALL = "/root/testdata/sf0.01"
ARTICLE = "<h1>Title of it</h1><p>One two three.</p><p>Four <b>five</b> six&amp;seven.</p>"
TEXT = "Title of it One two three. Four five six&seven."
LONG = "<p>" + "many words of a paragraph " * 8 + "</p>"
LONG_TEXT = ("many words of a paragraph " * 8).strip()


def plain_text(source):
    """What stands between the article tags, block by block."""
    inner = re.search(r"<article>(.*?)</article>", source, re.S).group(1)
    blocks = [html.unescape(re.sub(r"<[^>]*>", "", b)).split() for b in re.split(r"</?(?:p|h1|br)[^>]*>", inner)]
    return " ".join(" ".join(b) for b in blocks if b)


@pytest.fixture(scope="module")
def weights(spark):
    return maintext.fit(spark.read.parquet(f"{SMALL}/pages.parquet"))


def test_given_pages(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    want = {r.page_id: (r.url, plain_text(r.html), len(plain_text(r.html))) for r in pages.collect()}
    got = queries.QUERIES["op13_main_text"](spark, SMALL)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert {r.page_id: (r.url, r.text, r.n_chars) for r in got.collect()} == want


def test_pages_without_marks(spark, weights):
    """The same pages once the marking element is taken away: the weights find the text."""
    for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect():
        assert maintext.main_text(re.sub("</?article>", "", r.html), weights) == plain_text(r.html)


CASES = {
    "nothing": ("", ""),
    "no markup": ("just some  words\nof text", "just some words of text"),
    "article": (f"<body><nav><a href=x>Home</a></nav><article>{ARTICLE}</article><footer>(c) me</footer>", TEXT),
    "main": (f"<main>{ARTICLE}</main><aside>Read this as well, it is good</aside>", TEXT),
    "header and title": (f"<title>no</title><header><h1>Site name</h1><p>Our motto is long</p></header><article>{ARTICLE}</article>", TEXT),
    "header inside": (f"<article><header><h1>Title of it</h1></header>{ARTICLE[20:]}</article>", TEXT),
    "upper case": (f"<BODY><NAV><A HREF='x'>Home</A></NAV><ARTICLE CLASS=big>{ARTICLE.upper()}</ARTICLE>", TEXT.upper().replace("&SEVEN", "&SEVEN")),
    "sidebar in the middle": (f"<article>{ARTICLE}<div class='sidebar'><p>Other story here</p></div>{LONG}</article>", f"{TEXT} {LONG_TEXT}"),
    "notice": (f"<div id=cookie-notice><p>We use cookies, many of them, do you mind?</p></div><article>{ARTICLE}</article>", TEXT),
    "advert inside": (f"<article>{ARTICLE}<div class=\"ad\">Buy now!</div>{LONG}</article>", f"{TEXT} {LONG_TEXT}"),
    "form": (f"<article>{ARTICLE}<form><p>Your name</p><input name=a><button>Send</button></form></article>", TEXT),
    "form around": (f"<form><input><article>{ARTICLE}</article><p>Send this</p></form>", TEXT),
    "comments": (f"<article>{ARTICLE}<section id='comments'><article class=comment><p>{LONG}</p></article></section></article>", TEXT),
    "comments after": (f"<article>{ARTICLE}</article><ol class='comment-list'><li><p>first!</p>{LONG}</li></ol>", TEXT),
    "scripts": (f"<script>var a = '<p>x</p>';</script><style>p {{}}</style><article>{ARTICLE}<script>if (a < b) c('</p>')</SCRIPT ></article>", TEXT),
    "comment": (f"<!-- <article>no</article> --><article>{ARTICLE}<!-- > no --></article><!-- open", TEXT),
    "open elements": ("<article><h1>Title of it<p>One <b>two<p>three<br>four", "Title of it One two three four"),
    "stray ends": (f"</div></p></article><article>{ARTICLE}</span></b></article>", TEXT),
    "cut tag": (f"<article>{ARTICLE}<a href=\"x", TEXT),
    "open quote": (f"<article><p class=\"x>{ARTICLE[20:]}</article>", "One two three. Four five six&seven."),
    "bracket in attribute": (f"<article data-x='a>b' title=\"c>d\">{ARTICLE}</article>", TEXT),
    "lone brackets": ("<article><p>a < b <3 and c > d, 1<2 </p><p>x <> y</p></article>", "a < b <3 and c > d, 1<2 x <> y"),
    "references": ("<article><p>&lt;p&gt; &#65;&#x42; &eacute; &nbsp; &unknown; &amp;amp; &</p></article>", "<p> AB é &unknown; &amp; &"),
    "split reference": ("<article><p>&am</p><p>p; x</p></article>", "&am p; x"),
    "inline tags": ("<article><p>foo<b>bar</b><i> baz</i><span>qux</span></p></article>", "foobar bazqux"),
    "white space": ("<article><p> a\t\n b </p>\n\n<p>\r\n</p><pre>c  d\n e</pre></article>", "a b c d e"),
    "list and table": (f"<article>{ARTICLE}<ul><li>one</li><li>two</li></ul><table><tr><td>x</td><td>y</td></tr></table></article>", f"{TEXT} one two x y"),
    "links inside": (f"<article><p><a href=x>All of it is a link</a></p>{LONG}</article>", f"All of it is a link {LONG_TEXT}"),
    "link at the end": (f"<article>{LONG}<p>See <a href=x>here or elsewhere for very much more</a></p></article>", f"{LONG_TEXT} See here or elsewhere for very much more"),
    "hidden": (f"<article>{ARTICLE}<p hidden>not seen</p></article>", TEXT),
    "divs only": (f"<div class=nav><a href=1>One</a> <a href=2>Two</a></div><div id=content>{LONG}{LONG}</div><div class=footer>me</div>", f"{LONG_TEXT} {LONG_TEXT}"),
    "roles": (f"<div role=navigation><p>Go there</p></div><div role=main>{ARTICLE}</div><div role=contentinfo><p>me</p></div>", TEXT),
    "menu only": ("<nav><ul><li><a href=x>a</a></li></ul></nav><footer>me</footer>", ""),
}


@pytest.mark.parametrize("name", CASES)
def test_labelled_pages(weights, name):
    source, want = CASES[name]
    assert maintext.main_text(source, weights) == want


def test_unlabelled_weights_read_marked_pages():
    for name in ("article", "main", "notice", "comments", "sidebar in the middle", "no markup"):
        assert maintext.main_text(CASES[name][0], maintext.Weights()) == CASES[name][1]


def test_region_is_the_best_of_all(weights):
    """The linear scan against all pairs of cuts, over random pages."""
    chance = random.Random(11)
    parts = ["<p>", "</p>", "<div class=ad>", "</div>", "<li>", "<a href=x>", "</a>", "some words here ", "word ", "<nav>", "</nav>", "<section>"]
    for _ in range(200):
        page = maintext.Page("".join(chance.choices(parts, k=25)), weights)
        worth = [words * score if words else (0.0 if text else score) for words, score, _, text, _ in page.items]
        best = max([sum(worth[a:b]) for a in range(len(worth)) for b in range(a + 1, len(worth) + 1)], default=0.0)
        begin, end = page.region()
        assert sum(worth[begin:end]) == pytest.approx(max(best, 0.0))


def test_rows_and_columns(spark, weights):
    rows = [(1, "a", None), (None, None, ""), (2, "b", CASES["article"][0]), (2, "b", CASES["article"][0]), (3, None, "\x00<p>\x00")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = maintext.extract(pages, weights)
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(
        map(str, [(1, "a", "", 0), (None, None, "", 0), (2, "b", TEXT, len(TEXT)), (2, "b", TEXT, len(TEXT)), (3, None, "\x00 \x00", 3)])
    )
    empty = pages.limit(0)
    assert maintext.extract(empty, maintext.fit(empty)).count() == 0
    clash = pages.withColumnRenamed("url", "inside").withColumn("kind", pages["page_id"])
    assert maintext.extract(clash, weights).columns == ["page_id", "inside", "kind", "text", "n_chars"]


def test_the_sample_is_bounded(spark):
    pages = spark.createDataFrame([(f"<main><p>text number {i}</p></main><footer>me</footer>",) for i in range(300)], "html string")
    some, every = maintext.fit(pages, sample=40), maintext.fit(pages)
    assert some["in:main"] == every["in:main"] == maintext.CLIP and every["in:footer"] == -maintext.CLIP


@pytest.mark.parametrize("unit", ["<b>", "<p><i>", "<", "</", "<a href=\"", "<!--", "<script>", "</b>", "<p>x<b>y</i>", "&amp;", "<div class='", "word "])
def test_time_is_linear_in_the_page(weights, unit):
    begun = time.time()
    maintext.main_text("<article>" + unit * 60_000, weights)
    assert time.time() - begun < 10
