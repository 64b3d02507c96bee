"""Main text: pages made from known articles, a plain reading of the given pages, and damaged markup."""

import html
import random
import re
import time

import pytest

from docflow.llm import tagpaths

SCHEMA = "page_id long, url string, html string"
ARTICLE = ["On the river", "The river rose in the night, and by morning it had come up to the doors.", "Nobody had seen it so high since the spring of the great thaw; the bridge was closed.", "It fell again within a week."]


def plain_reading(page):
    """The blocks of the article element of a page of the given kind, by regular expressions alone."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    parts = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", inner).replace("<br>", " "))
    return "\n".join(x for x in (" ".join(html.unescape(p).split()) for p in parts) if x)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_given_pages(spark, sf):
    pages = spark.read.parquet(f"/root/testdata/{sf}/pages.parquet")
    got = {r.page_id: r for r in tagpaths.extract(pages).collect()}
    assert len(got) == pages.count()
    for r in pages.collect():
        assert got[r.page_id].text == plain_reading(r.html)
        assert got[r.page_id].n_chars == len(got[r.page_id].text) and got[r.page_id].url == r.url


NOISE = [
    "<nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>News, sport, weather.</a></li></ul></nav>",
    "<header><h2>The Daily Paper</h2><p>All the news, every day, since 1890.</p></header>",
    "<footer><p>Copyright 2020, all rights reserved. Terms, privacy, and so on.</p></footer>",
    "<div class='cookie-notice'>We use cookies, as all do. Please agree, or leave.</div>",
    "<div id=sidebar><h3>Most read</h3><p>A long text that has nothing to do with it, though it has commas, and more.</p></div>",
    "<aside><p>Another long text, beside the article, with marks; and more marks.</p></aside>",
    "<div class='ad'>Buy this, buy that, and do it now!</div>",
    "<form action='/s'><label>Your name, please.</label><input name=q><button>Go</button></form>",
    "<script>var p = '<p>not text, at all.</p>';</script><style>p { color: red }</style>",
    "<section class='comments'><h3>Comments</h3><article class='comment'><p>I saw it too, and it was high, very high indeed.</p></article></section>",
    "<!-- <p>an old paragraph, with marks.</p> --><noscript>Please turn scripts on, or see nothing.</noscript>",
    "<p style='display: none'>Not shown, to anyone.</p><div hidden>Nor this, ever.</div>",
]
SHELLS = [
    "<body>{before}<article><h1>{0}</h1><p>{1}</p><p>{2}</p><p>{3}</p>{within}</article>{after}</body>",
    "<body>{before}<main><div class='post-header'><h1>{0}</h1></div><div class='entry'><p>{1}<p>{2}<ul><li>{3}</ul></div>{within}</main>{after}</body>",
    "<body>{before}<article><header><h1>{0}</h1></header><section><p>{1}</p><blockquote><p>{2}</p></blockquote></section><table><tr><td>{3}</table>{within}</article>{after}</body>",
    "{before}<div class=content><h1>{0}</h1><p>{1}</p><p>{2}</p><p>{3}</p>{within}</div>{after}",
    "<form><div id='story'><h1>{0}</h1><p>{1}</p><p>{2}</p><p>{3}</p>{within}</div></form>{before}{after}",
]


@pytest.mark.parametrize("shell", range(len(SHELLS)))
def test_known_articles(shell):
    rng = random.Random(shell)
    for _ in range(40):
        some = [rng.sample(NOISE, rng.randrange(5)) for _ in range(2)]
        within = [n for n in NOISE if n.startswith(("<aside", "<div class='ad'", "<form", "<script", "<section", "<footer", "<p style"))]
        page = SHELLS[shell].format(*ARTICLE, before="".join(some[0]), after="".join(some[1]), within="" if shell == 4 else "".join(rng.sample(within, rng.randrange(3))))
        assert tagpaths.main_text(page) == "\n".join(ARTICLE), page


def test_ratios_find_unmarked_content():
    links = "<div><a href=/1>One</a> <a href=/2>Two</a></div>" * 3
    page = f"<html><body><table><tr><td>{links}</td><td><div><p>{ARTICLE[1]}</p><p>{ARTICLE[2]}</p></div></td></tr></table><div>Contact us</div></body></html>"
    assert tagpaths.main_text(page) == "\n".join(ARTICLE[1:3])


CASES = [
    (None, ""),
    ("", ""),
    ("   \n ", ""),
    ("no tags,  at\n all", "no tags, at all"),
    ("<p>a &lt;b&gt; &amp;amp; &eacute;&#233;&#xE9; &am &nbsp; c<br>d</p>", "a <b> &amp; ééé &am c d"),
    ("<article><p>one <b>two</b> thr<i>ee</i><p>four</article>", "one two three\nfour"),
    ("<article><p>Be.</p></article><footer>A far longer text, with marks, and more of them; and so on.</footer>", "Be."),
    ("<nav>only a menu</nav>", ""),
    ("<div class='comments'>all that there is</div>", "all that there is"),
    ("<article><p>kept <span class='ad'>bought <span>in</span> </span>and kept</p></article>", "kept and kept"),
    ("<article><p>a<!-- x --><p>b<!-- not closed <p>c", "a\nb"),
    ("<article><p>1 < 2 and 3 > 2</p></article>", "1 < 2 and 3 > 2"),
    ("<article><p title='a > b'>x</p><p title=\"it's>\">y</p><p title='open>z</p></article>", "x\ny\nz"),
    ("<ARTICLE><P>Upper</P></ARTICLE>", "Upper"),
    ("<article><p>a</p><article><p>a reader's word</p></article><p>b</p></article>", "a\nb"),
    ("<article><table><tr><td>a</div>b<td>c</table></article>", "a b\nc".replace("a b", "ab")),
]


@pytest.mark.parametrize("page,text", CASES)
def test_cases(page, text):
    assert tagpaths.main_text(page) == text


def test_rows_stay_whole(spark):
    rows = [(1, "u", p) for p, _ in CASES] + [(None, None, CASES[4][0])] * 2
    got = sorted((tuple(r) for r in tagpaths.extract(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr)
    want = sorted(((1, "u", t, len(t)) for _, t in CASES), key=repr)
    assert sorted([*want, *[(None, None, CASES[4][1], len(CASES[4][1]))] * 2], key=repr) == got
    assert tagpaths.extract(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("piece", ["<div>", "<p>a</b>", "<td>x", "<a b='", "<", "<div a=", "<li>y<div>", "<h1>a<h2>", "</p>", "&amp"])
def test_linear_time(piece):
    began = time.process_time()
    tagpaths.main_text(piece * (400_000 // len(piece)))
    assert time.process_time() - began < 10
