import html
import re
import time

import pytest

from linkgraph.llm import extraction as X
from tests.conftest import SF_SMALL


def article(page):
    """Blocks of a test page's article, by regular expressions."""
    begin = page.index("<article>") + 9
    end = page.find("</article>", begin)
    parts = re.split(r"</?(?:p|h1|br)>", re.sub(r"</?[bi]>", "", page[begin:end if end >= 0 else None]))
    found = (re.sub(r"\s+", " ", html.unescape(p)).strip() for p in parts)
    return "\n".join(p for p in found if p)


def test_test_pages(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    got = X.extract_pages(pages)
    assert set(got.columns) == {*pages.columns, "text"}
    rows = got.collect()
    assert len(rows) == pages.count() and all(r.text == article(r.html) for r in rows)


@pytest.mark.parametrize(("page", "text"), [
    ("", ""), ("plain &amp; text", "plain & text"), ("<p>a<p>b<br>c", "a\nb\nc"), ("<art", ""), ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"),
    ("<div class=ad>x</div><div class=content><p>Hello <b>bold</b> text</p><ul><li>one<li>two</ul></div>", "Hello bold text\none\ntwo"),
    ("<body><div class=sidebar>side</div><main><h1>T</h1><p>x <!-- c --> y</p><div id=comments>no</div><form>f</form></main><footer>f", "T\nx y"),
    ("<article><p>unclosed <i>it<p>next &eacute;&#233;&nbsp;z", "unclosed it\nnext éé z"),
    ("<article>a<script>if(a<b){'</p>'}</script>b<style>p{}</style></article>", "ab"),
    ("<article><section><p>aaaa aaaa</p></section><section><p>bbbb</p></section></article><div>zz</div>", "aaaa aaaa\nbbbb"),
    ("<body><nav>menu</nav><div hidden>gone</div><div role=dialog>notice</div><article>text</article>", "text"),
    ("<table><tr><td>nav<td><p>long text here<p>more<tr><td>c</table>", "long text here\nmore"),
    ("<p>x</p></div></p></b><p>y", "x\ny"), ("<P CLASS='a>b'>x</P>", "x"), ("a<!-- never closed", "a"), ("<article>" + "<div>" * 3000 + "deep", "deep"),
])
def test_pages_of_all_kinds(page, text):
    assert X.extract(page, None) == text


def test_host_votes_decide(spark):
    body = "<div class='post p%d'><p>%s</p></div>"
    wide = [(i, "http://h.example/a", body % (i, "long text " * 20)) for i in range(5)]
    odd = (9, "http://H.example:80/b", body % (9, "short text") + "<div class=box9><p>" + "other long text " * 30 + "</p></div>")
    lone = (10, "http://z.example/", odd[2])
    fallback = (11, "http://h.example/c", "<div class=other><p>nothing under the path</p></div>")
    df = spark.createDataFrame([*wide, odd, lone, fallback], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in X.extract_pages(df).collect()}
    assert got[9] == "short text" and got[10].startswith("other long text") and got[11] == "nothing under the path"
    votes = {r.host: r.winner for r in X.consensus(df).collect()}
    assert votes["h.example"] == "div.p#.post" and set(votes) == {"h.example", "z.example"}


def test_awkward_rows(spark):
    rows = [(1, None, None, "x", "h"), (1, None, None, "x", "h"), (2, "", "", "x", "h"), (None, "no url", "<p>a", "x", "h"),
            (3, "http://a.example/", "<p>" + "word " * 100_000, "x", "h"), (4, "http://a.example/", "<p>" * 20_000, "x", "h")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, _host string, host string")
    got = X.extract_pages(df)
    assert got.count() == 6 and set(got.columns) == {*df.columns, "text"}
    by = {r.page_id: r.text for r in got.collect()}
    assert by[1] == by[2] == by[4] == "" and by[None] == "a" and len(by[3]) == 499_999
    assert X.extract_pages(df.limit(0)).count() == 0


LONG = " ".join(f"sentence {i} of a long article about rivers and hills." for i in range(40))


def test_pages_without_host_do_not_share_a_vote(spark):
    site = f'<html><body><div class="a"><p>{LONG}</p></div><div class="b"><p>%s</p></div></body></html>'
    other = '<html><body><div class="a"><p>Note.</p></div><div class="b"><p>The longer text of this page stands here.</p></div></body></html>'
    rows = [(i, None, site % "x") for i in range(20)] + [(100, None, other), (101, "no host", other)]
    got = {r.page_id: r.text for r in X.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[100] == got[101] == "The longer text of this page stands here." and got[0] == LONG


STORY = " ".join(f"word{i}" for i in range(60))


@pytest.mark.parametrize("page", [
    f"<body><form action=/x><div class=menu>a b</div><div><p>{STORY}</p></div><input><button>go</button></form></body>",
    f'<body><p title=5">{STORY}</p><p class="x"></p></body>',
    f'<div class="share-price-article search"><p>{STORY}</p></div>',
    f'<div class="content widget"><p>{STORY}</p></div><div class="widget">Weather today</div>',
    f'<form><div class=widget><form><p>{STORY}</p></form></div></form>',
    f"<p data-a=b'c>{STORY}</p><p id='y'></p>"])
def test_marked_parts_that_hold_the_article_are_read(page):
    assert X.extract(page, None) == STORY


def test_soft_noise_beside_an_article_stays_out():
    side = "<div class='side'>" + "teaser text of other pages " * 12 + "</div>"
    assert X.extract(f"<article><p>{STORY}</p></article>{side}<form>{side}</form>", None) == STORY
    assert X.extract(f"<article><p>Short.</p></article><div id=comments><p>{STORY}</p></div>", None) == "Short."
    assert X.extract("<form class=search>Search the whole site <input></form>", None) == ""


def test_second_template_of_a_host_wins_its_own_pages(spark):
    one = "<div class='post'><p>%s</p></div>" % ("long text " * 40)
    two = "<div class='post'><p>Teaser.</p></div><div class='recipe'><p>%s</p></div>" % ("cook it " * 30)
    rows = [(i, "http://h.example/", one) for i in range(12)] + [(20 + i, "http://h.example/", two) for i in range(4)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in X.extract_pages(df).collect()}
    assert got[0].startswith("long text") and all(got[20 + i].startswith("cook it") for i in range(4))
    assert [r.winners for r in X.consensus(df).collect()] == [["div.post", "div.recipe"]]


def test_deep_nesting_takes_linear_time():
    begin = time.process_time()
    for page in ("<div>" * 100_000 + STORY, "<form>" * 30_000 + STORY, "<div class=widget>" * 30_000 + STORY):
        assert X.extract(page, ["div/div"]) == STORY
    assert time.process_time() - begin < 60
