"""Main text of pages, and what recurs on a host's pages."""

from __future__ import annotations

import time

import pytest

from sluice.llm import html_templates as H

PAGES = "page_id int, url string, html string, text string, key int, row string"

CASES = [
    ("<p>a <b>b</b>c<p>d", "a bc\nd"),
    ("<h1>T&amp;t</h1><p>x&nbsp;&lt;y  z\n\tw</p>", "T&t\nx <y z w"),
    ("<article><h1>T</h1><p>in</p></article><p>out</p><footer>f</footer>", "T\nin"),
    ("<nav>m</nav><div id='cookie-notice'>c</div><main><p>x</p><aside>s</aside></main><div>other</div>", "x"),
    ("<article><p>x</p><form>f</form><div class='share-buttons'>s</div><section id='comments'><article>boo</article></section></article>", "x"),
    ("<article><p>x</p></article><section class=comments><article class='comment'>boo</article></section>", "x"),
    ("<header>site</header><article><header><h1>T</h1></header><p>x</p></article>", "T\nx"),
    ("<script>var a='<p>no</p>';</script><style>p{}</style><p>yes<!-- no --></p><noscript>n</noscript>", "yes"),
    ("<ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><th>e</table>", "a\nb\nc\nd\ne"),
    ("<p>a<br>b</p><div>c<div>d</div>e</div>", "a b\nc\nd\ne"),
    ("1 < 2 <3 </ > x", "1 < 2 <3 x"),
    ("<p title='a>b'>ok</p></div></p>end", "ok\nend"),
    ("<p>cut off <a href=\"x", "cut off"),
    ("<a href=\"x>unclosed quote <p>text", "unclosed quote\ntext"),
    ("plain text", "plain text"),
    ("<div hidden>h</div><div aria-hidden=true>h</div><div role=navigation>h</div>x", "x"),
    ("<div class='article-body adverb'>kept</div><div class='ad top'>gone</div>", "kept"),
    ("<ARTICLE><P>Upper</P></ARTICLE>", "Upper"),
    ("<main><header><h1>T</h1></header><p>x</p></main>", "T\nx"),
    ("<main><article>a</article><p>between</p><article>b<article>c</article></article></main>", "a\nb\nc"),
    ("<div class='related'><article>only</article></div>", "only"),
    ("", ""),
    ("<", "<"),
]


@pytest.mark.parametrize("page, text", CASES)
def test_text_of_a_page(page, text):
    assert H.text_of(H.article(page)) == text


@pytest.mark.parametrize(
    "page",
    ['<a "' * 50_000, "<div>" * 50_000 + "x", "<p>" * 50_000, "<li>" * 50_000, "<b><p>" * 20_000, "</x>" * 50_000,
     "<script>" * 20_000, "<a b='" * 50_000, "<b>" * 20_000 + "</i>" * 20_000, "<!--" * 50_000, "&" * 100_000],
)
def test_odd_pages_take_linear_time(page):
    began = time.perf_counter()
    H.text_of(H.article(page))
    assert time.perf_counter() - began < 10


def site():
    pages = []
    for i in range(30):
        body = f"<div><p>Read our daily <b>letter</b> now</p></div><p>Own text {i}</p><p>The <i>same</i> words</p>" if i % 2 else (
            f"<article><p>Article {i}</p><div><p>Read our daily <b>letter</b> now</p></div></article>")
        pages.append((i, f"http://www.Site.com/{i}", f"<body>{body}</body>"))
    pages += [(100 + i, "http://small.net/x", "<p>Read our daily letter now</p><p>few pages</p>") for i in range(3)]
    pages += [(200 + i, f"http://copies.org/{i}", f"<article><p>{'copied' if i < 8 else f'own {i}'}</p></article>") for i in range(20)]
    pages += [(300, None, None), (301, "x", ""), (None, "http://www.site.com/z", None), pages[5], (302, "no host", "<p>t</p>")]
    return pages


def want(page):
    page_id, url, html = page
    if not html:
        return ""
    if page_id < 100:
        return f"Own text {page_id}\nThe same words" if page_id % 2 else f"Article {page_id}"
    if page_id < 200:
        return "Read our daily letter now\nfew pages"
    if page_id < 300:
        return "copied" if page_id < 208 else f"own {page_id - 200}"
    return "t"


def test_template_goes_and_articles_stay(spark):
    pages = site()
    df = spark.createDataFrame([(*p, "x", 1, "y") for p in pages], PAGES).repartition(4)
    found = H.main_text(df)
    got = sorted(((r.page_id, r.url, r.text) for r in found.collect()), key=str)
    assert got == sorted(((p[0], p[1], want(p)) for p in pages), key=str)


def test_thresholds(spark):
    pages = [(i, "http://h.com/", f"<p>same</p><p>own {i}</p>") for i in range(4)]
    df = spark.createDataFrame([(*p, "", 0, "") for p in pages], PAGES)
    assert {r.text for r in H.main_text(df).collect()} == {f"same\nown {i}" for i in range(4)}
    assert {r.text for r in H.main_text(df, min_pages=4).collect()} == {f"own {i}" for i in range(4)}
    assert {r.text for r in H.main_text(df, min_pages=4, min_share=1.0).collect()} == {f"same\nown {i}" for i in range(4)}



def texts_of(spark, pages, **limits):
    df = spark.createDataFrame([(i, "http://h.com/", html, "", 0, "") for i, html in enumerate(pages)], PAGES)
    return [r.text for r in H.main_text(df, **limits).orderBy("page_id").collect()]


def test_copies_of_an_article_are_no_template(spark):
    copied = "<body><nav><ul><li>m{i}</ul></nav><article><p>copied</p><div>twice</div></article><footer>f{i}</footer></body>"
    pages = [copied.format(i=i) for i in range(20)]
    assert texts_of(spark, pages) == ["copied\ntwice"] * 20
    mixed = pages + [f"<article><p>own {i}</p><p>box</p></article>" for i in range(9)]
    assert texts_of(spark, mixed) == ["copied\ntwice"] * 20 + [f"own {i}" for i in range(9)]


def test_blocks_count_also_where_the_structure_takes_them_out(spark):
    pages = [f"<aside><div><p>box</p></div></aside><p>own {i}</p>" if i < 7 else f"<div><p>box</p></div><p>own {i}</p>" for i in range(10)]
    assert texts_of(spark, pages) == [f"own {i}" for i in range(10)]


def test_many_pages_need_no_half_of_the_host(spark):
    pages = [f"<p>own {i}</p>" + "<div>section</div>" * (i % 3 == 0) + "<h2>History</h2>" * (i % 20 == 1) for i in range(60)]
    want = [f"own {i}" + "\nHistory" * (i % 20 == 1) for i in range(60)]
    assert texts_of(spark, pages, many_pages=20) == want
    assert texts_of(spark, pages, many_pages=21)[0] == "own 0\nsection"
    many = [f"<p>own {i}</p>" + "<div>section</div>" * (i % 3 == 0) for i in range(330)]
    assert texts_of(spark, many) == [f"own {i}" for i in range(330)]


def test_empty_table(spark):
    assert H.main_text(spark.createDataFrame([], PAGES)).collect() == []
