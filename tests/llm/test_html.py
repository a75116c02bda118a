import html
import re
import time

import pytest

from lakeops.llm.html_extract import extract_pages, main_text

PROSE = "Some words, then more words, and a full sentence of an article that goes on for a while."


def test_given_pages_equal_their_articles(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    source = {r.page_id: r.html for r in pages.collect()}
    for r in extract_pages(pages).collect():
        article = re.search(r"<article>(.*?)</article>", source[r.page_id], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]+>", "", b)).split()) for b in re.split("</?p>|</?h1>", article.replace("<br>", " "))]
        want = "\n".join(b for b in blocks if b)
        assert (r.text, r.n_chars) == (want, len(want))


def test_everything_around_the_article_is_left_out():
    around = [
        "<nav><p>{}</p></nav>", "<header><h1>Site</h1>{}</header>", "<footer>{}</footer>", "<aside><p>{}</p></aside>",
        "<form><p>{}</p></form>", "<script>{}</script>", "<style>{}</style>", "<div class='cookie-notice'><p>{}</p></div>",
        "<div id=comments><p>{}</p></div>", "<section class='comment-list'><article class=comment><p>{}</p></article></section>",
        "<div class='sidebar'><p>{}</p></div>", "<div class='ad banner'>{}</div>", "<div role=navigation>{}</div>",
        "<div hidden>{}</div>", "<p style='display:none'>{}</p>", "<!-- {} -->", "<noscript>{}</noscript>", "<select><option>{}</select>",
    ]
    for body in ("<article><h1>Title</h1><p>{0}</p><p>{0} &amp; so</p></article>", "<div class=content><h1>Title</h1><p>{0}</p><p>{0} &amp; so</p></div>"):
        want = f"Title\n{PROSE}\n{PROSE} & so"
        for junk in around:
            noise = junk.format("Noise, noise, and, still, more noise of the page, you see. " * 3)
            page = f"<html><body>{noise}{body.format(PROSE)}{noise}</body></html>"
            assert main_text(page) == want, junk
        inside = body.replace("<p>{0}</p>", "<div class='ad'>Buy</div><p>{0}</p><ul><li><a href=x>Menu</a><li><a href=y>More</a></ul>", 1)
        assert main_text(f"<body>{inside.format(PROSE)}</body>") == want


def test_markup_is_read_as_a_browser_would():
    assert main_text("<p>a<p>b<ul><li>x<li>y</ul><b>bold</b> t") == "a\nb\nx\ny\nbold t"
    assert main_text("<article><p>x&nbsp;&nbsp;y&#8217;s &bogus; 1 &lt 2\n\t z<br>q</p></article>") == "x y’s &bogus; 1 < 2 z q"
    assert main_text("no markup\n at all") == "no markup at all"
    assert main_text("<table><tr><td>one<td>two<tr><td>three</table>") == "one\ntwo\nthree"
    assert main_text("<p title='a>b'>t</p></div></span><p>u") == "t\nu"


def test_siblings_of_the_best_container_are_kept():
    part = "<div><p>{0}</p><p>{0}</p></div>".format(PROSE)
    links = "<div><a href=1>" + "link text " * 20 + "</a></div>"
    assert main_text(f"<body><div>{part}{links}{part}</div></body>") == "\n".join([PROSE] * 4)


def test_odd_pages(spark):
    odd = [None, "", "<", "<<<>>>", "<script>", "<div>" * 20_000 + "deep" + "</div>" * 20_000, "&#0;&#x110000;", "<p>" + "long " * 100_000, "</p></p>"]
    df = spark.createDataFrame([(i, "u", h, "t", 1) for i, h in enumerate(odd)], "page_id long, url string, html string, text string, n_chars long")
    out = {r.page_id: r for r in extract_pages(df).collect()}
    assert out[0].text == out[1].text == out[4].text == "" and out[5].text == "deep"
    assert out[7].n_chars == 5 * 100_000 - 1
    assert extract_pages(df.limit(0)).collect() == []


def test_names_do_not_drop_what_holds_the_article():
    body = f"<p>{PROSE}</p><p>{PROSE}</p>"
    want, noise = f"{PROSE}\n{PROSE}", "<div class='sidebar'><p>" + "Noise, noise and more noise of the page. " * 3 + "</p></div>"
    for page in (
        f"<div class='content-sidebar-wrap'><main>{body}</main>{noise}</div>", f"<div class='right-sidebar'><main>{body}</main></div>",
        f"<div class='right-sidebar'><article>{body}</article>{noise}</div>", f"<div class='story related-topics'>{body}</div>{noise}",
        f"<div class='content-sidebar-wrap'>{body}{noise}</div>", f"<main><div class='right-sidebar'><article>{body}</article></div></main>",
        f"<div class='social'>{body}</div>",  # nothing else is there
        f"<article>{body}</article><div class='related'><article>{body}</article></div>",
        f"<article>{body}<div class='related-posts'><article>{body}</article></div></article>",
    ):
        assert main_text(f"<html><body>{page}</body></html>") == want, page


def test_link_lists_of_an_article_stay():
    sources = ["A long report on the state of rivers", "Minutes of the meeting, second part", "NASA"]
    links = "".join(f"<li><a href=x>{s}</a></li>" for s in sources)
    for listed in (f"<ul>{links}</ul>", f"<ol>{links}</ol>", f"<div>{links}</div>"):
        assert main_text(f"<body><article><p>{PROSE}</p>{listed}</article></body>") == "\n".join([PROSE, *sources])
    assert main_text(f"<body><article><p>{PROSE}</p><ul class=menu>{links}</ul></article></body>") == PROSE


LONG = "A long paragraph of the article, with commas, and with enough words to be read as one. " * 5


@pytest.mark.parametrize("name", ["id='social-history'", "class='notice-board-story'", "class='newsletter-archive-of-letters'"])
def test_a_name_that_says_more_drops_no_article(name):
    body = f"<h1>Title</h1><p>{LONG}</p>"
    want = f"Title\n{LONG.strip()}"
    assert main_text(f"<body><div {name}>{body}</div><p>Impressum kurz.</p></body>").startswith(want)


def test_parts_of_an_article_stay():
    for part in ("<section class='related-work'><p>{0}</p></section>", "<div class='comments-on-method'><p>{0}</p></div>"):
        assert main_text(f"<article><p>{LONG}</p>{part.format(PROSE)}</article>") == f"{LONG.strip()}\n{PROSE}"
    for part in ("<section class='related-articles'><p>{0}</p></section>", "<div id='post-comments-list'><p>{0}</p></div>"):
        assert main_text(f"<article><p>{LONG}</p>{part.format(PROSE)}</article>") == LONG.strip()
    listed = "<ul><li><a href=1>Paper one</a><li><a href=2>Paper two</a></ul>"
    assert main_text(f"<article><p>{LONG}</p>{listed}</article>") == f"{LONG.strip()}\nPaper one\nPaper two"
    formula = "where <math><semantics><mrow><mi>x</mi><mo>=</mo><mn>2</mn></mrow><annotation>x=2</annotation></semantics></math> holds"
    assert main_text(f"<article><p>{LONG}{formula}</p></article>") == f"{LONG}where x=2 holds"
    assert main_text(f"<article><p data-id='ads' data-hidden title=\"id='ads'\">{PROSE}</p></article>") == PROSE


@pytest.mark.parametrize("part", [
    "<a ", "<![CDATA[", "<!", "<?x", "<a '", '<a "<a >', "<title>", "<textarea><svg>", "<a title='", "</", "<b", "<!--", "<ul><li>", "<b><p>",
    "<td><b>", "<a id=", "&", "<p class='x y", "<div class=sidebar>", "<a href=x>y", "<",
])
def test_broken_markup_takes_linear_time(part):
    for tail in ("", ">", "'", "'>", "-->"):
        began = time.perf_counter()
        main_text(part * (500_000 // len(part)) + tail)
        assert time.perf_counter() - began < 10, tail
    blocked = "<li><ul>" + "<b>" * 50_000 + "<li></li>" * 50_000
    assert main_text(blocked) == ""


def test_open_quotes_end_at_the_first_bracket():
    assert main_text("<p title='a>one</p><p>two") == "one\ntwo"
    assert main_text('<p>x</p><a "<a >y<p>z \'') in ("x\ny\nz '", "x y\nz '")
    assert main_text("a < b and <i>c</i> <d") == "a < b and c <d"
