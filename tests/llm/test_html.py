"""Main-text extraction: markup cases and the pages of the small tables."""

import html
import re
import tracemalloc

import pytest

from tallyfold.llm import html_extract, queries
from tallyfold.llm.common import table

from conftest import SF_SMALL

PARAGRAPH = "This is a sentence, and here is another one. It goes on for a while; then it stops."


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("<html></html>", ""), ("no markup", "no markup"),
    ("<article><p>a &amp; b&nbsp;&#233; &lt;x&gt;</p></article>", "a & b é <x>"),
    ("<article><h1>T</h1><p>one<p>two<br>three <b>bo</b>ld</article><footer>f</footer>", "T one two three bold"),
    ("<body><nav><a href=x>menu</a></nav><main><p>text</p><div class='ad box'>buy</div></main></body>", "text"),
    ("<article><p>x</p><!-- <p>no</p> --><script>var a='</p><p>';</script><p>y</p></article>", "x y"),
    ("<article><p>x <i>y</p><ul><li>a<li>b</ul></article><aside>z</aside>", "x y a b"),
    ("<article><p title=it's>x</p><p title = 'a>b' id=\"c>d\">y</p><p it's>z</p></article>", "x y z"),
    ("<article><p>open comment <!-- never closed", "open comment"),
    ("<article><p>5 < 6 and a<b</p></article>", "5 < 6 and a"),
    (f"<header><p>site</p></header><article><header><h1>Title</h1></header><p>{PARAGRAPH}</p></article>",
     f"Title {PARAGRAPH}"),
    (f"<div id=menu><p>m</p></div><div class=content><h2>T</h2><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p></div>"
     f"<div class=comments><p>{PARAGRAPH}</p></div>", f"T {PARAGRAPH} {PARAGRAPH}"),
    (f"<article><p>{PARAGRAPH}</p><form><label>name</label></form><div role=alert>cookies</div></article>", PARAGRAPH),
])
def test_cases(page, text):
    assert html_extract.main_text(page) == text


def test_ratios_separate_a_text_from_links_without_any_names():
    links = "".join(f"<div><a href=/{i}>link {i}</a></div>" for i in range(30))
    page = f"<body><table><tr><td>{links}</td><td><div><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p></div></td></tr></table></body>"
    assert html_extract.main_text(page) == f"{PARAGRAPH} {PARAGRAPH}"


def test_long_and_deep_pages():
    deep = "<div>" * 3000 + f"<p>{PARAGRAPH}</p>"
    assert html_extract.main_text(deep) == PARAGRAPH
    assert html_extract.main_text("<article>" + f"<p>{PARAGRAPH}</p>" * 5000).count("stops.") == 5000


def test_query_equals_the_article_of_each_page(spark):
    found = {r.page_id: r for r in queries.op8_html(spark, SF_SMALL).collect()}
    pages = table(spark, SF_SMALL, "pages").collect()
    assert len(found) == len(pages)
    for page in pages:
        article = re.search(r"<article>(.*?)</article>", page.html, re.S)[1]
        plain = re.sub(r"</?b>", "", re.sub(r"</?(p|br|h1)>", " ", article))
        want = " ".join(html.unescape(plain).split())
        assert (found[page.page_id].url, found[page.page_id].text) == (page.url, want)
        assert found[page.page_id].n_chars == len(want)


def test_frames(spark):
    pages = spark.createDataFrame([(1, None, "t"), (None, "<p>x</p>", "u"), (1, "<p>x</p>", "v"), (1, "<p>x</p>", "v")],
                                  "page_id long, html string, text string")
    got = sorted((str(r.page_id), r.text) for r in html_extract.extract(pages, ["page_id"]).collect())
    assert got == [("1", ""), ("1", "x"), ("1", "x"), ("None", "x")]
    assert html_extract.extract(pages.limit(0), ["page_id"]).collect() == []
    clash = pages.withColumnRenamed("text", "__html")
    assert html_extract.extract(clash, ["page_id", "__html"]).columns == ["page_id", "__html", "text"]
    assert html_extract.extract(clash, ["page_id", "__html"]).count() == 4


STORY = f"<h1>Title</h1><p>{PARAGRAPH} {PARAGRAPH}</p><p>{PARAGRAPH}</p><p>{PARAGRAPH} {PARAGRAPH}</p>"
STORY_TEXT = " ".join(["Title", *[PARAGRAPH] * 5])
CARDS = "".join(f"<article class=card><h3><a href=/{i}>Card {i}</a></h3><p>Teaser {i} of a story.</p></article>"
                for i in range(6))
LINKS = "<div class=x><h2>More</h2><ul>" + "".join(f"<li><a href=/{i}>link {i}</a></li>" for i in range(9)) + "</ul></div>"


@pytest.mark.parametrize("page", [
    f"<body><div class=story>{STORY}</div>{CARDS}</body>",
    f"<body><main>{CARDS}</main><div class=story>{STORY}</div></body>",
    f"<body><main>{LINKS}<article>{STORY}</article>{CARDS}{LINKS}</main></body>",
    f"<body><main><div class=y><p>We close at six.</p></div>{LINKS}<div class=story>{STORY}</div>{LINKS}</main></body>",
    f"<body><main><h1>Title</h1><div class=story>{STORY.replace('<h1>Title</h1>', '')}</div>{LINKS}</main></body>",
])
def test_scores_choose_also_where_there_is_an_article_element(page):
    assert html_extract.main_text(page) == STORY_TEXT


def test_the_article_of_each_page_is_found_without_its_name(spark):
    for page in table(spark, SF_SMALL, "pages").collect():
        renamed = page.html.replace("<article>", "<div>").replace("</article>", "</div>")
        assert html_extract.main_text(renamed) == html_extract.main_text(page.html) != ""


@pytest.mark.parametrize("start,end", [
    ("<div class='content has-sidebar'>", "</div>"), ("<div class=content-sidebar-wrap>", "</div>"),
    ("<article class='post comments-open'>", "</article>"), ("<div class=no-share>", "</div>"),
    ("<article id=search-results-article>", "</article>"), ("<form action=/x method=post>", "</form>"),
    ("<form><main>", "</main></form>"), ("<div class=widget>", "</div>"), ("<div role=search>", "</div>"),
    ("<article class='post search'>", "</article>"),
])
def test_a_boilerplate_word_around_the_article_does_not_lose_it(start, end):
    nav = "<nav><a href=/>home</a></nav><p class=sidebar-note>Short note.</p>"
    page = f"<body>{nav}{start}{STORY}{end}<div class=comments><p>{PARAGRAPH}</p></div><footer>f.</footer></body>"
    assert html_extract.main_text(page) == STORY_TEXT


def test_boilerplate_inside_the_article_still_goes():
    for box in ("<div class='ad box'>", "<div class=ad-box>", "<div id=share-this>", "<aside>"):
        page = f"<article>{STORY}{box}<p>Buy this now.</p></{box[1:].split()[0].rstrip('>')}></article>"
        assert html_extract.main_text(page) == STORY_TEXT, box


LONG = " ".join([PARAGRAPH] * 4)
SHORT = "A paragraph of fifty characters, or about that much."
EIGHT, EIGHT_TEXT = f"<p>{SHORT}</p>" * 8, " ".join([SHORT] * 8)
READERS = f"<p>{LONG}</p><p>{LONG}</p>"


@pytest.mark.parametrize("page,text", [
    # a linked paragraph neither goes nor takes its neighbours with it
    (f"<article><p>Intro line here.</p><p><a href=x>{PARAGRAPH}</a></p><p>Closing line.</p></article>",
     f"Intro line here. {PARAGRAPH} Closing line."),
    (f"<article>{f'<p>{PARAGRAPH}</p>' * 3}<p><a href=x>{LONG}</a></p></article>",
     " ".join([PARAGRAPH] * 3 + [LONG])),
    # a short article wins over a long advert, and over its readers
    (f"<article><p>Yes.</p></article><div class='promo-box'><p>{LONG}</p></div>", "Yes."),
    (f"<article><p>Yes.</p></article><div><p>{LONG}</p></div>", "Yes."),
    (f"<article>{EIGHT}</article><div class='comment-list'>{READERS}</div>", EIGHT_TEXT),
    (f"<article>{EIGHT}<div class='comment-list'>{READERS}</div></article>", EIGHT_TEXT),
    (f"<div class=post>{EIGHT}</div><div class='comment-list'>{READERS}</div>", EIGHT_TEXT),
    (f"<article>{EIGHT}</article><section id=comments><article class=comment>{READERS}</article>"
     f"<article class=comment>{READERS}</article></section>", EIGHT_TEXT),
    # of a list of sources the plain item stays
    (f"<article><p>{PARAGRAPH}</p><ul><li><a href=1>Source one</a></li><li><a href=2>Source two</a></li>"
     "<li>A plain list item, offline.</li></ul></article>", f"{PARAGRAPH} A plain list item, offline."),
    # a page of nothing but an advert still has a text
    (f"<div class=ad><p>{PARAGRAPH}</p></div>", PARAGRAPH),
])
def test_articles_are_not_lost_to_links_adverts_or_comments(page, text):
    assert html_extract.main_text(f"<body>{page}</body>") == text


def test_memory_grows_with_the_elements_and_not_with_their_depth():
    page = "<div class=a><aside>" * 50_000 + f"<p>{PARAGRAPH}</p>" + "</x></aside></div>" * 50_000
    tracemalloc.start()
    try:
        assert html_extract.main_text(page) == PARAGRAPH
        assert tracemalloc.get_traced_memory()[1] < 200 << 20
    finally:
        tracemalloc.stop()


def test_the_scores_decide_on_every_page_and_names_are_not_needed(spark):
    same = total = 0
    for page in table(spark, SF_SMALL, "pages").collect():
        text = html_extract.main_text(page.html)
        found, _ = html_extract.blocks(page.html)
        assert " ".join(block.text for block in found) != text
        bare = re.sub(r"""\s(class|id)=("[^"]*"|'[^']*'|[^\s>]+)""", "", page.html)
        same += html_extract.main_text(bare) == text
        total += 1
    assert same >= 0.99 * total
