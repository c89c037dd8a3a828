import html
import re

import pytest

from keytally.llm.html_extract import html_extract, main_text

LONG = "A paragraph of the article, with some commas, and with enough words to count as text of it."
PAGE = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{x}}</style><script>var a = "<p>no</p>";</script></head><body>
<header><h1>Site name</h1><nav><a href=/>Home</a></nav></header><div class="cookie-notice"><p>{LONG} cookies</p></div>
<div id="wrap"><div class="sidebar"><p>{LONG} sidebar</p></div>
<div class="post-content"><h1>Title &amp; more</h1><p>{LONG} <b>one</b><p>Second&nbsp;&lt;one&gt;   with\n white\tspace.<br>After break</p>
<ul><li>item one</li><li>item two</li></ul><div class="ad">Buy, buy, buy now, it is cheap, very cheap indeed</div>
<blockquote>Quoted, at some length, by the author.</blockquote><form><p>{LONG} form</p><input></form><table><tr><td>cell</td></tr></table></div>
<div id="comments"><h2>Comments</h2><p>{LONG} reader</p></div></div><aside>{LONG}</aside><footer><p>&copy; {LONG}</p></footer></body></html>"""


def test_whole_page():
    assert main_text(PAGE).split("\n\n") == [
        "Title & more", f"{LONG} one", "Second <one> with white space. After break", "item one", "item two",
        "Quoted, at some length, by the author.", "cell"]


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("   ", ""), ("just text", "just text"), ("<p>a", "a"), ("<nav><a href=x>menu</a></nav>", ""),
    ("<article><h1>H</h1></article>", "H"), ("<p>x &am y &amp z &#x41;&#66;</p>", "x &am y & z AB"), ("<![foo[ <p>q</p>", "q"),
    ("<body><article><p>one</p></article><article><p>two</p></article></body>", None),
    ("<article><p>a<p>b<div>c</div>d</article>", "a\n\nb\n\nc\n\nd"), ("<script>x", ""), ("<article>a<aside>b", "a"),
    ("<article><header><h1>T</h1></header><p>x</p></article>", "T\n\nx"),
    ("<main><p>Text before <span class='share-buttons'>share me</span> and after.</p></main>", "Text before and after."),
    ("<div role=banner>b</div><div><p>kept text</p></div>", "kept text"), ("<p>a &lt;b&gt; c</p>", "a <b> c"),
    ("<article><p>x</p><p hidden>y</p><p style='display:none'>z</p></article>", "x"),
    ("<article><svg><text>no</text></svg><p>x</p></article>", "x"), ("<!-- <p>no</p> --><p>yes</p>", "yes")])
def test_small_pages(page, text):
    got = main_text(page)
    assert got == text if text is not None else got in ("one", "one\n\ntwo")


def test_related_links_inside_the_article_go():
    links = "".join(f"<li><a href='/{i}'>Another story number {i}</a></li>" for i in range(6))
    assert main_text(f"<article><p>{LONG}</p><ul>{links}</ul><p>{LONG} end</p></article>") == f"{LONG}\n\n{LONG} end"


def test_deep_and_long_pages():
    deep = "<div>" * 5000 + f"<p>{LONG}</p>"
    assert main_text(deep) == LONG
    assert main_text("<article>" + f"<p>{LONG}</p>" * 3000 + "</article>").count("\n\n") == 2999


def test_rows(spark):
    rows = [(1, "u", PAGE), (None, None, "<p>x</p>"), (2, "v", None), (2, "v", None), (3, None, "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'q' as text", "1 as n_chars").repartition(3)
    got = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in html_extract(df).collect()), key=str)
    assert got == sorted(((i, u, main_text(h), len(main_text(h))) for i, u, h in rows), key=str)
    assert html_extract(df.limit(0)).collect() == []


def test_given_pages_give_their_articles(spark):
    """In the given pages the article is what stands in ``<article>``."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    source = {r.page_id: r.html for r in pages.collect()}
    for r in html_extract(pages).collect():
        inner = source[r.page_id].split("<article>")[1].split("</article>")[0]
        blocks = [" ".join(html.unescape(re.sub("<b>|<br>", "", x)).split()) for x in re.split("</?p>|</?h1>", inner)]
        assert r.text == "\n\n".join(b for b in blocks if b)


BODY = f"<article><h1>Title</h1><p>{LONG}</p><p>{LONG} end</p></article>"


@pytest.mark.parametrize("name", ["content-with-sidebar", "site has-sidebar", "layout no-sidebar", "header-fixed",
                                  "main-content nav-open", "post comments-open"])
@pytest.mark.parametrize("inner", [BODY, f"<div class='story'>{BODY[9:-10]}</div>", BODY[9:-10]])
def test_wrappers_with_unlikely_names_stay(name, inner):
    page = f"<body><div class='{name}'>{inner}<div class='sidebar'><p>{LONG[:60]}</p></div></div><div class='ad'>Buy now</div></body>"
    assert main_text(page) == f"Title\n\n{LONG}\n\n{LONG} end"


def test_forms_around_the_page_are_transparent():
    form = "<form class='search'><p>Search this site</p><input></form>"
    assert main_text(f"<body>{form}<form action=/><nav>menu</nav>{BODY}</form></body>") == f"Title\n\n{LONG}\n\n{LONG} end"
    assert main_text(f"<article><p>{LONG}</p><form><p>Your address, please</p></form></article>") == LONG


def test_second_try_when_nothing_is_left():
    assert main_text("<div class='widget'>Only text of the page</div>") == "Only text of the page"
    assert main_text("<div class='widget'>Only text</div><div class='ad' hidden>Buy</div>") == "Only text"


def test_titles_in_entry_headers_stay():
    inner = f"<div class='entry-header'><h1>Title</h1></div><div class='entry-content'><p>{LONG}</p></div>"
    assert main_text(f"<article>{inner}</article>") == f"Title\n\n{LONG}"
    assert main_text(f"<div class='post'>{inner}</div>") == f"Title\n\n{LONG}"


def test_articles_are_kept_whole():
    """Short sections, headings, lists, tables and bare text beside the best container of an article."""
    p = "Some words, that make, a paragraph, of text, which is long enough. " * 4
    p = p.strip()
    page = (f"<body><article><h1>T</h1>bare text<section><h2>A</h2>{f'<p>{p}</p>' * 10}</section><section><h2>B</h2><p>{p}</p></section>"
            "<h3>Notes</h3><ul><li>one</li><li>two</li></ul><table><tr><td>cell</td></tr></table>"
            "<ul>" + "".join(f"<li><a href=/{i}>A long title of the work that is referred to, number {i}</a>, 19{i}</li>" for i in range(10, 14)) + "</ul>"
            f"<dl>{''.join(f'<dt><a href=#{i}>term {i}</a></dt>' for i in range(3))}</dl></article><div><p>{LONG[:40]}</p></div></body>")
    want = ["T", "bare text", "A", *[p] * 10, "B", p, "Notes", "one", "two", "cell",
            *[f"A long title of the work that is referred to, number {i}, 19{i}" for i in range(10, 14)], "term 0", "term 1", "term 2"]
    assert main_text(page).split("\n\n") == want
    assert main_text(page.replace("article>", "main>")).split("\n\n") == want


FAR = f"<p>{LONG}</p>" * 3


@pytest.mark.parametrize("part,text", [
    ("<section id='social'><h2>Social life</h2><p>It was lively, then as now.</p></section>", "Social life\n\nIt was lively, then as now."),
    ("<div class='notice-board-history'><p>The board was put up in 1900.</p></div>", "The board was put up in 1900."),
    ("<p class='related'>A related matter.</p>", "A related matter."),
    (f"<section class='sharing-economy'>{FAR}</section>", "\n\n".join([LONG] * 3)),
    ("<h2>Glossary</h2><ul><li><a href=#a>alpha</a></li><li><a href=#b>beta</a></li><li><a href=#c>gamma</a></li></ul>", "Glossary\n\nalpha\n\nbeta\n\ngamma"),
    ("<p>The parts are:</p><ul><li><a href=#a>alpha</a></li><li><a href=#b>beta</a></li><li><a href=#c>gamma</a></li></ul>", "The parts are:\n\nalpha\n\nbeta\n\ngamma"),
    ("<h3>Related stories</h3><ul><li><a href=/a>one</a></li><li><a href=/b>two</a></li><li><a href=/c>three</a></li></ul>", "Related stories"),
    ("<div class='related'><a href=/a>One more story</a> <a href=/b>Another</a></div>", ""),
    ("<div class='ad-box'>Buy now</div>", ""), ("<div class='share-bar'><a href=x>Post</a></div>", ""),
    (f"<section class='responses'><h2>Responses</h2><article><p>{LONG}</p></article><article>{FAR}</article></section>", ""),
    (f"<section id='comments'>{FAR * 5}</section>", ""), (f"<ol class='comment-list'><li><article class='comment-body'>{FAR}</article></li></ol>", ""),
    (f"<article class='reply'>{FAR}</article>", ""),
])
def test_names_inside_an_article(part, text):
    """Only a strong sign, or a name with mostly links, takes text out of an article; reader comments always go."""
    got = main_text(f"<body><article><h1>Title</h1><p>{LONG} one</p>{part}<p>{LONG} end</p></article></body>")
    assert got == "\n\n".join(x for x in ("Title", f"{LONG} one", text, f"{LONG} end") if x)


def test_comments_behind_the_article_go():
    comments = f"<div id='comments'>{''.join(f'<article class=comment>{FAR}</article>' for _ in range(4))}</div>"
    assert main_text(f"<body>{BODY}{comments}</body>") == f"Title\n\n{LONG}\n\n{LONG} end"
    assert main_text(f"<body class='comments'>{BODY}</body>") == f"Title\n\n{LONG}\n\n{LONG} end"
    assert main_text(f"<div class='comments'>{BODY}</div>") == f"Title\n\n{LONG}\n\n{LONG} end"


@pytest.mark.parametrize("page,text", [("<p>a</p><!-- b <p>c</p>", "a"), ("<p>a</p><!--><p>b</p>", "a\n\nb"), ("<p>a</p> b <i", "a\n\nb"),
                                       ("<p>a</p> 1 < 2", "a\n\n1 < 2"), ("<script>'<!--'</script><p>a</p>", "a")])
def test_ends_of_pages(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("piece", ["<!--", "<!-- >", "<form>", "</x>", "</div>", "</p>", "<b>", "<div>a", "<![", "<?", "</a ", "<li>", "<a ", "<p>x</i>"])
def test_time_grows_with_the_page(piece):
    import time
    page = f"<article><p>{LONG}</p>" + piece * (200_000 // len(piece))
    began = time.process_time()
    main_text(page)
    assert time.process_time() - began < 15
