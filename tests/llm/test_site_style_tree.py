import html
import re

from spreadkit.llm import queries
from spreadkit.llm.dom import read
from spreadkit.llm.site_style_tree import extract, main_text, style_trees
from spreadkit.llm.tables import ship_package
from spreadkit.runtime import BROADCAST_CONF

from support import CLASHES, SF

SCHEMA = "page_id bigint, url string, html string"


def text_of(page):
    return main_text(read(page)[0], set())


def pages(spark, rows):
    ship_package(spark)
    return spark.createDataFrame(rows, SCHEMA)


def test_blocks_entities_and_white_space():
    page = (
        "<html><head><title>t</title><style>p{}</style></head><body><script>var x='</p><p>no';</script>"
        "<article><h1>A &amp; B&nbsp;&#x43;</h1><p>one\n  two <b>three</b><br>four<p>five<!-- no --><ul><li>x<li>y</ul>"
        "<table><tr><td>q<td>r</table>tail</article></body></html>"
    )
    assert text_of(page) == "A & B C\none two three four\nfive\nx\ny\nq\nr\ntail"


def test_side_elements_go():
    side = [
        "<nav>menu</nav>", "<header>top</header>", "<footer>end</footer>", "<aside>more</aside>", "<form>name <input></form>",
        '<div class="ad">buy</div>', '<div id="cookie-notice">ok</div>', '<section class="comments"><p>first!</p></section>',
        '<div class="sidebar">s</div>', '<div role="navigation">n</div>', "<script>x</script>", "<noscript>y</noscript>",
    ]
    assert text_of("<body>" + "".join(side) + "<div><p>Body of it.</p></div></body>") == "Body of it."
    assert text_of("<body><article>" + "".join(side) + "<p>In it.</p></article><p>Outside.</p></body>") == "In it."


def test_broken_markup():
    assert text_of("") == "" and text_of("<") == "<"
    assert text_of("plain &lt;text&gt; a<b") == "plain <text> a<b"
    assert text_of("<p>a<div>b</p>c") == "a\nb\nc"
    assert text_of('<p>b</p><div a="' + "x" * 50).startswith("b")
    assert text_of("<div>" * 3000 + "deep") == "deep"
    assert text_of("<article><p>no end") == "no end"
    assert text_of("<script>never closed <p>x") == ""


def article(page):
    """The articles of the test table, read by pattern."""
    body = re.search(r"(?s)<article>(.*?)(</article>|<footer>)", page)[1].replace("<br>", " ")
    blocks = [" ".join(html.unescape(x.replace("<b>", "").replace("</b>", "")).split()) for x in re.split(r"</?(?:p|h1)>", body)]
    return "\n".join(b for b in blocks if b)


def test_query_equals_the_articles(spark):
    rows = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = queries.op5_site_style_tree(spark, SF).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.url, r.text) == (rows[r.page_id].url, article(rows[r.page_id].html)) and r.n_chars == len(r.text)


def site(n, frame="<div class='x1'>Read our weekly letter, it is about everything</div>"):
    """Pages of one host without any telling name: a frame and a story each."""
    return [
        (i, f"http://h.example/{i}", f"<body>{frame}<div class='x2'><p>Story {i} opens so {i * 7}.</p><p>It ends {i}.</p></div></body>")
        for i in range(n)
    ]


def test_low_importance_branches_are_removed(spark):
    got = {r.page_id: r.text for r in extract(pages(spark, site(12))).collect()}
    assert got == {i: f"Story {i} opens so {i * 7}.\nIt ends {i}." for i in range(12)}
    # two pages are no evidence
    got = extract(pages(spark, site(2))).orderBy("page_id").collect()
    assert got[0].text.startswith("Read our weekly letter")


def test_importance_by_brute_force(spark):
    import math

    df = pages(spark, site(8)).selectExpr("'h' as host", "html")
    got = sorted(r.importance for r in style_trees(df).collect())
    one = 0.9 * (1 - math.log(8) / math.log(8)) + 0.1 * 0
    assert [round(x, 9) for x in got] == sorted(round(x, 9) for x in [one, 0.9, 0.9])  # x1, x2, p; the body is no branch


def test_copies_of_an_article_stay(spark):
    page = "<body><div class='x2'><p>The same story on every page.</p></div><i>{}</i></body>"
    rows = [(i, "http://h.example/a", page.format("" if i % 2 else "v")) for i in range(40)]
    assert all("The same story" in r.text for r in extract(pages(spark, rows)).collect())


def test_salted_join_gives_the_same(spark):
    df = pages(spark, site(30))
    want = sorted(map(tuple, extract(df).collect()))
    spark.conf.set(BROADCAST_CONF, "1")
    try:
        assert sorted(map(tuple, extract(df).collect())) == want
    finally:
        spark.conf.unset(BROADCAST_CONF)


def test_nulls_repeats_clashes_and_empty(spark):
    rows = [(1, None, "<p>a"), (1, "not a url", "<p>b"), (None, "http://x/", None), (2, "http://U:p@Host:80/q", ""), (1, None, "<p>a")]
    df = pages(spark, rows)
    for c in [*CLASHES, "host", "low", "text", "salt"]:
        df = df.selectExpr("*", f"1 as `{c}`")
    got = sorted((r.page_id or 0, r.text, r.n_chars) for r in extract(df).collect())
    assert got == [(0, "", 0), (1, "a", 1), (1, "a", 1), (1, "b", 1), (2, "", 0)]
    assert extract(pages(spark, [])).collect() == []


def test_names_of_a_whole_page_are_no_side():
    story = "<article><h2 id='related-work'>Work</h2><h2 class='search'>Found</h2><p>Body of it.</p></article>"
    for page in [
        f"<body class='has-sidebar'>{story}</body>", f"<body class='search'>{story}", f"<div class='content-with-sidebar'>{story}</div>",
        f"<body class='comments-open'><div class='widget'><div id='banner'>{story}</div></div></body>",
        f"<html><head><title>t</title><meta charset='utf-8'><div>{story}</div></html>",
        f"{story}<div class='comments'><article>First!</article></div>",
    ]:
        assert text_of(page) == "Work\nFound\nBody of it.", page
    assert text_of("<head><title>t</title>Plain text of it") == "Plain text of it"
    assert text_of("<div class='related'><article>Only one.</article></div>") == "Only one."


def test_raw_elements_end_where_they_end():
    page = "<body>" + "<p>\u0130stanbul</p>" * 20 + "<SCRIPT>var x='<p>';</Script><article><p>Haber.</p></article>"
    assert text_of(page) == "Haber."


def test_teasers_do_not_replace_the_text(spark):
    cards = "<div class='x3'><article>Card one.</article><article>Card two.</article></div>"
    rows = [(i, f"http://h.example/{i}", f"<body><div id='content'><p>Story {i} is told here at length {i * 7}.</p></div>{cards}") for i in range(12)]
    assert all(r.text.startswith(f"Story {r.page_id} is") for r in extract(pages(spark, rows)).collect())
    one = [(i, u, h.replace("<article>Card two.</article>", "")) for i, u, h in rows]
    assert all(r.text.startswith(f"Story {r.page_id} is") for r in extract(pages(spark, one)).collect())


def test_a_long_frame_does_not_come_back(spark):
    notice = "<div class='x1'>" + "Read this notice of the house before you go on. " * 12 + "</div>"
    got = {r.page_id: r.text for r in extract(pages(spark, site(12, notice))).collect()}
    assert got == {i: f"Story {i} opens so {i * 7}.\nIt ends {i}." for i in range(12)}


def test_copied_articles_are_put_back(spark):
    def page(i):
        a = i % 3
        return f"<div class='x1'>Menu of it</div><div class='x2'><h3>Title {a}</h3><p>{f'Copied story {a}. ' * 20}</p></div><i>v{i}</i>"

    got = {r.page_id: r.text for r in extract(pages(spark, [(i, "http://h.example/", page(i)) for i in range(300)])).collect()}
    assert all(f"Title {i % 3}\nCopied story {i % 3}." in t and "Menu" not in t for i, t in got.items())


STORY = "<article><h1>Title</h1><p>Body of it, told at some length.</p></article>"
WANT = "Title\nBody of it, told at some length."


def test_side_elements_around_the_article_do_not_empty_the_page():
    for page in [
        f"<form id='aspnetForm'><div>{STORY}</div></form>", f"<fieldset><div>{STORY}</div></fieldset>", f"<object>{STORY}</object>",
        f"<header><div>Site</div>{STORY}", f"<body><header>Site<nav>Menu</nav><main>{STORY}</main>", f"<form><header>Top</header>{STORY}<footer>End",
        f"<aside>{STORY}</aside>", f"<form class='search'><dialog>{STORY}</dialog></form>",
    ]:
        assert text_of(page) == WANT, page
    # beside an article of the page's own they stay what they are
    for side in ["aside", "footer", "nav", "form"]:
        assert text_of(f"<main>{STORY}</main><{side}><article>Card.</article></{side}>") == WANT


def test_pages_in_forms(spark):
    rows = [(i, f"http://h.example/{i}", f"<form><nav>Menu</nav><div><article><p>Story {i} of many.</p></article></div></form>") for i in range(8)]
    assert {r.page_id: r.text for r in extract(pages(spark, rows)).collect()} == {i: f"Story {i} of many." for i in range(8)}


def test_headings_in_the_header_of_an_article_stay():
    page = "<article><header><h1>A <b>title</b></h1><p>By us</p><nav><h2>Menu</h2></nav></header><p>Body.</p></article>"
    assert text_of(page) == "A title\nBody."
    assert text_of("<header><h1>Site</h1></header><article><p>Body.</p></article>") == "Body."


def test_comments_and_unclosed_markup():
    assert text_of("<!--><p>One</p><!---><p>Two</p><!-- no --><p>Three") == "One\nTwo\nThree"
    assert text_of("<p>One</p><!-- never closed") == "One" == text_of("<p>One</p><!-- never <b>closed</b> at all")
    assert text_of("<p>One</p>two <b") == "One\ntwo <b"


def test_low_branches_far_up_are_removed(spark):
    deep = "<div class='f'>" + "<div>" * 20 + "Frame of the house" + "</div>" * 20 + "<p>no {}</p></div>"
    rows = [(i, f"http://h.example/{i}", f"<body>{deep.format('x' if i % 2 else 'x')}<div><p>Story {i} itself.</p></div>") for i in range(8)]
    assert {r.page_id: r.text for r in extract(pages(spark, rows)).collect()} == {i: f"Story {i} itself." for i in range(8)}


def test_time_is_linear_on_broken_markup():
    import time

    for make in (
        lambda n: "<b>" * n + "</i>" * n, lambda n: "<a " * n, lambda n: "<a \"" * n, lambda n: "<p><div>" + "<b><blockquote>" * n,
        lambda n: "<li>" * n, lambda n: "<p>" + "<b>" * n + "</p>" * n, lambda n: "<!" * n, lambda n: "<a " * n + ">" + "<a " * n,
    ):
        took = []
        for n in (4000, 32_000):
            page, start = make(n), time.process_time()
            read(page)
            took.append(time.process_time() - start)
        assert took[1] < 24 * max(took[0], 0.02), (make(2), took)
