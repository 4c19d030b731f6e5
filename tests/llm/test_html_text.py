from __future__ import annotations

import pytest

from barhouse.llm import html_text
from tests.llm import small


def text_of(page):
    return "\n".join(t for t, _ in html_text.blocks(page))


@pytest.mark.parametrize(
    "page, text",
    [
        ("<html><head><title>T</title><style>p{}</style></head><body><nav><a href=x>Menu</a></nav>"
         "<article><h1>Head &amp; tail</h1><p>One\n two&nbsp;three<br>four<p>Five <b>six</article><footer>F</footer>",
         "Head & tail\nOne two three four\nFive six"),
        ("<body><div class='cookie-notice'>Cookies</div><main><header><h1>A</h1></header><p>B</p>"
         "<section id=comments><article class=comment>C</article></section><form>D<input></form></main>", "A\nB"),
        ("<p>a<script>var t='</p>';</script>b</p><!-- c --><p hidden>d</p><p>e &lt;f&gt; &#233;</p>", "ab\ne <f> é"),
        ("<div class=sidebar>x</div><div>y<ul><li>z<li>w</ul>v</div>", "y\nz\nw\nv"),
        ("<ul><li><a href=1>Home</a><li><a href=2>About</a></ul><p>Text with <a href=3>a link</a>.</p>", "Text with a link."),
        ("<p>cut off <a href='x", "cut off"),
        ("a < b <3 & c</p>", "a < b <3 & c"),
        ("<article><h2>x</h2><div class='ad'>ad</div><div class='shareBar'>s</div><div class='heading'>h</div></article>", "x\nh"),
        ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n2\n3"),
        ("<p>one</p><aside>two<p>three</aside><P CLASS=Promo>four</P>five", "one\nfive"),
        ("<p title='a > b'>q</p><p x=\"y'z\">r</p>", "q\nr"),
        ("<pre>a\n  b</pre>", "a b"),
        ("", ""), ("   ", ""), ("<", "<"), ("<article></article>", ""),
    ],
)
def test_blocks(page, text):
    assert text_of(page) == text


BODY = "A long paragraph of the page, with more than one sentence. It goes on and on."


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<div><p>{BODY}</p><p>{BODY}</p></div><article><h3>Teaser</h3></article>", f"{BODY}\n{BODY}\nTeaser"),
        (f"<main><p>Short.</p></main><div><p>{BODY}</p></div>", f"Short.\n{BODY}"),
        (f"<article class='post category-social'><p>{BODY}</p></article><p>x</p>", BODY),
        (f"<article class='hentry tag-menus'><p>{BODY}</p></article>", BODY),
        (f"<article class=social><p>{BODY}</p></article>", BODY),
        (f"<div class='content has-sidebar'><p>{BODY}</p></div><div class=sidebar>s</div>", BODY),
        (f"<div class='content-widget'><p>{BODY}</p></div><main>m</main>", f"{BODY}\nm"),
        (f"<div class='social'><p>{BODY}</p></div><div class='site-nav'>n</div>", BODY),
        (f"<form id=aspnetForm><div><p>{BODY}</p></div><div class=nav>n</div></form>", BODY),
        (f"<div class=overlay><main><p>m</p></main></div><div><p>{BODY}</p></div>", f"m\n{BODY}"),
        (f"<div><p>{BODY}</p></div><ul><li><a href=1>One</a></ul><article><a href=2>Two</a></article>", f"{BODY}\nTwo"),
    ],
)
def test_main_text_is_kept(page, text):
    assert text_of(page) == text


def test_deep_and_long_pages():
    assert text_of("<div>" * 20_000 + "deep" + "</div>" * 20_000) == "deep"
    assert text_of("<p>" + "word " * 100_000) == " ".join(["word"] * 100_000)


def pages(spark, data):
    return spark.createDataFrame(data, "page_id long, url string, html string")


def site(n, host, common):
    page = "<body><div>{0}</div><div><p>Text {1} alpha.</p><p>More {1} beta.</p></div><div><span>Call us: 555</span></div></body>"
    return [(i, f"http://{host}/{i}", page.format(common, i)) for i in range(n)]


def test_templates_of_a_site_go(spark):
    data = site(12, "a.example", "All our products") + [(100 + i, u, h) for i, u, h in site(3, "b.example", "Few pages")]
    data += [(200, None, None), (201, "http://a.example/x", ""), (202, "bad url", "<p>x</p>"), (202, "bad url", "<p>x</p>"), (None, "http://c.example", "<p>é\U0001f600</p>")]
    found = small.rows(html_text.extract(small.crowded(pages(spark, data))))
    want = [(i, f"http://a.example/{i}", f"Text {i} alpha.\nMore {i} beta.") for i in range(12)]
    want += [(100 + i, f"http://b.example/{i}", f"Few pages\nText {i} alpha.\nMore {i} beta.\nCall us: 555") for i in range(3)]
    want += [(200, None, ""), (201, "http://a.example/x", ""), (202, "bad url", "x"), (202, "bad url", "x"), (None, "http://c.example", "é\U0001f600")]
    assert found == sorted(want, key=repr)


def test_copies_of_a_page_are_no_template(spark):
    copy = "<article><p>The same article on many addresses.</p></article>"
    data = [(i, f"http://a.example/{i}", f"<nav>{i}</nav>{copy}<div>{i}</div>") for i in range(30)]
    data += [(100 + i, f"http://a.example/o{i}", f"<article><p>Own {i}.</p></article>") for i in range(6)]
    found = {r.page_id: r.text for r in html_text.extract(pages(spark, data)).collect()}
    assert all(found[i] == "The same article on many addresses." for i in range(30))
    assert all(found[100 + i] == f"Own {i}." for i in range(6))


def test_templates_equal_a_count_in_memory(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    seen: dict = {}
    for r in df.collect():
        found = html_text.blocks(r.html or "")
        held = seen.setdefault(html_text.host_of(r.url), {})
        held.setdefault("\n".join(t for t, _ in found), set()).update(h for _, p in found for h in p)
    want = {}
    for host, contents in seen.items():
        counts: dict = {}
        for subtrees in contents.values():
            for h in subtrees:
                counts[h] = counts.get(h, 0) + 1
        often = {h for h, n in counts.items() if n >= 3 and n >= 0.05 * len(contents)}
        if often:
            want[host] = often
    read = df.select("page_id", "url", "html").mapInArrow(html_text._read, html_text._PAGE_SQL)
    got = {r.host: set(r.templates) for r in html_text.site_templates(read, 3, 0.05).collect()}
    assert got == want and want


def varied(n, host, piece):
    """Pages of one host, each with a paragraph of its own and what ``piece`` gives for it."""
    return [(i, f"http://{host}/{i}", f"<body>{piece(i)}<div><p>Page {i} alone.</p></div></body>") for i in range(n)]


@pytest.mark.parametrize(
    "piece",
    [
        lambda i: f"<div>Notice {i % 3}</div>",  # three notices in turn
        lambda i: "<div><p>Of this section only</p></div>" if i % 5 == 0 else "",
        lambda i: "<h3>Call us: 555</h3>" if i < 20 else "",
        lambda i: "<span>Call us: 555</span>" if i % 2 else "",  # no block of its own
        lambda i: "<div><p>Advert</p></div>" if i < 9 else "<aside><div><p>Advert</p></div></aside>" if i < 30 else "",  # marked on most pages
    ],
)
def test_templates_of_a_part_of_a_site_go(spark, piece):
    found = {r.page_id: r.text for r in html_text.extract(pages(spark, varied(60, "a.example", piece))).collect()}
    assert found == {i: f"Page {i} alone." for i in range(60)}


def test_recurring_sentences_stay(spark):
    """A sentence on 12 % of a host's pages, a word in a sentence on all, a sentence on 5 pages of 24."""
    often = lambda i: f"<article><p>A common sentence.</p><p>It is <em>not</em> {i}.</p></article>" if i % 8 == 1 else f"<p>It is <em>not</em> {i}.</p>"
    data = varied(100, "a.example", often) + [(1000 + i, u, h) for i, u, h in varied(24, "b.example", lambda i: "<p>Five times.</p>" if i < 5 else "")]
    found = {r.page_id: r.text for r in html_text.extract(pages(spark, data)).collect()}
    for i in range(100):
        assert found[i].split("\n") == ["A common sentence."] * (i % 8 == 1) + [f"It is not {i}.", f"Page {i} alone."]
    assert [found[1000 + i] for i in range(24)] == ["Five times.\n" * (i < 5) + f"Page {i} alone." for i in range(24)]


def test_all_subtrees_are_counted(spark):
    page = "<body><nav><ul><li>Menu</li></ul></nav><div><b>x</b> y</div><footer>f</footer></body>"
    read = pages(spark, [(1, "http://a.example", page)]).mapInArrow(html_text._read, html_text._PAGE_SQL).first()
    assert len(read.subtrees) == 2 and len(read.marked) == 5  # body, div; nav, ul, li, b, footer


def test_empty_table(spark):
    assert html_text.extract(pages(spark, [])).collect() == []


@pytest.mark.parametrize(
    "page, n",
    [
        ("<b>" * 60_000 + "</i>x" * 60_000, 1),
        ("<b>" * 60_000 + "</p>x" * 60_000, 60_000),
        ("<div>x" * 60_000, 60_000),
        ("<b>" * 60_000 + "x</b>" * 60_000, 1),
        ("<li><ul>" + "<b>" * 60_000 + "<li>" * 60_000, 0),
    ],
)
def test_unbalanced_and_nested_pages_take_linear_time(page, n):
    import time

    began = time.process_time()
    root = html_text.parse(page)
    nodes, found = html_text._blocks(root, html_text._hashes(root))
    assert len(found) == n and len(nodes) <= 130_000
    assert time.process_time() - began < 30  # quadratic steps would take many minutes
