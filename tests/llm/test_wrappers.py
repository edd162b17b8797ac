"""Wrapper induction: golden pages, alignment laws, broken markup, time, and the query against a plain reading."""

import html as entities
import re
import time

import pytest

from gigloom.llm import wrappers as W
from gigloom.llm.queries import op9_wrappers
from tests.llm.odd import clashing

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>no";</script></head><body class="nav-open">
<header><h2>Site</h2></header><nav><ul><li><a href="/">Home</a></li><li><a>About</a></li></ul></nav><div class="ad">Buy</div>
<div id="cookie-notice"><p>We use cookies</p></div>
<article><h1>Head &amp; line</h1><p>One<br>two <b>three</b>.<p>Four &lt;5&gt; &#233;&nbsp;x</p><div class="share-buttons">Share</div>
<aside>Side</aside><ul><li>a<li>b</ul><form><input><label>Mail</label></form><p></p><!-- <p>hidden</p> --><table><tr><td>c</td><td>d</td></table>
<section class="comments"><p>First!</p></section></article><footer>&copy; me</footer></body></html>"""


def text_of(*pages):
    wrapper = W.expression(pages[0])
    for p in pages[1:]:
        wrapper = W.aligned(wrapper, W.expression(p))
    return [W.main_text(p, W.rule(wrapper, len(pages))) for p in pages]


def test_golden_page():
    assert text_of(PAGE) == ["Head & line\nOne two three.\nFour <5> é x\na\nb\nc\nd"]


def test_wrapper_is_a_regular_expression_over_tags():
    a = W.expression("<body><nav><a>1</a></nav><article><h1>x</h1><p>a</p><p>b</p></article></body>")
    b = W.expression("<body><article><h1>y</h1><p>c</p><ul><li>1<li>2</ul></article><footer>same</footer></body>")
    c = W.expression("<body><article><h1>z</h1></article><footer>same</footer></body>")
    w = W.aligned(W.aligned(a, b), c)
    assert W.written(w) == ("<body>(<nav>\"1\"</nav>)?<article><h1>#</h1>(<p>#</p>)*(<ul>(<li>#</li>)+</ul>)?</article>"
                            "(<footer>\"same\"</footer>)?</body>")
    assert W.aligned(w, b) == W.aligned(w, b) and W.written(W.aligned(w, a)) == W.written(w)


def test_runs_of_kinds_are_groups():
    w = W.expression("<dl><dt>a</dt><dd>1</dd><dt>b</dt><dd>2</dd><dt>c</dt><dd>3</dd></dl>")
    assert W.written(w) == "<dl>(<dt>#</dt><dd>#</dd>)+</dl>"


def test_pages_without_an_article_use_slots():
    pages = [f"<body><div class='top'>Brand</div><div class='body'><p>Text {i} of this page, quite long and new {i * 7}</p>"
             f"<h3>Same on all</h3></div><div class='menu'>x</div></body>" for i in range(5)]
    assert text_of(*pages) == [f"Text {i} of this page, quite long and new {i * 7}" for i in range(5)]


def test_text_that_one_page_alone_has_stays(spark):
    """A quote, a heading and the paragraph behind it on one page of six, and three copies of one page on a host."""
    bodies = [f"<p>Text {i} of this page, quite long and new {i * 7}</p>" for i in range(6)]
    bodies[2] += "<blockquote>Only quote</blockquote><h3>Only head</h3><p>Behind it</p>"
    rows = [(i, "http://a/", f"<body><div class='top'>Brand</div><div class='body'>{b}</div></body>") for i, b in enumerate(bodies)]
    rows += [(10 + i, "http://b/", "<body><div><p>One page</p><p>in copies</p></div></body>") for i in range(3)]
    got = {r.page_id: r.text for r in W.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    own = [f"Text {i} of this page, quite long and new {i * 7}" for i in range(6)]
    assert got == {**{i: t + ("\nOnly quote\nOnly head\nBehind it" if i == 2 else "") for i, t in enumerate(own)},
                   **{10 + i: "One page\nin copies" for i in range(3)}}


def test_main_element_and_mixed_hosts():
    a, b = "<body><main><p>Main</p></main><p>Other</p></body>", "<body><article><p>Art</p></article><p>Other</p></body>"
    assert text_of(a, b) == ["Main", "Art"]


@pytest.mark.parametrize("page", ["", "<", "<![foo[bar]]>a", "a<![1", "<p", "<a href=\"x", "</p></div>", "<!--", "<script>x", "<article><p>x",
                                  "<article>a</b></i>b", "&#xD800;&#99999999;&bogus;", "<article><p class=x y='z\">q</p>", "\0<article>\0"])
def test_broken_markup_never_fails(page):
    assert isinstance(text_of(page)[0], str)


def test_layout_names_are_not_furniture():
    page = ("<body class='nav-open'><div class='layout has-sidebar no-comments'><article class='post share-on'><p>x</p></article>"
            "<div class='left-sidebar'>s</div></div><article class='comment'><p>c</p></article><article class='teaser'><p>t</p></article></body>")
    assert text_of(page) == ["x"]


def test_names_made_of_words_of_the_text_are_not_furniture():
    page = ("<article><h2 id='related-work'>Related work</h2><p id='notice-period'>A <span class='social'>social</span> word</p>"
            "<section id='feedback-loops'><p>Loops</p></section><section id='comments'><p>On comments</p></section>"
            "<div class='banner-history'>Banners</div><div class='comment-list'>c</div><div id='share-buttons'>s</div><div class='ad-2'>a</div></article>")
    assert text_of(page) == ["Related work\nA social word\nLoops\nOn comments\nBanners"]


def test_a_page_wide_form_or_layout_name_empties_no_page():
    text = "<h1>Head</h1><p>Some words of a page</p><p>More of them</p>"
    search = "<div><form><p>Search here</p></form></div>"
    for page in (f"<body><form action='x'>{text}</form></body>", f"<body><form><nav>Menu</nav><article>{text}</article></form></body>",
                 f"<body><div class='content-banner-wrapper'>{text}</div><footer>f</footer></body>",
                 f"<body><div role='banner'><div class='promo'>{text}</div></div></body>"):
        assert text_of(page) == ["Head\nSome words of a page\nMore of them"]
        pages = [page.replace("Some", f"{i} other").replace("More of them", f"Line {i}") for i in range(4)]
        assert [t.split("\n")[-2:] for t in text_of(*pages)] == [[f"{i} other words of a page", f"Line {i}"] for i in range(4)]
    assert text_of(f"<body>{search}<div>{text * 3}</div></body>") == ["\n".join(["Head\nSome words of a page\nMore of them"] * 3)]
    assert text_of(f"<body>{search}<article><p>x</p></article></body>") == ["x"]
    assert text_of("<body><div class='cookie-notice'><p>We use cookies</p></div><nav>Menu</nav></body>") == [""]


def test_an_articles_own_header_stays():
    page = ("<body><header><h1>Site</h1></header><article><header class='post-header'><h1>Head</h1><p>Standfirst</p></header><p>x</p>"
            "<header><nav>Menu</nav></header></article></body>")
    assert text_of(page) == ["Head\nStandfirst\nx"]


def test_a_teaser_article_beside_the_text():
    def page(i):
        return (f"<body><article class='lead'><p>Read {i}</p></article><div id='main'><h1>Head {i}</h1>"
                f"<p>Page {i} says much more than its teaser does.</p><p>It goes on for {i} lines.</p></div></body>")
    for n in (1, 5):
        assert text_of(*map(page, range(n))) == [f"Head {i}\nPage {i} says much more than its teaser does.\nIt goes on for {i} lines." for i in range(n)]
    links = "".join(f"<div class='link'>A link to page number {i}</div>" for i in range(50))
    assert text_of(f"<body><article><p>Short</p></article>{links}</body>") == ["Short"]


def test_the_hosts_wrapper_changes_the_result():
    """A sentence that all pages of a host have in their articles is template; by its own wrapper a page keeps it."""
    pages = [f"<body><article><h1>Head {i}</h1><p>Words of page {i}</p><p>Write to us at any time.</p></article></body>" for i in range(4)]
    assert text_of(*pages) == [f"Head {i}\nWords of page {i}" for i in range(4)]
    assert [text_of(p)[0] for p in pages] == [f"Head {i}\nWords of page {i}\nWrite to us at any time." for i in range(4)]
    kept = [f"<body><article><h2>What you get from us</h2><p>Words of {i}</p><table><tr><td>Yes</td><td>{i}</td></tr></table></article></body>" for i in range(4)]
    assert text_of(*kept) == [f"What you get from us\nWords of {i}\nYes\n{i}" for i in range(4)]
    same = [f"<body><article><p>All alike</p></article><aside>{i}</aside><div>{i}</div></body>" for i in range(4)]
    assert text_of(*same) == ["All alike"] * 4


def size(nodes):
    return sum(1 + size(n[6]) for n in nodes)


@pytest.mark.parametrize("nested", [False, True])
def test_generated_class_names_make_no_large_wrapper(nested):
    def names(i):
        return [f"css-{''.join(chr(97 + (i * 31 + k * 7 + j * (i + 3)) % 26) for j in range(8))}" for k in range(30)]

    def page(i):
        if nested:
            return "<body><article>" + "".join(f"<div class='{c}'>" for c in names(i)) + f"<p>Text {i}</p>" + "</div>" * 30 + "</article></body>"
        return "<body><article>" + "".join(f"<div class='{c}'><p>Text {i}</p></div>" for c in names(i)) + "</article></body>"
    start, sizes, wrapper = time.time(), [], W.expression(page(0))
    for i in range(1, 300):
        wrapper = W.aligned(wrapper, W.expression(page(i)))
        sizes.append(size(wrapper))
    assert time.time() - start < 4 and sizes[-1] <= max(sizes[:100]) < 6000
    known = W.rule(wrapper, 300)
    assert all(W.main_text(page(i), known) == "\n".join([f"Text {i}"] * (1 if nested else 30)) for i in range(0, 300, 7))


def test_articles_below_any_depth():
    page = "<body>" + "<div>" * 300 + "<article><p>x</p></article><p>other</p>" + "</div>" * 300 + "</body>"
    shallow = "<body><article><p>y</p></article></body>"
    assert text_of(page, shallow) == ["x", "y"]


def test_unclosed_article_keeps_its_text():
    assert text_of("<body><article><h1>a</h1><p>b") == ["a\nb"]


def test_time_grows_with_the_page():
    start = time.time()
    for page in ("<b>" * 200_000 + "</i>" * 200_000, "<div>" * 100_000 + "x" + "</p>" * 100_000, '<a href="' * 50_000, "<li><p>" * 50_000,
                 "<!-- " * 50_000, "<script>" * 50_000, "".join(f"<x{i}>" for i in range(20_000))):
        text_of(page)
    assert time.time() - start < 30


def test_deep_pages_lose_no_text():
    deep = "<article>" + "<div>" * 200 + "x" + "<p>y</p>" + "</div>" * 200 + "</article>"
    assert text_of(deep)[0].split() == ["x", "y"]


def plain(html):
    m = re.search(r"<article>(.*?)(</article>|\Z)", html or "", re.S)
    blocks = re.split(r"</?(?:h1|p)>", m[1]) if m else []
    blocks = [" ".join(entities.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", b))).split()) for b in blocks]
    return "\n".join(b for b in blocks if b)


def test_query_matches_a_plain_reading(spark):
    sf = "/root/testdata/sf0.001"
    want = {r.page_id: (r.url, plain(r.html)) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = op9_wrappers(spark, sf).collect()
    assert len(got) == len(want)
    for r in got:
        assert (r.url, r.text) == want[r.page_id] and r.n_chars == len(r.text)


@pytest.mark.parametrize("size", [32 << 20, -1])  # rules broadcast, and met by shuffle
def test_odd_rows(spark, monkeypatch, size):
    monkeypatch.setattr(W, "RULE_BYTES", size)
    page = "<body><article><p>x y</p></article></body>"
    rows = [(1, "http://h/1", page), (2, "http://h/2", None), (3, "http://h/3", ""), (None, "http://h/4", page), (5, None, page),
            (6, "::odd", page), (7, "http://k/", "x" * 300_000), (8, "http://h/8", page), (8, "http://h/8", page)]
    df = clashing(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = [(r.page_id, r.url, r.text, r.n_chars) for r in W.extracted(df).collect()]
    want = [(i, u, {2: "", 3: "", 7: "x" * 300_000}.get(i, "x y")) for i, u, _ in rows]
    assert sorted(got, key=str) == sorted([(i, u, t, len(t)) for i, u, t in want], key=str)
    assert W.extracted(df.limit(0)).count() == 0 and W.wrappers(df).count() == 3
