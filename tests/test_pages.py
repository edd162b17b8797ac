"""Markup to nodes, selection, text, and layouts with missing parts."""

import cProfile
import time

import pytest
from pyspark.sql import functions as F

from gigloom.boards import BOARDS
from gigloom.boards.base import DETAIL, LISTED, details, detailed, listed, pairs, posting, route, routed
from gigloom.sources import pages as P
from gigloom.sources.markup import Flat


@pytest.fixture
def read(spark):
    def run(html, *fns):
        df = spark.createDataFrame([(html,)], "html string").select(P.nodes("html").alias("dom"))
        row = df.select(*[f(F.col("dom")).alias(f"c{i}") for i, f in enumerate(fns)]).first()
        return row[0] if len(fns) == 1 else tuple(row)
    return run


def test_unclosed_elements_end_where_a_browser_ends_them(read):
    html = "<div><p>one<p>two <b>bold</div><ul><li>1<li>2<ul><li>2a</ul><li>3</ul><table><tr><td>c<td>d<tr><td>e</table>"
    assert read(html, lambda d: F.transform(P.each(d, P.el("p")), P.shown)) == ["one", "two bold"]
    assert read(html, lambda d: F.transform(P.each(d, P.el("ul"), P.child(P.el("li"))), P.shown)) == ["1", "2\n2a", "2a", "3"]
    assert read(html, lambda d: F.transform(P.each(d, P.el("tr")), lambda r: F.size(P.pick(r, P.el("td"))))) == [2, 1]


def test_steps(read):
    html = "<a class='x y' id=k data-n='1'><i>in</i></a><i>out</i><div><p><img src='/a/department.svg'><span>s1</span><span>s2</span></p><span>s3</span></div>"
    assert read(html, lambda d: P.text_at(d, P.el(cls="x"), P.el("i"))) == "in"
    assert read(html, lambda d: P.text_at(d, P.el("img", src_has="department"), P.after(P.el("span")))) == "s1"
    assert read(html, lambda d: F.transform(P.each(d, P.el("div"), P.child(P.el("span"))), P.shown)) == ["s3"]
    assert read(html, lambda d: F.size(P.pick(d, P.el("a", cls=["y", "x"], data_n="1", id="k")))) == 1
    assert read(html, lambda d: F.size(P.pick(d, P.el("a", cls="z")))) == 0
    assert read(html, lambda d: P.text_at(d, P.el("u"))) is None


def test_text_forms(read):
    html = "<style>x{}</style><div> a <b>b</b>c<br>d&amp;e <p>f</p><script>var s='<p>';</script></div>"
    assert read(html, lambda d: P.text_at(d, P.el("div"))) == "a bc\nd&e\nf"
    assert read(html, lambda d: P.text_at(d, P.el("div"), sep="|")) == "a|b|c|d&e|f"
    assert read(html, lambda d: P.data_at(d, P.el("script"))) == ["var s='<p>';"]


def test_odd_markup_does_not_fail(read):
    for html in [None, "", "<", "<<a", "</div></p>", "<a href='x>y</a>", "<!-- open", "<p " + "x" * 5000, "&#x0;&bogus;", "<script>never closed"]:
        assert read(html, lambda d: F.size(d)) >= 1


def test_deep_nesting_stays_linear(read):
    assert read("<div>" * 3000 + "x" + "</div>" * 3000, lambda d: F.size(P.pick(d, P.el("div")))) == 3000


@pytest.mark.parametrize("name", list(BOARDS))
def test_blank_pages_give_no_postings_and_null_details(spark, name):
    pages = spark.createDataFrame([(1, "https://x.com/", "<html><body><p>nothing here</p></body></html>"), (2, "https://x.com/", None)],
                                  "page_id long, url string, html string")
    assert listed(pages, BOARDS[name].listing).count() == 0
    rows = detailed(pages, BOARDS[name].detail).collect()
    assert len(rows) == 2 and all(r[f] is None for r in rows for f in DETAIL)
    assert detailed(pages, BOARDS[name].detail, "original_description").count() == 0


def test_gate_works_inside_the_layout_choice(spark):
    html = "<table><tr class='jobDetailRow'><td><a class='jobdetail' href='/1'>t</a></td><td>Cook</td><td></td><td></td></tr></table><a href='/jobs/2'>Solar Lead</a>"
    pages = spark.createDataFrame([("https://x.com", html)], "url string, html string")
    listing = BOARDS["zoho"].listing
    assert [r.title for r in listed(pages, listing).collect()] == ["Cook"]
    assert [r.title for r in listed(pages, listing, lambda t: t.contains("Solar")).collect()] == ["Solar Lead"]


def test_lever_header_leaves_labels_to_later_fields(spark):
    html = ("<div class='posting-headline'><div class='posting-category location'>Pune</div></div><div class='section page-centered' data-qa='job-description'>d</div>"
            "<ul class='posting-requirements'><li><h5>Location type</h5><span>Remote</span></li></ul>")
    row = detailed(spark.createDataFrame([(html,)], "html string"), BOARDS["lever"].detail).first()
    assert (row.location, row.job_type) == ("Pune", "Remote")


def test_routing_first_last_joined(spark):
    df = spark.createDataFrame([([("city", "A"), ("type", ""), ("city", "B"), ("type", "T"), ("other", "x")],)],
                               "p array<struct<label:string,value:string>>")
    routes = [("place", lambda x: x.contains("city")), ("kind", lambda x: x.contains("type"))]
    r = df.select(route(F.col("p"), routes).alias("r"))
    got = r.select(routed(F.col("r"), "place"), routed(F.col("r"), "place", "last"), routed(F.col("r"), "place", sep=", "),
                   routed(F.col("r"), "kind"), routed(F.col("r"), "none")).first()
    assert tuple(got) == ("A", "B", "A, B", "T", None)


def test_large_pages_in_one_batch_stay_whole_and_apart(spark):
    """Nodes are handed over in chunks; every page keeps exactly its own."""
    sizes = [40_000, 0, 35_000, 30_000, 5]
    pages = spark.createDataFrame([(i, "<b>x</b>" * n if n else None) for i, n in enumerate(sizes)], "i int, html string").coalesce(1)
    rows = pages.select("i", P.nodes("html").alias("dom")).select(
        "i", F.size(P.pick(F.col("dom"), P.el("b"))).alias("n"), F.element_at("dom", -1)["pos"].alias("last"), F.size("dom").alias("all"))
    for r in rows.orderBy("i").collect():
        assert (r.n, r["last"] + 1) == (sizes[r.i], r["all"])


@pytest.mark.parametrize("markup", ["<![foo[bar]]><p>x</p>", "<p>x</p><![ x", "<p>x</p>a<![1", "<!foo><p>x</p>", "<p>x<!ENTITY a", "<p>x</p><![CDATA[y]]>"])
def test_unknown_declarations_are_comments(markup):
    flat = Flat().read(markup)
    assert "x" in [t for t in flat.text if t]


HOSTILE = ["<a \"", "<a '", "&#", "&amp", "<!--", "<!-- -", "--", "<div>", "<b>", "</i>", "<a href=x>", "<li><p>", "<a href='", "<a =", "<a b ", "<", "</", "<!", "<?", "<script>",
           "<style></", "<a/", "<table><tr><td>", "<p><table>", "<option>", "</p>", "<x y=\"'", "< a", "<![CDATA["]


@pytest.mark.parametrize("piece", HOSTILE)
def test_time_grows_with_the_page(piece):
    markup = "<p>before</p>" + piece * (1_000_000 // len(piece))
    start = time.time()
    flat = Flat().read(markup)
    assert time.time() - start < 6
    assert "before" in flat.text


@pytest.mark.parametrize(("markup", "want"), [
    ("a < b <3 &lt;c&gt; & d", ["a < b <3 <c> & d"]),
    ("<p>x<!-- <b>no</b> -->y<!-->z<!--->w<!--a--!>v", ["x", "y", "z", "w", "v"]),
    ("<?xml version='1'?>a</>b</ c>d<!DOCTYPE html>e", ["a", "b", "d", "e"]),
    ("a<p title='x", ["a"]), ("a<p title", ["a"]), ("a<p", ["a"]), ("a</p", ["a"]), ("a<!-- b", ["a"]),
    ("<script>if (a<b) x='</scripty>'</SCRIPT >after", ["if (a<b) x='</scripty>'", "after"]),
    ("<style>p > a {}</style><script/>x", ["p > a {}", "x"]),
])
def test_scanner_reads_as_browsers_do(markup, want):
    assert [t for t in Flat().read(markup).text if t] == want


def test_attributes():
    flat = Flat().read("<A HREF = \"a&amp;b\" x=1/2 y Z='q\"' =w =v=3 data-i=></A><img src=u/>")
    assert flat.attrs[1] == [("href", "a&b"), ("x", "1/2"), ("y", None), ("z", 'q"'), ("=w", "v=3"), ("data-i", "")]
    assert (flat.tag[1], flat.tag[2], flat.attrs[2]) == ("a", "img", [("src", "u/")])


def test_unclosed_anchors_do_not_nest():
    flat = Flat().read("<p><a href=1>one<a href=2>two<p><a href=3><div>three</div></a>")
    assert [flat.last[i] - i for i, t in enumerate(flat.tag) if t == "a"][:2] == [1, 1]


@pytest.mark.parametrize(("markup", "want"), [
    ("a<b x=1 y='2>c", ["a"]), ("a<b x=\"1\" ' y=2>c", ["a", "c"]), ("a<b x = >c", ["a", "c"]), ("1 < 2<b>3</b x>4", ["1 < 2", "3", "4"]),
    ("a<b/ /x='>'/>c</b", ["a", "c"]), ("a</b", ["a"]), ("<a b=c'd e=\"f\"g>h", ["h"]), ("a<b x=y\"z>c", ["a", "c"]),
])
def test_tags_end_where_their_attributes_do(markup, want):
    assert [t for t in Flat().read(markup).text if t] == want


def test_a_tag_takes_few_calls():
    """A page of short tags costs calls, not characters: each tag is one match."""
    page = "<ul>" + "<li class='x y'><a href='/j/1'><b>t</b></a></li>" * 200 + "</ul>"
    calls = cProfile.Profile()
    calls.runcall(Flat().read, page)
    assert sum(entry.callcount for entry in calls.getstats()) < 20 * page.count("<")


def test_what_a_freshteam_card_says_is_read_once(spark):
    """The place and the job type stand in one element, the department in its role's heading."""
    pages = spark.createDataFrame([(1, "https://x.com/", "")], "page_id long, url string, html string")
    plan = listed(pages, BOARDS["freshteam"].listing)._jdf.queryExecution().analyzed().toString()
    assert plan.count("location-info") == plan.count("role-title") > 0
