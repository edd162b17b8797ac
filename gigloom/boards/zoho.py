"""Zoho Recruit: table, else cards, else recognisable anchors; posting pages in several designs."""

from pyspark.sql import functions as F

from gigloom.boards.base import Board, details, first_layout, has, kept, pairs, posting, route, routed
from gigloom.functions import dates, fixed_values as V, rules, urls
from gigloom.functions.text import first_line, let, nonempty, strip
from gigloom.sources.pages import each, either, el, first, joined, pick, scope_at, shown, text_at, within


def _address(url, href):
    return F.when(F.coalesce(href, F.lit("")) != "", urls.absolute(url, href))


def table(dom, url):
    """Rows of at least four cells: type link, title, date, place."""
    def row(s):
        cells = each(s, el("td"))

        def cell(i):
            return joined(F.get(cells, F.lit(i)), "")
        link = first(F.get(cells, F.lit(0)), el("a", cls="jobdetail"))
        return posting(title=cell(1), posted=cell(2), location=cell(3), job_type=text_at(
            F.get(cells, F.lit(0)), el("a", cls="jobdetail"), sep=""), job_url=_address(url, link["attrs"]["href"]))
    rows = F.filter(each(dom, el("tr", cls="jobDetailRow")), lambda s: F.size(pick(s, el("td"))) >= 4)
    return F.transform(rows, row)


def cards(dom, url):
    def card(s):
        head = first(s, el("a", cls="cw-3-title"))
        place = let(scope_at(s, el("p", cls="filter-subhead")), lambda p: F.when(
            p.isNotNull(), _without(p, first(p, el("span", cls="search-work-experience")))))
        return posting(title=text_at(s, el("a", cls="cw-3-title"), sep=""),
                       job_url=F.when(head.isNotNull(), urls.absolute(url, head["attrs"]["href"])), location=place,
                       job_type=text_at(s, el("span", cls="cw-full-time"), sep=""),
                       posted=text_at(s, el("span", cls="search-date-opened"), sep=""))
    return F.transform(each(dom, el("div", cls="cw-filter-joblist")), card)


def _without(scope, node):
    """Text of a scope with one inner element left out."""
    outside = F.filter(scope, lambda n: node.isNull() | (n["pos"] < node["pos"]) | (n["pos"] > node["last"]))
    return joined(outside, " ")


ANCHORS = [el("a", cls="cw-1-title"), el("a", cls="cw-3-title"), el("a", cls="zp_career_site_job_title"),
           el("a", cls="jobdetail"), el("a", href_has="/jobs/"), el("a", href_has="JobOpenings"),
           el("a", href_has="jobdetail")]


def _anchor(dom, url, read):
    return lambda n: posting(title=read(within(dom, n)), job_url=_address(url, n["attrs"]["href"]))


def _real(rows):
    return F.filter(rows, lambda j: ~rules.contains_any(j["title"], V.ANCHOR_NOISE))


def anchors(dom, url):
    """All recognisable anchors in page order."""
    test = either(*ANCHORS, el("a", href_has="recruit"))
    return _real(F.transform(pick(dom, test), _anchor(dom, url, lambda s: joined(s, " "))))


def anchors_first(dom, url):
    """Anchors of the first kind present on the page."""
    return _real(F.transform(first_layout(*[pick(dom, t) for t in ANCHORS]), _anchor(dom, url, shown)))


def anchors_each(dom, url):
    """Anchors of every kind, kind by kind."""
    return _real(F.transform(F.concat(*[pick(dom, t) for t in ANCHORS]), _anchor(dom, url, shown)))


def listing(dom, url, keep=None):
    return first_layout(kept(table(dom, url), keep, title=keep is not None),
                        kept(cards(dom, url), keep, title=keep is not None), kept(anchors(dom, url), keep))


def listing_rendered(dom, url, keep=None):
    return first_layout(kept(table(dom, url), keep, title=keep is not None),
                        kept(cards(dom, url), keep, title=keep is not None),
                        kept(anchors_first(dom, url) if keep is None else anchors_each(dom, url), keep))


TITLES = [(el("div", cls="tem3-titleBlock"), el("h1")), (el("div", cls="tem4-col2_hdr"), el("h2")),
          (el("div", cls="cw-jobheader-information"), el("h1")), (el("h1"),), (el("h2"),)]
BODIES = [el("div", cls="job-dec-block_new"), el("div", cls="cw-jobdescription"), el("div", cls="temp4-content"),
          el("span", id="spandesc"), el("div", cls="tem3ContentBlock")]
ROUTES = [("posted", has("date", "posted")), ("job_type", has("job type")), ("experience", has("experience")),
          ("department", has("department", "function")), ("industry", has("industry")),
          ("location", has("location", "city", "state", "province", "country", "region"))]


def detail(dom):
    """Null fields throughout when the page has no title."""
    title = let(F.coalesce(*[scope_at(dom, *t) for t in TITLES]), lambda s: F.when(
        s.isNotNull(), nonempty(first_line(joined(s, " ")))))
    body = let(F.coalesce(*[scope_at(dom, b) for b in BODIES]), lambda s: F.when(s.isNotNull(), joined(s, "\n")))

    def spans(s):
        found = each(s, el("span"))
        return F.struct(F.lower(joined(F.get(found, F.lit(0)), "")).alias("label"),
                        joined(F.get(found, F.lit(1)), "").alias("value"), F.size(found).alias("n"))
    listed = F.transform(F.filter(F.transform(each(dom, el("ul", cls="cw-summary-list"), el("li")), spans),
                                  lambda p: p["n"] >= 2),
                         lambda p: F.struct(p["label"].alias("label"), p["value"].alias("value")))
    boxed = pairs(dom, (el("div", cls="tem3ContentBlock"), el("div", cls="tem3-TextCont")), (el("span"),),
                  (el("div", cls="tem3-RightSideText"),), read=lambda s: joined(s, " "))
    found = route(F.filter(F.concat(listed, boxed), lambda p: (p["label"] != "") & (p["value"] != "")), ROUTES)

    def whole(name):
        return let(found, lambda f: details(
            title=name, original_description=body, location=routed(f, "location", sep=", "),
            **{x: routed(f, x) for x in ("posted", "job_type", "experience", "department", "industry")}))
    return let(title, lambda name: F.when(name.isNotNull(), whole(name)))


def _published(c, as_of):
    return dates.month_first(c)


BOARD = Board(
    "zoho", "zoho recruit", listing, detail, posted=_published, published=_published, match="eq", strict=True,
    keys=("job_url", "title"), drop="none", needs_description=False,
    patched=("title", "original_description", "job_type", "published_date", "min_exp", "max_exp", "location",
             "department", "industry"),
    prefer={c: "detail_only" for c in ("title", "original_description", "job_type", "published_date", "location",
                                       "department", "industry")},
    ats_once="zoho", listing_rendered=listing_rendered, listed_once=("location", "job_type", "published_date"),
    failed_once=None, needed_once="title",
)
