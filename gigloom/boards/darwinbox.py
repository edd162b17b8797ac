"""Darwinbox: tiles or a table; posting pages with two label blocks."""

from pyspark.sql import functions as F

from gigloom.boards.base import Board, details, has, kept, pairs, posting, route, routed
from gigloom.functions import dates, urls
from gigloom.functions.text import clean, first_nonempty, let
from gigloom.sources.pages import after, attr_at, each, el, pick, scope_at, shown, text_at


def tiles(dom, url):
    def tile(s):
        return posting(
            title=text_at(s, el(cls="job-title")),
            job_url=_resolved(url, attr_at(s, "href", el("a", cls="action-btn"))),
            department=text_at(s, el("img", src_has="department"), after(el("span"))))
    return F.transform(each(dom, el("ui-job-tile")), tile)


def table(dom, url):
    def row(s):
        def cell(name):
            return text_at(s, el("td", data_th=name), el("span"))
        title = (el("td", data_th="Job title"), el("a"))
        return posting(title=text_at(s, *title), job_url=_resolved(url, attr_at(s, "href", *title)),
                       department=cell("Home Team"), location=cell("Location"), job_type=cell("Employee Type"),
                       posted=cell("Job posted on"))
    return F.transform(each(dom, el("table", cls="db-table-one"), el("tr")), row)


def _resolved(url, href):
    return F.when(F.coalesce(href, F.lit("")) != "", urls.absolute(url, href))


def listing(dom, url, keep=None):
    """Tiles when the page has any, else the table."""
    return kept(F.when(F.size(pick(dom, el("ui-job-tile"))) > 0, tiles(dom, url)).otherwise(table(dom, url)),
                keep, title=keep is not None)


SNAPSHOT = [("location", lambda x: x == "location"), ("job_type", lambda x: x.contains("employee type") | (x == "type")),
            ("department", has("department", "function")), ("experience", has("experience")),
            ("posted", has("updated date", "job posted on"))]
BLOCK = [("location", has("location")), ("job_type", has("type")), ("department", has("function", "department")),
         ("experience", has("experience")), ("posted", has("job posted on", "updated date"))]
BODIES = ["jd-container", "job-summary", "jd", "job-description"]


def _parts(dom):
    def body(cls):
        return let(F.coalesce(text_at(dom, el(cls=cls)), F.lit("")),
                   lambda t: let(clean(t), lambda c: F.when(F.length(c) > 50, c)))
    snapshot = route(pairs(dom, (el(cls=["section", "mobile-section"]), el(cls="grid-item")),
                           (el(cls="label"),), (el(cls="value"),), required=False), SNAPSHOT)
    block = route(pairs(dom, (el(cls="job-details"), el(cls="job-details-item")), (el("label"),), (el("p"),)), BLOCK)
    spare = clean(text_at(dom, el(cls=["job-details-item", "experience-range"]), el("p")))
    return F.coalesce(*[body(c) for c in BODIES]), snapshot, block, spare


def detail(dom):
    """The last label read wins."""
    body, snapshot, block, spare = _parts(dom)
    return let(F.concat(snapshot, block), lambda both: details(
        original_description=body, experience=first_nonempty(routed(both, "experience", "last"), spare),
        **{f: routed(both, f, "last") for f in ("location", "job_type", "department", "posted")}))


def detail_once(dom):
    """The first label read wins, but the snapshot's last experience goes first."""
    body, snapshot, block, spare = _parts(dom)

    def whole(snap, rest):
        both = F.concat(snap, rest)
        return details(
            original_description=body,
            experience=first_nonempty(routed(snap, "experience", "last"), routed(rest, "experience"), spare),
            **{f: routed(both, f) for f in ("location", "job_type", "department", "posted")})
    return let(snapshot, lambda snap: let(block, lambda rest: whole(snap, rest)))


BOARD = Board(
    "darwinbox", "darwinbox", listing, detail, posted=dates.relative_or_written, published=dates.relative_or_written,
    patched=("original_description", "location", "job_type", "department", "published_date", "min_exp", "max_exp"),
    needs_description=False,
    detail_once=detail_once, refresh_once=True,
    prefer_once={c: "listing" for c in ("location", "job_type", "department", "published_date")},
)
