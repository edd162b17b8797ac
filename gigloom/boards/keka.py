"""Keka: link cards; posting pages with icon-labelled fields."""

from pyspark.sql import functions as F

from gigloom.boards.base import Board, details, kept, posting
from gigloom.functions import dates, urls
from gigloom.functions.text import bullets_or_text, clean, let, nonempty
from gigloom.sources.pages import attr_at, each, either, el, pick, scope_at, shown, text_at, within

CARD = either(el("a", cls="kh-card"), el("a", cls="kh-job-card"), el("a", cls=["card", "job-card"]),
              el("a", href_has="jobdetails"))


def _listing(address):
    def listing(dom, url, keep=None):
        def card(s):
            def said(*tests):
                return clean(text_at(s, either(*tests)), False)
            return posting(
                title=said(el("h4", cls="kh-job-title"), el("h3", cls="job-title")),
                job_url=address(url, F.coalesce(F.get(s, F.lit(0))["attrs"]["href"], F.lit(""))),
                posted=said(el("small"), el("span", cls="text-secondary")),
                job_type=said(el(cls="job-type"), el(cls="type")), location=said(el("span", cls="font-large")))
        return kept(F.transform(each(dom, CARD), card), keep, title=keep is not None)
    return listing


def _absolute(url, href):
    return F.when((href == "") | href.startswith("http"), href).otherwise(urls.absolute(url, href))


def _beside(dom, icon):
    """Second span next to an icon."""
    spans = pick(dom, el("span"))
    values = F.transform(pick(dom, el("span", cls=icon)), lambda i: F.get(
        F.filter(spans, lambda s: s["up"] == i["up"]), F.lit(1)))
    return let(F.get(F.filter(values, lambda v: v.isNotNull()), F.lit(0)),
               lambda n: F.when(n.isNotNull(), clean(shown(within(dom, n)), False)))


def _described(dom, container):
    return let(scope_at(dom, container), lambda s: F.when(s.isNotNull(), nonempty(
        bullets_or_text(F.transform(each(s, el("li")), shown), shown(s)))))


def _detail(*containers):
    def detail(dom):
        return details(original_description=F.coalesce(*[_described(dom, c) for c in containers]),
                       location=_beside(dom, "ki-location"), job_type=_beside(dom, "ki-briefcase"),
                       experience=_beside(dom, "ki-user-tie"))
    return detail


BODY = el(cls="job-description-container")

BOARD = Board(
    "keka", "keka", _listing(_absolute), _detail(BODY), posted=dates.relative, stamp="always", needs_description=False,
    patched=("original_description", "location", "job_type", "min_exp", "max_exp"),
    prefer={"location": "listing", "job_type": "detail_only"},
    listing_once=_listing(urls.job_details_url),
    detail_once=_detail(BODY, el(cls="job-description"), el("quill-view-html"), el("quill-view"), el(cls="ql-editor"),
                        el("div", cls_has="description")),
    prefer_once={"location": "listing", "job_type": "listing", "published_date": "listing_only"}, listed_once=("location", "job_type", "published_date"), failed_once=None,
)
