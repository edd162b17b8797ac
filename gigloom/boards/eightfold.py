"""Eightfold (one-pass): listing cards; posting pages with a description container."""

from pyspark.sql import functions as F

from gigloom.boards.base import Board, details, kept, posting
from gigloom.functions import dates, urls
from gigloom.functions.text import clean, first_of, let, time_type
from gigloom.sources.pages import after, attr_at, each, el, joined, pick, scope_at, shown, text_at, within


def listing(dom, url, keep=None):
    def card(s):
        href = attr_at(s, "href", el("a"))
        return posting(title=text_at(s, el(cls="title-1aNJK")), job_url=F.when(href.isNotNull(), urls.absolute(url, href)),
                       location=text_at(s, el(cls="fieldValue-3kEar")), posted=text_at(s, el(cls="subData-13Lm1")))
    return kept(F.transform(each(dom, el(data_test_id="job-listing")), card), keep)


def _date_posted(dom):
    """The div after the one that reads 'Date posted'."""
    divs = pick(dom, el("div"))
    head = F.filter(divs, lambda n: F.exists(within(dom, n), lambda t: (t["up"] == n["pos"]) & (
        F.coalesce(t["text"], F.lit("")) == "Date posted")))
    beside = let(F.get(head, F.lit(0)), lambda h: F.get(F.filter(
        divs, lambda n: (n["up"] == h["up"]) & (n["pos"] > h["pos"])), F.lit(0)))
    return let(beside, lambda n: F.when(n.isNotNull(), shown(within(dom, n))))


def detail(dom):
    body = text_at(dom, el(id="job-description-container"))
    return details(original_description=clean(body, False), job_type=time_type(body), posted=_date_posted(dom))


BOARD = Board("eightfold", "eightfold", listing, detail, posted=dates.first_number_days,
              published=dates.first_number_days, listed_once=("location", "published_date"),
              needed_once="original_description",
              prefer_once={"location": "listing_only", "job_type": "detail_only"})
