"""Workable: list items; posting pages with up to three sections."""

from pyspark.sql import functions as F

from gigloom.boards.base import Board, details, kept, posting
from gigloom.functions import dates, rules, urls
from gigloom.functions.text import clean, nonempty, plain_sections
from gigloom.sources.pages import attr_at, each, el, text_at


def listing(dom, url, keep=None):
    def job(s):
        href = attr_at(s, "href", el("a"))
        return posting(title=text_at(s, el("h3", data_ui="job-title")),
                       job_url=F.when(F.coalesce(href, F.lit("")) != "", urls.absolute(url, href)),
                       department=text_at(s, el("span", data_ui="job-department")),
                       job_type=rules.job_type(text_at(s, el("span", data_ui="job-type")), titled=True),
                       posted=text_at(s, el("small", data_ui="job-posted")),
                       location=text_at(s, el(data_ui="job-location")))
    return kept(F.transform(each(dom, el("li", data_ui="job")), job), keep)


def detail(dom):
    section = [text_at(dom, el("section", data_ui=name), sep="\n")
               for name in ("job-description", "job-requirements", "job-benefits")]
    place = clean(text_at(dom, el("div", data_ui="job-location"), sep=" "))
    return details(original_description=plain_sections(*section),
                   location=F.coalesce(nonempty(place), attr_at(dom, "content", el("meta", property="og:locality"))),
                   job_type=rules.job_type(text_at(dom, el(data_ui="job-type"), sep=""), titled=True),
                   department=clean(text_at(dom, el(data_ui="job-department"), sep="")))


BOARD = Board("workable", "workable", listing, detail, posted=dates.relative_units,
              prefer_once={"published_date": "listing_only"})
