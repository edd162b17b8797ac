"""Workday (one-pass): list items with a title link; posting pages with labelled definition lists."""

from pyspark.sql import functions as F

from gigloom.boards.base import Board, details, kept, posting
from gigloom.functions import dates, urls
from gigloom.functions.text import commas_to_spaces
from gigloom.sources.pages import attr_at, each, el, pick, text_at

TITLE = el(data_automation_id="jobTitle")


def listing(dom, url, keep=None):
    def item(s):
        href = attr_at(s, "href", TITLE)
        return posting(title=text_at(s, TITLE), job_url=F.when(F.coalesce(href, F.lit("")) != "", urls.absolute(url, href)))
    return kept(F.transform(F.filter(each(dom, el("li")), lambda s: F.size(pick(s, TITLE)) > 0), item), keep)


def detail(dom):
    def said(name):
        return text_at(dom, el(data_automation_id=name), el("dd"))
    return details(location=said("locations"), job_type=said("time"), posted=said("postedOn"),
                   original_description=commas_to_spaces(text_at(dom, el("div", data_automation_id="jobPostingDescription"))))


BOARD = Board("workday", "workday", listing, detail, published=dates.first_number_days,
              prefer_once={c: "detail_only" for c in ("location", "job_type", "published_date", "original_description")},
              listed_once=(), needed_once="original_description", skip_failed_once=True,
              title_once=commas_to_spaces)
