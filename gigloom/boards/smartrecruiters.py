"""SmartRecruiters: sectioned openings; posting pages with four titled sections."""

from pyspark.sql import functions as F

from gigloom.boards.base import Board, details, kept, posting
from gigloom.functions import urls
from gigloom.functions.text import clean, nonempty, titled_sections
from gigloom.sources.pages import attr_at, each, el, pick, text_at


def listing(dom, url, keep=None):
    def job(s):
        href = attr_at(s, "href", el("a", cls_has="details"))
        return posting(title=text_at(s, el("h4", cls_has="job-title")),
                       job_url=F.when(F.coalesce(href, F.lit("")) != "", urls.absolute(url, href)),
                       job_type=text_at(s, el("p", cls_has="job-desc"), el("span")))
    jobs = F.transform(each(dom, el("section", cls_has="openings-section"), el("li", cls_has="opening-job")), job)
    ready = F.size(pick(dom, el("div", cls_has="openings-body"))) > 0
    return kept(F.when(ready, jobs).otherwise(F.slice(jobs, 1, 0)), keep)


SECTIONS = [("st-companyDescription", "### Company Description"), ("st-jobDescription", "### Job Description"),
            ("st-qualifications", "### Qualifications"), ("st-additionalInformation", "### Additional Info")]


def detail(dom):
    place = clean(text_at(dom, el(cls="c-spl-job-location__place")))
    named = clean(F.replace(text_at(dom, el("li", itemprop="jobLocation")), F.lit("Location"), F.lit("")))
    parts = [(title, clean(text_at(dom, el(id=name), el(cls="wysiwyg")))) for name, title in SECTIONS]
    return details(original_description=F.coalesce(titled_sections(*parts), nonempty(
                       clean(text_at(dom, el(itemprop="description"))))),
                   location=F.coalesce(nonempty(place), named),
                   job_type=clean(text_at(dom, el(itemprop="employmentType"))),
                   department=attr_at(dom, "content", el("meta", itemprop="industry")))


BOARD = Board("smartrecruiters", "smartrecruiters", listing, detail, match="contains_cs", drop="falsy", listed_once=(),
              prefer_once={c: "detail_only" for c in ("location", "job_type", "department", "original_description")})
