"""Lever: posting blocks; posting pages with a headline and optional info list."""

from pyspark.sql import functions as F

from gigloom.boards.base import Board, details, has, kept, pairs, posting, route, routed
from gigloom.functions import rules, urls
from gigloom.functions.text import clean, first_nonempty, let, strip
from gigloom.sources.pages import attr_at, child, each, either, el, text_at

LINK = child(el("a", cls_has="posting-title"))


def listing(dom, url, keep=None):
    def block(s):
        href = attr_at(s, "href", LINK)
        return posting(title=text_at(s, LINK, el("h5", data_qa="posting-name")),
                       job_url=F.when(F.coalesce(href, F.lit("")) != "", urls.absolute(url, href)),
                       job_type=rules.job_type(text_at(s, el("span", cls_has="commitment")), slashes=True),
                       location=text_at(s, el("span", cls_has="location")))
    return kept(F.transform(each(dom, el("div", cls_has="posting")), block), keep)


INFO = [("location", has("location")), ("department", has("team", "department")),
        ("job_type", has("employment", "type", "commitment")), ("experience", has("experience")),
        ("posted", has("date", "opened"))]


def detail(dom):
    def head(kind):
        return clean(text_at(dom, el("div", cls="posting-headline"), el("div", cls=["posting-category", kind])))

    def unslashed(c):
        return strip(F.replace(c, F.lit("/"), F.lit("")))

    headed = F.struct(head("location").alias("location"), unslashed(head("department")).alias("department"),
                      unslashed(head("commitment")).alias("job_type"))
    items = [(el("ul", cls="posting-requirements"), el("li")), (el(data_qa="job-info"), el("li"))]
    found = F.concat(*[pairs(dom, i, (either(el("h5"), el(cls="posting-category-title")),),
                             (either(el("span"), el(cls="posting-category-value")),)) for i in items])

    def whole(top, rows):
        def unless_headed(name, test):
            return (lambda x: test(x) & (top[name] == "")) if name in ("location", "department", "job_type") else test
        # a field the headline has filled does not use up its label: later routes get their turn
        return let(route(rows, [(f, unless_headed(f, t)) for f, t in INFO]), lambda info: details(
            original_description=clean(text_at(
                dom, el("div", cls=["section", "page-centered"], data_qa="job-description"))),
            **{f: first_nonempty(top[f], routed(info, f)) for f in ("location", "department", "job_type")},
            experience=routed(info, "experience"), posted=routed(info, "posted")))
    return let(headed, lambda top: whole(top, found))


BOARD = Board("lever", "lever", listing, detail, strict=True, drop="overwrite",
              job_type=lambda c: rules.job_type(c, slashes=True))
