"""Freshteam: postings grouped by department; posting pages with a content block and JSON-LD."""

from pyspark.sql import functions as F

from gigloom.boards.base import Board, details, kept, posting
from gigloom.functions import dates, rules, urls
from gigloom.functions.text import clean, drop_tags, let, location_and_type, nonempty, strip
from gigloom.sources.pages import attr_at, child, data_at, each, el, pick, text_at


def listing(dom, url, keep=None):
    def group(role):
        def job(a, department):
            # what a card says of its place is read once for all that is taken from it
            return let(location_and_type(text_at(a, el("div", **{"class": "location-info"}))), lambda place: posting(
                title=text_at(a, el("div", **{"class": "job-title"})),
                job_url=urls.absolute(url, F.get(a, F.lit(0))["attrs"]["href"]), department=department,
                location=place["location"], job_type=rules.job_type(place["job_type"], underscores=True)))
        return let(text_at(role, el("div", **{"class": "role-title"}), child(el("h5"))), lambda department: F.transform(
            each(role, el("a", cls_has="heading")), lambda a: job(a, department)))

    jobs = F.flatten(F.transform(each(dom, el("li", data_portal_role=True)), group))
    ready = F.size(pick(dom, el("div", data_portal_id="jobs_list"))) > 0
    return kept(F.when(ready, jobs).otherwise(F.slice(jobs, 1, 0)), keep)


POSTING = "array<struct<`@type`:string,description:string,employmentType:string,datePosted:string,jobLocation:string>>"
PLACE = "array<struct<address:string>>"
ADDRESS = "struct<addressLocality:string,addressRegion:string,addressCountry:string>"


def _as_array(text):
    return F.when(F.ltrim(text).startswith("["), text).otherwise(F.concat(F.lit("["), text, F.lit("]")))


def job_posting(scripts):
    """First JobPosting among JSON-LD texts (each an object or an array of objects), or null."""
    found = F.flatten(F.transform(scripts, lambda s: F.slice(F.filter(
        F.coalesce(F.from_json(_as_array(s), POSTING), F.from_json(F.lit("[]"), POSTING)),
        lambda p: F.coalesce(p["@type"] == "JobPosting", F.lit(False))), 1, 1)))
    return F.get(found, F.lit(0))


def place_of(posting_):
    """'locality, region, country' of the posting's (first) location."""
    address = F.get(F.from_json(_as_array(posting_["jobLocation"]), PLACE), F.lit(0))["address"]

    def joined(a):
        parts = F.array(a["addressLocality"], a["addressRegion"], a["addressCountry"])
        said = F.filter(parts, lambda p: p.isNotNull() & (p != ""))
        return F.when(~F.exists(said, lambda p: p.startswith("{")), nonempty(F.array_join(said, ", ")))
    return let(F.from_json(address, ADDRESS), joined)


def detail(dom):
    def with_posting(p):
        body = nonempty(clean(text_at(dom, el(cls=["job-details-content", "content"]))))
        return details(original_description=F.coalesce(body, drop_tags(p["description"])), location=place_of(p),
                       job_type=rules.job_type(p["employmentType"], underscores=True), posted=strip(p["datePosted"]))
    return let(job_posting(data_at(dom, el("script", type="application/ld+json"))), with_posting)


BOARD = Board("freshteam", "freshteam", listing, detail,
              published=lambda c, as_of: dates.iso_or_written(c), strict=True,
              patched=("original_description", "location", "job_type", "department", "published_date"),
              prefer={"published_date": "detail_only"})
