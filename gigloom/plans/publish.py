"""Publishing: which active postings are new, long enough and fresh, and what they look like published."""

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gigloom.functions import fixed_values as V
from gigloom.functions import rules
from gigloom.functions.dates import any_timestamp, day_text, moment
from gigloom.functions.numbers import experience_label
from gigloom.functions.text import first_nonempty, nonblank, sections, slug, standard_location
from gigloom.functions.urls import tracked
from gigloom.operators.keys import computed, lookup_join, map_distinct, new_only, reason_counts, skip_reasons
from gigloom.operators.match import nearest
from gigloom.operators.merge import retain
from gigloom.operators.wording import closest_wording
from gigloom.sources.tables import with_parents


@dataclass(frozen=True)
class Edition:
    """What varies between the published tables."""
    source: str
    rules: list
    default: str
    min_words: int = 50
    days: int | None = 90
    months: int | None = None
    similar: float = 0.30
    wording: list | None = None
    by_source: bool = True
    retains: bool = True
    structured: bool = True
    plain_location: bool = False
    india_only: bool = False
    remote: tuple = ("remote",)
    extra: dict = field(default_factory=dict)


GENERAL = Edition("jobs", V.GENERAL_DEPARTMENT_RULES, V.GENERAL_DEPARTMENT_DEFAULT)
GREEN = Edition("jobs_sustain", V.GREEN_DEPARTMENT_RULES, V.GREEN_DEPARTMENT_DEFAULT, india_only=True,
                remote=("remote", "work from home", "wfh"))
LONG = Edition("jobs", V.LONG_DEPARTMENT_RULES, V.LONG_DEPARTMENT_DEFAULT, min_words=20, days=None, months=6,
               similar=0.5, wording=V.LONG_DEPARTMENTS, by_source=False, structured=False, plain_location=True,
               retains=False)


def cutoff(edition: Edition, as_of) -> Column:
    now = moment(as_of)
    if edition.days is not None:
        return now - F.make_dt_interval(F.lit(edition.days))
    return now - F.make_ym_interval(F.lit(0), F.lit(edition.months))


def _known(published: DataFrame, edition: Edition) -> DataFrame:
    if edition.by_source:
        published = published.where(F.col("source_table") == edition.source)
    return published.select(F.col("job_id").alias("id"))


def _tests(edition: Edition, as_of):
    when = any_timestamp("published_date")
    # more than so many words: the search ends at the first word beyond them
    enough = F.coalesce(F.col("original_description"), F.lit("")).rlike(rf"(?U)^\s*(?:\S+\s+){{{edition.min_words}}}\S")
    return {"short": ~enough, "old": when.isNull() | (when < cutoff(edition, as_of))}


def judged(jobs: DataFrame, published: DataFrame, edition: Edition, as_of) -> DataFrame:
    """Active postings with the first reason they are skipped: exists, short, old; null when kept."""
    tests = _tests(edition, as_of)
    # decided before the join, so a caller who only counts moves ids and flags, not texts
    rows = jobs.where("is_active").select("*", *[t.alias(f"_{n}") for n, t in tests.items()])
    known = _known(published, edition).withColumn("_known", F.lit(True))
    found = lookup_join(rows, known, ["id"], distinct=True)
    return skip_reasons(found, [("exists", F.col("_known")), *[(n, F.col(f"_{n}")) for n in tests]]).drop(
        "_known", *[f"_{n}" for n in tests])


def wanted(jobs: DataFrame, published: DataFrame, edition: Edition, as_of) -> DataFrame:
    """The postings `judged` gives no reason to skip; what a scan can decide is decided before the join."""
    tests = _tests(edition, as_of)
    rows = jobs.where("is_active").where(~tests["old"]).where(~tests["short"])  # dates first: texts are read for fresh rows only
    return new_only(rows, _known(published, edition), "id")


def counts(jobs: DataFrame, published: DataFrame, edition: Edition, as_of) -> DataFrame:
    return reason_counts(judged(jobs, published, edition, as_of))


def departments(rows: DataFrame, edition: Edition, categories: DataFrame | None = None, vec: str | None = None,
                to: str = "department_label") -> DataFrame:
    """Department by rules, then wording, then nearest category, then the default."""
    text = first_nonempty("department", "title")
    rows = rows.withColumn(to, F.when(nonblank(text).isNotNull(), rules.first_match(text, edition.rules)))
    # the costlier steps see only postings no earlier step has named
    if edition.wording:
        rows = rows.withColumn("_open", F.when(F.col(to).isNull(), nonblank(text)))
        rows = map_distinct(rows, "_open", lambda t: t.withColumn("_worded", closest_wording("_open", edition.wording)), "_worded")
        rows = rows.withColumn(to, F.coalesce(to, "_worded")).drop("_open", "_worded")
    if categories is not None and vec is not None:
        open_vec = F.when(F.col(to).isNull() & nonblank(text).isNotNull(), F.col(vec))
        rows = nearest(rows.withColumn("_vec", open_vec), "_vec", categories, edition.similar, to="_near_label")
        rows = rows.withColumn(to, F.coalesce(to, "_near_label")).drop("_vec", "_near_label")
    return rows.withColumn(to, F.coalesce(to, F.lit(edition.default)))


def publishable(jobs: DataFrame, published: DataFrame, edition: Edition, as_of, tracking: str,
                bare_host: str | None = None, parents: DataFrame | None = None,
                categories: DataFrame | None = None, vec: str | None = None, key: str = "scrape_id") -> DataFrame:
    """New rows for the published table.

    `jobs` carries `candidate_description`, the cleaned description text. `parents` gives the
    company columns by `key` (see sources.tables.parents) and meets only postings that are
    kept; without it the postings carry them already.
    """
    rows = wanted(jobs, published, edition, as_of)
    if edition.india_only:
        rows = rows.where(rules.in_india("location"))
    body = sections("candidate_description") if edition.structured else F.col("candidate_description")
    body = F.when(F.length("original_description") >= 50, body)
    rows = computed(rows, body, "generated_description", lambda b: b != "")
    if parents is not None:
        rows = with_parents(rows, parents, key)
    rows = departments(rows, edition, categories, vec)
    resolved = F.col("resolved_location") if "resolved_location" in rows.columns else None
    place = F.col("location") if edition.plain_location else standard_location("location", edition.remote, resolved)
    out = rows.select(
        F.col("id").alias("job_id"), F.lit(edition.source).alias("source_table"), "company_name",
        tracked("company_url", tracking, bare_host).alias("company_website"),
        tracked("job_url", tracking, bare_host).alias("job_url"), "title",
        day_text(any_timestamp("published_date")).alias("published_at"),
        F.col("min_exp").try_cast("int").alias("min_ex"), F.col("max_exp").try_cast("int").alias("max_ex"),
        experience_label("min_exp", "max_exp").alias("experience_range"), place.alias("location"),
        rules.employment_class("job_type").alias("job_type"), F.col("company_logo").alias("logo_file"),
        slug("title", "company_name", "id").alias("internal_slug"), "generated_description",
        F.col("company_about").alias("company_description"), F.col("department_label").alias("department"), "industry",
        F.lit(False).alias("is_synced"))
    return out if edition.by_source else out.drop("source_table", "is_synced")


def publish(jobs, published, edition: Edition, as_of, tracking: str, **more) -> DataFrame:
    """The published table after retention (for editions that drop old rows) and the new rows."""
    kept = retain(published, "published_at", as_of, days=edition.days, months=edition.months) if edition.retains else published
    # no new row has a key the table holds, so adding them is the upsert
    return kept.unionByName(publishable(jobs, kept, edition, as_of, tracking, **more), allowMissingColumns=True)
