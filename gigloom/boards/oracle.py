"""Oracle (one-pass): landed requisition and detail JSON instead of pages."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gigloom.functions import dates, rules, urls
from gigloom.functions.text import clean, first_nonempty, let, nonempty
from gigloom.operators.coverage import gaps
from gigloom.operators.keys import lookup_join, salts_of
from gigloom.sources.pages import joined, nodes
from gigloom.sources.tables import REQUISITION_DETAILS, REQUISITIONS

PAGE = 100  # requisitions that a listing request asks for


def json_rows(df: DataFrame, column: str, schema: str, path: Column) -> DataFrame:
    """Parse a JSON text column and give one row per element of the array at `path`.

    `path` is built from the column named `_json`; unreadable text gives no rows.
    """
    rest = [c for c in df.columns if c != column]
    parsed = df.withColumn("_json", F.from_json(column, schema))
    return parsed.select(*rest, F.explode(path).alias("_row")).select(*rest, "_row.*")


def requisitions(listings: DataFrame) -> DataFrame:
    """(api_base, site_name, offset, body) to listed requisitions with the site's own number."""
    top = F.get(F.col("_json.items"), F.lit(0))
    parsed = listings.withColumn("_json", F.from_json("body", REQUISITIONS)).withColumn("_top", top)
    numbers = parsed.where((F.col("offset") == 0) & nonempty(F.col("_top.SiteNumber")).isNotNull()).groupBy(
        "api_base", "site_name").agg(F.max("_top.SiteNumber").alias("site_number"))
    rows = parsed.select("api_base", "site_name", "offset", F.posexplode("_top.requisitionList").alias("pos", "_r"))
    rows = rows.select("api_base", "site_name", "offset", "pos", "_r.*")
    return lookup_join(rows, numbers, ["api_base", "site_name"], salts=salts_of(rows), spread_by=["offset", "pos"]).withColumn(
        "site_number", F.coalesce("site_number", "site_name"))


def listing_gaps(listings: DataFrame, limit: int = PAGE) -> DataFrame:
    """api_base, site_name, total, from_position, to_position: the requisitions of each site that no landed page lists.

    A page lists `limit` requisitions from its offset on, as the next page is asked for at offset + limit; one that lists none
    or can't be read covers nothing. The site's count is the largest that its pages tell; sites that tell none aren't judged.
    """
    top = F.get(F.from_json("body", REQUISITIONS)["items"], F.lit(0))
    told = listings.select("api_base", "site_name", F.col("offset").cast("long").alias("start"), top.alias("_top")).select(
        "api_base", "site_name", "start", F.when(F.size("_top.requisitionList") > 0, F.col("start") + limit).alias("stop"),
        F.col("_top.TotalJobsCount").alias("total"))
    return gaps(told, ["api_base", "site_name"])


def listed(listings: DataFrame, keep=rules.is_green_title, country: str | None = "IN") -> DataFrame:
    """Requisitions that pass the title and country gates, with their public address."""
    r = requisitions(listings)
    title = clean("Title")
    r = r.where((title != "") & keep(title))
    if country:
        r = r.where(rules.country_gate("PrimaryLocationCountry", country))
    job = F.coalesce("Id", F.lit(""))
    return r.select(
        "api_base", "site_name", "site_number", "offset", "pos", job.alias("job_id"),
        urls.requisition_url("api_base", "site_name", job).alias("job_url"), title.alias("title"),
        nonempty(clean("PrimaryLocation")).alias("location"), nonempty(clean("WorkplaceType")).alias("workplace_type"),
        dates.leading_date("PostedDate").alias("published_date"),
        nonempty(clean("ShortDescriptionStr")).alias("short_description"),
        nonempty(clean("Department")).alias("department"), nonempty(clean("Organization")).alias("organization"),
        nonempty(clean("JobType")).alias("job_type"), nonempty(clean("JobSchedule")).alias("job_schedule"),
        nonempty(clean("ContractType")).alias("contract_type"))


def detail(bodies: DataFrame) -> DataFrame:
    """(api_base, job_id, body) to detail fields; descriptions lose their markup."""
    parsed = bodies.select("api_base", "job_id", F.get(F.from_json("body", REQUISITION_DETAILS)["items"], F.lit(0)).alias("d"))
    said = parsed.where(F.col("d").isNotNull()).select(
        "api_base", "job_id",
        first_nonempty("d.ExternalDescriptionStr", "d.ShortDescriptionStr").alias("markup"),
        *[nonempty(clean(F.col("d")[f])).alias(n) for f, n in [
            ("Department", "d_department"), ("Organization", "d_organization"), ("JobType", "d_job_type"),
            ("PrimaryLocation", "d_location")]])
    return said.withColumn("d_description", nonempty(let(nodes("markup"), lambda d: joined(d, "\n")))).drop("markup")


def merged(listing: DataFrame, details: DataFrame, extra=()) -> DataFrame:
    """Detail fields win, listed ones fill; organization stands for department when given. `extra` columns of the listing stay."""
    out = lookup_join(listing, details, ["api_base", "job_id"])
    return out.select(
        *[c for c in ("company_sustain_id", *extra) if c in out.columns],
        "title", "job_url", F.coalesce("d_location", "location").alias("location"),
        F.coalesce("d_organization", "organization", "d_department", "department").alias("department"),
        F.coalesce("d_job_type", "job_type", "job_schedule", "contract_type").alias("job_type"),
        "published_date", F.coalesce("d_description", "short_description").alias("original_description"),
        F.lit(True).alias("is_active"))
