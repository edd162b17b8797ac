"""Tables: schemas, scans, parent lookups and writes."""

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gigloom.functions import fixed_values as V
from gigloom.functions.text import strip
from gigloom.operators.keys import lookup_join, salts_of

SCHEMAS = {
    "input_list": "id bigint, name string, domain string, description string, status string",
    "companies": "id string, created_at timestamp, updated_at timestamp, name string, homepage_url string, "
                 "careers_url string, logo_file_name string, description string, list_id bigint, status string",
    "ats_website": "id string, company_id string, ats_name string, ats_url string, code_name string",
    "scrapes": "id string, ats_website_id string, status string, created_at timestamp, updated_at timestamp, "
               "finished_at timestamp",
    "jobs": "id bigint, created_at timestamp, updated_at timestamp, scrape_id string, title string, job_url string, "
            "is_active boolean, published_date timestamp, job_type string, location string, "
            "original_description string, internal_slug string, min_exp int, max_exp int, department string, "
            "industry string",
    "companies_sustain": "id string, company_name string, jobs_page_url string, ats_detected string, "
                         "company_url string, logo_file_name string, description string",
    "jobs_sustain": "id bigint, company_sustain_id string, title string, job_url string, location string, "
                    "published_date date, job_type string, department string, industry string, min_exp int, "
                    "max_exp int, original_description string, is_active boolean",
    "jobs_uploadable_wp": "job_id bigint, source_table string, company_name string, company_website string, "
                          "job_url string, title string, published_at string, min_ex int, max_ex int, "
                          "experience_range string, location string, job_type string, logo_file string, "
                          "internal_slug string, generated_description string, company_description string, "
                          "department string, industry string, is_synced boolean",
    "pages": "page_id bigint, url string, html string",
    "redirects": "url string, final_url string",
    "requests": "page_id bigint, url string",
}
REQUISITIONS = (
    "struct<items:array<struct<SiteNumber:string,TotalJobsCount:int,requisitionList:array<struct<"
    "Id:string,Title:string,PrimaryLocation:string,PrimaryLocationCountry:string,WorkplaceType:string,"
    "PostedDate:string,ShortDescriptionStr:string,Department:string,Organization:string,JobType:string,"
    "JobSchedule:string,ContractType:string>>>>>")
REQUISITION_DETAILS = (
    "struct<items:array<struct<ExternalDescriptionStr:string,ShortDescriptionStr:string,Department:string,"
    "Organization:string,JobType:string,PrimaryLocation:string>>>")


def read(spark: SparkSession, table: str, path: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[table]).parquet(live(spark, path))


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """Exactly the columns of a schema: absent ones as typed nulls, the rest cast and ordered."""
    wanted = [(c.split(" ", 1)[0], c.split(" ", 1)[1]) for c in ddl.split(", ")]
    return df.select(*[(F.col(n) if n in df.columns else F.lit(None)).cast(t).alias(n) for n, t in wanted])


# --- scans ---------------------------------------------------------------------------

def pending(df: DataFrame, marker: str) -> DataFrame:
    return df.where(F.col(marker).isNull())


def _named(column: str, wanted: str, match: str):
    name = F.coalesce(F.col(column), F.lit(""))
    if match == "eq":
        return F.lower(strip(name)) == wanted.lower()
    if match == "contains_cs":
        return name.contains(wanted)
    return F.lower(name).contains(wanted.lower())


def boards(ats_website: DataFrame, ats: str, match: str = "eq") -> DataFrame:
    """Boards of one platform."""
    return ats_website.where(_named("ats_name", ats, match))


def targets(companies: DataFrame, ats: str, without: str | None = None) -> DataFrame:
    """Companies with a board address on a platform: (company_sustain_id, company, url)."""
    on = _named("ats_detected", ats, "contains")
    if without:
        on = on & ~_named("ats_detected", without, "contains")
    url = strip(F.coalesce(F.col("jobs_page_url"), F.lit("")))
    name = F.when(F.coalesce(F.col("company_name"), F.lit("")) == "", V.UNKNOWN_COMPANY).otherwise(F.col("company_name"))
    return companies.where(on & (url != "")).select(
        F.col("id").alias("company_sustain_id"), strip(name).alias("company"), url.alias("url"))


def key_set(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).where(F.col(key).isNotNull() & (F.col(key) != "")).distinct()


def parents(scrapes: DataFrame, ats_website: DataFrame, companies: DataFrame | None = None,
            how: str = "left") -> DataFrame:
    """scrape_id with its platform and, optionally, its company, as one lookup table.

    The parents are joined to each other first, so postings meet them in a single join.
    """
    up = scrapes.select(F.col("id").alias("scrape_id"), F.col("ats_website_id").alias("_ats"))
    ats = ats_website.select(F.col("id").alias("_ats"), "ats_name", F.col("company_id").alias("_co"))
    chain = lookup_join(up, ats, ["_ats"], how)
    if companies is not None:
        co = companies.select(F.col("id").alias("_co"), F.lit(True).alias("company_found"),
                              F.col("name").alias("company_name"), F.col("homepage_url").alias("company_url"),
                              F.col("logo_file_name").alias("company_logo"),
                              F.col("description").alias("company_about"))
        chain = lookup_join(chain, co, ["_co"], how)
    return chain.drop("_ats", "_co")


def with_parents(jobs: DataFrame, lookup: DataFrame, key: str = "scrape_id", how: str = "left",
                 salts: int | None = None) -> DataFrame:
    """Postings with parent columns; a posting without a company gets the default name.

    A third of all postings may hang on one scrape: its postings are shared by `salts` tasks.
    """
    out = lookup_join(jobs, lookup, key, how, salts=salts or salts_of(jobs))
    if "company_found" in out.columns:
        out = out.withColumn("company_name", F.when(F.col("company_found").isNull(), V.UNKNOWN_COMPANY)
                             .otherwise(F.col("company_name"))).drop("company_found")
    return out


def pending_jobs(jobs: DataFrame, scrapes: DataFrame, ats_website: DataFrame, ats: str, match: str = "contains",
                 how: str = "left") -> DataFrame:
    """Postings of one platform still without a description."""
    mine = ats_website.where(_named("ats_name", ats, match))
    wanted = parents(scrapes, mine, how="inner")
    return with_parents(pending(jobs, "original_description"), wanted, how="inner")


def export_rows(jobs: DataFrame, scrapes: DataFrame, ats_website: DataFrame, ats: str | None = None) -> DataFrame:
    """All postings with their platform name, optionally of one platform only."""
    out = with_parents(jobs, parents(scrapes, ats_website))
    return out if ats is None else out.where(_named("ats_name", ats, "contains"))


# --- writes --------------------------------------------------------------------------

def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(live(df.sparkSession, path))


def export_csv(df: DataFrame, path: str, by: str | None = None, mode: str = "overwrite") -> None:
    out = df.write.mode(mode).option("header", True)
    (out.partitionBy(by) if by else out).csv(path)


def _versions(spark: SparkSession, path: str) -> list[str]:
    """Complete versions of a replaced table, oldest first: a version counts once its writer has left _SUCCESS in it."""
    top = f"{path}/_versions"
    if not exists(spark, top):
        return []
    where = spark._jvm.org.apache.hadoop.fs.Path(top)
    names = [x.getPath().getName() for x in where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where)]
    return [f"{top}/{n}" for n in sorted(names) if exists(spark, f"{top}/{n}/_SUCCESS")]


def live(spark: SparkSession, path: str) -> str:
    """The folder with a table's contents: its newest complete version, or the path itself if it was never replaced."""
    return ([path] + _versions(spark, path))[-1]


def replace(df: DataFrame, path: str) -> None:
    """Write the table's next contents as a new version, which readers of `live` see once it is complete.

    `df` may read the table: the version before stays, for readers that have begun; older ones go.
    """
    spark = df.sparkSession
    done = _versions(spark, path)
    number = int(done[-1].rsplit("/v", 1)[1].split("-")[0]) + 1 if done else 1
    df.write.parquet(f"{path}/_versions/v{number:08d}-{uuid4().hex}")
    for old in done[:-1]:
        where = spark._jvm.org.apache.hadoop.fs.Path(old)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
