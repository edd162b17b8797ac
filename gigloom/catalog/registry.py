"""Registered queries: a Spark query over the driver's tables and, where SQL can say it, the same in ANSI SQL."""

from pyspark.sql import DataFrame, SparkSession

from gigloom.session import dealt_out

QUERIES: dict = {}
ORACLES: dict = {}

AS_OF = "2024-06-15 12:00:00"


def query(sql: str | None = None, name: str | None = None):
    def register(fn):
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"{key} is registered twice")
        QUERIES[key] = fn
        if sql:
            ORACLES[key] = sql
        return fn
    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def dealt(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table for costly expressions, dealt out over the tasks of a shuffle where its files make fewer."""
    return dealt_out(table(spark, sf, name))


class Shape:
    """A reshaping of one driver table that reads the same in Spark SQL and DuckDB."""

    def __init__(self, source: str, **columns: str):
        self.source, self.columns = source, columns

    def df(self, spark, sf, deal: bool = False) -> DataFrame:
        return (dealt if deal else table)(spark, sf, self.source).selectExpr(*[f"{e} AS {n}" for n, e in self.columns.items()])

    def sql(self) -> str:
        return "(SELECT " + ", ".join(f"{e} AS {n}" for n, e in self.columns.items()) + f" FROM {self.source})"


# The tables of the job-posting model, read out of the star schema:
# postings are orders, scrape runs customers, boards nations, companies regions.
JOBS = Shape(
    "orders", id="o_orderkey", scrape_id="CAST(o_custkey AS STRING)",
    title="CASE o_orderpriority WHEN '1-URGENT' THEN 'Solar Design Engineer' WHEN '2-HIGH' THEN 'Data Analyst'"
          " WHEN '3-MEDIUM' THEN 'Safety Officer' WHEN '4-NOT SPECIFIED' THEN NULL ELSE 'Accountant' END",
    job_url="CASE WHEN o_orderstatus = 'P' THEN NULL ELSE concat('https://jobs.example.com/', CAST(o_orderkey AS STRING)) END",
    is_active="o_orderstatus <> 'F'", published_date="o_orderdate", job_type="o_orderpriority",
    location="CASE WHEN o_totalprice > 250000 THEN '' WHEN o_totalprice > 50000 THEN 'Pune, India' END",
    original_description="CASE WHEN o_orderstatus = 'O' THEN concat('Order ', CAST(o_orderkey AS STRING)) END",
    min_exp="CAST(o_custkey % 7 AS INT)", max_exp="CASE WHEN o_custkey % 3 > 0 THEN CAST(o_custkey % 11 AS INT) END")
SCRAPES = Shape("customer", id="CAST(c_custkey AS STRING)",
                ats_website_id="CASE WHEN c_acctbal >= 0 THEN CAST(c_nationkey AS STRING) END", status="c_mktsegment")
BOARDS = Shape("nation", id="CAST(n_nationkey AS STRING)",
               company_id="CASE WHEN n_nationkey <> 3 THEN CAST(n_regionkey AS STRING) END",
               ats_name="concat(CASE WHEN n_nationkey % 2 = 0 THEN ' ' ELSE '' END, n_name)",
               ats_url="CASE WHEN n_nationkey % 5 > 0 THEN concat('https://n', CAST(n_nationkey AS STRING), '.example.com') END")
COMPANIES = Shape("region", id="CAST(r_regionkey AS STRING)", name="r_name",
                  homepage_url="concat('https://', lower(r_name), '.example.com')", logo_file_name="concat(r_name, '.png')",
                  description="concat('All of ', r_name)")
GREEN_COMPANIES = Shape(
    "supplier", id="CAST(s_suppkey AS STRING)", company_name="CASE WHEN s_nationkey % 4 > 0 THEN s_name END",
    jobs_page_url="CASE WHEN s_nationkey % 6 = 0 THEN '  ' ELSE concat(' https://s', CAST(s_suppkey AS STRING), '.example.com ') END",
    ats_detected="CASE s_nationkey % 5 WHEN 0 THEN 'Keka' WHEN 1 THEN 'OracleCloud' WHEN 2 THEN 'Oracle HCM / oraclecloud'"
                 " WHEN 3 THEN 'keka, lever' END")
