"""Scans, parents, projections."""

from pyspark.sql import functions as F

from gigloom.catalog.registry import BOARDS, COMPANIES, GREEN_COMPANIES, JOBS, SCRAPES, Shape, query, table
from gigloom.functions.text import first_nonempty, no_nan, nonblank, not_missing, strip
from gigloom.functions import rules as R
from gigloom.functions import urls
from gigloom.operators.keys import new_only
from gigloom.sources import pages as P
from gigloom.sources import tables as T

LIST = Shape("orders", id="o_orderkey", name="CASE WHEN o_orderpriority = '5-LOW' THEN ' ' ELSE o_orderpriority END",
             domain="CASE WHEN o_totalprice < 100000 THEN NULL ELSE concat('d', CAST(o_custkey AS STRING)) END",
             status="nullif(o_orderstatus, 'P')")


@query(f"SELECT id, name, domain FROM {LIST.sql()} WHERE status IS NULL AND trim(name) <> '' AND trim(domain) <> ''")
def pending_scan(spark, sf):
    rows = T.pending(LIST.df(spark, sf), "status")
    return rows.where((strip("name") != "") & (strip("domain") != "") & F.col("id").isNotNull()).select("id", "name", "domain")


@query(f"SELECT DISTINCT company_id FROM {BOARDS.sql()} WHERE company_id IS NOT NULL")
def matched_company_keys(spark, sf):
    return T.key_set(BOARDS.df(spark, sf), "company_id")


@query("SELECT s_suppkey AS id, s_name AS name, s_acctbal AS homepage_url FROM supplier")
def company_projection(spark, sf):
    return table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                                               F.col("s_acctbal").alias("homepage_url"))


SEGMENTS = Shape("customer", id="c_custkey", ats_name="concat(' ', c_mktsegment, ' ')",
                 ats_url="CASE WHEN c_nationkey % 4 = 0 THEN ' ' WHEN c_nationkey % 4 = 1 THEN NULL ELSE c_name END")


@query(f"SELECT id, ats_url FROM {SEGMENTS.sql()} WHERE lower(trim(ats_name)) = 'machinery' AND trim(ats_url) <> ''")
def board_scan(spark, sf):
    return T.boards(SEGMENTS.df(spark, sf), "Machinery").where(nonblank("ats_url").isNotNull()).select("id", "ats_url")


@query(f"SELECT id FROM {SEGMENTS.sql()} WHERE lower(ats_name) LIKE '%u%'")
def board_scan_contains(spark, sf):
    return T.boards(SEGMENTS.df(spark, sf), "U", "contains").select("id")


@query(f"SELECT id FROM {SEGMENTS.sql()} WHERE ats_name LIKE '%HOUSE%'")
def board_scan_case_sensitive(spark, sf):
    return T.boards(SEGMENTS.df(spark, sf), "HOUSE", "contains_cs").select("id")


def _targets(where):
    return f"""SELECT id AS company_sustain_id, trim(coalesce(company_name, 'Unknown')) AS company,
        trim(jobs_page_url) AS url FROM {GREEN_COMPANIES.sql()} WHERE {where} AND trim(jobs_page_url) <> ''"""


@query(_targets("lower(coalesce(ats_detected, '')) LIKE '%keka%'"))
def target_scan(spark, sf):
    return T.targets(GREEN_COMPANIES.df(spark, sf), "keka")


@query(_targets("lower(ats_detected) LIKE '%oraclecloud%' AND lower(ats_detected) NOT LIKE '%oracle hcm%'"))
def target_scan_without(spark, sf):
    return T.targets(GREEN_COMPANIES.df(spark, sf), "oraclecloud", without="oracle hcm")


@query(_targets("lower(ats_detected) LIKE '%oracle hcm%'"))
def target_scan_hcm(spark, sf):
    return T.targets(GREEN_COMPANIES.df(spark, sf), "oracle hcm")


def _pending(where):
    return f"""SELECT j.id, j.scrape_id, a.ats_name FROM {JOBS.sql()} j JOIN {SCRAPES.sql()} s ON j.scrape_id = s.id
        JOIN {BOARDS.sql()} a ON s.ats_website_id = a.id WHERE j.original_description IS NULL AND {where}"""


def _model(spark, sf):
    return JOBS.df(spark, sf), SCRAPES.df(spark, sf), BOARDS.df(spark, sf)


@query(_pending("lower(a.ats_name) LIKE '%nation_1%'"))
def pending_jobs(spark, sf):
    return T.pending_jobs(*_model(spark, sf), "Nation_1").select("id", "scrape_id", "ats_name")


@query(_pending("lower(trim(a.ats_name)) = 'nation_4'"))
def pending_jobs_equal(spark, sf):
    return T.pending_jobs(*_model(spark, sf), "nation_4", "eq").select("id", "scrape_id", "ats_name")


@query(_pending("a.ats_name LIKE '%NATION_2%'"))
def pending_jobs_case_sensitive(spark, sf):
    return T.pending_jobs(*_model(spark, sf), "NATION_2", "contains_cs").select("id", "scrape_id", "ats_name")


@query(f"SELECT DISTINCT job_url FROM {JOBS.sql()} WHERE job_url IS NOT NULL AND job_url <> ''")
def existing_keys(spark, sf):
    return T.key_set(JOBS.df(spark, sf), "job_url")


@query(f"""SELECT j.id, a.ats_name, CASE WHEN c.id IS NULL THEN 'Unknown' ELSE c.name END AS company_name,
    c.homepage_url AS company_url, c.logo_file_name AS company_logo, c.description AS company_about
    FROM {JOBS.sql()} j LEFT JOIN {SCRAPES.sql()} s ON j.scrape_id = s.id
    LEFT JOIN {BOARDS.sql()} a ON s.ats_website_id = a.id LEFT JOIN {COMPANIES.sql()} c ON a.company_id = c.id
    WHERE j.is_active""")
def active_with_parents(spark, sf):
    jobs, scrapes, boards = _model(spark, sf)
    found = T.with_parents(jobs.where("is_active"), T.parents(scrapes, boards, COMPANIES.df(spark, sf)))
    return found.select("id", "ats_name", "company_name", "company_url", "company_logo", "company_about")


@query(f"""SELECT l.l_orderkey AS id, l.l_linenumber AS line, coalesce(CASE WHEN c.id IS NULL THEN 'Unknown' ELSE c.company_name END, '-') AS company_name
    FROM lineitem l LEFT JOIN {GREEN_COMPANIES.sql()} c ON CAST(l.l_suppkey AS STRING) = c.id""")
def parents_one_level(spark, sf):
    co = GREEN_COMPANIES.df(spark, sf).select(F.col("id").alias("key"), "company_name", F.lit(True).alias("company_found"))
    jobs = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("line"),
                                               F.col("l_suppkey").cast("string").alias("key"))
    return T.with_parents(jobs, co, "key").select("id", "line", F.coalesce("company_name", F.lit("-")).alias("company_name"))


@query(f"""SELECT j.id, a.ats_name FROM {JOBS.sql()} j JOIN {SCRAPES.sql()} s ON j.scrape_id = s.id
    JOIN {BOARDS.sql()} a ON s.ats_website_id = a.id""")
def parents_inner(spark, sf):
    jobs, scrapes, boards = _model(spark, sf)
    return T.with_parents(jobs, T.parents(scrapes, boards, how="inner"), how="inner").select("id", "ats_name")


@query(f"""SELECT j.id, j.job_url, a.ats_name FROM {JOBS.sql()} j LEFT JOIN {SCRAPES.sql()} s ON j.scrape_id = s.id
    LEFT JOIN {BOARDS.sql()} a ON s.ats_website_id = a.id WHERE lower(a.ats_name) LIKE '%nation_2%'""")
def export_rows(spark, sf):
    return T.export_rows(*_model(spark, sf), "nation_2").select("id", "job_url", "ats_name")


@query("""SELECT o.o_orderkey AS id FROM orders o WHERE NOT EXISTS
    (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'R')""")
def published_anti(spark, sf):
    source = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.lit("R").alias("source_table"))
    seen = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_returnflag").alias("source_table"))
    return new_only(source, seen, ["id", "source_table"]).select("id")


@query("SELECT page_id, url FROM pages WHERE page_id % 4 <> 0")
def fetched_pages(spark, sf):
    pages = table(spark, sf, "pages").withColumn("status", F.when(F.col("page_id") % 4 == 0, 404).otherwise(200))
    return P.fetched(pages).select("page_id", "url")


@query("""SELECT c_custkey AS id, CAST(NULL AS TIMESTAMP) AS updated_at, c_name AS title, CAST(NULL AS STRING) AS department,
    CAST(c_nationkey AS INT) AS min_exp FROM customer""")
def conform_rows(spark, sf):
    raw = table(spark, sf, "customer").selectExpr("c_nationkey AS min_exp", "c_name AS title", "c_custkey AS id")
    return T.conform(raw, "id bigint, updated_at timestamp, title string, department string, min_exp int")


@query("""SELECT o_orderkey AS id, nullif(o_orderstatus, 'F') AS missing_text,
    coalesce(nullif(nullif(o_orderstatus, 'F'), ''), nullif(o_orderpriority, '5-LOW'), 'none') AS chosen,
    CASE WHEN o_totalprice >= 1000 THEN o_totalprice END AS price FROM orders""")
def missing_values(spark, sf):
    o = table(spark, sf, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "NA").otherwise(F.col("o_orderstatus"))
    low = F.when(F.col("o_orderpriority") == "5-LOW", "").otherwise(F.col("o_orderpriority"))
    price = F.when(F.col("o_totalprice") < 1000, F.lit(float("nan"))).otherwise(F.col("o_totalprice"))
    return o.select(F.col("o_orderkey").alias("id"), no_nan(price).alias("price"), not_missing(status).alias("missing_text"),
                    first_nonempty(not_missing(status), low, F.lit("none")).alias("chosen"))


@query("""SELECT page_id, url LIKE 'http%' AS fetchable, contains(lower(concat_ws(' ', url, html)), 'india') AS about
    FROM pages""")
def row_filters(spark, sf):
    return table(spark, sf, "pages").select("page_id", urls.looks_fetchable("url").alias("fetchable"),
                                            R.mentions("India", "url", "html").alias("about"))
