"""Whole runs per platform over rendered pages, with expected tables as SQL."""

from pyspark.sql import functions as F

from gigloom.boards import BOARDS, freshteam, oracle, zoho
from gigloom.boards.base import label_rows
from gigloom.catalog import platforms as C
from gigloom.catalog.expected import ENRICHED, ONE_PASS
from gigloom.catalog.registry import AS_OF, Shape, query, table
from gigloom.operators.keys import shuffled
from gigloom.plans import listing as plan
from gigloom.sources import tables as T

NOW = C.NOW
GATE = "regexp_matches(title, '\\bSolar\\b')"

# --- stage one: boards are parts, some postings are already known ---------------------------------

TWO_STAGE = ["darwinbox", "freshteam", "keka", "lever", "smartrecruiters", "workable", "zoho"]
POSTED = {"darwinbox": f"CASE WHEN posted IS NOT NULL THEN {C.AGO} END", "keka": f"CASE WHEN posted IS NOT NULL THEN {C.AGO} END",
          "workable": f"CASE WHEN posted IS NOT NULL THEN {C.AGO} END", "zoho": f"CASE WHEN posted IS NOT NULL THEN {C.US} END"}


def _known(name):
    """Addresses of the first cards of large parts count as already stored."""
    firsts = [c["job_url"] for pos, when, c in C.CARDS[name] if pos == 0]
    return "(SELECT DISTINCT u AS job_url FROM (" + " UNION ALL ".join(
        f"SELECT {C._inline(u, C.PARTS)} AS u FROM part WHERE p_size > 40" for u in dict.fromkeys(firsts)) + "))"


def _discover_sql(name):
    cols = {"title": "title", "job_url": "job_url", "is_active": "TRUE", "published_date": POSTED.get(name, "CAST(NULL AS TIMESTAMP)"),
            "job_type": "job_type", "location": "location", "department": "department"}
    return C.cards_sql(name, cols, f"WHERE job_url NOT IN (SELECT job_url FROM {_known(name)})")


def _board_rows(name):
    return Shape("part", id="CAST(p_partkey AS STRING)", ats_name=f"'{' ' + BOARDS[name].ats.title() + ' '}'",
                 ats_url=f"concat('{C.SITE}/list/', CAST(p_partkey AS STRING))")


def _register_discover(name):
    known = Shape("part", size="p_size", **{f"u{i}": C._inline(c["job_url"], C.PARTS) for i, (pos, _, c) in enumerate(C.CARDS[name]) if pos == 0})

    @query(_discover_sql(name), f"discover_{name}")
    def run(spark, sf):
        urls = known.df(spark, sf).where("size > 40")
        jobs = urls.select(F.explode(F.array(*[c for c in urls.columns if c != "size"])).alias("job_url"))
        pages = C.list_pages(name).df(spark, sf, deal=True).withColumnRenamed("id", "page_id")
        _, fresh = plan.discover(BOARDS[name], _board_rows(name).df(spark, sf), pages, jobs, AS_OF)
        return fresh.select("title", "job_url", "is_active", "published_date", "job_type", "location", "department")


def _register_status(name):
    lonely = "size % 7 = 0" if BOARDS[name].strict else "FALSE"

    @query(C._inline(f"SELECT CAST(id AS VARCHAR) AS ats_website_id, CASE WHEN {lonely} THEN 'failed' ELSE 'success' END AS status FROM part", C.PARTS), f"runs_{name}")
    def run(spark, sf):
        pages = C.list_pages(name).df(spark, sf, deal=True).withColumnRenamed("id", "page_id")
        sizes = table(spark, sf, "part").selectExpr("p_partkey AS page_id", "CASE WHEN p_size % 7 = 0 THEN 404 ELSE 200 END AS status")
        scrapes, _ = plan.discover(BOARDS[name], _board_rows(name).df(spark, sf), pages.join(shuffled(sizes), "page_id"),
                                   table(spark, sf, "part").selectExpr("p_name AS job_url"), AS_OF)
        return scrapes.select("ats_website_id", "status")


for _name in TWO_STAGE:
    _register_discover(_name)
for _name in ("lever", "keka"):
    _register_status(_name)


# a static capture of some boards is empty; the rendered capture then counts
KINDED = Shape("part", id="p_partkey", url=f"concat('{C.SITE}/list/', CAST(p_partkey AS STRING))", size="p_size",
               static=f"CASE WHEN p_size % 4 = 0 THEN '<p>loading</p>' ELSE {C._inline(C.LIST['zoho'], C.PARTS)} END",
               rendered=C._inline(C.h("<a class='zp_career_site_job_title' href='/r/{id}'>{brand}</a><a href='/jobs/{id}'>{name}</a>"), C.PARTS))


@query(f"""SELECT page_id, title, job_url FROM ({C.cards_sql('zoho', {'page_id': 'page_id', 'size': 'size', 'title': 'title', 'job_url': 'job_url'})}) WHERE size % 4 <> 0
    UNION ALL SELECT p_partkey, p_brand, '{C.SITE}/r/' || p_partkey FROM part WHERE p_size % 4 = 0""")
def capture_fallback(spark, sf):
    p = KINDED.df(spark, sf, deal=True)
    pages = p.select(F.col("id").alias("page_id"), "url", F.explode(F.array(
        F.struct(F.lit("static").alias("kind"), F.col("static").alias("html")),
        F.struct(F.lit("rendered").alias("kind"), F.col("rendered").alias("html")))).alias("k")).select("page_id", "url", "k.*")
    return plan.read_listing(zoho.BOARD, pages).select("page_id", "title", "job_url")


# --- stage two: postings are documents ---------------------------------------------------------------

JOBS = Shape("documents", id="doc_id", created_at="CAST('2024-01-01 00:00:00' AS TIMESTAMP)", updated_at="CAST('2024-01-01 00:00:00' AS TIMESTAMP)",
             scrape_id="CAST(n_chars % 50 AS STRING)", title="'old title'",
             job_url="CASE WHEN doc_id % 10 = 9 THEN 'ftp://x' ELSE concat('https://d.example.com/', CAST(doc_id AS STRING)) END",
             location="CASE WHEN doc_id % 2 = 0 THEN 'Old place' END", job_type="CASE WHEN doc_id % 3 = 0 THEN 'Old type' END",
             original_description="CASE WHEN doc_id % 6 = 5 THEN 'done' END", min_exp="CAST(NULL AS INT)", max_exp="CAST(NULL AS INT)",
             department="CASE WHEN doc_id % 2 = 1 THEN 'Old team' END", industry="CAST(NULL AS STRING)",
             published_date="CASE WHEN doc_id % 4 = 0 THEN CAST('2023-03-03 00:00:00' AS TIMESTAMP) END")
RUNS = Shape("nation", id="CAST(n_nationkey AS STRING)", ats_website_id="CAST(n_nationkey % 5 AS STRING)")


def _ats(name):
    label = {"smartrecruiters": "SmartRecruiters"}.get(name, BOARDS[name].ats.title())
    return Shape("region", id="CAST(r_regionkey AS STRING)", company_id="r_name",
                 ats_name=f"CASE WHEN r_regionkey = 4 THEN 'Other' ELSE '{label}' END")


EXPERIENCE = {"darwinbox": ("years", "14"), "keka": ("years", "NULL"), "zoho": ("years", "years")}
PUBLISHED = {"darwinbox": f"{NOW} - to_days(day_ago)", "freshteam": "TIMESTAMP '2024-05-01 04:30:00'", "zoho": C.US_TOLD}
FILLED = {("keka", "location"): "coalesce(j.location, d.location)",
          ("lever", "job_type"): "CASE WHEN coalesce(d.job_type, j.job_type) = 'Full-time' THEN 'Full time' ELSE coalesce(d.job_type, j.job_type) END"}
WRITTEN = ["title", "location", "job_type", "original_description", "min_exp", "max_exp", "department", "industry", "published_date"]


def _enrich_sql(name):
    want, tells = ENRICHED[name], C.TELLS[name]
    said = {f: tells.get(f, "CAST(NULL AS VARCHAR)") for f in ("title", "location", "job_type", "department", "industry", "original_description")}
    if name == "zoho":
        said["department"] = "CAST(NULL AS VARCHAR)"
    said["min_exp"], said["max_exp"] = (f"CAST({x} AS INT)" for x in EXPERIENCE.get(name, ("NULL", "NULL")))
    said["published_date"] = PUBLISHED.get(name, "CAST(NULL AS TIMESTAMP)")
    told = ", ".join(f"{C._inline(e, C.DOCS)} AS {f}" for f, e in said.items())
    # runs 20 and up belong to no known board, and board 4 is another platform
    run = "CAST(j.scrape_id AS INT) < 25 AND CAST(j.scrape_id AS INT) % 5 <> 4"
    hit = f"j.original_description IS NULL AND j.job_url LIKE 'http%' AND {run}"
    if want["needs_description"]:
        hit += " AND d.original_description IS NOT NULL"
    outs = []
    for f in WRITTEN:
        new = FILLED.get((name, f), f"coalesce(d.{f}, j.{f})") if f in want["patched"] else f"j.{f}"
        outs.append(f"CASE WHEN {hit} THEN {new} ELSE j.{f} END AS {f}")
    if want["stamped"] == "always":
        stamped = hit
    else:
        stamped = f"{hit} AND coalesce(" + ", ".join(
            f"CAST({'d.' + f if f in ('title', 'original_description', 'min_exp', 'max_exp', 'published_date', 'industry') else f'coalesce(d.{f}, j.{f})'} AS VARCHAR)" for f in want["patched"]) + ") IS NOT NULL"
    return f"""WITH j AS {JOBS.sql()}, d AS (SELECT doc_id AS id, {told} FROM documents)
        SELECT j.id, {', '.join(outs)}, CASE WHEN {stamped} THEN {NOW} ELSE j.updated_at END AS updated_at FROM j JOIN d ON j.id = d.id"""


def _register_enrich(name):
    @query(_enrich_sql(name), f"enrich_{name}")
    def run(spark, sf):
        jobs = JOBS.df(spark, sf)
        pages = C.detail_pages(name).df(spark, sf).withColumnRenamed("job_url", "url").withColumnRenamed("id", "page_id")
        return plan.enrich_pending(BOARDS[name], jobs, RUNS.df(spark, sf), _ats(name).df(spark, sf), pages, AS_OF).select(
            "id", *WRITTEN, "updated_at")


for _name in TWO_STAGE:
    _register_enrich(_name)


@query(_enrich_sql("lever"))
def enrich_recaptured(spark, sf):
    """Every page has an older capture that says something else, under a larger id."""
    new = C.detail_pages("lever").df(spark, sf).withColumnRenamed("job_url", "url").withColumnRenamed("id", "page_id")
    old = new.withColumns({"page_id": F.col("page_id") + 10**9, "html": F.regexp_replace("html", "[a-m]([a-z])", "$1$1"),
                           "fetched_at": F.lit("2024-06-01 00:00:00").cast("timestamp")})
    pages = new.withColumn("fetched_at", F.lit("2024-06-02 00:00:00").cast("timestamp")).unionByName(old)
    return plan.enrich_pending(BOARDS["lever"], JOBS.df(spark, sf), RUNS.df(spark, sf), _ats("lever").df(spark, sf), pages, AS_OF).select(
        "id", *WRITTEN, "updated_at")


# --- one pass: companies and postings are parts ----------------------------------------------------------

def _once_rows(name):
    """First cards of a listing that pass the gate, one per part."""
    first = {}
    for pos, when, card in C.CARDS[name]:
        if "name" in card["title"]:
            first.setdefault(when, card)
    return first


ONCE_URL = {"keka": f"'{C.SITE}/careers/jobdetails/' || id"}
ONCE = list(BOARDS)
LISTED_ONCE_FIRST = {"darwinbox": {"location", "job_type", "department", "published_date"}, "keka": {"location", "job_type"}}
ONCE_POSTED = {"darwinbox": f"CAST({C.AGO} AS DATE)", "keka": f"CAST({C.AGO} AS DATE)", "workable": f"CAST({C.AGO} AS DATE)",
               "eightfold": f"CAST({C.AGO} AS DATE)", "zoho": f"CAST({C.US} AS DATE)"}
ONCE_TOLD = {"darwinbox": f"CAST({NOW} - to_days(day_ago) AS DATE)", "eightfold": f"CAST({NOW} - to_days(day_ago) AS DATE)",
             "workday": f"CAST({NOW} - to_days(day_ago) AS DATE)", "zoho": f"CAST({C.US_TOLD} AS DATE)", "freshteam": "DATE '2024-05-01'"}
HAS_PAGE = "size % 5 <> 0"
ONCE_COLS = ["company_sustain_id", "title", "job_url", "location", "published_date", "job_type", "department", "industry", "min_exp", "max_exp",
             "original_description", "is_active"]
ALL = {**C.PART_TOLD, **{k: v for k, v in C.PARTS.items() if k not in C.PART_TOLD}}


def _once_sql(name):
    want = ONE_PASS[name]
    tells = dict(C.TELLS[name])
    if name == "darwinbox":
        tells["location"] = "'First'"
    tells = {f: C._inline(e, C.PART_TOLD) for f, e in tells.items()}
    has_page, nothing = C._inline(HAS_PAGE, C.PARTS), "CAST(NULL AS VARCHAR)"
    selects = []
    for when, card in _once_rows(name).items():
        card = {f: C._inline(e, C.PARTS) for f, e in card.items()}
        out = {"company_sustain_id": "CAST(p_partkey AS VARCHAR)", "is_active": "TRUE", "title": card["title"],
               "job_url": C._inline(ONCE_URL[name], C.PARTS) if name in ONCE_URL else card["job_url"]}
        listed = {f: card.get(f, nothing) if f in want["listed"] else nothing for f in ("location", "job_type", "department")}
        dated = "posted" in card and "published_date" in want["listed"]
        listed["published_date"] = C._inline(ONCE_POSTED.get(name, "CAST(NULL AS DATE)") if dated else "CAST(NULL AS DATE)", C.PARTS)
        told = {f: tells.get(f, nothing) for f in ("location", "job_type", "department", "industry")}
        told["published_date"] = C._inline(ONCE_TOLD.get(name, "CAST(NULL AS DATE)"), C.PART_TOLD)
        for f in ("location", "job_type", "department", "published_date"):
            mine, their = listed[f], f"CASE WHEN {has_page} THEN {told[f]} END"
            out[f] = {"detail": f"coalesce({their}, {mine})", "listing": f"coalesce({mine}, {their})", "listing_only": mine,
                      "detail_only": their}[want["wins"].get(f, "detail")]
        out["industry"] = f"CASE WHEN {has_page} THEN {told['industry']} END"
        low, high = ("years", "years") if name == "lever" else EXPERIENCE.get(name, ("NULL", "NULL"))
        out["min_exp"], out["max_exp"] = (
            f"CAST(CASE WHEN {has_page} THEN {C._inline(x, C.PART_TOLD)} END AS INT)" for x in (low, high))
        failed = f"'{want['failed']}'" if want["failed"] else "NULL"
        out["original_description"] = f"CASE WHEN {has_page} THEN {tells['original_description']} ELSE {failed} END"
        if "title" in tells:
            out["title"] = f"CASE WHEN {has_page} THEN {tells['title']} ELSE {card['title']} END"
        known = "TRUE" if want["again"] else "p_size % 11 <> 0"
        if want["skips_failed"]:
            known += f" AND {has_page}"
        cols = ", ".join(f"{out[c]} AS {c}" for c in ONCE_COLS)
        selects.append(f"SELECT {cols} FROM part WHERE ({C._inline(when, C.PARTS)}) AND p_size % 3 = 0 AND {known}")
    return " UNION ALL ".join(selects)


def _register_once(name):
    board = BOARDS[name]
    companies = Shape("part", id="CAST(p_partkey AS STRING)", company_name="p_name", ats_detected=f"'on {(board.ats_once or board.ats).upper()}'",
                      jobs_page_url=f"concat(' {C.SITE}/list/', CAST(p_partkey AS STRING))")
    links = _once_rows(name)
    address = "CASE " + " ".join(f"WHEN {w} THEN {ONCE_URL.get(name, c['job_url'])}" for w, c in links.items()) + " ELSE concat('none', CAST(id AS STRING)) END"
    told = Shape("part", page_id="p_partkey", url=C._inline(address, ALL), html=C._inline(C.DETAILS[name], C.PART_TOLD), size="p_size")

    @query(_once_sql(name), f"once_{name}")
    def run(spark, sf):
        details = told.df(spark, sf)
        pages = C.list_pages(name).df(spark, sf, deal=True).withColumnRenamed("id", "page_id").unionByName(
            details.where("size % 5 <> 0").drop("size"))
        known = details.where("size % 11 = 0").select(F.col("url").alias("job_url"))
        return plan.once(board, companies.df(spark, sf), pages, known, AS_OF).select(*ONCE_COLS)


for _name in ONCE:
    _register_once(_name)


@query("""SELECT o_orderkey AS id, coalesce('https://x/' || o_orderkey, '') AS job_url, CASE WHEN o_orderkey % 3 = 0 THEN 'new ' || o_orderkey ELSE o_orderpriority END AS title
    FROM orders UNION ALL SELECT -p_partkey, 'https://y/' || p_partkey, p_name FROM part""")
def save_once(spark, sf):
    o = table(spark, sf, "orders").selectExpr("o_orderkey AS id", "concat('https://x/', o_orderkey) AS job_url", "o_orderpriority AS title")
    again = o.where("id % 3 = 0").selectExpr("-1000000 - id AS id", "job_url", "concat('new ', id) AS title")
    new = table(spark, sf, "part").selectExpr("-p_partkey AS id", "concat('https://y/', p_partkey) AS job_url", "p_name AS title")
    return plan.save_once(o, again.unionByName(new))


# --- JSON ---------------------------------------------------------------------------------------------------

SITE_JSON = Shape(
    "supplier", id="CAST(s_suppkey AS STRING)", company_name="s_name", ats_detected="CASE WHEN s_nationkey % 2 = 0 THEN 'OracleCloud' ELSE 'Oracle HCM' END",
    jobs_page_url="concat('https://h', CAST(s_suppkey AS STRING), '.fa.us2.oraclecloud.com/hcmUI/sites/Careers', CAST(s_nationkey AS STRING), '/jobs')",
    api_base="concat('https://h', CAST(s_suppkey AS STRING), '.fa.', CASE WHEN s_nationkey % 3 = 0 THEN 'ocs' ELSE 'us2' END, '.oraclecloud.com')",
    site_name="concat('Careers', CAST(s_nationkey AS STRING))", site_number="concat('CX_', CAST(s_nationkey AS STRING))", nation="s_nationkey")
LISTING_BODY = """to_json(named_struct('items', array(named_struct('SiteNumber', site_number, 'TotalJobsCount', 3, 'requisitionList', array(
    named_struct('Id', concat(id, '1'), 'Title', concat('Solar  Lead ', id), 'PrimaryLocation', 'Pune', 'PrimaryLocationCountry', 'in', 'PostedDate', '2024-05-06T01:02', 'ShortDescriptionStr', 'short', 'Department', 'Dept', 'JobSchedule', 'Shift', 'ContractType', ''),
    named_struct('Id', concat(id, '2'), 'Title', 'ESG Analyst', 'PrimaryLocation', '', 'PrimaryLocationCountry', 'US', 'PostedDate', 'x', 'ShortDescriptionStr', '', 'Department', '', 'JobSchedule', '', 'ContractType', ''),
    named_struct('Id', concat(id, '3'), 'Title', 'ESG Analyst', 'PrimaryLocation', '', 'PrimaryLocationCountry', '', 'PostedDate', 'x', 'ShortDescriptionStr', ' brief ', 'Department', '', 'JobSchedule', '', 'ContractType', 'Fixed'),
    named_struct('Id', concat(id, '4'), 'Title', 'Accountant', 'PrimaryLocation', '', 'PrimaryLocationCountry', 'IN', 'PostedDate', 'x', 'ShortDescriptionStr', '', 'Department', '', 'JobSchedule', '', 'ContractType', ''))))))"""
DETAIL_BODY = """to_json(named_struct('items', array(named_struct('ExternalDescriptionStr', '<p>One</p><ul><li>Two &amp; three</ul>', 'Organization', concat('Org ', id), 'JobType', '', 'PrimaryLocation', ' '))))"""


def _requisitions(spark, sf):
    s = SITE_JSON.df(spark, sf)
    listings = s.selectExpr("api_base", "site_name", "0 AS offset", f"{LISTING_BODY} AS body")
    bodies = s.where("nation % 4 = 0").selectExpr("api_base", "concat(id, '1') AS job_id", f"{DETAIL_BODY} AS body")
    return s, listings, bodies


REQ = "api_base || '/hcmUI/CandidateExperience/en/sites/' || site_name || '/job/' || id || "


def _oracle_sql(where):
    return f"""SELECT id AS company_sustain_id, 'Solar Lead ' || id AS title, {REQ}'1' AS job_url, 'Pune' AS location,
        CASE WHEN nation % 4 = 0 THEN 'Org ' || id ELSE 'Dept' END AS department, 'Shift' AS job_type, DATE '2024-05-06' AS published_date,
        CASE WHEN nation % 4 = 0 THEN 'One' || chr(10) || 'Two & three' ELSE 'short' END AS original_description FROM {SITE_JSON.sql()} WHERE {where}
        UNION ALL SELECT id, 'ESG Analyst', {REQ}'3', NULL, NULL, 'Fixed', NULL, 'brief' FROM {SITE_JSON.sql()} WHERE {where} AND nation % 6 <> 0"""


def _once_oracle(spark, sf, hcm):
    s, listings, bodies = _requisitions(spark, sf)
    seen = s.where("nation % 6 = 0").selectExpr("concat(api_base, '/hcmUI/CandidateExperience/en/sites/', site_name, '/job/', id, '3') AS job_url")
    return plan.once_oracle(s, listings, bodies, seen, hcm).select(
        "company_sustain_id", "title", "job_url", "location", "department", "job_type", "published_date", "original_description")


@query(_oracle_sql("nation % 2 = 0 AND nation % 3 <> 0"))
def once_oracle_cloud(spark, sf):
    return _once_oracle(spark, sf, False)


@query(_oracle_sql("nation % 2 = 1"))
def once_oracle_hcm(spark, sf):
    return _once_oracle(spark, sf, True)


# listing pages of sites: a supplier's orders are dealt over twenty sites, parts say which pages landed; those of line 7 list nothing
LANDED_PAGES = Shape(
    "lineitem", api_base="concat('https://s', CAST(l_suppkey AS STRING))", site_name="concat('CX', CAST(l_orderkey % 20 AS STRING))",
    offset="100 * (l_partkey % 67)", total="100 * (30 + l_suppkey % 41) + 7", n="CASE WHEN l_linenumber = 7 THEN 0 ELSE 1 END",
    id="CAST(l_orderkey AS STRING)")
LANDED_BODY = """CASE WHEN n = 0 THEN concat('{"items":[{"TotalJobsCount":', total, ',"requisitionList":[]}]}')
    WHEN CAST(id AS INT) % 50 = 1 THEN 'not json' ELSE concat('{"items":[{"TotalJobsCount":', total, ',"requisitionList":[{"Id":"', id, '"}]}]}') END"""


@query(f"""WITH p AS (SELECT *, CAST(id AS INT) % 50 <> 1 OR n = 0 AS readable FROM {LANDED_PAGES.sql()}),
    t AS (SELECT api_base, site_name, max(total)::BIGINT AS total FROM p WHERE readable GROUP BY 1, 2),
    s AS (SELECT DISTINCT api_base, site_name, "offset"::BIGINT AS a FROM p WHERE readable AND n = 1
          UNION ALL SELECT api_base, site_name, total FROM t),
    g AS (SELECT *, coalesce(max(a + 100) OVER (PARTITION BY api_base, site_name ORDER BY a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM s)
    SELECT api_base, site_name, total, b AS from_position, least(a, total) AS to_position FROM g JOIN t USING (api_base, site_name) WHERE b < least(a, total)""")
def listing_gaps(spark, sf):
    """The requisitions of each site that no landed page lists."""
    pages = LANDED_PAGES.df(spark, sf)
    return oracle.listing_gaps(pages.selectExpr("api_base", "site_name", "offset", f"{LANDED_BODY} AS body"))


@query(f"""SELECT * EXCLUDE (nation), nation % 5 <> 0 AS listing_complete FROM (
    {_oracle_sql("nation % 2 = 1").replace(" FROM ", ", nation FROM ")})""")
def once_oracle_marked(spark, sf):
    """Postings with a mark where the site's pages landed in part: every fifth nation's sites say they have 300."""
    s, listings, bodies = _requisitions(spark, sf)
    less = "replace(body, '\"TotalJobsCount\":3', '\"TotalJobsCount\":300')"
    listings = listings.withColumn("body", F.expr(f"CASE WHEN CAST(substr(site_name, 8) AS INT) % 5 = 0 THEN {less} ELSE body END"))
    seen = s.where("nation % 6 = 0").selectExpr("concat(api_base, '/hcmUI/CandidateExperience/en/sites/', site_name, '/job/', id, '3') AS job_url")
    return plan.once_oracle(s, listings, bodies, seen, True, whole="listing_complete").select(
        "company_sustain_id", "title", "job_url", "location", "department", "job_type", "published_date", "original_description", "listing_complete")


@query(f"""SELECT api_base, site_name, site_number, pos, id || (pos + 1) AS job_id FROM {SITE_JSON.sql()}, (SELECT unnest([0, 1, 2, 3]) AS pos)""")
def requisition_rows(spark, sf):
    return oracle.requisitions(_requisitions(spark, sf)[1]).select("api_base", "site_name", "site_number", "pos", F.col("Id").alias("job_id"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_rows(spark, sf):
    e = table(spark, sf, "events").selectExpr("event_id", "concat('{\"items\":[', props, ']}') AS body")
    return oracle.json_rows(e, "body", "struct<items:array<struct<k:bigint>>>", F.col("_json.items"))


@query("""SELECT event_id, CASE event_type WHEN 'click' THEN NULL ELSE 'Engineer ' || user_id END AS title,
    CASE event_type WHEN 'click' THEN NULL WHEN 'view' THEN 'Pune, IN' WHEN 'error' THEN 'Goa' END AS place FROM events""")
def json_posting(spark, sf):
    e = table(spark, sf, "events").selectExpr("event_id", """CASE event_type
        WHEN 'click' THEN '{"@type":"Organization"}'
        WHEN 'view' THEN concat('[{"@type":"Other"},{"@type":"JobPosting","description":"Engineer ', user_id, '","jobLocation":{"address":{"addressLocality":"Pune","addressCountry":"IN"}}}]')
        WHEN 'error' THEN concat('{"@type":"JobPosting","description":"Engineer ', user_id, '","jobLocation":[{"address":{"addressRegion":"Goa"}},{"address":{"addressRegion":"X"}}]}')
        ELSE concat('{"@type":"JobPosting","description":"Engineer ', user_id, '","jobLocation":"somewhere"}') END AS body""")
    found = e.withColumn("p", freshteam.job_posting(F.array(F.lit("{bad"), "body")))
    return found.select("event_id", F.col("p.description").alias("title"), freshteam.place_of(F.col("p")).alias("place"))


LABELS = [("posted", lambda x: x.contains("date")), ("kind", lambda x: x.contains("type")), ("place", lambda x: x.contains("city") | x.contains("country"))]
LABEL = "CASE l_linenumber WHEN 1 THEN 'Date Opened' WHEN 2 THEN 'Job Type' WHEN 3 THEN 'City' WHEN 4 THEN 'Country' WHEN 5 THEN 'Date' WHEN 6 THEN 'Other' ELSE ' TYPE ' END"


def _label_sql(pick):
    def of(nums):
        return pick.format(f"l_linenumber IN ({nums})")
    return f"""SELECT l_orderkey, {of('1, 5')} AS posted, {of('2, 7')} AS kind, {of('3, 4')} AS place
        FROM (SELECT *, l_partkey || '-' || l_suppkey AS v, (l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS o FROM lineitem) WHERE l_linenumber <> 6 GROUP BY 1"""


def _labels(spark, sf, **how):
    rows = table(spark, sf, "lineitem").selectExpr("l_orderkey", f"{LABEL} AS label", "concat(l_partkey, '-', l_suppkey) AS value",
                                                   "struct(l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS ord")
    return label_rows(rows, "label", "value", "ord", "l_orderkey", LABELS, **how)


@query(_label_sql("arg_min(v, o) FILTER ({})"))
def label_route_first(spark, sf):
    return _labels(spark, sf)


@query(_label_sql("arg_max(v, o) FILTER ({})"))
def label_route_last(spark, sf):
    return _labels(spark, sf, keep="last")


@query(_label_sql("string_agg(v, ', ' ORDER BY o) FILTER ({})"))
def label_route_joined(spark, sf):
    return _labels(spark, sf, sep=", ")
