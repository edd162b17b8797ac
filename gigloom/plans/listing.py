"""Board runs over landed pages: discover postings, enrich pending ones, or both in one pass."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gigloom.boards.base import Board, detailed, listed, said
from gigloom.boards import oracle
from gigloom.functions import rules, urls
from gigloom.functions.dates import moment
from gigloom.functions.numbers import experience
from gigloom.functions.text import nonblank
from gigloom.operators.keys import computed, dedupe, lookup_join, new_only, salts_of, shuffled
from gigloom.operators.merge import enrich, patch, upsert
from gigloom.session import settled
from gigloom.sources import pages as P
from gigloom.sources import tables as T


def row_id(*cols):
    """A stable positive 63-bit id; re-run tasks give the same one."""
    return F.xxhash64(*cols).bitwiseAND(F.lit(2**63 - 1))


def _first_kind(read: DataFrame, key, value) -> DataFrame:
    """Per page address, the first kind of capture ('static' before others) that gave something."""
    rank = F.when(F.col("kind") == "static", 0).otherwise(1)
    return read.groupBy(*key).agg(F.min_by(value, rank).alias(value))


def read_listing(board: Board, pages: DataFrame, keep=None, once: bool = False) -> DataFrame:
    """Listed postings of landed board pages; columns besides html and kind are carried along."""
    static = (once and board.listing_once) or board.listing
    if "kind" not in pages.columns or board.listing_rendered is None:
        return listed(pages.drop("kind"), static, keep)
    columns = [c for c in pages.columns if c not in ("html", "kind")]
    dom, url = F.col("dom"), F.col("url")
    jobs = F.when(F.col("kind") == "static", static(dom, url, keep)).otherwise(board.listing_rendered(dom, url, keep))
    best = _first_kind(computed(P.with_nodes(pages), jobs, "_jobs", lambda j: F.size(j) > 0), columns, "_jobs")
    return best.select(*columns, F.posexplode("_jobs").alias("card_pos", "_job")).select(*columns, "card_pos", "_job.*")


def read_details(board: Board, pages: DataFrame, as_of, once: bool = False) -> DataFrame:
    """One row per landed posting page (column job_url), dates and experience parsed."""
    detail = (once and board.detail_once) or board.detail
    columns = [c for c in pages.columns if c not in ("html", "kind")]
    needed = board.needed_once if once or board.needed_once == "title" else None
    if "kind" in pages.columns:
        read = computed(P.with_nodes(pages), detail(F.col("dom")), "_d", said(needed))
        rows = _first_kind(read, columns, "_d").select(*columns, "_d.*")
    else:
        rows = detailed(pages, detail, needed)
    published = board.published or (lambda c, _: F.lit(None).cast("timestamp"))
    return (rows.withColumn("published_date", published("posted", as_of))
            .withColumn("_exp", experience("experience")).select("*", "_exp.*").drop("_exp", "experience", "posted"))


def _board_pages(pages: DataFrame, runs: DataFrame) -> DataFrame:
    """Pages of the boards at hand; a landed page may name the board it was reached from."""
    at = "board_url" if "board_url" in pages.columns else "url"
    order = F.col("page_ord") if "page_ord" in pages.columns else F.lit(0)
    rows = P.captures(pages, runs.select("url"), at).withColumn("page_ord", order).withColumn("_at", F.col(at))
    found = lookup_join(rows, runs.withColumnRenamed("url", "_at"), "_at", "inner", salts=salts_of(rows), spread_by=["url", "page_ord"])
    return found.drop("_at", "status", "board_url")


def discover(board: Board, boards: DataFrame, pages: DataFrame, jobs: DataFrame, as_of):
    """Stage one: (scrape records, new postings) of a platform's boards."""
    mine = T.boards(boards, board.ats).where(nonblank("ats_url").isNotNull())
    runs = mine.select(F.col("id").alias("ats_website_id"), F.col("ats_url").alias("url"),
                       F.sha2(F.concat_ws("|", "id", F.lit(str(as_of))), 256).alias("scrape_id"))
    found = settled(read_listing(board, _board_pages(pages, runs)))
    now = moment(as_of)
    posted = board.posted("posted", as_of) if board.posted else F.lit(None).cast("timestamp")
    rows = found.select("*", posted.alias("published_date"))
    once = dedupe(rows, list(board.keys), ["ats_website_id", "page_ord", "card_pos"], board.keep)
    fresh = new_only(once, jobs, "job_url").withColumn("id", row_id("job_url", "title"))
    fresh = T.conform(fresh.withColumn("created_at", now).withColumn("updated_at", now)
                      .withColumn("is_active", F.lit(True)), T.SCHEMAS["jobs"])
    counts = found.groupBy("scrape_id").agg(F.count("*").alias("n"))
    ok = F.coalesce(F.col("n"), F.lit(0)) > 0 if board.strict else F.lit(True)
    scrapes = runs.join(shuffled(counts), "scrape_id", "left").select(
        F.col("scrape_id").alias("id"), "ats_website_id", F.when(ok, "success").otherwise("failed").alias("status"),
        now.alias("created_at"), now.alias("updated_at"), now.alias("finished_at"))
    return scrapes, fresh


def board_status(boards: DataFrame, postings: DataFrame, key: str, strict: bool) -> DataFrame:
    """Per board: number of postings and run status."""
    counts = postings.groupBy(key).agg(F.count("*").alias("n"))
    n = F.coalesce(F.col("n"), F.lit(0))
    status = F.when(n > 0, "success").otherwise("failed") if strict else F.lit("success")
    return boards.join(shuffled(counts), key, "left").withColumn("n", n).withColumn("status", status)


def enrich_pending(board: Board, jobs: DataFrame, scrapes: DataFrame, ats_website: DataFrame, pages: DataFrame,
                   as_of) -> DataFrame:
    """Stage two: the jobs table with this platform's pending postings filled in."""
    wanted = T.pending_jobs(jobs, scrapes, ats_website, board.ats if board.match != "contains_cs" else "SmartRecruiters",
                            board.match).where(urls.looks_fetchable("job_url"))
    told = P.captures(pages, wanted.select("job_url")).drop("status", "page_id", "fetched_at").withColumnRenamed("url", "job_url")
    told = read_details(board, told, as_of)
    told = dedupe(told, ["job_url"], ["original_description"])  # for pages without an id, whose captures can't be told apart
    theirs = [c for c in board.patched if c in told.columns]
    merged = enrich(wanted.select("id", "job_url", *theirs), told.select("job_url", *theirs), "job_url",
                    prefer=board.prefer, found_only=True).drop("job_url")
    if board.job_type:
        merged = merged.withColumn("job_type", board.job_type("job_type"))
    if board.needs_description:
        merged = merged.where(nonblank("original_description").isNotNull())
    # only pending postings can change: the rest of the table is passed on without a shuffle
    open_jobs = T.pending(jobs, "original_description")
    if board.drop == "overwrite":
        filled = upsert(open_jobs, merged.withColumn("updated_at", moment(as_of)), "id")
    else:
        filled = patch(open_jobs, merged, "id", drop=board.drop, as_of=as_of, stamp=board.stamp)
    return jobs.where(F.col("original_description").isNotNull()).unionByName(filled)


def once(board: Board, companies: DataFrame, pages: DataFrame, jobs: DataFrame, as_of, keep=rules.is_green_title):
    """One pass for gated postings: list, gate, drop known, read details, merge."""
    targets = T.targets(companies, board.ats_once or board.ats)
    found = read_listing(board, _board_pages(pages, targets), keep, once=True)
    order = ["company_sustain_id", "page_ord", "card_pos"]
    rows = dedupe(found, list(board.keys), order, "first")
    if list(board.keys) != ["job_url"]:
        rows = dedupe(rows, ["job_url"], order, "last")
    if not board.refresh_once:
        rows = new_only(rows, jobs, "job_url")
    if board.title_once:
        rows = rows.withColumn("title", board.title_once("title"))
    posted = board.posted("posted", as_of) if board.posted else F.lit(None).cast("timestamp")
    rows = settled(rows.withColumn("published_date", posted).select(
        "company_sustain_id", "title", "job_url", *board.listed_once))

    told = P.captures(pages, rows.select("job_url"))
    told = read_details(board, told.drop("status", "page_id", "fetched_at", "board_url", "page_ord").withColumnRenamed("url", "job_url"),
                        as_of, once=True)
    told = dedupe(told, ["job_url"], ["original_description"])
    if board.needed_once != "title":
        told = told.drop("title")
    merged = enrich(rows, told, "job_url", prefer=board.prefer_once, found_only=board.skip_failed_once,
                    missing={"original_description": board.failed_once})
    return T.conform(merged.withColumn("id", row_id("job_url")).withColumn("is_active", F.lit(True)),
                     T.SCHEMAS["jobs_sustain"])


def once_oracle(companies: DataFrame, listings: DataFrame, bodies: DataFrame, jobs: DataFrame, hcm: bool = False,
                keep=rules.is_green_title, whole: str | None = None) -> DataFrame:
    """One pass for landed requisition JSON: (api_base, site_name, offset, body) and (api_base, job_id, body).

    whole: a further column that tells whether the landed pages list all that the posting's site says it has.
    """
    targets = (T.targets(companies, "oracle hcm") if hcm else T.targets(companies, "oraclecloud", without="oracle hcm"))
    sites = targets.withColumn("_s", urls.site_info("url")).where(F.col("_s.site_name").isNotNull()).select(
        "company_sustain_id", "_s.api_base", "_s.site_name")
    if hcm:
        # the alternate host counts only where the first one landed nothing
        answered = listings.select("api_base", "site_name").distinct().withColumn("_up", F.lit(True))
        sites = lookup_join(sites, answered, ["api_base", "site_name"]).withColumn("api_base", F.when(
            F.col("_up").isNull(), F.coalesce(urls.alternate_host("api_base"), "api_base")).otherwise(F.col("api_base")))
        sites = sites.drop("_up")
    found = lookup_join(oracle.listed(listings, keep), sites, ["api_base", "site_name"], "inner", salts=salts_of(listings),
                        spread_by=["job_id"])
    rows = dedupe(found, ["job_url"], ["company_sustain_id", "offset", "pos"], "first")
    rows = new_only(rows, jobs, "job_url")
    if whole:
        lacking = oracle.listing_gaps(listings).select("api_base", "site_name").distinct().withColumn(whole, F.lit(False))
        rows = lookup_join(rows, lacking, ["api_base", "site_name"], salts=salts_of(rows), spread_by=["job_id"])
        rows = rows.withColumn(whole, F.coalesce(whole, F.lit(True)))
    merged = oracle.merged(rows, oracle.detail(bodies), [whole] if whole else ()).withColumn("id", row_id("job_url"))
    schema = T.SCHEMAS["jobs_sustain"]
    return T.conform(merged, f"{schema}, {whole} boolean" if whole else schema)


def save_once(jobs: DataFrame, rows: DataFrame) -> DataFrame:
    """jobs_sustain with the run's rows written over equal addresses; known rows keep their id."""
    return upsert(jobs, rows, "job_url", fixed=["id"])
