"""Careers-page discovery and hiring-platform detection over landed pages."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gigloom.functions import fixed_values as V
from gigloom.functions import rules, urls
from gigloom.functions.dates import moment
from gigloom.functions.text import code_name, first_of, let, nonempty, strip, urls_in
from gigloom.operators.keys import (dedupe, is_set, known_by_any, lookup_join, partitions, pick_first, reason_counts, salts_of,
                                   shuffled, skip_reasons)
from gigloom.session import settled, spread
from gigloom.sources import pages as P
from gigloom.sources.tables import pending

ACCEPTED = 0.7


def page_facts(pages: DataFrame) -> DataFrame:
    """Per fetched page: text score and length, link counts, verdict, and job-like links in order."""
    keep = [c for c in pages.columns if c not in ("html", "status")]

    def anchor(d, a):
        # the rules name link and text once for each of their words, so both are built first
        said = F.struct(urls.link_from(F.col("url"), a["attrs"]["href"]).alias("link"), P.shown(P.within(d, a)).alias("text"))
        return let(said, lambda x: F.struct(x["link"].alias("link"), rules.is_job_link(x["link"], x["text"]).alias("jobish"),
                                            rules.on_platform(x["link"]).alias("platform")))

    dom = F.col("dom")
    anchors = F.transform(F.filter(P.pick(dom, P.el("a")), lambda n: F.coalesce(n["attrs"]["href"], F.lit("")) != ""),
                          lambda a: anchor(dom, a))
    read = P.with_nodes(P.fetched(pages)).select(*keep, P.joined(dom, "\n", keep_blank=True).alias("text"),
                                                 anchors.alias("anchors"))
    facts = read.select(
        *keep, rules.page_score("text").cast("int").alias("score"), F.length("text").alias("text_length"),
        F.size(F.filter("anchors", lambda a: a["jobish"])).alias("job_links"),
        F.size(F.filter("anchors", lambda a: a["platform"])).alias("platform_links"),
        F.transform(F.filter("anchors", lambda a: a["jobish"]), lambda a: a["link"]).alias("next"))
    return facts.withColumn("_v", rules.careers_verdict("url", "score", "text_length", "job_links", "platform_links")
                            ).select("*", "_v.*").drop("_v")


def guesses(sites: DataFrame, stage: int, careers: bool = False) -> DataFrame:
    """Direct path candidates of each site, ranked in path order; a site gives many, so sites are dealt over a shuffle's tasks."""
    paths = F.array(*[F.lit(p) for p in urls.path_guesses()])
    root = urls.careers_host("base") if careers else F.col("base")
    return spread(sites, partitions(sites)).select("list_id", root.alias("root"), F.posexplode(paths).alias("pos", "path")).select(
        "list_id", F.concat("root", "path").alias("url"), F.lit(stage).alias("stage"),
        F.array("pos").alias("rank"), F.lit("direct").alias("how"))


def addresses(pages: DataFrame) -> DataFrame:
    """The address keys of all fetched pages, written once: what every round asks before it reads markup."""
    return settled(P.fetched(pages).select(urls.key("url").alias("_key")).where(F.col("_key").isNotNull()).distinct())


def judged(candidates: DataFrame, pages: DataFrame, landed: DataFrame, known: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(facts of all pages read so far by address key, candidates whose page passes).

    Candidates without a landed page go first, by address alone. Of the others only the latest
    captures are read and parsed, and only those that no earlier round has (`known`).
    """
    held = settled(lookup_join(candidates.withColumn("_key", urls.key("url")), landed, "_key", "left_semi", spread_by=["list_id"]))
    fresh = held.select("_key").distinct()
    if known is not None:
        fresh = fresh.join(shuffled(known.select("_key")), "_key", "left_anti")
    facts = page_facts(P.captures(pages, fresh, address=urls.key))
    facts = facts.withColumn("_key", urls.key("url")).select("_key", "next", "confidence", "reason")
    facts = settled(dedupe(facts, ["_key"], ["confidence", "reason"]))
    facts = facts if known is None else known.unionByName(facts)
    passing = facts.where(F.col("confidence") >= ACCEPTED).select("_key", "confidence", "reason")
    hits = lookup_join(held, passing, "_key", "inner", spread_by=["list_id"], salts=salts_of(candidates))
    return facts, hits.select("list_id", F.col("url").alias("careers_url"), "stage", "rank", "confidence",
                              F.concat_ws(":", "how", "reason").alias("method"))


def search(sites: DataFrame, pages: DataFrame, max_depth: int = 2) -> DataFrame:
    """(list_id, careers_url, confidence, method) of sites (list_id, base) with a careers page.

    Direct paths come first, then a breadth-first crawl from the homepage over job-like links,
    then the careers subdomain. Each round reads pages for companies that an earlier one has
    not settled: paths and homepages, then links and subdomains, then deeper links. In the
    crawl an address counts at its first place in the queue and is not followed twice, and no
    page is read in two rounds.
    """
    def crawled(level, depth):
        return level.select("list_id", "url", F.lit(1).alias("stage"), F.concat(F.array(F.lit(depth)), "rank").alias("rank"),
                            F.lit(f"depth-{depth}").alias("how"))

    landed = addresses(pages)
    level = sites.select("list_id", F.col("base").alias("url"), F.array(F.lit(0)).alias("rank"))
    every = level.select("list_id", urls.key("url").alias("_key"))
    facts, hits = judged(guesses(sites, 0).unionByName(crawled(level, 0)), pages, landed)
    for depth in range(1, max_depth + 1):
        done = shuffled(hits.where("stage < 2").select("list_id").distinct())
        here = lookup_join(level.join(done, "list_id", "left_anti").withColumn("_key", urls.key("url")),
                           facts.select("_key", "next"), "_key", "inner", spread_by=["list_id"], salts=salts_of(level))
        reached = here.select("list_id", "rank", F.posexplode("next").alias("pos", "url")).select(
            "list_id", "url", urls.key("url").alias("_key"), F.concat("rank", F.array("pos")).alias("rank"))
        reached = dedupe(reached, ["list_id", "_key"], ["rank"], "first").join(shuffled(every), ["list_id", "_key"], "left_anti")
        level = spread(settled(reached.select("list_id", "url", "rank")))
        every = every.union(level.select("list_id", urls.key("url")))
        candidates = crawled(level, depth)
        if depth == 1:
            candidates = candidates.unionByName(guesses(sites.join(done, "list_id", "left_anti"), 2, careers=True))
        facts, more = judged(candidates, pages, landed, facts)
        hits = hits.unionByName(more)
    return pick_first(hits, "list_id", ["stage", "rank"], ["careers_url", "confidence", "method"])


def find_careers(input_list: DataFrame, companies: DataFrame, pages: DataFrame, redirects: DataFrame, as_of):
    """(new company rows, list statuses) for pending list rows."""
    rows = pending(input_list, "status").select(
        F.col("id").alias("list_id"), strip("name").alias("name"), strip("domain").alias("domain"),
        strip("description").alias("description"))
    rows = rows.where(F.col("list_id").isNotNull() & (F.col("name") != "") & (F.col("domain") != ""))
    rows = rows.withColumn("base", urls.base("domain"))
    moved = dedupe(redirects.select(F.col("url").alias("base"), "final_url"), ["base"], ["final_url"])
    rows = lookup_join(rows, moved, ["base"]).withColumn(
        "homepage", urls.base(F.coalesce(nonempty("final_url"), F.col("base")))).drop("final_url")
    rows = settled(known_by_any(rows, companies, [("homepage", "homepage_url"), ("name", "name")]))

    open_rows = rows.where(~F.col("known"))
    hits = search(open_rows.select("list_id", "base"), pages)
    told = rows.join(shuffled(hits), "list_id", "left")
    now = moment(as_of)
    fresh = told.where(F.col("careers_url").isNotNull()).select(
        F.sha2(F.concat_ws("|", "list_id", "homepage"), 256).alias("id"), now.alias("created_at"), now.alias("updated_at"),
        "name", F.col("homepage").alias("homepage_url"), "careers_url", urls.icon("homepage").alias("logo_file_name"),
        "description", "list_id", F.lit(None).cast("string").alias("status"))
    status = told.select(F.col("list_id").alias("id"), F.when(F.col("known"), V.EXISTS).when(
        F.col("careers_url").isNotNull(), V.SCANNED).otherwise(V.NO_CAREERS).alias("status"))
    return fresh, status


# --- platform detection ----------------------------------------------------------------

def first_platform(addresses):
    """First platform found in an array of addresses, else null."""
    return let(F.filter(F.transform(addresses, rules.platform_of), lambda p: p.isNotNull()), first_of)


def page_platform(pages: DataFrame, requests: DataFrame | None = None, html: str = "html") -> DataFrame:
    """Per page: platform by final address, else by requested addresses, else by addresses in the markup."""
    final = F.col("final_url") if "final_url" in pages.columns else F.col("url")
    keep = [c for c in pages.columns if c not in (html, "final_url")]
    own = spread(pages)
    known = rules.platform_of(final)
    if requests is not None:
        asked = requests.select("page_id", "url", rules.platform_of("url").alias("_p")).where(F.col("_p").isNotNull())
        asked = asked.groupBy("page_id").agg(F.min_by("_p", "url").alias("_by"))
        own = lookup_join(own, asked, ["page_id"])
        known = F.coalesce(known, "_by")
    # the markup is searched only where no address decides
    found = let(known, lambda k: F.when(k.isNotNull(), k).otherwise(first_platform(urls_in(html))))
    return own.withColumn("_f", found).select(*keep, "_f.ats_name", "_f.ats_url")


def to_check(companies: DataFrame, ats_website: DataFrame) -> DataFrame:
    """Companies with a careers address, each with the reason it is skipped or null."""
    done = companies.join(ats_website.select(F.col("company_id").alias("id")).distinct(), "id", "left_semi")
    homes = done.select(F.lower(strip("homepage_url")).alias("_home")).where(F.col("_home").isNotNull())
    rows = companies.where(urls.looks_fetchable("careers_url")).withColumn("_home", nonempty(F.lower(strip("homepage_url"))))
    rows = lookup_join(rows, homes.withColumn("_done", F.lit(True)), ["_home"], distinct=True)
    return skip_reasons(rows, [("status", is_set("status")), ("homepage", F.col("_done"))]).drop("_home", "_done")


def check_counts(companies: DataFrame, ats_website: DataFrame) -> DataFrame:
    return reason_counts(to_check(companies, ats_website))


def detect(companies: DataFrame, ats_website: DataFrame, pages: DataFrame, requests: DataFrame | None = None):
    """(new ats_website rows, company statuses, report rows)."""
    rows = to_check(companies, ats_website).where(F.col("reason").isNull()).select("id", "name", "homepage_url", "careers_url")
    held = P.captures(pages, rows.select(urls.key("careers_url")), address=urls.key)
    found = page_platform(held, requests).select(urls.key("url").alias("_key"), "ats_name", "ats_url")
    found = dedupe(found, ["_key"], [F.col("ats_name").isNull(), "ats_name", "ats_url"], "first")
    told = lookup_join(rows.withColumn("_key", urls.key("careers_url")), found, ["_key"]).drop("_key")
    matched = told.where(F.col("ats_name").isNotNull())
    new = matched.select(F.sha2(F.concat_ws("|", "id", "ats_url"), 256).alias("id"), F.col("id").alias("company_id"),
                         "ats_name", "ats_url", code_name("name", "ats_name").alias("code_name"))
    status = told.select("id", F.when(F.col("ats_name").isNotNull(), V.PLATFORM_FOUND).otherwise(
        V.PLATFORM_MISSING).alias("status"))
    report = matched.select(F.col("name").alias("Company Name"), F.col("homepage_url").alias("Domain"),
                            F.col("careers_url").alias("Company URL"), F.col("ats_name").alias("ATS_Detected"),
                            F.col("ats_url").alias("Jobs_Page_URL"))
    return new, status, report
