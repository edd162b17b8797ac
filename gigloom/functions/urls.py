"""URL handling as Column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from gigloom.functions import fixed_values as V
from gigloom.functions.text import col, let, nonempty, strip

SCHEME = r"^[a-zA-Z][a-zA-Z0-9+.-]*:"


def looks_fetchable(c) -> Column:
    return F.coalesce(col(c).startswith("http"), F.lit(False))


def base(c) -> Column:
    """Trimmed, with a scheme, without trailing slashes; blank becomes ''."""
    return let(strip(F.coalesce(col(c), F.lit(""))), lambda t: F.when(t == "", "").otherwise(
        F.regexp_replace(F.when(t.rlike(SCHEME), t).otherwise(F.concat(F.lit("https://"), t)), "/+$", "")))


def key(c) -> Column:
    """What two spellings of one address share: host in lower case, no fragment, no trailing slash."""
    host = r"^\s*([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)"

    # patterns are matched only where they would change something: most addresses are passed on as they are
    def cut(t):
        bare = F.regexp_replace(F.regexp_replace(t, "#.*$", ""), "/+$", "")
        return F.when(t.contains("#") | t.endswith("/"), bare).otherwise(t)

    def lowered(u):
        return F.when(u == F.lower(u), u).otherwise(F.concat(F.lower(F.regexp_extract(u, host, 1)), F.regexp_replace(u, host, "")))

    return let(strip(col(c)), lambda t: let(cut(t), lowered))


def origin(c) -> Column:
    """scheme://host, null when either is missing."""
    return nonempty(F.regexp_extract(col(c), r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1))


def _without_dots(path) -> Column:
    """Resolve '.' and '..' segments of an absolute path."""
    def step(done, seg):
        return (F.when(seg == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
                .when(seg == ".", done).otherwise(F.concat(done, F.array(seg))))

    def resolve(p):
        opened = F.regexp_replace(p, r"(/\.{1,2})$", "$1/")
        done = F.array_join(F.aggregate(F.split(opened, "/"), F.lit([]).cast("array<string>"), step), "/")
        return F.regexp_replace(done, "^(?!/)", "/")

    return let(path, lambda p: F.when(p.rlike(r"/\.{1,2}(/|$)"), resolve(p)).otherwise(p))


def absolute(page, href) -> Column:
    """The address `href` points to when found on `page`."""
    page, href = col(page), col(href)
    parts = r"^((?:[a-zA-Z][a-zA-Z0-9+.-]*:)?(?://[^/?#]*)?)([^?#]*)"

    def merged(h):
        path = F.regexp_extract(h, r"^([^?#]*)", 1)
        folder = F.regexp_replace(F.regexp_extract(page, parts, 2), "[^/]*$", "")
        below = F.regexp_replace(F.concat(F.lit("/"), folder, path), "/{2,}", "/")
        rest = F.regexp_replace(F.regexp_extract(h, r"([?#].*)$", 1), "^[?#]$", "")
        return F.concat(F.regexp_extract(page, parts, 1),
                        _without_dots(F.when(h.startswith("/"), path).otherwise(below)), rest)

    return let(F.coalesce(href, F.lit("")), lambda h: (
        F.when(h == "", page)
        .when(h.rlike(SCHEME), h)
        .when(h.startswith("//"), F.concat(F.regexp_extract(page, SCHEME, 0), h))
        .when(h.rlike("^[?#]$"), F.regexp_replace(page, "#.*$", ""))
        .when(h.startswith("#"), F.concat(F.regexp_replace(page, "#.*$", ""), h))
        .when(h.startswith("?"), F.concat(F.regexp_replace(page, "[?#].*$", ""), h))
        .otherwise(merged(h))))


def link_from(page, href) -> Column:
    """As `absolute`, but the page address is taken as a folder."""
    return absolute(F.concat(col(page), F.lit("/")), href)


def icon(c, size: int = 64) -> Column:
    """Site-icon address for a homepage; blank becomes ''."""
    return let(base(c), lambda b: F.when(b == "", "").otherwise(F.concat(
        F.lit("https://t1.gstatic.com/faviconV2?client=SOCIAL&type=FAVICON&fallback_opts=TYPE,SIZE,URL&url="),
        b, F.lit(f"&size={size}"))))


def tracked(c, tracking: str, bare_host: str | None = None) -> Column:
    """Append a tracking query; `bare_host` loses query and fragment instead."""
    c = col(c)
    parts = r"^([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
    path, query, frag = (F.regexp_extract(c, parts, i) for i in (1, 2, 3))
    marked = F.concat(path, F.lit("?"), F.when(query != "", F.concat(query, F.lit("&"))).otherwise(""),
                      F.lit(tracking), F.when(frag != "", F.concat(F.lit("#"), frag)).otherwise(""))
    out = F.when(~c.startswith("http"), c)
    if bare_host:
        out = out.when(F.regexp_extract(c, r"^[a-z]+://([^/?#]*)", 1) == bare_host,
                       F.regexp_replace(path, ";[^/]*$", ""))
    return out.otherwise(marked)


def careers_host(c) -> Column:
    """Same site under a 'careers.' host, without 'www.'."""
    return F.regexp_replace(F.regexp_replace(col(c), r"^(https?://)(www\.)?", "$1"), "://", "://careers.")


def path_guesses() -> list[str]:
    """Fixed candidate paths, sorted and distinct."""
    variants = [f"/{word}" for pair in V.CAREER_PATH_VARIANTS for word in pair]
    return sorted({*V.CAREER_PATHS, *variants})


def site_info(c) -> Column:
    """struct<api_base, site_name> of a '/sites/<name>' address; nulls otherwise."""
    c = col(c)
    name = nonempty(F.regexp_extract(
        c, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*(?:/[^?#]*?)?/sites/+([^/?#;]+)", 1))
    return F.struct(F.when(name.isNotNull(), origin(c)).alias("api_base"), name.alias("site_name"))


def requisition_url(api_base, site_name, job_id) -> Column:
    return F.concat(col(api_base), F.lit("/hcmUI/CandidateExperience/en/sites/"), col(site_name),
                    F.lit("/job/"), col(job_id))


def job_details_url(page, href) -> Column:
    """Canonical '/careers/jobdetails/<id>' on the page's host; absolute links are kept."""
    page, href = col(page), F.coalesce(col(href), F.lit(""))
    job = nonempty(F.regexp_extract(href, r"jobdetails/([A-Za-z0-9\-]+)", 1))
    return (F.when((href == "") | href.startswith("http"), href)
            .otherwise(F.coalesce(F.concat(origin(page), F.lit("/careers/jobdetails/"), job), absolute(page, href))))


def alternate_host(c) -> Column:
    """Second address to look for when a '.us2.' host did not answer."""
    return F.when(col(c).contains(".us2.oraclecloud"), F.replace(col(c), F.lit(".us2."), F.lit(".ocs.")))
