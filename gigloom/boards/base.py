"""What every hiring platform's layout description is made of."""

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gigloom.functions import fixed_values as V
from gigloom.functions.text import clean, col, first_nonempty, let, nonempty
from gigloom.operators.keys import computed
from gigloom.sources import pages as P

LISTED = ["title", "job_url", "location", "job_type", "department", "posted"]
DETAIL = ["title", "original_description", "location", "job_type", "department", "industry", "experience", "posted"]


@dataclass(frozen=True)
class Board:
    """One platform: how its pages read and how its postings are kept.

    listing(dom, url, keep): array of listed postings; `keep` is a test on the title.
    detail(dom): fields of a posting's own page.
    prefer: per column, whether listing or detail wins. drop: what a patch leaves out.
    strict: a run without postings counts as failed.
    """
    name: str
    ats: str
    listing: Callable
    detail: Callable
    posted: Callable | None = None
    published: Callable | None = None
    job_type: Callable | None = None
    match: str = "contains"
    prefer: dict = field(default_factory=dict)
    patched: tuple = ("original_description", "location", "job_type", "department")
    needs_description: bool = True
    drop: str = "none_empty"
    stamp: str = "changed"
    strict: bool = False
    keys: tuple = ("job_url",)
    keep: str = "last"
    # one-pass runs
    ats_once: str | None = None
    listing_once: Callable | None = None
    listing_rendered: Callable | None = None
    listed_once: tuple = ("location", "job_type", "department", "published_date")
    detail_once: Callable | None = None
    prefer_once: dict = field(default_factory=dict)
    failed_once: str | None = V.FAILED
    needed_once: str | None = None
    skip_failed_once: bool = False
    refresh_once: bool = False
    title_once: Callable | None = None


def posting(**fields) -> Column:
    """A listed posting; fields not named are null, '' becomes null."""
    return F.struct(*[(nonempty(fields[n]) if n in fields else F.lit(None).cast("string")).alias(n) for n in LISTED])


def kept(postings: Column, keep=None, title: bool = True) -> Column:
    """Postings with an address (and title), passing the title test."""
    def good(j):
        ok = j["job_url"].isNotNull()
        if title:
            ok = ok & j["title"].isNotNull()
        return ok if keep is None else ok & keep(j["title"])
    return F.filter(postings, good)


def first_layout(*layouts) -> Column:
    """The first layout that gives any rows; an empty array when none does."""
    tried = [let(rows, lambda r: F.when(F.size(r) > 0, r)) for rows in layouts]
    return F.coalesce(*tried, F.slice(layouts[0], 1, 0))


def details(**fields) -> Column:
    """Fields of a posting's page; fields not named are null, '' becomes null."""
    return F.struct(*[(nonempty(fields[n]) if n in fields else F.lit(None).cast("string")).alias(n) for n in DETAIL])


def first_text(dom, tests, read=P.shown) -> Column:
    """Text of the first element found, trying the step lists in order."""
    return first_nonempty(*[let(P.scope_at(dom, *t), lambda s: F.when(s.isNotNull(), clean(read(s)))) for t in tests])


# --- label / value routing -----------------------------------------------------------

def pairs(dom, item, label, value, read=P.shown, required=True) -> Column:
    """array<struct<label, value>> from repeated items; items without a label are dropped."""
    def one(s):
        said = P.scope_at(s, *value)
        return F.struct(let(P.scope_at(s, *label), lambda x: F.when(x.isNotNull(), F.lower(clean(read(x))))).alias("label"),
                        let(said, lambda x: F.when(x.isNotNull(), clean(read(x)))).alias("value"))
    rows = F.transform(P.each(dom, *item), one)
    if required:
        return F.filter(rows, lambda p: p["label"].isNotNull() & p["value"].isNotNull())
    return F.transform(F.filter(rows, lambda p: p["label"].isNotNull()),
                       lambda p: F.struct(p["label"].alias("label"), F.coalesce(p["value"], F.lit("")).alias("value")))


def has(*parts):
    def test(label):
        hit = label.contains(parts[0])
        for p in parts[1:]:
            hit = hit | label.contains(p)
        return hit
    return test


def route(found: Column, routes) -> Column:
    """Name each pair after the first route whose test its label passes."""
    def one(p):
        name = None
        for field_name, test in routes:
            hit = test(p["label"])
            name = F.when(hit, field_name) if name is None else name.when(hit, field_name)
        return F.struct(name.alias("field"), p["value"].alias("value"))
    return F.transform(found, one)


def routed(found: Column, name: str, keep: str = "first", sep: str | None = None) -> Column:
    """Value of a field: first non-empty, last as written, or all non-empty joined."""
    mine = F.transform(F.filter(found, lambda p: p["field"] == name), lambda p: p["value"])
    if keep == "last":
        return let(mine, lambda m: F.when(F.size(m) > 0, F.element_at(m, -1)))
    said = F.filter(mine, lambda v: v != "")
    return F.get(said, F.lit(0)) if sep is None else nonempty(F.array_join(said, sep))


def label_rows(df: DataFrame, label: str, value: str, order: str, key: str, routes, keep: str = "first",
               sep: str | None = None) -> DataFrame:
    """Route label/value rows of a table: one row per key, one column per field.

    The rows of a key are combined before the shuffle, so no key gathers in one task. `sep`
    joins all values of a field in order instead of choosing one: rows are dealt out by ranges
    of (key, field, order), each range joins its values, and only these pieces meet by key.
    """
    name = None
    for field_name, test in routes:
        hit = test(F.lower(F.trim(label)))
        name = F.when(hit, field_name) if name is None else name.when(hit, field_name)
    rows = df.withColumn("_field", name).where(F.col("_field").isNotNull() & (col(value) != ""))

    names = list(dict.fromkeys(f for f, _ in routes))
    if sep is not None:
        return _joined_rows(rows, value, order, key, names, sep)

    def chosen(field_name):
        mine = F.col("_field") == field_name
        return (F.min_by if keep == "first" else F.max_by)(F.when(mine, col(value)), F.when(mine, col(order)))
    return rows.groupBy(key).agg(*[chosen(f).alias(f) for f in names])


def _joined_rows(rows: DataFrame, value: str, order: str, key: str, names: list[str], sep: str) -> DataFrame:
    """One row per key: for each field its values in order, joined piece by piece.

    A range holds neighbours in order, so a key of any size is cut into ranges of like size
    and a task sorts one of them; a field's text is put together from one piece for each range.
    """
    def told(found: Column) -> Column:
        return F.array_join(F.transform(F.array_sort(F.collect_list(found)), lambda x: x["_text"]), sep)
    dealt = rows.select(F.col(key), "_field", F.col(order).alias("_order"), F.col(value).cast("string").alias("_text")).repartitionByRange(
        key, "_field", "_order", "_text").withColumn("_range", F.spark_partition_id())
    parts = dealt.groupBy(key, "_field", "_range").agg(told(F.struct("_order", "_text")).alias("_text"))
    return parts.groupBy(key).agg(*[
        nonempty(told(F.when(F.col("_field") == f, F.struct("_range", "_text")))).alias(f) for f in names])


# --- running a layout over pages -----------------------------------------------------

def listed(pages: DataFrame, listing, keep=None) -> DataFrame:
    """Landed pages to listed postings: page columns, card position and posting fields."""
    columns = [c for c in pages.columns if c != "html"]
    rows = P.with_nodes(pages).select(*columns, F.posexplode(listing(F.col("dom"), F.col("url"), keep)).alias(
        "card_pos", "_job"))
    return rows.select(*columns, "card_pos", "_job.*")


def detailed(pages: DataFrame, detail, needed: str | None = None) -> DataFrame:
    """Landed posting pages to one row of fields each; pages without the needed field are left out."""
    columns = [c for c in pages.columns if c != "html"]
    rows = computed(P.with_nodes(pages), detail(F.col("dom")), "_d", said(needed))
    return rows.select(*columns, "_d.*")


def said(field_name: str | None):
    return lambda d: F.lit(True) if field_name is None else d[field_name].isNotNull()
