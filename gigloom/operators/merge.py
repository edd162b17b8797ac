"""Key-based table changes as DataFrames: upsert, patch, retention, enrichment.

Without a table format there is no MERGE: these return the table's next contents, to be
written to a new path (see sources.tables.replace).
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gigloom.functions.dates import moment
from gigloom.functions.text import nonempty
from gigloom.operators.keys import _list, lookup_join


def upsert(target: DataFrame, source: DataFrame, keys, nulls: str = "overwrite", fixed=()) -> DataFrame:
    """Supplied columns of matching rows are replaced, other rows are added.

    Columns the source lacks keep the target's value. nulls='keep' lets a null source value
    leave the target's; `fixed` columns keep the target's value wherever the row exists.
    Keys must be unique in the source; null keys match nothing.
    """
    keys = _list(keys)
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    new = source.where(complete)
    supplied = [c for c in target.columns if c in source.columns and c not in keys]
    told = new.select(*keys, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_s_{c}") for c in supplied])
    # the target is passed on by one left join: where Spark can broadcast the source, it is not shuffled
    both = target.join(told, keys, "left")

    def value(c) -> Column:
        if c not in supplied or c in fixed:
            return F.col(c)
        theirs = F.col(f"_s_{c}").cast(target.schema[c].dataType)
        return F.coalesce(theirs, F.col(c)) if nulls == "keep" else F.when(F.col("_hit"), theirs).otherwise(F.col(c))

    merged = both.select(*[value(c).alias(c) for c in target.columns])
    matched = target.select(*keys).join(new.select(*keys), keys, "left_semi").distinct()
    fresh = new.join(matched, keys, "left_anti").unionByName(source.where(~complete))
    return merged.unionByName(fresh.select(*[
        F.col(c).cast(target.schema[c].dataType).alias(c) for c in target.columns if c in source.columns]), allowMissingColumns=True)


def _kept(c: Column, kind: str, drop: str) -> Column:
    """Null out payload values that must not be written."""
    if drop == "none":
        return c
    if kind == "string":
        return nonempty(c)
    if drop == "falsy":
        if kind == "boolean":
            return F.when(c, c)
        if kind in ("int", "bigint", "double", "float", "smallint", "tinyint"):
            return F.when(c != 0, c)
    return c


def patch(target: DataFrame, source: DataFrame, keys, drop: str = "none_empty", as_of=None,
          stamp: str = "changed") -> DataFrame:
    """Write only the payload values that say something.

    drop: 'none' skips nulls; 'none_empty' also ''; 'falsy' also 0 and false.
    `updated_at` is set where anything was written (stamp='always': for every patched row).
    """
    keys = _list(keys)
    payload = [c for c in source.columns if c not in keys]
    kinds = dict(source.dtypes)
    src = source.select(*keys, F.lit(True).alias("_hit"),
                        *[_kept(F.col(c), kinds[c], drop).alias(f"_p_{c}") for c in payload])
    joined = lookup_join(target, src, keys)
    any_value = reduce(lambda a, b: a | b, [F.col(f"_p_{c}").isNotNull() for c in payload])
    touched = F.col("_hit") if stamp == "always" else any_value

    def value(c):
        if c == "updated_at" and as_of is not None:
            return F.when(F.coalesce(touched, F.lit(False)), moment(as_of)).otherwise(F.col(c))
        if c in payload:
            return F.coalesce(F.col(f"_p_{c}").cast(target.schema[c].dataType), F.col(c))
        return F.col(c)

    return joined.select(*[value(c).alias(c) for c in target.columns])


def retain(df: DataFrame, column: str, as_of, days: int | None = None, months: int | None = None) -> DataFrame:
    """Drop rows dated before the cutoff day; undated rows stay, as does the cutoff day itself."""
    day = moment(as_of).cast("date")
    cutoff = F.date_sub(day, days) if days is not None else F.add_months(day, -months)
    if dict(df.dtypes)[column] == "string":
        cutoff = F.date_format(cutoff, "yyyy-MM-dd")
    return df.where(F.col(column).isNull() | (F.col(column) >= cutoff))


def enrich(listing: DataFrame, detail: DataFrame, keys, prefer=None, default: str = "detail",
           missing=None, found_only: bool = False) -> DataFrame:
    """Merge detail fields into listed rows.

    prefer maps a column to 'detail' (detail wins, listing fills), 'listing' (listing wins),
    'detail_only' or 'listing_only'. missing maps a column to the value it takes when a row
    has no detail at all; found_only drops such rows.
    """
    keys, prefer, missing = _list(keys), prefer or {}, missing or {}
    kinds = {**dict(detail.dtypes), **dict(listing.dtypes)}
    theirs = [c for c in detail.columns if c not in keys]
    found = detail.select(*keys, F.struct(*theirs).alias("_d"), F.lit(True).alias("_found"))
    joined = lookup_join(listing, found, keys, "inner" if found_only else "left")

    def said(c, column):
        return nonempty(column) if kinds[c] == "string" else column

    def value(c):
        mine = said(c, F.col(c)) if c in listing.columns else F.lit(None).cast(kinds[c])
        their = said(c, F.col("_d")[c]) if c in theirs else F.lit(None).cast(kinds[c])
        rule = prefer.get(c, default)
        merged = {"detail": F.coalesce(their, mine), "listing": F.coalesce(mine, their),
                  "detail_only": their, "listing_only": mine}[rule]
        if c in missing:
            merged = F.when(F.col("_found").isNull(), F.lit(missing[c])).otherwise(merged)
        elif rule == "detail_only" and c in listing.columns:
            merged = F.when(F.col("_found").isNull(), mine).otherwise(merged)
        return merged

    columns = [*listing.columns, *[c for c in theirs if c not in listing.columns]]
    return joined.select(*[F.col(c) if c in keys else value(c).alias(c) for c in columns])
