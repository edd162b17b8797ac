"""Set-based incremental operators: dedupe, new-only, known-by-any, skip reasons.

Hot keys: dedupe aggregates before its shuffle, so a key holding a third of all rows leaves
each task as one row. Joins dedupe the lookup side, and rows whose key is null (which can
match nothing) are dealt out evenly instead of meeting in one task.
"""

from functools import reduce
from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gigloom.functions.text import strip

def dedupe(df: DataFrame, keys, order, keep: str = "last") -> DataFrame:
    """One row per key: the last (or first) by `order`, which names one or more columns."""
    keys, order = _list(keys), _list(order)
    rest = [c for c in df.columns if c not in keys]
    choose = F.max_by if keep == "last" else F.min_by
    chosen = choose(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(chosen.alias("_row")).select(*[
        F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def _list(x):
    return [x] if isinstance(x, (str, Column)) else list(x)


def partitions(df: DataFrame) -> int:
    """How many tasks a shuffle of the session has: what null keys are dealt over."""
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def salts_of(df: DataFrame) -> int:
    """How many tasks share one hot key where a lookup is repeated for each: grows with the square root of the shuffle."""
    return max(8, isqrt(partitions(df)))


def row_bin(df: DataFrame, keys, bins: int) -> Column:
    """A bin per row from all numbers, dates and flags other than the keys and three texts, so large texts can be pruned."""
    plain = [(c, kind) for c, kind in df.dtypes if c not in keys and not kind.startswith(("map", "array", "struct", "binary"))]
    others = [c for c, kind in plain if kind != "string"] + [c for c, kind in plain if kind == "string"][:3]
    return F.pmod(F.xxhash64(*others), F.lit(bins)) if others else F.lit(0).cast("bigint")


def shuffled(lookup: DataFrame) -> DataFrame:
    """The lookup side of a join that meets its rows by a shuffle and never goes through the driver.

    Spark judges a scan by the size of its files: addresses and other built texts don't count, so millions of rows
    from a small file would be taken for a small table and gathered in the driver.
    """
    return lookup.hint("merge")


def lookup_join(df: DataFrame, lookup: DataFrame, keys, how: str = "left", distinct: bool = False,
                salts: int = 1, spread_by=None) -> DataFrame:
    """Equi-join on key columns that no single key can hold up.

    Rows of `df` whose key is null match nothing and are dealt over 16 bins for each task of a shuffle. With
    salts > 1 the rows of every key are dealt over that many bins, by a hash of `spread_by`,
    and the (much smaller) lookup is repeated for each; else adaptive skew splitting applies.
    distinct: the lookup holds key columns (and constants) only and is reduced to distinct
    rows, in the partitioning the join uses.
    """
    keys = _list(keys)
    by = [c for c in (spread_by or df.columns) if c not in keys]
    empty = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    own = row_bin(df.select(*by) if by else df, keys, salts) if salts > 1 else F.lit(0).cast("bigint")
    left = df.withColumn("_bin", F.when(empty, row_bin(df, keys, 16 * partitions(df)) + salts).otherwise(own))
    # one bin: always 0, but not a literal, which would be folded out of the join keys
    bins = F.pmod(F.xxhash64(*keys), F.lit(1)).cast("bigint") if salts == 1 else F.explode(
        F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint")))
    right = lookup.select("*", bins.alias("_bin"))
    if distinct:
        right = right.dropDuplicates([*keys, "_bin"])
    return left.join(shuffled(right), [*keys, "_bin"], how).drop("_bin")


def computed(df: DataFrame, value: Column, to: str, test) -> DataFrame:
    """Add a costly column and keep the rows whose value passes the test.

    A filter on the column would be pushed below the projection and build it twice.
    """
    return df.select("*", F.explode(F.filter(F.array(value), test)).alias(to))


def new_only(df: DataFrame, existing: DataFrame, keys) -> DataFrame:
    """Rows whose key is not in `existing`; duplicates among the new rows stay."""
    keys = _list(keys)
    return lookup_join(df, existing.select(*keys).dropna(), keys, "left_anti", distinct=True)


def known_by_any(df: DataFrame, existing: DataFrame, pairs, flag: str = "known") -> DataFrame:
    """Flag rows that match `existing` on any of the (left, right) column pairs.

    One equi-join per pair: a single join on an OR of equalities would compare all with all.
    """
    hits = []
    for i, (left, right) in enumerate(pairs):
        name = f"_hit{i}"
        found = existing.select(F.col(right).alias(left)).where(
            F.col(left).isNotNull() & (F.col(left) != "")).withColumn(name, F.lit(True))
        df = lookup_join(df, found, [left], distinct=True)
        hits.append(name)
    return df.withColumn(flag, F.coalesce(*hits, F.lit(False))).drop(*hits)


def skip_reasons(df: DataFrame, reasons, to: str = "reason") -> DataFrame:
    """Name of the first (name, predicate) that holds; null rows are kept ones."""
    out = None
    for name, test in reasons:
        test = F.coalesce(test, F.lit(False))
        out = F.when(test, name) if out is None else out.when(test, name)
    return df.withColumn(to, out)


def reason_counts(df: DataFrame, column: str = "reason", kept: str = "kept") -> DataFrame:
    return df.groupBy(F.coalesce(column, F.lit(kept)).alias(column)).agg(F.count("*").alias("n"))


def pick_first(df: DataFrame, key: str, rank, columns) -> DataFrame:
    """Per key, the columns of the row with the smallest rank."""
    best = F.min_by(F.struct(*columns), F.struct(*_list(rank)))
    return df.groupBy(key).agg(best.alias("_best")).select(key, *[F.col("_best")[c].alias(c) for c in columns])


def is_set(c) -> Column:
    """A status counts as set when it is not blank."""
    return strip(F.coalesce(F.col(c), F.lit(""))) != ""


def map_distinct(df: DataFrame, key: str, fn, to: str) -> DataFrame:
    """Run a costly DataFrame step once per distinct value of `key` and join the answers back.

    `fn` takes a one-column DataFrame of distinct keys and returns key plus column `to`.
    """
    return lookup_join(df, fn(df.select(key).dropna().distinct()).select(key, to), [key])
