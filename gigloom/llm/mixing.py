"""Mixing sources to target weights by subset-sum budget fitting.

A source's target in words is first met by whole passes over its documents; the rest is a
subset-sum problem over document lengths. Documents are counted by exact length, each length
gives its share of the rest, and a bounded knapsack over the lengths still left fills what
rounding leaves open, usually to the word. Which documents of a length are taken is decided by
a seeded hash, so a rerun takes the same.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gigloom.llm.store import shipped, stored

BUCKET = 4096  # documents of one length of one source that are ranked together
OPEN = 20_000  # words that the knapsack fits
MOST = 3  # times a document (and its source) may be taken


def _numbered(df: DataFrame, column: str) -> DataFrame:
    """`df` with n: each row's place (from 0) in the order of `column`, nulls last; no single task sorts all rows."""
    order = F.col(column).asc_nulls_last()
    rows = stored(df.repartitionByRange(order).withColumn("p", F.spark_partition_id()))
    before, total = [], 0
    for r in rows.groupBy("p").count().orderBy("p").collect():  # one row per partition
        before.append((r.p, total))
        total += r["count"]
    offset = F.create_map(*[F.lit(x) for pair in before for x in pair])[F.col("p")] if before else F.lit(0)
    return rows.withColumn("n", F.row_number().over(Window.partitionBy("p").orderBy(order)) - 1 + offset).drop("p")


def targets(sources: DataFrame, weights=(5, 2, 1), most: int = MOST) -> DataFrame:
    """`sources` (source, source_size) with target: the sum of all sizes shared by weight, none above `most` times its size.

    Weights go round the sources in code point order, null last. What a capped source can't
    use is shared anew by weight among the others until none is above its cap.
    """
    rows = _numbered(sources, "source")
    rows = stored(rows.select("source", "source_size", F.array(*[F.lit(float(w)) for w in weights])[
        (F.col("n") % len(weights)).cast("int")].alias("w")))
    cap = F.col("source_size") * float(most)
    total, weight = rows.agg(F.sum("source_size"), F.sum("w")).first()
    level = total / weight if weight else 0.0
    while weight:
        capped = cap < F.col("w") * F.lit(level)
        used, rest = rows.agg(F.sum(F.when(capped, cap)), F.sum(F.when(~capped, F.col("w")))).first()
        raised = (total - (used or 0.0)) / rest if rest else level
        if raised <= level:
            break
        level = raised
    return rows.select("source", "source_size", F.least(cap, F.col("w") * F.lit(level)).alias("target"))


def fill(sizes: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each size to take so that their sizes add up to at most `budget`, as close as can be found.

    Every size gives about its share; then some are put back until OPEN words are open, and a
    bounded knapsack over all that is left fits those. sizes: distinct, above 0.
    """
    take = np.zeros(len(sizes), np.int64)
    whole = int((sizes * counts).sum())
    if budget <= 0 or not whole:
        return take
    if budget >= whole:
        return counts.copy()
    order = np.argsort(-sizes)
    done, seen = 0, 0
    for i in order:  # the open part of each size's share is carried to the next smaller size
        seen += int(sizes[i] * counts[i])
        take[i] = min(int(counts[i]), max(0, budget * seen // whole - done) // int(sizes[i]))
        done += int(take[i] * sizes[i])
    rng = np.random.default_rng(len(sizes))
    left = budget - done
    for i in rng.permutation(len(sizes)):
        if left >= OPEN:
            break
        back = min(int(take[i]), -(-(OPEN - left) // int(sizes[i])))
        take[i] -= back
        left += int(back * sizes[i])
    free = counts - take
    mask, reach, steps = (1 << (left + 1)) - 1, 1, []
    for i in rng.permutation(len(sizes)):
        n, size, part = min(int(free[i]), left // int(sizes[i])), int(sizes[i]), 1
        while n > 0 and not reach >> left & 1:  # n copies as 1, 2, 4, ... and a rest
            k = min(part, n)
            steps.append((i, k, reach))
            reach |= (reach << k * size) & mask
            n, part = n - k, part * 2
        if reach >> left & 1:
            break
    at = reach.bit_length() - 1
    for i, k, before in reversed(steps):
        if not before >> at & 1:
            take[i] += k
            at -= k * int(sizes[i])
    return take


def _plan(pdf: pd.DataFrame) -> pd.DataFrame:
    """One source's lengths: whole passes over all, and how many documents of each length once more."""
    budget, whole = int(round(pdf.target.iloc[0])), int(pdf.source_size.iloc[0])
    passes = min(MOST, budget // whole) if whole else 0
    rest = 0 if passes >= MOST else budget - passes * whole
    sizes, counts = pdf["size"].to_numpy(np.int64), pdf["count"].to_numpy(np.int64)
    some = sizes > 0
    take = np.zeros(len(pdf), np.int64)
    take[some] = fill(sizes[some], counts[some], rest)
    return pd.DataFrame({"source": pdf.source, "size": sizes, "passes": passes, "once": take})


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def mixed(docs: DataFrame, weights=(5, 2, 1), seed: str = "mix", doc_id: str = "doc_id", text: str = "text",
          source: str = "source") -> DataFrame:
    """doc_id, size, source, source_size, target, taken of every row: taken is size times how often the mix has it.

    Null, empty and blank texts have size 0 and take nothing; a null source is a source of its
    own, last in order; null ids are rows like others. Rows that repeat an id, or are equal in
    all, are documents each. Ties in the seeded order are between equal rows. An empty table
    gives no rows; other columns are not read. Sizes are of whole texts.

    Only (doc_id, source, size, hash) is shuffled. Lengths are counted before the shuffle; the
    documents of one length of one source are ranked in buckets of about BUCKET, so no group of
    equal documents, however large, is ranked by one task. A task holds the length counts of one
    source: at most one per distinct length.
    """
    shipped(docs.sparkSession)
    h = F.xxhash64(F.lit(seed), F.col(doc_id), F.col(text))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"),
                       words_in(F.col(text).cast("string")).alias("size"), h.alias("h"))
    rows = stored(rows)
    buckets = max(1, rows.count() // BUCKET)
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("h"), F.lit(buckets)))
    counted = stored(rows.groupBy("source", "size", "bucket").agg(F.count("*").alias("count")))
    sources = targets(counted.groupBy("source").agg(F.sum(F.col("size") * F.col("count")).alias("source_size")), weights)
    sources = stored(sources)
    lengths = counted.groupBy("source", "size").agg(F.sum("count").alias("count")).alias("a").join(
        sources.alias("b"), F.expr("a.source <=> b.source")).select("a.*", "source_size", "target")
    plan = stored(lengths.groupBy("source").applyInPandas(_plan, "source string, size long, passes long, once long"))
    before = F.coalesce(F.sum("count").over(Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    shares = counted.withColumn("before", before).alias("a").join(
        plan.alias("b"), F.expr("a.source <=> b.source AND a.size = b.size")).select(
        "a.source", "a.size", "bucket", "passes", "count", F.expr("greatest(0L, least(count, once - before))").alias("share")).alias("a").join(
        sources.alias("b"), F.expr("a.source <=> b.source")).select("a.*", "source_size", "target")
    each = rows.alias("a").join(shares.alias("b"), F.expr(
        "a.source <=> b.source AND a.size = b.size AND a.bucket = b.bucket")).select(
        "a.*", "passes", "count", "share", "source_size", "target")
    part = F.expr("share > 0 AND share < count")
    ranked = each.where(part).withColumn("once", F.row_number().over(
        Window.partitionBy("source", "size", "bucket").orderBy("h", "doc_id")) <= F.col("share"))
    each = each.where(~part).withColumn("once", F.col("share") > 0).unionByName(ranked)
    return each.select("doc_id", "size", "source", "source_size", "target",
                       (F.col("size") * (F.col("passes") + F.col("once").cast("long"))).alias("taken"))
