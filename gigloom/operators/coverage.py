"""What of a numbered range the landed pieces cover."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gigloom.functions.text import col
from gigloom.session import settled

BUCKET = 100_000  # positions that one window goes over


def gaps(spans: DataFrame, keys: list[str], start="start", stop="stop", total="total", bucket: int = BUCKET) -> DataFrame:
    """keys, total, from_position, to_position: each part of [0, total) of a key that no [start, stop) covers, ends excluded.

    The largest total of a key counts; without one the key isn't judged. Spans with a null end or no length cover nothing,
    those of a negative start count from 0. Equal and overlapping spans count once. An empty table gives no rows.

    A key's positions are cut into buckets. One window goes over each bucket's spans, another over a key's buckets, which
    tells each bucket how far the earlier ones reach. So no task holds more than a bucket's distinct starts or a key's buckets.
    """
    rows = spans.select(*keys, F.greatest(col(start).cast("long"), F.lit(0).cast("long")).alias("_a"), col(stop).cast("long").alias("_b"), col(total).cast("long").alias("total"))
    # what is landed is read once: costly spans, as those of parsed bodies are, go into one file of distinct starts
    starts = settled(rows.groupBy(*keys, "_a").agg(F.max(F.when(F.col("_b") > F.col("_a"), F.col("_b"))).alias("_b"), F.max("total").alias("total")))
    totals = starts.groupBy(*keys).agg(F.max("total").alias("total")).where("total is not null")
    pieces = starts.where("_b is not null").select(*keys, "_a", "_b", F.expr(f"_a div {bucket}").alias("_bucket"))
    reached = pieces.groupBy(*keys, "_bucket").agg(F.max("_b").alias("_top"))
    same = [F.col(k).eqNullSafe(F.col(f"_{i}")) for i, k in enumerate(keys)]
    named = [F.col(k).alias(f"_{i}") for i, k in enumerate(keys)]

    def earlier(what: str, by: list[str], order: str) -> Column:
        return F.max(what).over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1))

    zero = F.lit(0).cast("long")
    carried = reached.select(*named, F.col("_bucket").alias("_in"), F.coalesce(earlier("_top", keys, "_bucket"), zero).alias("_carry"))
    met = pieces.join(carried, [*same, F.col("_bucket") == F.col("_in")])
    between = met.select(*keys, F.greatest("_carry", F.coalesce(earlier("_b", [*keys, "_bucket"], "_a"), zero)).alias("from_position"),
                         F.col("_a").alias("to_position")).where("from_position < to_position")
    ends = reached.groupBy(*keys).agg(F.max("_top").alias("_top")).select(*named, "_top")
    tail = totals.join(ends, same, "left").select(*keys, F.coalesce("_top", zero).alias("from_position"), F.col("total").alias("to_position"))
    judged = totals.select(*named, "total")
    return between.unionByName(tail).join(judged, same).select(
        *keys, "total", "from_position", F.least("to_position", "total").alias("to_position")).where("from_position < to_position")
