"""Experience ranges."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from gigloom.functions.text import col, let, strip


def _int(text, pattern, group) -> Column:
    return F.regexp_extract(text, pattern, group).try_cast("int")


def experience(c) -> Column:
    """Text to struct<min_exp:int, max_exp:int>; nulls when no number is present."""
    plus, span, one = r"(\d+)\s*\+", r"(\d+)\s*(?:-|to)\s*(\d+)", r"(\d+)"

    def read(t):
        fresh = t.contains("fresher") | t.rlike(r"^0\s*(years|yrs)?$")
        low = (F.when(fresh, 0).when(t.rlike(plus), _int(t, plus, 1))
               .when(t.rlike(span), _int(t, span, 1)).when(t.rlike(one), _int(t, one, 1)))
        high = (F.when(fresh, 0).when(t.rlike(plus), F.lit(None).cast("int"))
                .when(t.rlike(span), _int(t, span, 2)).when(t.rlike(one), _int(t, one, 1)))
        return F.struct(low.cast("int").alias("min_exp"), high.cast("int").alias("max_exp"))

    return let(strip(F.lower(F.coalesce(col(c), F.lit("")))), read)


def experience_label(low, high) -> Column:
    """'a-b years', 'a+ years', or null when both ends are below one."""
    a, b = (F.coalesce(col(x).try_cast("int"), F.lit(0)) for x in (low, high))
    return (F.when((a < 1) & (b < 1), F.lit(None).cast("string"))
            .when(b > a, F.concat(a.cast("string"), F.lit("-"), b.cast("string"), F.lit(" years")))
            .otherwise(F.concat(a.cast("string"), F.lit("+ years"))))
