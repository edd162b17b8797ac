"""Gaps of numbered listings against marking every position."""

import json
import random

import pytest

from gigloom.boards.oracle import listing_gaps
from gigloom.operators.coverage import gaps


def brute(rows):
    totals, held = {}, {}
    for key, a, b, total in rows:
        if total is not None:
            totals[key] = max(total, totals.get(key, 0))
        if a is not None and b is not None:
            held.setdefault(key, set()).update(range(max(a, 0), b))
    out = set()
    for key, total in totals.items():
        free = [i for i in range(total) if i not in held.get(key, ())]
        starts = [i for i in free if i - 1 not in set(free)]
        ends = [i + 1 for i in free if i + 1 not in set(free)]
        out |= {(key, total, a, b) for a, b in zip(starts, ends)}
    return out


@pytest.mark.parametrize("bucket", [1, 7, 40, 100_000])
def test_matches_brute_force(spark, bucket):
    rng = random.Random(bucket)
    rows = [(f"k{rng.randrange(12)}", a := rng.randrange(-3, 300), a + rng.choice([0, 1, 5, 40, 90, -2]), rng.choice([None, 100, 260])) for _ in range(150)]
    rows += [("none", None, None, 20), ("unknown", 3, 9, None), (None, 2, 4, 9), ("whole", 0, 50, 50), ("zero", 0, 5, 0), ("open", 5, None, 8)]
    df = spark.createDataFrame(rows, "k string, start int, stop int, total int")
    got = {tuple(r) for r in gaps(df, ["k"], bucket=bucket).collect()}
    assert got == brute(rows)
    assert gaps(df.limit(0), ["k"]).count() == 0


def page(total, n):
    return json.dumps({"items": [{"SiteNumber": "s", "TotalJobsCount": total, "requisitionList": [{"Id": str(i)} for i in range(n)]}]})


def test_pages_of_a_listing(spark):
    rows = [("a", "x", 0, page(250, 100)), ("a", "x", 200, page(250, 50)), ("a", "x", 200, page(250, 50)),  # 100..200 didn't land
            ("a", "y", 0, page(99, 99)), ("a", "z", 0, page(150, 100)), ("a", "z", 100, page(150, 0)),  # the last page lists none
            ("b", "x", 0, "broken"), ("b", "y", 0, page(None, 3)), ("b", "z", 100, page(120, 20)), ("b", "w", 0, None)]
    df = spark.createDataFrame(rows, "api_base string, site_name string, offset int, body string")
    assert {tuple(r) for r in listing_gaps(df).collect()} == {("a", "x", 250, 100, 200), ("a", "z", 150, 100, 150), ("b", "z", 120, 0, 100)}
