"""Values of a key joined in order, however many rows the key has."""

import random

from gigloom.boards.base import label_rows

ROUTES = [("place", lambda label: label.contains("city")), ("kind", lambda label: label.contains("type"))]
SCHEMA = "text string, label string, value string, at long"


def joined(spark, rows, parts=6):
    found = label_rows(spark.createDataFrame(rows, SCHEMA).repartition(parts), "label", "value", "at", "text", ROUTES, sep="|")
    return found, {r["text"]: (r.place, r.kind) for r in found.collect()}


def test_a_hot_key_is_joined_in_order_from_pieces(spark):
    rows = [("hot", "City" if i % 3 else " Job type ", f"v{i % 977}", i) for i in range(60_000)]
    rows += [(f"k{i}", "city", "x", i) for i in range(500)]
    random.Random(3).shuffle(rows)
    found, got = joined(spark, rows)
    assert got["hot"] == ("|".join(f"v{i % 977}" for i in range(60_000) if i % 3), "|".join(f"v{i % 977}" for i in range(0, 60_000, 3)))
    assert len(got) == 501 and all(got[f"k{i}"] == ("x", None) for i in range(500))
    assert "rangepartitioning" in found._jdf.queryExecution().executedPlan().toString().lower()


def test_ties_nulls_empties_and_repeated_rows(spark):
    rows = [("a", "city", "y", 1), ("a", "city", "x", 1), ("a", "city", "x", 1), ("a", "city", "first", None), ("a", "other", "z", 0),
            ("a", "type", "", 0), ("a", None, "n", 0), ("b", "type", None, 0), (None, "type", "t", 5), (None, "type", "s", 4)]
    assert joined(spark, rows)[1] == {"a": ("first|x|x|y", None), None: (None, "s|t")}
    assert joined(spark, [])[1] == {}
