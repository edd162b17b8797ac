"""Containment search against plain sets."""

import random

import pytest

from gigloom.llm import decontaminate
from gigloom.llm.decontaminate import candidates, contaminated, inverted_index, without_contaminated
from tests.llm.odd import TEXT, no_documents, odd_documents
from tests.llm.test_ngram_join import shingle_set


def tables(spark):
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([3, 5, 9, 14, 30, 59])))) for i in range(40)]
    docs = []
    for i in range(120):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([4, 30, 400]))]
        for _ in range(rng.randrange(3)):
            item = rng.choice(items)[1].split()
            for _ in range(rng.randrange(4)):
                item[rng.randrange(len(item))] = rng.choice(vocabulary)
            at = rng.randrange(len(words))
            words[at:at] = item
        docs.append((i, " ".join(words).upper() if i % 7 == 0 else " ".join(words)))
    docs += [(200, items[0][1]), (201, items[1][1]), (202, items[2][1])]
    return docs, items


@pytest.mark.parametrize("rows", [500_000, 0])  # index broadcast, and met by shuffle
def test_matches_brute_force(spark, monkeypatch, rows):
    monkeypatch.setattr(decontaminate, "INDEX_ROWS", rows)
    docs, items = tables(spark)
    got = {(r.doc_id, r.item_id, r.n_item_shingles, r.n_found) for r in contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = set()
    for d, t in docs:
        for i, u in items:
            b = shingle_set(u, 5)
            a = shingle_set(t, min(5, len(u.split())))
            if 100 * len(a & b) >= 80 * len(b):
                want.add((d, i, len(b), len(a & b)))
    assert got == want and len(want) > 20


def test_documents_meet_signatures_only(spark):
    docs, items = tables(spark)
    docs_df = spark.createDataFrame(docs, "doc_id long, text string")
    items_df = spark.createDataFrame(items, "item_id long, text string")
    index = inverted_index(items_df, "item_id", "text", 5, 80, 100)
    signatures = index.where("sig")
    assert signatures.where("q >= 20").count() < 0.5 * index.where("q >= 20").count()
    pairs = {(r.doc_id, r.item_id) for r in candidates(docs_df, signatures, [3, 5]).collect()}
    matches = {(r.doc_id, r.item_id) for r in contaminated(docs_df, items_df).collect()}
    sharing = {(d, i) for d, t in docs for i, u in items
               if shingle_set(t, min(5, len(u.split()))) & shingle_set(u, 5)}
    assert matches < pairs < sharing


def test_short_items_inside_longer_documents(spark):
    docs = [(1, "so alpha BETA gamma it is"), (2, "alpha beta and gamma"), (3, "alpha beta gamma"), (4, "alpha beta"), (5, "x one y")]
    items = [(1, "alpha beta gamma"), (2, "One"), (3, "alpha beta gamma delta")]
    got = {(r.doc_id, r.item_id) for r in contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {(1, 1), (3, 1), (5, 2)}


def test_odd_rows(spark):
    items = spark.createDataFrame([(1, TEXT), (2, None), (3, ""), (4, "zwei drei vier"), (None, TEXT), (1, TEXT)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in contaminated(odd_documents(spark), items).collect()}
    assert got == {(1, 1), (2, 1), (6, 1), (7, 4)}
    left = without_contaminated(odd_documents(spark), items)
    assert left.columns == odd_documents(spark).columns
    assert sorted((r.doc_id or -1) for r in left.collect()) == [-1, 3, 4, 5, 8, 9]
    assert contaminated(no_documents(spark), items).count() == 0
    assert contaminated(odd_documents(spark), items.limit(0)).count() == 0
    assert without_contaminated(odd_documents(spark), items.limit(0)).count() == 11


def test_no_python_on_the_main_path(spark):
    docs, items = tables(spark)
    plan = contaminated(spark.createDataFrame(docs, "doc_id long, text string"),
                        spark.createDataFrame(items, "item_id long, text string"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
