"""Ranked search against scoring every document."""

import random
import re
from collections import Counter, namedtuple
from math import floor, log

import pyarrow as pa
import pytest

from gigloom.llm import lexical
from gigloom.llm.lexical import indexed, ranked
from tests.llm.odd import LONG, TEXT, clashing, no_documents, odd_documents

Row = namedtuple("Row", "item item_id term times df")
TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return Counter(TERM.findall((text or "").translate(LOWER)))


def brute(docs, items, k):
    held = [(i, c) for i, t in docs if (c := terms(t))]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for doc, c in held:
            m = 75 + 25 * sum(c.values()) * n // total
            score = sum(times * floor(1000 * log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m))
                        for t, times in terms(text).items() if c[t])
            if score > 0 and doc is not None:
                scores.append((-score, doc))
        out += [(item, rank, doc, -s) for rank, (s, doc) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def corpus():
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 8, 40, 300])) + ["Hot"] * rng.randrange(60))) for i in range(400)]
    docs += [(i, "w1 w2 w3 w4 w5 copies") for i in range(1000, 1060)]  # a group of copies: ties by id
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 5, 30])))) for i in range(30)]
    return docs, items + [(90, "W1 w2! w3 w4-w5 copies copies"), (91, "nowhere"), (92, "hot HOT w7")]


def rows(df):
    return sorted(tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect())


@pytest.mark.parametrize("small", [False, True])
def test_matches_brute_force(spark, monkeypatch, small):
    if small:  # several passes and sheets, blocks of few documents, wanted documents met by shuffle
        for name, value in (("PASS", 100), ("SHEET", 4), ("BLOCK_BITS", 1 << 12), ("WANTED", 0), ("SEEDS", 1), ("PENDING", 50)):
            monkeypatch.setattr(lexical, name, value)
    docs, items = corpus()
    got = ranked(spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
                 spark.createDataFrame(items, "item_id long, text string"), k=20)
    assert rows(got) == brute(docs, items, 20)


def test_bounds_are_never_too_low_and_rule_documents_out(spark):
    docs, items = corpus()
    index = indexed(spark.createDataFrame(docs, "doc_id long, text string").repartition(2))
    wanted = {(i, d): s for i, _, d, s in brute(docs, items, len(docs))}
    n = len(docs)
    held = [(i, terms(t)) for i, t in items]
    df = Counter(t for _, t in docs for t in terms(t))
    queries = lexical.Queries([Row(i, i, hashed(t), c, df[t]) for i, q in held for t, c in q.items() if df[t]],
                              n, sum(sum(terms(t).values()) for _, t in docs))
    loose = checked = 0
    for row in lexical._blocks(index.where("slices is not null").toArrow().to_batches()):
        for first, got in lexical._bounds(queries, row):
            for q in range(len(got)):
                for d, bound in zip(row["ids"], got[q]):
                    score = wanted.get((queries.items[first + q], d), 0)
                    assert bound >= score
                    checked, loose = checked + 1, loose + (bound > score * 1.2)
    assert checked > 10_000 and loose < checked / 10


def hashed(word):
    return int(lexical.term_counts(pa.RecordBatch.from_pydict({"text": [word]}), "text")[1].view("int64")[0])


def test_odd_rows(spark):
    items = [(1, TEXT), (2, None), (3, ""), (4, "zwei DREI"), (None, TEXT), (1, TEXT), (5, "word1x1 " * 500), (6, LONG), (7, "漢字 xyz")]
    docs = odd_documents(spark)
    held = [(r.doc_id, r.text) for r in docs.collect()]
    asked = clashing(spark.createDataFrame(items, "item_id long, text string"))
    want = brute(held, [x for x in dict.fromkeys(items) if x[0] is not None], 20)
    assert rows(ranked(docs, asked)) == want
    assert [r[1] for r in want if r[0] == 4] == [1, 2]  # both rows that repeat an id have a rank
    assert rows(ranked(no_documents(spark), asked)) == []
    assert rows(ranked(docs, asked.limit(0))) == []
