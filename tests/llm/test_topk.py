"""Top-k search against scoring all pairs."""

import math
import random

import pytest

from gigloom.llm import topk
from gigloom.llm.topk import nearest
from tests.llm.odd import clashing


def brute(rows, k, every):
    vectors = {i: [math.floor(1024 * x) for x in e] for i, e in rows
               if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)}
    out = set()
    for q, a in vectors.items():
        if q % every == 0:
            near = sorted(((-sum(x * y for x, y in zip(a, b)), i) for i, b in vectors.items() if i != q and len(a) == len(b)))[:k]
            out |= {(q, r, i, -s) for r, (s, i) in enumerate(near, 1)}
    return out


def corpus():
    rng = random.Random(9)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(4)]
    rows = [(i, [c + rng.gauss(0, 0.3) for c in rng.choice(centres)]) for i in range(300)]
    rows += [(i, [0.5, 0.25, -1.0, 0.0, 0.0, 2.0]) for i in range(300, 420)]  # equal vectors: ties by id
    rows += [(500, None), (510, [None, 1.0]), (520, [float("nan")] * 6), (530, [float("inf")] * 6), (540, []), (550, []),
             (560, [1.0, 2.0]), (570, [2.0, -1.0]), (580, [1e6] * 6), (-10, [0.0] * 6), (None, [1.0] * 6)]
    return rows


@pytest.mark.parametrize(("block", "group", "queries"), [(512, 16, 512), (8, 3, 5)])
def test_matches_brute_force(spark, monkeypatch, block, group, queries):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "GROUP", group)
    monkeypatch.setattr(topk, "QUERIES", queries)
    df = clashing(spark.createDataFrame(corpus(), "vec_id long, embedding array<float>"))
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got = [tuple(r) for r in nearest(df, k=10, every=10).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows, 10, 10)


def test_few_and_no_rows(spark):
    df = spark.createDataFrame([(0, [1.0]), (100, [2.0]), (3, [-1.0]), (3, [-1.0])], "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in nearest(df).collect())
    one = 1024**2
    assert got == [(0, 1, 100, 2 * one), (0, 2, 3, -one), (0, 3, 3, -one), (100, 1, 0, 2 * one), (100, 2, 3, -2 * one), (100, 3, 3, -2 * one)]
    assert nearest(df.limit(0)).count() == 0
    assert nearest(df.where("vec_id = 0")).count() == 0


@pytest.mark.parametrize("group", [16, 1])
def test_rows_that_repeat_are_candidates_and_queries(spark, monkeypatch, group):
    monkeypatch.setattr(topk, "GROUP", group)
    rng = random.Random(4)
    rows = [(i % 40, [float(rng.randrange(3)) for _ in range(3)]) for i in range(200)] + [(0, [1.0, 1.0, 2.0])] * 15
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in nearest(df, k=4, every=10).collect())
    want = []
    for i, (q, a) in enumerate(rows):
        if q % 10 == 0:
            near = sorted((-sum(math.floor(1024 * x) * math.floor(1024 * y) for x, y in zip(a, b)), v) for j, (v, b) in enumerate(rows) if j != i)[:4]
            want += [(q, rank, v, -s) for rank, (s, v) in enumerate(near, 1)]
    assert got == sorted(want)
