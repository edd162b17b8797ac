"""Targets against an iterated resharing, the knapsack against all subsets, and the mix against its contract."""

import itertools
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from gigloom.llm import mixing
from gigloom.llm.mixing import fill, mixed
from tests.llm.odd import no_documents, odd_documents


def plain_targets(sizes: dict) -> dict:
    names = sorted([s for s in sizes if s is not None], key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        free = [s for s in names if s not in capped]
        out = {s: 3 * sizes[s] if s in capped else rest * weight[s] / sum(weight[f] for f in free) for s in names}
        above = {s for s in free if out[s] > 3 * sizes[s]}
        if not above:
            return out
        capped |= above


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 30), st.integers(1, 3)), min_size=1, max_size=6, unique_by=lambda x: x[0]), st.integers(0, 200))
def test_fill_is_the_best_subset(lengths, budget):
    sizes, counts = np.array([s for s, _ in lengths]), np.array([c for _, c in lengths])
    take = fill(sizes, counts, budget)
    sums = {sum(s * k for (s, _), k in zip(lengths, ks)) for ks in itertools.product(*[range(c + 1) for _, c in lengths])}
    assert (take >= 0).all() and (take <= counts).all()
    assert int((take * sizes).sum()) == max(x for x in sums if x <= budget)


def test_fill_of_many_lengths():
    rng = np.random.default_rng(1)
    sizes = np.unique(rng.integers(1, 9000, 4000))
    counts = rng.integers(1, 50, len(sizes))
    whole = int((sizes * counts).sum())
    for share in (0.01, 0.3, 0.7, 0.999):
        take = fill(sizes, counts, int(whole * share))
        assert (take <= counts).all() and int((take * sizes).sum()) == int(whole * share)


def docs(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(["w"] * rng.choice([1, 2, 3, 5, 8, 40, 200])), rng.choice(["a", "b", "B", "é", None, "z"])) for i in range(600)]
    rows += [(1000 + i, "w " * 7, "hot") for i in range(400)] + [(2000, "w", "tiny"), (2001, "", "none"), (2002, None, "none")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_contract(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET", 50)  # equal documents of one source fall in several buckets
    rows, df = docs(spark)
    got = mixed(df).collect()
    size = {i: len((t or "").split()) for i, t, _ in rows}
    total = {}
    for i, _, s in rows:
        total[s] = total.get(s, 0) + size[i]
    want, taken = plain_targets(total), {}
    assert len(got) == len(rows)
    for r in got:
        assert r.size == size[r.doc_id] and r.source_size == total[r.source] and abs(r.target - want[r.source]) < 1e-6 * max(1, r.target)
        assert r.taken == 0 or (r.taken % r.size == 0 and r.taken <= 3 * r.size)
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, n in taken.items():
        assert abs(n - want[s]) <= (8 if s == "hot" else 2), (s, n, want[s])  # hot has lengths of 7 only
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixed(df).collect()), key=str)


def test_odd_rows(spark):
    got = mixed(odd_documents(spark)).collect()
    assert len(got) == 11 and {r.taken for r in got if r.doc_id in (3, 4, 5)} == {0}
    assert mixed(no_documents(spark)).count() == 0
    blank = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert [(r.size, r.target, r.taken) for r in mixed(blank).collect()] == [(0, 0.0, 0)] * 2
