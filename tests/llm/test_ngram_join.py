"""The n-gram Jaccard join against all pairs in plain Python."""

import random
import re

import numpy as np

from gigloom.llm import ngram_join
from gigloom.llm.ngram_join import adaptive_prefix, groups_of_near_copies
from tests.llm.odd import no_documents, odd_documents


def shingle_set(text, width):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return {tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def brute(rows, width, num, den):
    sets = {i: shingle_set(t, width) for i, t in rows}
    ids, group = sorted(sets), {i: i for i in sets}

    def find(i):
        while group[i] != i:
            i = group[i]
        return i
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            x, y = sets[a], sets[b]
            if x and y and den * len(x & y) >= num * len(x | y):
                p, q = sorted((find(a), find(b)))
                group[q] = p
    return {(i, len(sets[i]), find(i)) for i in ids}


def edited(rng, words, edits):
    w = list(words)
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
    return " ".join(w)


def corpus():
    """Groups of near copies around the threshold, exact copies, and passages that unlike texts share."""
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, passage = [], [rng.choice(vocabulary) for _ in range(30)]
    for g in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([20, 60, 150]))]
        rows += [edited(rng, base, rng.randrange(6)) for _ in range(rng.choice([1, 2, 8, 20]))]
    rows += [" ".join(passage + [rng.choice(vocabulary) for _ in range(10)]) for _ in range(20)]
    rows += [" ".join(rng.choice(vocabulary) for _ in range(40)) for _ in range(30)] + rows[:10] + ["", None, "a", "a b", "a b"]
    rng.shuffle(rows)
    return list(enumerate(rows, 100))


def test_groups_match_brute_force(spark, monkeypatch):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for hot, width, limit in ((64, 4, (85, 100)), (3, 5, (80, 100))):  # with hot shingles, most goes by pivots and blocks
        monkeypatch.setattr(ngram_join, "HOT", hot)
        monkeypatch.setattr(ngram_join, "BLOCK_ROWS", 4)
        got = {tuple(r) for r in groups_of_near_copies(df, width, limit).collect()}
        assert got == brute(rows, width, *limit)


def test_prefixes_share_enough():
    """Any two sets that link share at least the smaller l of their prefixes."""
    rng = np.random.default_rng(2)
    for _ in range(300):
        base = rng.choice(500, 60, replace=False)
        a = np.unique(base[rng.random(60) > 0.08]).astype(np.uint64)
        b = np.unique(np.append(base[rng.random(60) > 0.08], rng.choice(500, 3))).astype(np.uint64)
        shared = len(np.intersect1d(a, b))
        if 100 * shared < 80 * (len(a) + len(b) - shared):
            continue
        df = rng.random(500) * 100
        (pa_, la), (pb, lb) = (adaptive_prefix(x[np.lexsort((x, df[x.astype(int)]))], np.sort(df[x.astype(int)]), 80, 100) for x in (a, b))
        assert len(np.intersect1d(pa_, pb)) >= min(la, lb)


def test_odd_rows(spark):
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in groups_of_near_copies(odd_documents(spark), 4, (85, 100)).collect()}
    assert {(1, 9, 1), (6, 9, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5), (7, 1, 7), (None, 9, None)} <= got
    assert groups_of_near_copies(odd_documents(spark)).count() == 11
    assert groups_of_near_copies(no_documents(spark)).count() == 0


def test_one_id_with_two_texts_is_one_node(spark):
    one, two = "a b c d e f g h", "p q r s t u v w"
    df = spark.createDataFrame([(1, one), (5, one), (5, two), (9, two)], "doc_id long, text string")
    assert {tuple(r) for r in groups_of_near_copies(df, 4, (85, 100)).select("doc_id", "component_id").collect()} == {(1, 1), (5, 1), (9, 1)}
