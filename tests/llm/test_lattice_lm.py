"""The lattice against all segmentations, the model's sums, and the counts against plain ones."""

import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from gigloom.llm import lattice_lm
from gigloom.llm.lattice_lm import Lattice, Level, Model, scored, vocabulary, VOCABULARY
from tests.llm.odd import no_documents, odd_documents

PIECES = {b" ": 0.1, b"a": 0.1, b"b": 0.1, b" a": 0.2, b"ab": 0.2, b" ab": 0.15, b"bb": 0.1, b"\xc3": 0.025, b"\xa9": 0.025}


def lattice():
    names = sorted(PIECES)
    return names, Lattice.of(names, np.array([PIECES[n] for n in names]))


def cuts(raw):
    if not raw:
        yield []
    for n in range(1, len(raw) + 1):
        if raw[:n] in PIECES:
            for rest in cuts(raw[n:]):
                yield [raw[:n], *rest]


def test_forward_sums_all_segmentations():
    _, lat = lattice()
    found = [b"a", b"ab", b"abab", b"bbab", "é".encode(), b"aaaaaaaa"]
    got = lat.words(found)
    for w, g in zip(found, got):
        want = sum(math.prod(PIECES[p] for p in c) for c in cuts(b" " + w))
        assert np.isclose(np.exp(g), want)


def test_expected_counts_weigh_all_segmentations():
    names, lat = lattice()
    w = b" abab"
    used = lat.expected(lat.arcs(np.frombuffer(w, np.uint8)[None].astype(np.uint64)), len(w), np.array([2.0]))
    total = sum(math.prod(PIECES[p] for p in c) for c in cuts(w))
    for k, n in enumerate(names):
        want = 2 * sum(math.prod(PIECES[p] for p in c) * c.count(n) for c in cuts(w)) / total
        assert np.isclose(used[k], want)


def test_vocabulary_holds_every_byte():
    names, p = vocabulary(VOCABULARY)
    assert len(names) > 20_000 and all(bytes([b]) in names for b in range(256)) and np.isclose(p.sum(), 1)
    assert np.isfinite(Lattice.of(names, p).words([bytes(range(128, 256)), "漢字😀".encode()])).all()


def test_seen_words_and_lattice_share_the_mass():
    """Over all words of a tiny alphabet and the end, P(token | class) sums to 1."""
    names = [b" ", b"a", b"b"]
    lat = Lattice.of(names, np.array([0.5, 0.25, 0.25]))
    words = [bytes(w) for n in range(14) for w in __import__("itertools").product(b"ab", repeat=n)]
    logs = lat.words(words)
    counts = {b"a": (3, 1), b"ab": (0, 2), b"bb": (1, 0)}
    classes = [Level(4 + 2, 3, 2, 0.5), Level(3 + 1, 3, 1, 0.4)]
    model = Model(Level(10, 4, 3, 0.6), classes, np.zeros(0, np.int64), np.zeros((0, 2), np.int64), np.zeros(0))
    c = np.array([counts.get(w, (0, 0)) for w in words])
    total = (10.0 ** model.scores(c, logs)).sum(axis=0)
    ends = 10.0 ** (model.end() - np.log10([(z.ends + 0.5) / (3 + 1) for z in classes]))
    tail = 1 - np.exp(logs).sum()  # longer words
    rest = np.array([z.freed * model.all.freed * tail for z in classes])
    assert np.allclose(total + ends + rest, 1)


def test_counts_and_base(spark):
    docs = [(i, t, g) for i, (t, g) in enumerate([
        ("the cat sat", "en"), ("The cat\tran", "en"), ("le chat", "fr"), ("unseen cat", "en"), (None, "en"), ("", None), ("le chat", "fr"), ("é cat é", "fr")])]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    learn = F.col("doc_id") != 3
    train = [re.findall(r"\S+", (t or "").lower()) + [None] for i, t, _ in docs if i != 3]
    flat = [x for t in train for x in t]
    n, v = len(flat), len(set(flat))
    by_head = {}
    for head in (1000, 2, 0):  # counts known to tasks, and met in the join
        for r in scored(df, learn, head=head).collect():
            t = re.findall(r"\S+", (docs[r.doc_id][1] or "").lower()) + [None]
            assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t), sum(flat.count(x) > 0 for x in t), n)
            assert np.isclose(r.base_score, sum(math.log10((flat.count(x) + 0.1) / (n + 0.1 * (v + 1))) for x in t))
            assert -200 < r.score < 0
            assert np.isclose(by_head.setdefault(r.doc_id, r.score), r.score, rtol=1e-9)
    assert by_head[0] > by_head[3]


def test_beats_single_words_on_held_out_texts_it_can_tell(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    r = scored(df, F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(10)) != 0).agg(
        F.sum("score"), F.sum("base_score"), F.count("*")).first()
    assert r[2] == 1000 and r[0] > r[1]


def test_odd_rows(spark):
    got = scored(odd_documents(spark), F.col("doc_id") < 8).collect()
    assert len(got) == 11 and all(np.isfinite(r.score) and r.score <= 0 for r in got)
    assert {r.n_tokens for r in got if r.doc_id in (3, 4, 5)} == {1}
    assert scored(no_documents(spark), F.lit(True)).count() == 0
    alone = scored(odd_documents(spark), F.lit(False)).collect()
    assert {(r.n_known, r.train_tokens) for r in alone} == {(0, 0)} and all(np.isfinite(r.score) for r in alone)


def segmented(word, p):
    """All segmentations of a word's bytes, with the blank before it, and their probabilities."""
    found = []

    def go(raw, pieces_, weight):
        if not raw:
            found.append((pieces_, weight))
        for n in range(1, len(raw) + 1):
            if raw[:n] in p:
                go(raw[n:], [*pieces_, raw[:n]], weight * p[raw[:n]])
    go(b" " + word, [], 1.0)
    return found


def test_scores_against_all_segmentations(spark, monkeypatch):
    """The whole score by brute force: pieces re-estimated over all segmentations, discounted counts, classes, ends."""
    names = sorted(PIECES)
    monkeypatch.setattr(lattice_lm, "vocabulary", lambda path: (names, np.array([PIECES[n] for n in names])))
    docs = [(0, "ab bb ab", "x"), (1, "AB a", "x"), (2, "bb bb é", "y"), (3, "abab ab bbab", "y"), (4, "a b", None), (5, "", "x"), (6, None, "y"),
            (10, "ab aab", "x"), (11, "bbbb a abab é", None), (12, "", None), (13, "ab ab ab ab bb", "y")]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")

    def tokens(text):
        return [w.encode() for w in re.findall(r"\S+", (text or "").lower())] + [None]
    train = [(tokens(t), g or "") for i, t, g in docs if i < 10]
    kinds = sorted({g for _, g in train})
    counts = {g: Counter(x for t, k in train for x in t if k == g) for g in kinds}
    both = sum(counts.values(), Counter())
    p = dict(PIECES)
    for _ in range(lattice_lm.ROUNDS):
        used = Counter()
        for word in both:
            if word is not None:
                cuts_ = segmented(word, p)
                whole = sum(x for _, x in cuts_)
                for some, x in cuts_:
                    for piece in some:
                        used[piece] += x / whole
        # the pieces start anew from the file's probabilities each time, as 50 more pieces
        size = sum(used.values())
        p = {n: (used[n] + 50 * PIECES[n]) / (size + 50) for n in names}

    def level(c):
        once, twice = (sum(v == k for v in c.values()) for k in (1, 2))
        d = once / (once + 2 * twice) if once and twice else 0.5
        total = sum(c.values())
        return lambda token: max(c[token] - d, 0) / total, d * len(c) / total
    seen_all, freed_all = level(both)

    def score(text):
        out = 0.0
        for g in kinds:
            seen, freed = level(counts[g])
            value = (counts[g][None] + 0.5) / (both[None] + 0.5 * len(kinds))
            for token in tokens(text):
                back = seen_all(token) + (freed_all * sum(x for _, x in segmented(token, p)) if token is not None else 0)
                value *= seen(token) + freed * back
            out += value
        return math.log10(out)
    for head in (1000, 0):
        got = {r.doc_id: r.score for r in scored(df, F.col("doc_id") < 10, head=head).collect()}
        assert len(got) == len(docs)
        for i, text, _ in docs:
            assert np.isclose(got[i], score(text), rtol=1e-9), (i, got[i], score(text))
