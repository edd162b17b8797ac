"""Toxicity: held-out accuracy on planted insults, unseen misspellings, windows against plain sums, odd rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gigloom.llm import toxicity
from gigloom.llm.toxicity import WINDOW, bags, fit, scored, train, worst
from tests.llm.odd import no_documents, odd_documents

INSULTS = ["idiot", "moron", "scumbag", "worthless", "pathetic"]


def texts(n, seed):
    rng = random.Random(seed)
    parts = ["an", "th", "er", "ou", "ti", "on", "re", "st", "le", "mo", "id"]
    out = []
    for i in range(n):
        words = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 5))) for _ in range(rng.choice([10, 40, 300]))]
        if i % 3 == 0:
            for _ in range(rng.randrange(1, 4)):
                words[rng.randrange(len(words))] = rng.choice(INSULTS)
        out.append((" ".join(words), int(i % 3 == 0)))
    return out


@pytest.fixture(scope="module")
def model():
    rows = texts(1500, 1)
    return train([t for t, _ in rows], np.array([y for _, y in rows]))


def score(model, found):
    return model.probability(worst(bags(found), model.part, model.bias, len(found)))


def test_held_out(model):
    rows = texts(600, 2)
    p, y = score(model, [t for t, _ in rows]), np.array([y for _, y in rows])
    assert (p[y == 1] >= 0.7).mean() >= 0.95 and (p[y == 0] >= 0.7).mean() <= 0.03


def test_misspellings_share_their_ngrams(model):
    clean = " ".join(["thering", "on", "ander", "lest"] * 10)
    plain, *odd = score(model, [clean, f"{clean} idiots", f"{clean} moronic", f"{clean} scumbagg"])
    assert all(p > max(0.5, 10 * plain) for p in odd)


def test_windows_match_plain_sums():
    rng = np.random.default_rng(3)
    part = rng.normal(size=toxicity.BUCKETS).astype(np.float32)
    found = ["one two three", "", None, "a " * 20 + "bb cc", "x", " ".join(f"w{i}" for i in range(50))]
    b = bags(found)
    got = worst(b, part, 0.25, len(found))
    for r in range(len(found)):
        of = [part[b.bucket[b.word == k]] for k in np.flatnonzero(b.row == r)]
        windows = [np.concatenate(of[i:i + WINDOW]).astype(float).mean() for i in range(max(1, len(of) - WINDOW + 1))] if of else []
        assert np.isclose(got[r], max(windows) + 0.25, atol=1e-5) if windows else got[r] == -np.inf


def test_words_have_their_own_subwords():
    b = bags(["abcd", "xx abcd yy", "ABCD"])
    own = [sorted(b.bucket[b.word == k]) for k in range(len(b.row))]
    assert own[0] == own[2] == own[4] and b.row.tolist() == [0, 1, 1, 1, 2]


def test_long_texts_teach(spark):
    """All texts have over 4,000 code points, one over LONG, and toxic ones are told from others."""
    rng = random.Random(9)
    rows = [(" ".join(t for t, _ in texts(90, 100 + i)[1::3]), i % 2) for i in range(60)]
    rows = [(f"{t[:len(t) // 2]} {' '.join(rng.choice(INSULTS) for _ in range(4))} {t[len(t) // 2:]}" if y else t, y) for t, y in rows]
    rows[0] = (rows[0][0] * (toxicity.LONG // len(rows[0][0]) + 2), 0)
    assert min(len(t) for t, _ in rows) > 4000
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)], "doc_id long, toxic int")
    learned = fit(docs, labels, F.col("doc_id") < 40)
    held = [r for r in scored(docs, learned).collect() if r.doc_id >= 40]
    assert np.mean([(r.score >= 0.5) == bool(r.doc_id % 2) for r in held]) >= 0.9


def test_odd_rows(spark):
    rows = texts(300, 4)
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)] + [(None, 1), (5, None), (5, 0), (9999, 1)], "doc_id long, toxic int")
    learned = fit(docs, labels, F.lit(True))
    odd = odd_documents(spark)
    got = scored(odd, learned)
    assert set(got.columns) == set(odd.columns) and got.count() == 11
    by = {r.doc_id: r.score for r in got.collect()}
    assert by[3] == by[4] == by[5] == 0.0 and all(0 <= p <= 1 for p in by.values())
    assert scored(no_documents(spark), learned).count() == 0
    assert fit(no_documents(spark), labels, F.lit(True)) is None
    assert fit(docs, labels.limit(0), F.lit(True)) is None
    assert {r.score for r in scored(odd, None).collect()} == {0.0}


def test_labels_without_a_sign_dont_flatten_the_probability():
    """Toxic labels on texts that look clean are the floor's, so the others still score high."""
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(-6, 1.2, 900), rng.normal(3, 1.2, 90), rng.normal(-6, 1.2, 10)])
    y = np.concatenate([np.zeros(900), np.ones(100)]).astype(int)
    slope, offset, floor = toxicity._logistic(x, y)
    model = toxicity.Model(np.zeros(1), 0.0, slope, offset, floor)
    p = model.probability(np.array([-np.inf, -6.0, 1.0, 3.0]))
    assert 0.005 <= floor <= 0.03 and p[0] == 0 and 0.005 <= p[1] < 0.05 and p[2] > 0.7 and p[3] > 0.97
    assert toxicity.Model(np.zeros(1), 0.0, *toxicity._logistic(x[:990], y[:990])).floor == 0


def test_stems_of_long_letters_are_learned():
    """Words are told apart by stems of several two-byte letters; new endings share them."""
    rng = np.random.default_rng(6)

    def text(stem):
        return " ".join("".join(rng.choice(list("éèêàç"), 5)) for _ in range(12)) + (f" réeux{''.join(rng.choice(list('abdfg'), 4))}" if stem else "")
    labels = np.arange(400) % 4 == 0
    model = train([text(y) for y in labels], labels.astype(int))
    new = [text(i % 2 == 0) for i in range(60)]
    p = model.probability(worst(bags(new), model.part, model.bias, 60))
    assert ((p >= 0.7) == (np.arange(60) % 2 == 0)).mean() >= 0.95
