"""Scores published with the public matcher this follows."""

import pytest

from gigloom.functions import fixed_values as V
from gigloom.operators import wording as W

TEAMS = ["Atlanta Falcons", "New York Jets", "New York Giants", "Dallas Cowboys"]


@pytest.mark.parametrize("a, b, score", [
    ("this is a test", "this is a new test!!!", 85.5), ("this is a test", "this is a new test", 95.0),
    ("new york jets", "New York Jets", 76.92307692307692), ("new york jets", "New York Giants", 64.28571428571428),
    ("cowboys", "Dallas Cowboys", 83.07692307692308), ("", "x", 0.0), ("same", "same", 100.0)])
def test_published_scores(a, b, score):
    assert W.weighted(a, b) == pytest.approx(score) == pytest.approx(W.weighted(b, a))


def test_parts():
    assert W.alike("this is a test", "this is a test!") == pytest.approx(96.55172413793103)
    assert W.partial("this is a test", "this is a test!") == 100
    assert W.tokens("fuzzy wuzzy was a bear", "wuzzy fuzzy was a bear") == 100
    assert W.tokens("fuzzy was a bear but not a dog", "fuzzy was a bear") == 100


def test_common_against_the_table_method():
    import random
    rnd = random.Random(5)
    for _ in range(300):
        a, b = ("".join(rnd.choice("abc ") for _ in range(rnd.randint(0, 12))) for _ in range(2))
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        assert W.common(a, b) == t[-1][-1]


def test_first_best_label_wins(spark):
    df = spark.createDataFrame([("Data Analyst",), ("Enginering",), ("qqq",), (None,)], "t string")
    got = [r[0] for r in df.select(W.closest_wording("t", V.LONG_DEPARTMENTS)).collect()]
    assert got == [W.best_of("Data Analyst", V.LONG_DEPARTMENTS, 85), "Engineering", None, None]
    assert W.best_of("Data Analyst", ["zz", "Data Science & Analytics", "Data Science & Machine Learning"], 85) == "Data Science & Analytics"


def test_skipping_hopeless_labels_changes_no_answer():
    import random
    rnd = random.Random(9)
    words = ["Data", "Water", "Lead", "Sales", "Analyst", "Finance", "Officer", "IT", "and", "Marketing", "Solar"]
    for _ in range(60):
        text = " ".join(rnd.sample(words, rnd.randint(1, 4)))
        scores = [W.weighted(text, x) for x in V.LONG_DEPARTMENTS]
        want = V.LONG_DEPARTMENTS[scores.index(max(scores))] if max(scores) >= 85 else None
        assert W.best_of(text, V.LONG_DEPARTMENTS, 85) == want


def titles():
    import random
    rnd = random.Random(7)
    words = sorted({w for label in V.LONG_DEPARTMENTS for w in label.split()}) + "senior junior lead of and for manager trainee solar x".split()
    out = [" ".join(rnd.choices(words, k=rnd.randint(1, 6))) for _ in range(150)]
    for _ in range(250):  # labels with letters changed, lost, doubled and swapped, in other surroundings
        t = list(rnd.choice(V.LONG_DEPARTMENTS))
        for _ in range(rnd.randint(0, 5)):
            i = rnd.randrange(len(t))
            t[i:i + 1] = rnd.choice([[], [t[i], t[i]], [rnd.choice("abc e")], [t[i].swapcase()]]) or []
            t = t or ["q"]
        out.append(rnd.choice(["", "Senior ", "the "]) + "".join(t) + rnd.choice(["", "s", "  II", " (remote)"]))
    return out + ["", " ", "q", "data data data data", "&", "a" * 300, "漢字", "A n a l y t i c s", "HR\tManager"]


def test_ruled_out_labels_never_win():
    held, pairs, scored = W.Labels(V.LONG_DEPARTMENTS, 85.0), 0, 0
    for t in titles():
        assert held.best(t) == W.best_of(t, V.LONG_DEPARTMENTS, 85.0), t
        able = set(held.near(t))
        assert all(W.weighted(t, label) < 85.0 for i, label in enumerate(V.LONG_DEPARTMENTS) if i not in able), t
        pairs, scored = pairs + len(V.LONG_DEPARTMENTS), scored + len(able)
    assert scored * 10 <= pairs, (scored, pairs)
    assert W.Labels([], 85.0).best("x") is None
