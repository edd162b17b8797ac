"""Line dedup against a plain reading of its rules."""

import random
import re

from gigloom.llm.line_dedup import MIN_LINE, MIN_RUN, repeated_passages, without_repeats
from tests.llm.odd import LONG, no_documents, odd_documents


def brute(rows):
    """{doc_id: [(start, end)]} by dictionaries over all units."""
    def norm(s):
        return tuple(re.findall(r"[^\x20\x09-\x0D]+", re.sub(r"[A-Z]", lambda m: m[0].lower(), s)))

    def cut(text):
        lines, sentences = [], []
        for m in re.finditer(r"[^\n]*", text):
            words = list(re.finditer(r"[^\x20\x09-\x0D]+", m[0]))
            if not words:
                continue
            base, group = m.start(), []
            lines.append((base + words[0].start(), base + words[-1].end(), norm(m[0])))
            for k, w in enumerate(words):
                group.append(w)
                if w[0][-1] in ".!?" or k == len(words) - 1:
                    a, b = group[0].start(), group[-1].end()
                    sentences.append((base + a, base + b, norm(m[0][a:b])))
                    group = []
        return lines, sentences
    texts = {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        texts.setdefault(i, t or "")
    seen, out = set(), {}
    for i, t in texts.items():
        lines, sentences = cut(t)
        spans, run = [], []
        for kind, units in (("l", lines), ("s", sentences)):
            run = []
            for a, b, n in [*units, (None, None, None)]:
                again = n is not None and (kind, n) in seen
                if n is not None:
                    seen.add((kind, n))
                if kind == "l" and again and len(n) >= MIN_LINE:
                    spans.append((a, b))
                if kind == "s":
                    if again:
                        run.append((a, b, len(n)))
                    else:
                        if sum(x[2] for x in run) >= MIN_RUN:
                            spans.append((run[0][0], run[-1][1]))
                        run = []
        merged = []
        for a, b in sorted(spans):
            if merged and a <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
            else:
                merged.append((a, b))
        if merged:
            out[i] = merged
    return out


def corpus():
    rng = random.Random(8)
    vocabulary = [f"{a}{b}" for a in ("the", "on", "Ér", "in") for b in ("ar", "è", "tion", "", "漢")]
    sentence = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n)) + rng.choice(".!?")
    shared = [" ".join(sentence(rng.randrange(3, 12)) for _ in range(k)) for k in (1, 2, 6, 9, 9)]
    rows = []
    for i in range(60):
        parts = [sentence(rng.randrange(1, 15)) for _ in range(rng.randrange(1, 12))]
        for _ in range(rng.randrange(3)):
            parts.insert(rng.randrange(len(parts) + 1), rng.choice(shared))
        rows.append((i, "".join(p + rng.choice([" ", "\n", "  \n", " "]) for p in parts)))
    return rows + [(60, rows[5][1]), (61, rows[5][1].upper())]


def test_passages_match_brute_force(spark):
    rows = corpus()
    got = {}
    for r in repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got.setdefault(r.doc_id, []).append((r.start, r.end))
        assert r.first_doc_id <= r.doc_id and r.n_words >= MIN_LINE
    assert {k: sorted(v) for k, v in got.items()} == brute(rows)


def test_passage_inside_a_line(spark):
    """A passage of over 50 words between other sentences of a line goes from all texts but the first."""
    passage = " ".join(f"p{i} q{i} r{i} s{i} t{i}." for i in range(12))
    rows = [(i, f"Text {i} begins so{i}. {passage} And {i} ends so{i}.") for i in range(5)]
    got = {r.doc_id: r.text for r in without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0] == rows[0][1] and all(got[i] == f"Text {i} begins so{i}. And {i} ends so{i}." for i in range(1, 5))


def test_passage_pasted_within_a_sentence(spark):
    """Without sentence ends, with its only ends far inside, and with a full stop of another script: all go to their exact ends."""
    plain = " ".join(f"é{i}w" for i in range(51))
    ends = " ".join(f"k{i}" + "." * (i in (20, 40)) for i in range(60))
    other = " ".join(f"漢{i}" + "。" * (i % 10 == 9) for i in range(70))
    rows = [(10 * k + i, f"Host {k} {i} says{i}  {p}\tand{i} goes on{i} so.") for k, p in enumerate((plain, ends, other)) for i in range(4)]
    short = " ".join(f"s{i}" for i in range(49))
    rows += [(90 + i, f"Own{i} {short} end{i}") for i in range(3)]
    got = {r.doc_id: r.text for r in without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        k, i2 = divmod(i, 10)
        assert got[i] == (text if i2 == 0 or k == 9 else f"Host {k} {i2} says{i2}  and{i2} goes on{i2} so.")
    spans = {r.doc_id: (r.n_words, r.first_doc_id) for r in repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert spans == {10 * k + i: (n, 10 * k) for k, n in enumerate((51, 60, 70)) for i in range(1, 4)}


def test_odd_rows(spark):
    docs = odd_documents(spark)
    got = {(r.doc_id, r.start, r.end, r.n_words, r.first_doc_id) for r in repeated_passages(docs).collect()}
    assert got == {(6, 0, 62, 12, 1)}
    out = without_repeats(docs)
    assert out.columns == docs.columns and out.count() == 11
    texts = {(r.doc_id, r.text) for r in out.select("doc_id", "text").collect()}
    assert {(6, ""), (3, None), (4, ""), (8, LONG), (7, "zwei drei vier")} <= texts
    assert repeated_passages(no_documents(spark)).count() == 0 and without_repeats(no_documents(spark)).count() == 0


def test_lines_repeated_in_one_text(spark):
    line = "a line of five words"
    got = without_repeats(spark.createDataFrame([(1, f"{line}\n{line}\nend\n{line}")], "doc_id long, text string")).first().text
    assert got == f"{line}\nend\n"
