"""License scans: golden notices with edits, offsets, winnowing's guarantee, alignment against plain dynamic programming."""

import random

import numpy as np

from gigloom.llm.license_scan import GAP, MATCH, MISMATCH, aligned, licenses, winnowed
from gigloom.llm.license_texts import TEMPLATES
from tests.llm.odd import no_documents, odd_documents


def found(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {(r.doc_id, r.license): r for r in licenses(df).collect()}


def test_every_template_is_found_in_its_place(spark):
    names = sorted(TEMPLATES)
    texts = [f"é intro {i} words.\n{TEMPLATES[n]}\nand more" for i, n in enumerate(names)]
    got = found(spark, texts)
    for i, n in enumerate(names):
        r = got[i, n]
        assert r.coverage == 1.0 and r.matched == r.template_words
        assert texts[i][r.start:r.end].strip('"().<>/') in TEMPLATES[n] and len(texts[i][r.start:r.end]) >= len(TEMPLATES[n]) - 4


def test_edited_notices(spark):
    words = TEMPLATES["MIT"].split()
    rng = random.Random(1)
    few, many = list(words), list(words)
    for _ in range(12):
        few[rng.randrange(len(few))] = "changed"
    del few[40:44]
    for i in range(0, len(many), 2):
        many[i] = "changed"
    got = found(spark, [" ".join(few), " ".join(many), " ".join(words[:60]), "MIT License is mentioned here, version 3."])
    assert 0.8 <= got[0, "MIT"].coverage < 1 and (1, "MIT") not in got and (2, "MIT") not in got
    assert not [k for k in got if k[0] == 3]


def test_neighbours_are_told_apart(spark):
    """Every template's text has its own name and no other, also with words of its own before and after."""
    names = sorted(TEMPLATES)
    got = {}
    for r in licenses(spark.createDataFrame([(i, f"some words first {TEMPLATES[n]} and others after") for i, n in enumerate(names)],
                                            "doc_id long, text string")).collect():
        got.setdefault(names[r.doc_id], []).append(r.license)
    assert got == {n: [n] for n in names}


def test_notices_of_unknown_versions_have_no_name(spark):
    gpl = TEMPLATES["GPL-3.0-or-later"]
    texts = ["This work is licensed under the GNU General Public License, version 2.", "Licensed under CC BY 4.0.", "Licensed under CC BY 2.5.",
             "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
             "Released under the Artistic License.", gpl.replace("version 3", "version 9"), gpl.replace("GNU General", "GNU Lesser General"),
             TEMPLATES["BSD-3-Clause"].replace("holder nor", "owner nor"), f"{TEMPLATES['MIT']}\n{TEMPLATES['Apache-2.0']}"]
    got = {}
    for doc, name in found(spark, texts):
        got.setdefault(doc, set()).add(name)
    assert got == {0: {"GPL-2.0 notice"}, 1: {"CC-BY-4.0 notice"}, 3: {"CC-BY-NC-4.0"}, 6: {"LGPL-3.0-or-later"}, 7: {"BSD-3-Clause"},
                   8: {"MIT", "Apache-2.0"}}


def test_words_inserted_into_a_notice(spark):
    words = TEMPLATES["MIT"].split()
    half, third = len(words) // 2, len(words) // 3
    more = [f"own{i}" for i in range(600)]
    middle = " ".join(words[:half] + more[:20] + words[half:])
    texts = [middle, " ".join(words[:third] + more[:9] + words[third:2 * third] + more[9:] + words[2 * third:]), f"{middle}\n{middle}",
             " ".join(words[half:] + more[:20] + words[:half])]
    rows = [r for r in licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect() if r.license == "MIT"]
    assert sorted((r.doc_id, r.start) for r in rows) == [(0, 0), (1, 0), (2, 0), (2, len(middle) + 1)]
    assert all(r.coverage == 1.0 for r in rows)
    assert {r.end for r in rows if r.doc_id == 0} == {len(middle.rstrip('."'))}


def test_repeated_notices_are_rows_each(spark):
    line = "Released under the MIT License."
    df = spark.createDataFrame([(1, "\n".join([line] * 50)), (2, f"{line} {'x ' * 5000}{line.upper()}")], "doc_id long, text string")
    got = licenses(df).collect()
    assert sorted((r.doc_id, r.start) for r in got) == [(1, i * (len(line) + 1)) for i in range(50)] + [(2, 0), (2, len(line) + 1 + 10_000)]


def test_winnowing_keeps_one_of_every_window():
    rng = np.random.default_rng(0)
    for n in range(1, 40):
        runs = rng.integers(0, 12, n).astype(np.uint64)
        kept = set(winnowed(runs, 4).tolist())
        assert all(kept & set(range(i, min(i + 4, n))) for i in range(max(1, n - 3)))


def test_alignment_finds_the_common_words():
    rng = random.Random(5)
    for _ in range(200):
        t = [rng.randrange(30) for _ in range(20)]
        x = [w for w in t if rng.random() > 0.15]
        for _ in range(rng.randrange(3)):
            x.insert(rng.randrange(len(x) + 1), 99)
        text = [50] * 5 + x + [51] * 5
        best = [[0] * (len(text) + 1) for _ in range(len(t) + 1)]  # plain local alignment
        for i in range(1, len(t) + 1):
            for j in range(1, len(text) + 1):
                best[i][j] = max(0, best[i - 1][j - 1] + (MATCH if t[i - 1] == text[j - 1] else MISMATCH), best[i - 1][j] + GAP, best[i][j - 1] + GAP)
        n, a, b = aligned(np.array(t), np.array(text), 5, 8)
        assert MATCH * n >= max(map(max, best)) and text[a] in t and text[b] in t


def test_odd_rows(spark):
    assert licenses(odd_documents(spark)).count() == 0 and licenses(no_documents(spark)).count() == 0
    got = licenses(spark.createDataFrame([(None, TEMPLATES["ISC"]), (1, None)], "doc_id long, text string")).collect()
    assert [(r.doc_id, r.license) for r in got] == [(None, "ISC")]
    assert licenses(odd_documents(spark), templates={}).count() == 0
    assert licenses(odd_documents(spark), templates={"own": "one two three four five"}).count() == 4
