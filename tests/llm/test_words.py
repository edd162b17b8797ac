"""Words, hashes and shingles against plain Python."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from gigloom.llm.words import CHUNK, by_row, pieces, shingles, words

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aAbZ é\t\n\x0b\x0c\r.漢\x00\x1f", max_size=30)), max_size=8)


def batch(texts):
    return pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], ["id", "text"])


def plain(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_words_match_a_regular_expression(texts):
    w = words(batch(texts), "text")
    low = re.sub(rb"[A-Z]", lambda m: m[0].lower(), w.raw.tobytes())
    got = [[] for _ in texts]
    for r, s, e in zip(w.row, w.start, w.end):
        got[r].append(low[s:e])
    assert got == [plain(t) for t in texts]
    h = w.hashes()
    by_word = {}
    for r, s, e, x in zip(w.row, w.start, w.end, h):
        assert by_word.setdefault(low[s:e], x) == x
    assert len(set(by_word.values())) == len(by_word)
    assert w.counts().tolist() == [len(plain(t)) for t in texts]


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.integers(1, 5))
def test_shingles_match_slices(texts, width):
    w = words(batch(texts), "text")
    row, h = shingles(w.row, w.hashes(), width)
    cut = by_row(row, len(texts))
    names = {}
    for t, a, b in zip(texts, cut[:-1], cut[1:]):
        p = plain(t)
        want = [tuple(p[i:i + width]) for i in range(max(1, len(p) - width + 1))] if p else []
        assert len(want) == b - a
        for x, y in zip(want, h[a:b]):
            assert names.setdefault(x, y) == y
    assert len(set(names.values())) == len(names)


def test_hashes_do_not_depend_on_place():
    long = "x" * (CHUNK + 5)
    w = words(batch([f"ab {long} ab", "ab", long]), "text")
    h = w.hashes()
    assert h[0] == h[2] == h[3] and h[1] == h[4] and h[0] != h[1]


def test_pieces_keep_all_rows_in_order():
    b = batch([None, "a" * 10, "b" * 30, "", "c" * 5, "d" * 5])
    parts = list(pieces([b, b], "text", 12))
    assert [x for p in parts for x in p.column(0).to_pylist()] == [*range(6), *range(6)]
    assert all(p.num_rows == 1 or sum(len(x or "") for x in p.column(1).to_pylist()) <= 12 for p in parts)


def test_sliced_batches():
    w = words(batch(["a b", "c", "d e f"]).slice(1, 2), "text")
    assert w.row.tolist() == [0, 1, 1, 1] and np.all(np.diff(w.start) > 0)
