"""Alignment against walking over both tokenizers' tokens, text by text."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gigloom.llm import alignment
from gigloom.llm.alignment import Aligner, aligned, byte_alphabet, byte_ranks, merged, packed
from gigloom.llm.tokens import public
from tests.llm.odd import no_documents, odd_documents

A, B = public("byte_bpe_50k.json"), public("piece_bpe_32k.model")
LIBRARY, ALPHABET = Tokenizer.from_str(A.data.decode()), byte_alphabet()
LIBRARY.encode_special_tokens = True
TRAPS = ["", " ", "  ", "a ", " a", "a  b", "a\n b\n", "\n", "a▁b c", "x <|endoftext|> y", "a\xa0 b", "a \x1c b", "a　  b", "\0 a",
         "<s> </s> <unk> <0x41>", "é é 漢字  😀", "don't  I'll", "a\t\t b \r\n  c", "▁ ▁", "a ▁", "  \n  ", "1234 56", "a" * 3000]


def spans(parts):
    at, out = 0, []
    for p in parts:
        out.append((at, at + len(p)))
        at += len(p)
    return out


def plain(text):
    """((n_a, n_b, n_groups, n_links), digest, links) of one text."""
    nothing = ((0, 0, 0, 0), "", [])
    if not text:
        return nothing
    found, model = LIBRARY.encode(" " + text, add_special_tokens=False), B.load()
    ids_b = model.encode(text)
    bytes_a = [bytes(ALPHABET[c] for c in t) for t in found.tokens]
    names = [model.id_to_piece(i) for i in ids_b]
    bytes_b = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids_b, names)]
    if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
        return nothing
    at_a, at_b = spans(bytes_a), spans(bytes_b)
    links, j = [], 0
    for a, (start, end) in zip(found.ids, at_a):
        while at_b[j][1] <= start:
            j += 1
        k = j
        while k < len(at_b) and at_b[k][0] < end:
            links.append((a, ids_b[k]))
            k += 1
    cuts = {e for _, e in at_a} & {e for _, e in at_b}
    one, two = [], []
    for ids, at, out in ((found.ids, at_a, one), (ids_b, at_b, two)):
        mine = []
        for i, (_, end) in zip(ids, at):
            mine.append(str(i))
            if end in cuts:
                out.append(",".join(mine))
                mine = []
    groups = [f"{x}|{y}" for x, y in zip(one, two)]
    return (len(found.ids), len(ids_b), len(groups), len(links)), hashlib.sha256(";".join(groups).encode()).hexdigest(), links


def brute(rows):
    held = [(i, *plain(t)) for i, t in rows]
    counts = Counter(pair for *_, links in held for pair in links)
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    return sorted((i if i is not None else -1, *n, sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links), digest)
                  for i, n, digest, links in held)


def rows(df):
    return sorted((r.doc_id if r.doc_id is not None else -1, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256)
                  for r in df.collect())


def check(aligner, texts):
    counts, digests, text, pairs = aligner.texts(texts)
    for i, t in enumerate(texts):
        n, digest, links = plain(t)
        assert (tuple(counts[i]), digests[i]) == (n, digest), t
        assert sorted(pairs[text == i].tolist()) == sorted(b * aligner.width + a for a, b in links), t


def test_stretches_are_aligned_apart():
    check(Aligner(A, B), TRAPS)


ALIGNER = Aligner(A, B)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("   \n\t\r\xa0\x1c　▁<|>'astred0x1É漢😀\0"), max_size=30), max_size=4))
def test_any_texts(texts):
    check(ALIGNER, texts)


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(alignment, "HELD", 5)
    aligner = Aligner(A, B)
    for i in range(30):
        check(aligner, [f"word{i % 7} other{i}", f"{'long' * 30} a▁b" if i % 5 == 0 else "x  y"])


def test_ids_are_ranks():
    ranks = byte_ranks(A)
    assert len(ranks) == 50_256 and sorted(ranks.values()) == list(range(50_256)) and sorted(alignment.byte_alphabet().values()) == list(range(256))


@pytest.mark.parametrize("small", [False, True])
def test_matches_brute_force(spark, monkeypatch, small):
    if small:  # many runs of several chunks in several groups
        for name, value in (("RUN", 300), ("CHUNK", 7), ("FAN", 2), ("PARTS", 3)):
            monkeypatch.setattr(alignment, name, value)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60 if small else 1000)
    held = [(r.doc_id, r.text) for r in docs.collect()] + [(1000 + i, t) for i, t in enumerate(TRAPS)]
    assert rows(aligned(spark.createDataFrame(held, "doc_id long, text string").repartition(3))) == brute(held)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    assert rows(aligned(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert aligned(no_documents(spark)).count() == 0


def test_merge_holds_few_chunks_and_rises():
    rng = np.random.default_rng(3)
    runs = [np.sort(rng.integers(0, 500, 400)) for _ in range(9)]
    chunks = sorted((int(r[i]), n, packed(r[i:i + 16], np.full(len(r[i:i + 16]), n, np.uint16))) for n, r in enumerate(runs) for i in range(0, 400, 16))
    seen, last, held = [], -1, 0
    for step in merged(iter(chunks), lambda run: (np.uint16,)):
        pairs = np.concatenate([x[0] for _, x in step])
        assert pairs.min() > last and all((x[1] == run).all() for run, x in step)
        last, held = int(pairs.max()), max(held, len(pairs))
        seen.append(pairs)
    assert np.array_equal(np.sort(np.concatenate(seen)), np.sort(np.concatenate(runs))) and held <= 9 * 3 * 16
