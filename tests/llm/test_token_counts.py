"""Counts by the cache against the library, text by text."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gigloom.llm import token_counts, tokens
from gigloom.llm.token_counts import counted
from gigloom.llm.tokens import public
from tests.llm.odd import no_documents, odd_documents

NAME = "word_bpe_49k.json"
TRAPS = ["", " ", "a<|endoftext|>b", "<|ENDOFTEXT|> x", "<|start oftext|>", " <|startoftext|><|endoftext|> ", "Don't we'LL", "é ́e",
         "a\xa0b\x1cc　d\x85e", "ΑΣ ΑΣ. İ", "x" * 5000, "1234 5 \n\n\t 6", "漢字 😀😀", "\0 a \x0b\x0c b"]


def library(texts):
    import public_tokenizers
    t = Tokenizer.from_file(public_tokenizers.path(NAME))
    return [len(t.encode(x or "", add_special_tokens=False)) for x in texts]


def test_words_count_alone():
    assert tokens.lengths_of(public(NAME), TRAPS) == library(TRAPS)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(" \n\t\x0b\x0c\r\xa0\x1c\x85'<|>astredofx́eΣσÉé1漢"), max_size=40), max_size=4))
def test_any_texts(texts):
    assert tokens.lengths_of(public(NAME), texts) == library(texts)


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(tokens, "HELD", 3)
    lengths = tokens.Lengths(public(NAME))
    texts = [f"word{i % 7} other{i} {'long' * (i % 40)}" for i in range(60)]
    assert [n for t in texts for n in lengths.of([t])] == library(texts)


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    held = docs.collect()
    want = {(r.doc_id, len((r.text or "").encode()), n, n > 2048) for r, n in zip(held, library([r.text for r in held]))}
    assert {tuple(r) for r in counted(docs).collect()} == want


@pytest.mark.parametrize("name", [NAME, "piece_bpe_32k.model", "byte_bpe_50k.json"])
def test_cache(spark, tmp_path, monkeypatch, name):
    """A second call encodes only what is new; another tokenizer shares the folder but not the counts."""
    cache, docs = str(tmp_path / "cache"), spark.createDataFrame(
        [(1, "one two"), (2, "one  two\n"), (3, None), (4, ""), (5, "one two")], "doc_id long, text string")
    one = public(name)
    first = sorted(tuple(r) for r in counted(docs, one, cache).collect())
    stored = spark.read.parquet(cache).count()
    assert stored == (2 if one.drops_space else 3) and [r[2] for r in first] == [one.lengths([t])[0] for t in ("one two", "one  two\n", "", "", "one two")]
    more = docs.unionByName(spark.createDataFrame([(6, "three"), (7, "three")], docs.schema))
    again = sorted(tuple(r) for r in counted(more, one, cache).collect())
    assert again[:5] == first and spark.read.parquet(cache).count() == stored + 1
    counted(docs, public("byte_bpe_50k.json" if name == NAME else NAME), cache).collect()
    assert spark.read.parquet(cache).select("version").distinct().count() == 2
    # a key that two writers appended counts once, and stored counts are used
    spark.read.parquet(cache).selectExpr("version", "digest", "n_tokens + 7 as n_tokens").write.parquet(str(tmp_path / "raised"))
    spark.read.parquet(str(tmp_path / "raised")).write.mode("append").parquet(str(tmp_path / "raised2"))
    spark.read.parquet(str(tmp_path / "raised")).write.mode("append").parquet(str(tmp_path / "raised2"))
    assert sorted(r.n_tokens for r in counted(docs, one, str(tmp_path / "raised2")).collect()) == sorted(r[2] + 7 for r in first)


def test_version_tells_tokenizers_apart():
    assert len({public(n).version for n in (NAME, "piece_bpe_32k.model", "byte_bpe_50k.json")}) == 3


def test_odd_rows(spark):
    rows = counted(odd_documents(spark), limit=11).collect()
    held = odd_documents(spark).collect()
    want = sorted((r.doc_id or -1, len((r.text or "").encode()), n, n > 11) for r, n in zip(held, library([r.text for r in held])))
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens, r.over_limit) for r in rows) == want
    assert counted(no_documents(spark)).count() == 0


def test_copies_are_encoded_once(spark, tmp_path):
    docs = spark.range(2000).selectExpr("id as doc_id", "if(id % 3 = 0, concat('text ', id), 'the same text') as text")
    assert counted(docs, cache=str(tmp_path / "c")).count() == 2000
    assert spark.read.parquet(str(tmp_path / "c")).count() == 668
    assert token_counts.counts_in(str(tmp_path / "none"), "v", docs.selectExpr("cast(text as binary) as digest")).count() == 0
