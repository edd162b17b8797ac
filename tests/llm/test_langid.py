"""Language ID: held-out accuracy, the scores against a plain sum, and odd rows."""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from gigloom.llm import langid
from gigloom.llm.queries import op3_language_id
from tests.llm.odd import no_documents, odd_documents

SF = "/root/testdata/sf0.001"


def test_held_out_accuracy(spark):
    truth = {r.doc_id: (r.lang, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op3_language_id(spark, SF).collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if r.held_out]
    assert len(held) > 20 and np.mean([r.lang_pred == truth[r.doc_id][0] for r in held]) >= 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_features_match_a_plain_count():
    texts = ["Ab c1", None, "", "éé", "x\0y"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    for t, (found, share) in zip(texts, langid.features(batch, "text")):
        s = re.sub(r"[\x01-\x7f]", lambda m: m[0] if m[0].isalpha() else " ", (t or "").replace("\0", " ").lower())
        grams = [s[i:i + n] for n in langid.ORDERS for i in range(len(s) - n + 1)]
        assert len(found) == len(set(grams)) and abs(sum(share) - bool(grams)) < 1e-9
        assert np.allclose(sorted(share), sorted(grams.count(g) / len(grams) for g in set(grams)))


def test_scores_match_the_linear_model():
    rng = np.random.default_rng(0)
    model = langid.Model(["a", "b", "c"], rng.normal(size=(langid.DIMS, 3)).astype(np.float32), np.array([0.1, 0.2, -0.3]), 1.7)
    batch = pa.RecordBatch.from_arrays([pa.array(["One text", "zwei", None, "tres tigres " * 50])], ["text"])
    got = langid.scores(batch, "text", model)
    for row, (found, share) in zip(got, langid.features(batch, "text")):
        z = (share @ model.weights[found].astype(float) + model.bias) / model.temperature if len(found) else model.bias / model.temperature
        assert np.allclose(row, np.exp(z) / np.exp(z).sum(), atol=1e-6)


def test_every_language_is_learned(spark):
    """205 languages of own alphabets, the last five with fewer texts than the others."""
    rows = []
    for k in range(205):
        rng = np.random.default_rng(k)
        rows += [(f"l{k:03}", " ".join("".join(chr(0x4E00 + 40 * k + c) for c in rng.integers(0, 12, 4)) for _ in range(8))) for _ in range(8 if k < 200 else 6)]
    docs = spark.createDataFrame([(i, t, g) for i, (g, t) in enumerate(rows)], "doc_id long, text string, lang string")
    got = langid.languages(docs, F.lit(True)).collect()
    assert len(got) == len(rows) and np.mean([r.lang == r.lang_pred for r in got]) > 0.99
    assert {r.lang_pred for r in got} == {r.lang for r in got}


def test_sparse_weights_say_the_same(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    one = langid.fit(docs, F.lit(True))
    monkeypatch.setattr(langid, "DENSE", 1)
    monkeypatch.setattr(langid, "LEAST", langid.SAMPLE)
    other = langid.fit(docs, F.lit(True))
    texts = [r.text for r in docs.orderBy("doc_id").limit(100).collect()]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    assert isinstance(other.weights, langid.Sparse)
    assert np.allclose(langid.scores(batch, "text", one), langid.scores(batch, "text", other), atol=1e-3)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    got = langid.languages(docs, F.lit(True), pred="p", score="s")
    assert got.columns == [*docs.columns, "p", "s"] and got.count() == 11
    by = {r.doc_id: (r.p, r.s) for r in got.collect()}
    assert by[3] == by[4] == by[5] == ("und", 0.0) and by[9][0] != "und"
    digits = spark.createDataFrame([(1, "123 ... 45", "en"), (2, "abc", "en")], "doc_id long, text string, lang string")
    assert {r.doc_id: r.lang_pred for r in langid.languages(digits, F.lit(True)).collect()} == {1: "und", 2: "en"}
    assert langid.languages(no_documents(spark), F.lit(True)).count() == 0
    unlearned = langid.languages(docs, F.lit(False)).collect()
    assert {(r.lang_pred, r.score) for r in unlearned} == {("und", 0.0)} and "mine score" not in {r.score for r in unlearned}
