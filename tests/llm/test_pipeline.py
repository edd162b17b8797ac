"""The pipeline: each stage takes odd rows, keeps the columns of documents, and its decisions take effect."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gigloom.llm.store import stored
from tests.llm.odd import clashing, no_documents, odd_documents
from tests.llm.test_mixing import plain_targets

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_rows(spark, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    for docs in (odd_documents(spark), no_documents(spark)):
        docs = clashing(docs)
        out = stage(spark, docs, SF)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.schema.names == docs.schema.names
            assert {r["_lang_pred"] for r in out.select("_lang_pred").collect()} <= {"mine _lang_pred"}
        assert out.count() <= docs.count()


def test_language_fills_what_is_null_and_chooses(spark):
    rows = [(i, ("the cat sat on the mat and " if i % 2 else "der hund und die katze ") * 5, ("en" if i % 2 else "de") if i < 60 else None, "s", 1)
            for i in range(70)] + [(99, "123", "en", "s", 1), (98, None, None, "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = {r.doc_id: r.lang for r in corpus_pipeline.known_language(spark, docs, SF).collect()}
    assert out == {i: "en" if i % 2 else "de" for i in range(70)}
    only = corpus_pipeline.known_language(spark, docs, SF, wanted=("de",)).collect()
    assert {r.doc_id for r in only} == set(range(0, 70, 2))


def test_stages_on_planted_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").where("lang = 'en'")
    item = spark.read.parquet(f"{SF}/benchmark.parquet").where("item_id = 2").first().text
    clean = [(90_001, "Quite another text, with words that no one else has: " + " ".join(f"zyx{i}" for i in range(80)))]
    passage, own = " ".join(f"pass{i} age{i}." for i in range(40)), " ".join(f"other{i}" for i in range(60)) + ". "
    planted = [(90_002, clean[0][1] + " more"), (90_003, "1234 5678"), (90_004, "begin " + item + " end"),
               (90_005, " ".join(f"first{i}" for i in range(60)) + ". " + passage), (90_006, own + passage)]
    more = spark.createDataFrame([(i, t, "en", "src0", len(t)) for i, t in clean + planted], docs.schema)
    docs = docs.union(more)
    ids = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF))
        ids.append({r.doc_id: r.text for r in docs.where("doc_id > 90000").collect()})
    language, near, dedup, leaks = ids
    assert set(language) == {90_001, 90_002, 90_004, 90_005, 90_006}
    assert set(near) == {90_001, 90_004, 90_005, 90_006}
    assert dedup[90_005] == planted[3][1] and dedup[90_006] == own
    assert set(leaks) == {90_001, 90_005, 90_006} and leaks[90_001] == clean[0][1]
    assert docs.where(F.length("text") != F.col("n_chars")).count() == 0


def test_short_texts_of_near_languages_stay(spark):
    """Eight languages share all their words, so the best probability of each text is far below a half."""
    rows = [(i, f"casa grande {'mar sol luz'.split()[i % 3]} {'terra vento'.split()[i % 2]}", f"l{i // 12}", "a") for i in range(96)]
    docs = spark.createDataFrame([(*r, len(r[1])) for r in [*rows, (96, "12 34", "l0", "a")]],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id for r in corpus_pipeline.known_language(spark, docs, SF).collect()}
    assert kept == set(range(96))


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    sizes = {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    want = plain_targets(sizes)
    assert rows and all(abs(r.target - want[r.source]) < 1e-6 * (1 + r.target) for r in rows)
