"""From raw documents to a mixed training corpus: STAGES in order, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gigloom.llm import decontaminate, langid, line_dedup, mixing, ngram_join
from gigloom.llm.store import read, spare, stored
from gigloom.session import drop_settled, remembered


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str, wanted: tuple[str, ...] | None = None) -> DataFrame:
    """Documents that have a language: all but `und`, with the predicted language where `lang` is null.

    wanted: only documents whose predicted language is one of these. A clean text between near languages is sure of none, and
    stays; a null or empty text and one without a letter goes. Repeated rows, nulls in other columns and columns of any name
    stay as they are. An empty table stays empty.
    """
    learn = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) != 0
    pred = spare(docs, "_lang_pred")
    found = langid.languages(docs, learn, pred=pred, score=spare(docs, "_lang_score"))
    kept = found.where(F.col(pred) != "und" if wanted is None else F.col(pred).isin(*wanted))
    return kept.select(*[F.coalesce(c, pred).alias(c) if c == "lang" else F.col(f"`{c}`") for c in docs.columns])


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near copies by 5-word shingles at 0.8: the smallest doc_id of each group stays, and rows without an id.

    Null and empty texts are near to nothing and stay; rows that repeat the kept id all stay. An empty table stays empty.
    """
    groups = ngram_join.groups_of_near_copies(docs, width=5, similarity=(80, 100))
    copies = groups.where("component_id < doc_id").select("doc_id").distinct()
    return docs.join(copies, "doc_id", "left_anti").select(docs.columns)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines and passages that an earlier document has; a document left without a word goes.

    So do null and empty texts. Rows without an id lose nothing. An empty table stays empty.
    """
    left = line_dedup.without_repeats(docs)
    kept = left.where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return (kept.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else kept).select(docs.columns)


def without_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark. Null and empty texts hold none and stay, as do rows without an id."""
    return decontaminate.without_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the training mix takes of each document; a null or empty text has none, an empty table gives no rows."""
    return mixing.mixed(docs, weights=(5, 2, 1))


STAGES = [
    ("language ID", known_language),
    ("n-gram Jaccard join", one_of_each_group),
    ("substring dedup", without_repeated_passages),
    ("benchmark decontamination", without_test_items),
    ("mixing sources to target weights", mixed_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        before = remembered()
        docs = stored(stage(spark, docs, sf_dir))
        output = remembered()[-1]
        # the package's archive is needed as long as the program runs
        drop_settled(spark, [p for p in remembered() if p not in before and p != output and not p.endswith(".zip")])
    return docs


ORACLE_SQL = None
