"""Token counts by a cache of digests.

A text's key is the digest of its normalised content with the digest of the tokenizer's version. Keys meet the stored counts
in a join; of those that miss, one row each hands its text to the tokenizer, and the new counts are appended to the cache.
"""

from __future__ import annotations

from uuid import uuid4

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gigloom.llm.store import shipped, stored
from gigloom.llm.tokens import Tokenizer, lengths_of, public
from gigloom.llm.words import pieces
from gigloom.session import remember, shared_dir

CACHE = "version string, digest binary, n_tokens long"


def content(text: Column, drops_space: bool) -> Column:
    """What the tokens of a text depend on: null is empty, and runs of white space are one space where a tokenizer drops them."""
    whole = F.coalesce(text, F.lit(""))
    return F.trim(F.regexp_replace(whole, r"[ \t\n\x0B\f\r]+", " ")) if drops_space else whole


def _encoded(tokenizer: Tokenizer):
    """(digest, n_tokens) of the rows' contents; of rows with one digest in a batch the first is encoded."""
    def run(batches):
        for batch in pieces(batches, "content"):
            first = dict(reversed(list(zip(batch.column("digest").to_pylist(), batch.column("content")))))
            n = lengths_of(tokenizer, [t.as_py() for t in first.values()])
            yield pa.RecordBatch.from_arrays([pa.array(list(first), pa.binary()), pa.array(n, pa.int64())], ["digest", "n_tokens"])
    return run


def counts_in(cache: str, version: str, keys: DataFrame) -> DataFrame:
    """digest, n_tokens: the stored counts of `keys` (digest, distinct) under one version; a cache that isn't there yet is empty."""
    spark = keys.sparkSession
    where = spark._jvm.org.apache.hadoop.fs.Path(cache)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], "digest binary, n_tokens long")
    rows = spark.read.schema(CACHE).parquet(cache).where(F.col("version") == version)
    # writers that ran at one time may have appended the same key twice
    return rows.join(keys, "digest", "left_semi").groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def counted(docs: DataFrame, tokenizer: Tokenizer | None = None, cache: str | None = None, limit: int = 2048,
            doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than `limit` tokens) of every row.

    cache: the folder of stored counts, made when first needed and appended to; without one the counts are stored in a
    folder of this call. Keys are digests (SHA-256) of whole contents and of the tokenizer's file and release, so stored
    counts never go stale, and tokenizers share a cache.

    One row for each row, repeated ones too; rows of equal content are encoded once. A null text is empty: 0 bytes and
    tokens. A null id stays null. Texts of any length count whole. Other columns are ignored, whatever their names. An
    empty table gives no rows and appends nothing.

    A content's text travels from the row with its smallest id, so copies aren't shuffled to one task; of rows that repeat
    the id as well, each batch encodes one.
    """
    spark = docs.sparkSession
    shipped(spark)
    tokenizer = tokenizer or public("word_bpe_49k.json")
    version = tokenizer.version
    if cache is None:
        cache = f"{shared_dir(spark)}/token-counts-{uuid4().hex}"
        remember(cache)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("whole")).select(
        "doc_id", F.coalesce(F.octet_length("whole"), F.lit(0)).cast("long").alias("n_bytes"),
        content(F.col("whole"), tokenizer.drops_space).alias("content"))
    rows = rows.withColumn("digest", F.unhex(F.sha2("content", 256)))
    keyed = stored(rows.select("doc_id", "n_bytes", "digest"))
    keys = stored(keyed.groupBy("digest").agg(F.min("doc_id").alias("from_id")))
    known = stored(counts_in(cache, version, keys.select("digest")))
    misses = stored(keys.join(known, "digest", "left_anti"))
    # both columns of the key spread the copies of one content; only the row that stands for them has a partner
    chosen = rows.select("digest", "content", "doc_id").join(
        misses.select(F.col("digest").alias("_miss"), "from_id").hint("shuffle_hash"),
        (F.col("digest") == F.col("_miss")) & F.col("doc_id").eqNullSafe(F.col("from_id")), "left_semi")
    new = stored(chosen.select("digest", "content").mapInArrow(_encoded(tokenizer), "digest binary, n_tokens long"))
    once = stored(new.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")))
    once.select(F.lit(version).alias("version"), "digest", "n_tokens").write.mode("append").parquet(cache)
    return keyed.join(known.unionByName(once), "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
