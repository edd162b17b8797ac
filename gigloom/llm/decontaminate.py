"""Benchmark decontamination: short test items inside long documents, by size-partitioned MinHash signatures.

Jaccard similarity says little when a 30-shingle item sits in a 9,000-shingle document, so the
side that is signed is the small one. An item's signature is its shingles with the smallest
hashes, as many for all items of a size partition (sizes from one power of two to the next):
HITS more than the partition's largest item may lack. A document with the asked share of an
item's shingles therefore has HITS of its signature at least, whichever it lacks, and no match
is lost. Documents meet signatures only; pairs with enough hits are candidates, and only the
candidates' documents are read again and verified by exact containment of the whole items.

DataFrame functions only. Signatures, whole items and candidates are broadcast below INDEX_ROWS
rows (a checked count), and documents are never shuffled then; above that both sides meet by
hash or by id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gigloom.llm.store import stored

INDEX_ROWS = 500_000  # rows of a side that is broadcast, of about 40 bytes each
HITS = 3  # signature hashes a true match holds at least (fewer if the item is smaller)


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), "")


def _rows(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(F.col(key).cast("long").alias("key"), _words(F.col(text).cast("string")).alias("w")).where(
        F.col("key").isNotNull() & (F.size("w") > 0))


def _runs(rows: DataFrame, most: int) -> DataFrame:
    """(key, size, n, h, g): two hashes of each run of `n` words (`most` at most); size is the number of them in the row."""
    at = rows.withColumn("size", F.size("w") - F.col("n") + 1).where("size > 0").select(
        "key", "w", "n", "size", F.explode(F.sequence(F.lit(0), F.col("size") - 1)).alias("i"))
    run = [F.when(F.col("n") > k, F.get("w", F.col("i") + k)) for k in range(most)]
    return at.select("key", "size", "n", F.xxhash64(*run).alias("h"), F.xxhash64(F.lit("again"), *run).alias("g"))


def _broadcast(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= INDEX_ROWS else df


def _missing(q: Column, num: int, den: int) -> Column:
    """Of q shingles, how many a match may lack."""
    return q - F.ceil(q * num / den)


def inverted_index(items: DataFrame, item_id: str, text: str, width: int, num: int, den: int) -> DataFrame:
    """h, g, n (words in a run), item_id, q (distinct shingles), need, sig (in the signature), hits (signature hashes asked)."""
    rows = _rows(items, item_id, text).withColumn("n", F.least(F.size("w"), F.lit(width)))
    rows = _runs(rows, width).select(F.col("key").alias("item_id"), "n", "h", "g").distinct()
    w = Window.partitionBy("item_id")
    rows = rows.withColumn("q", F.count("*").over(w)).withColumn("rank", F.row_number().over(w.orderBy("h", "g")))
    top = F.pow(F.lit(2.0), F.floor(F.log2("q")) + 1) - 1  # the partition's largest size
    length = F.least(F.col("q"), _missing(top, num, den) + HITS)
    return rows.select("h", "g", "n", "item_id", "q", F.ceil(F.col("q") * num / den).alias("need"),
                       (F.col("rank") <= length).alias("sig"),
                       F.least(F.lit(HITS), length - _missing(F.col("q"), num, den)).alias("hits"))


def candidates(docs: DataFrame, signatures: DataFrame, widths: list[int], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, item_id) of documents that hold enough of an item's signature; `signatures` is the index where `sig`."""
    probes = _runs(_rows(docs, doc_id, text).withColumn("n", F.explode(F.array(*[F.lit(n) for n in widths]))), max(widths))
    probes = probes.select(F.col("key").alias("doc_id"), F.col("h").alias("h2"), F.col("n").alias("n2"))
    found = probes.join(signatures.select("h", "n", "item_id", "hits"), (F.col("h2") == F.col("h")) & (F.col("n2") == F.col("n")))
    found = found.select("doc_id", "item_id", "h", "hits").distinct()
    return found.groupBy("doc_id", "item_id").agg(F.count("*").alias("n_hits"), F.first("hits").alias("hits")).where(
        "n_hits >= hits").select("doc_id", "item_id")


def contaminated(docs: DataFrame, items: DataFrame, width: int = 5, share: tuple[int, int] = (80, 100),
                 doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, item_id, n_item_shingles, n_found, containment of every document that holds a test item.

    A document holds an item if den * found >= num * distinct shingles of the item, for share
    (num, den). Words are lower-cased and split at white space; an item of fewer than `width`
    words is one shingle, which is found wherever a document has these words in a row.

    Null, empty and blank texts and rows with a null id match nothing. Rows that repeat an id
    count as one document (or item) with the shingles of all of them. Empty tables give no rows;
    other columns are not read. Whole texts are read, whatever their length. A document with
    several items has a row for each; an item in a third of all documents is counted per
    document before and after the shuffle and never gathered.
    """
    num, den = share
    index = stored(inverted_index(items, item_id, item_text, width, num, den))
    widths = sorted(r.n for r in index.select("n").distinct().collect()) or [width]  # `width` values at most
    signatures = index.where("sig")
    pairs = stored(candidates(docs, _broadcast(signatures, signatures.count()), widths, doc_id, text))
    pairs = _broadcast(pairs, pairs.count())
    read = _rows(docs, doc_id, text).join(pairs.select(F.col("doc_id").alias("key")), "key", "left_semi")
    runs = _runs(read.withColumn("n", F.explode(F.array(*[F.lit(n) for n in widths]))), max(widths))
    runs = runs.withColumnsRenamed({"key": "doc_id", "n": "n2", "g": "g2", "h": "h2"})
    found = runs.join(_broadcast(index, index.count()),
                      (F.col("h2") == F.col("h")) & (F.col("g2") == F.col("g")) & (F.col("n2") == F.col("n")))
    found = found.join(pairs, ["doc_id", "item_id"], "left_semi").select("doc_id", "item_id", "h", "g", "q", "need").distinct()
    return found.groupBy("doc_id", "item_id").agg(
        F.first("q").alias("n_item_shingles"), F.first("need").alias("need"), F.count("*").alias("n_found")).where(
        "n_found >= need").select(
        "doc_id", "item_id", "n_item_shingles", "n_found", (F.col("n_found") / F.col("n_item_shingles")).alias("containment"))


def without_contaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """The rows of `docs` that hold no test item; rows with a null id stay."""
    bad = contaminated(docs, items, doc_id=doc_id, **options).select(F.col("doc_id").alias(doc_id)).distinct()
    return docs.join(bad, doc_id, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
