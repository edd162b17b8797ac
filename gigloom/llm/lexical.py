"""Ranked lexical search by bit-sliced Bloom signatures.

Documents of like size share a block. A block has a Bloom filter for each document, stored by bits: slice j is a bitmap of the
documents whose filter has bit j. A filter holds each term once for every level of LEVELS that its count reaches, so ANDed
slices tell a term's level in every document of a block, never too low. Levels give each query term the most it can score in
a document, and their weighted sum bounds the document's score. The best bounds are scored exactly first; the k-th of these
scores is a floor, and all documents whose bound reaches it are then scored exactly from their whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gigloom.llm.store import shipped, stored
from gigloom.llm.words import mix, pieces, words

LEVELS = np.array([1, 2, 3, 5, 9, 17, 33])  # the count of a term that each level asks for
HASHES, BITS = 4, 12  # bits that a filter sets for an entry, and has for it
BLOCK_BITS, BLOCK_DOCS = 1 << 22, 1024  # a block's bits (a larger filter is a block of its own) and documents
SEEDS = 3  # times k documents of the best bounds give the floor
PASS = 200_000  # terms of queries that the driver and each task hold at a time
SHEET = 64  # queries that a task bounds at a time
WANTED = 500_000  # documents whose numbers are broadcast; more are met by a shuffle
PENDING = 1 << 20  # terms that a task holds before it adds up how many documents have each

_TERM = np.zeros(256, bool)
_TERM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_STEP = np.uint64(0x9E3779B97F4A7C15)

_FIELDS = [("docs", pa.int64()), ("terms", pa.int64()), ("width", pa.int64()), ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())),
           ("slices", pa.binary()), ("term", pa.int64()), ("df", pa.int64())]
_SCHEMA = "docs long, terms long, width long, ids array<long>, sizes array<long>, slices binary, term long, df long"


def _rows(**columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([pa.array(columns[c], t) if c in columns else pa.nulls(n, t) for c, t in _FIELDS], [c for c, _ in _FIELDS])


def term_counts(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, count) of a batch by rising row and term; a term is its 64-bit hash."""
    found = words(batch, column, _TERM)
    term, row = found.hashes(), found.row
    order = np.lexsort((term, row))
    term, row = term[order], row[order]
    at = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (term[1:] != term[:-1])])) if len(term) else np.zeros(0, np.int64)
    return row[at], term[at], np.diff(np.append(at, len(term)))


def positions(term: np.ndarray, level: np.ndarray, width: int) -> np.ndarray:
    """The HASHES bits (last axis) of entries in a filter of `width` bits."""
    x = mix(term + level.astype(np.uint64) * _STEP)
    step = mix(x ^ _STEP) | np.uint64(1)
    return ((x[..., None] + np.arange(HASHES, dtype=np.uint64) * step[..., None]) % np.uint64(width)).astype(np.int64)


def _levels(count: np.ndarray) -> np.ndarray:
    """How many levels a count reaches."""
    return np.searchsorted(LEVELS, count, "right")


def block(width: int, held: list[tuple[int, int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """A block's row, its documents by rising id."""
    held = sorted(held, key=lambda d: d[0])
    n = len(held)
    bits = np.zeros((width, -(-n // 8) * 8), bool)
    doc = np.repeat(np.arange(n), [len(d[2]) for d in held])
    term, reached = np.concatenate([d[2] for d in held]), _levels(np.concatenate([d[3] for d in held]))
    for level in range(len(LEVELS)):
        at = np.flatnonzero(reached > level)
        bits[positions(term[at], np.full(len(at), level), width), doc[at, None]] = True
    return _rows(docs=[n], terms=[sum(d[1] for d in held)], width=[width], ids=[[d[0] for d in held]], sizes=[[d[1] for d in held]],
                 slices=[np.packbits(bits, axis=1).tobytes()])


def _summed(terms: list[np.ndarray]) -> pa.RecordBatch:
    term, n = np.unique(np.concatenate(terms), return_counts=True)
    return _rows(term=term.view(np.int64), df=n)


def _indexed(block_bits: int, most_pending: int):
    """Blocks, and rows (term, df) with the documents of a task that have each term. Documents without an id have no block."""
    def run(batches):
        kinds, terms, pending, unnamed = {}, [], 0, [0, 0]
        for batch in pieces(batches, "text"):
            row, term, count = term_counts(batch, "text")
            terms.append(term)
            pending += len(term)
            if pending > most_pending:
                yield _summed(terms)
                terms, pending = [], 0
            at = np.searchsorted(row, np.arange(batch.num_rows + 1))
            for doc_id, a, b in zip(batch.column("doc_id").to_pylist(), at, at[1:]):
                n = int(count[a:b].sum())
                if n and doc_id is None:
                    unnamed = [unnamed[0] + 1, unnamed[1] + n]
                elif n:
                    width = BITS << max(3, int(_levels(count[a:b]).sum() - 1).bit_length())
                    held = kinds.setdefault(width, [])
                    held.append((doc_id, n, term[a:b], count[a:b]))
                    if len(held) >= max(1, min(BLOCK_DOCS, block_bits // width)):
                        yield block(width, kinds.pop(width))
        for width, held in kinds.items():
            yield block(width, held)
        if pending:
            yield _summed(terms)
        if unnamed[0]:
            yield _rows(docs=unnamed[:1], terms=unnamed[1:])
    return run


def _query_terms(batches) -> Iterator[pa.RecordBatch]:
    """(item, item_id, term, times), the items of a task numbered."""
    base = TaskContext.get().partitionId() << 32
    for batch in pieces(batches, "text"):
        row, term, count = term_counts(batch, "text")
        ids = batch.column("item_id").to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays([pa.array(base + row), pa.array(ids[row], pa.int64()), pa.array(term.view(np.int64)), pa.array(count)],
                                         ["item", "item_id", "term", "times"])
        base += batch.num_rows


class Queries:
    """The queries of one pass: their distinct terms, and for each query the places of its terms and w * repeats."""

    def __init__(self, rows, docs: int, terms: int):
        self.docs, self.terms, self.sheet = docs, terms, SHEET
        held = {}
        for r in rows:
            w = floor(1000 * log((2 * docs + 2) / (2 * r.df + 1)))
            held.setdefault((r.item, r.item_id), []).append((r.term, w * r.times))
        self.items = [i for _, i in held]
        self.term = np.array(sorted({t for q in held.values() for t, _ in q}), np.int64)
        self.places = [np.searchsorted(self.term, np.array([t for t, _ in q], np.int64)) for q in held.values()]
        self.weights = [np.array([w for _, w in q], np.int64) for q in held.values()]

    def lengths(self, sizes) -> np.ndarray:
        """Each document's m, from its number of terms."""
        return np.array([75 + 25 * int(n) * self.docs // self.terms for n in sizes], np.int64)


def value(count: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * count) // (1000 * count + 12 * m)


def _bounds(queries: Queries, row: dict) -> Iterator[tuple[int, np.ndarray]]:
    """(first query, bounds) for each sheet of queries: rows are queries, columns a block's documents."""
    n, width = row["docs"], row["width"]
    slices = np.frombuffer(row["slices"], np.uint8).reshape(width, -1)
    m = queries.lengths(row["sizes"])
    most = np.append(LEVELS[1:] - 1, 0)[:, None] + np.zeros(n, np.int64)
    most[-1] = np.maximum(row["sizes"], LEVELS[-1])  # nothing but the document's size bounds the last level
    worth = np.concatenate([np.zeros((1, n), np.int64), value(most, m)])
    term = queries.term.view(np.uint64)
    for first in range(0, len(queries.items), queries.sheet):
        places = queries.places[first:first + queries.sheet]
        used = np.unique(np.concatenate(places))
        levels = np.zeros((len(used), n), np.uint8)
        alive = None
        for level in range(len(LEVELS)):  # a term that reaches a level in no document reaches no higher one
            rows = np.arange(len(used)) if alive is None else alive
            bits = np.bitwise_and.reduce(slices[positions(term[used[rows]], np.full(len(rows), level), width)], axis=1)
            seen = np.flatnonzero(bits.any(axis=1))
            rows, bits = rows[seen], np.unpackbits(bits[seen], axis=1)[:, :n]
            if not len(rows):
                break
            levels[rows] += bits & (levels[rows] == level)
            alive = rows
        points = np.take_along_axis(worth, levels.astype(np.int64), axis=0) if n else np.zeros((len(used), 0), np.int64)
        out = np.zeros((len(places), n), np.int64)
        for q, (at, w) in enumerate(zip(places, queries.weights[first:first + queries.sheet])):
            out[q] = w @ points[np.searchsorted(used, at)]
        yield first, out


def _blocks(batches) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {c: batch.column(c)[i].as_py() for c in ("docs", "width", "ids", "sizes", "slices")}


_PAIR = ["query", "doc_id", "bound"]


def _seeds(queries: Queries, k: int):
    """(query, doc_id, bound): of each query the k best bounds of a task's blocks, ties to the smaller id."""
    def run(batches):
        n = len(queries.items)
        bound, doc = np.zeros((n, k), np.int64), np.full((n, k), np.iinfo(np.int64).max)
        for row in _blocks(batches):
            ids = np.array(row["ids"], np.int64)
            for first, got in _bounds(queries, row):
                some = slice(first, first + len(got))
                near = np.argsort(-got, axis=1, kind="stable")[:, :k]  # documents are in the order of their ids
                b = np.concatenate([bound[some], np.take_along_axis(got, near, axis=1)], axis=1)
                d = np.concatenate([doc[some], ids[near]], axis=1)
                order = np.lexsort((d, -b), axis=1)[:, :k]
                bound[some], doc[some] = np.take_along_axis(b, order, axis=1), np.take_along_axis(d, order, axis=1)
        q, at = np.nonzero(bound > 0)
        yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(doc[q, at]), pa.array(bound[q, at])], _PAIR)
    return run


def _reaching(queries: Queries, floors: np.ndarray, last: np.ndarray):
    """(query, doc_id, bound) of all documents whose bound is above the query's floor, or equals it with an id up to `last`."""
    def run(batches):
        for row in _blocks(batches):
            ids = np.array(row["ids"], np.int64)
            for first, got in _bounds(queries, row):
                low, most = floors[first:first + len(got), None], last[first:first + len(got), None]
                q, at = np.nonzero((got > low) | ((got == low) & (got > 0) & (ids <= most)))
                yield pa.RecordBatch.from_arrays([pa.array(first + q, pa.int32()), pa.array(ids[at]), pa.array(got[q, at])], _PAIR)
    return run


def _scored(queries: Queries):
    """(query, doc_id, score) of documents for the queries that want them, from whole texts."""
    def run(batches):
        terms = queries.term.view(np.uint64)
        order = np.argsort(terms)
        for batch in pieces(batches, "text"):
            row, term, count = term_counts(batch, "text")
            at = np.searchsorted(row, np.arange(batch.num_rows + 1))
            out = ([], [], [])
            for i, (doc_id, wanted) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("queries").to_pylist())):
                mine, n = slice(at[i], at[i + 1]), count[at[i]:at[i + 1]]
                m = queries.lengths([n.sum()])
                found = np.minimum(np.searchsorted(terms, term[mine], sorter=order), len(terms) - 1)
                hit = terms[order[found]] == term[mine]
                points = np.zeros(len(terms), np.int64)
                points[order[found[hit]]] = value(n[hit], m)
                for q in wanted:
                    out[0].append(q)
                    out[1].append(doc_id)
                    out[2].append(int(queries.weights[q] @ points[queries.places[q]]))
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64())],
                                             ["query", "doc_id", "score"])
    return run


def indexed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Blocks of signatures of all documents, and how many documents have each term; written once, for any number of searches."""
    shipped(docs.sparkSession)
    return stored(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        _indexed(BLOCK_BITS, PENDING), _SCHEMA))


def _exact(docs: DataFrame, pairs: DataFrame, queries: Queries) -> DataFrame:
    """query, doc_id, score of pairs (query, doc_id): only documents that some query wants are read into terms."""
    wanted = stored(pairs.groupBy("doc_id").agg(F.collect_set("query").alias("queries")))  # a set has at most a pass's queries
    wanted = F.broadcast(wanted) if wanted.count() <= WANTED else wanted.hint("shuffle_hash")
    return docs.join(wanted, "doc_id").select("doc_id", "text", "queries").mapInArrow(_scored(queries), "query int, doc_id long, score long")


def ranked(docs: DataFrame, items: DataFrame, k: int = 20, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text",
           index: DataFrame | None = None) -> DataFrame:
    """item_id, rank, doc_id, score: of each item the k documents with the highest scores above 0, ties by smaller doc_id.

    Terms are runs of letters and digits of ASCII and of all else beyond it, A-Z lower-cased. A term's weight and a document's
    length are those of the whole table. `index` is what `indexed` gave for the same documents; without one it is made.

    Texts that are null, empty or without a term take no part, in either table. Documents without an id count in the weights
    and lengths but aren't found; items without an id are left out. Rows that repeat a doc_id are documents of their own, each
    with its rank. Items that repeat an id and a text count once, an item_id with several texts is ranked for each. Texts of
    any length count whole. Other columns are ignored, whatever their names. An empty table gives no rows.

    Items are taken in passes of about PASS terms. Of the documents nothing is held but a block at a time, and the numbers of
    those that are scored exactly, all of them, are broadcast up to WANTED.
    """
    spark = docs.sparkSession
    shipped(spark)
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    index = indexed(docs) if index is None else index
    blocks = index.where("slices is not null").select("docs", "width", "ids", "sizes", "slices")
    n_docs, n_terms = index.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("terms"), F.lit(0))).first()
    asked = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("text")).where("item_id is not null").distinct()
    asked = stored(asked.mapInArrow(_query_terms, "item long, item_id long, term long, times long"))
    df = index.where("term is not null").join(asked.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    asked = stored(asked.join(df, "term"))  # terms that no document has score nothing
    passes = -(-asked.count() // PASS)
    order = Window.partitionBy("query").orderBy(F.desc("score"), "doc_id")
    found = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for p in range(passes):
        rows = asked.where(F.pmod(F.xxhash64("item"), F.lit(passes)) == p).collect()  # about PASS rows
        if not rows:
            continue
        queries = Queries(rows, n_docs, n_terms)
        best = Window.partitionBy("query").orderBy(F.desc("bound"), "doc_id")
        seeds = stored(blocks.mapInArrow(_seeds(queries, SEEDS * k), "query int, doc_id long, bound long").withColumn(
            "place", F.row_number().over(best)).where(F.col("place") <= SEEDS * k).select("query", "doc_id"))
        floors, last = np.zeros(len(queries.items), np.int64), np.full(len(queries.items), np.iinfo(np.int64).max)
        for r in _exact(docs, seeds, queries).withColumn("rank", F.row_number().over(order)).where(F.col("rank") == k).collect():
            floors[r["query"]], last[r["query"]] = r.score, r.doc_id
        pairs = stored(blocks.mapInArrow(_reaching(queries, floors, last), "query int, doc_id long, bound long"))
        scores = _exact(docs, pairs.select("query", "doc_id"), queries).where("score > 0")
        named = stored(scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k))
        ids = spark.createDataFrame(list(enumerate(queries.items)), "query int, item_id long")
        found = found.unionByName(named.join(ids, "query").select("item_id", "rank", "doc_id", "score"))
    return found
