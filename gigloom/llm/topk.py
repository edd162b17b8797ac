"""Exact top-k search by inner product with block-at-a-time pruning.

Vectors are dealt into document-range blocks in the order of their strongest components, so
that a block's vectors point the same way. A block keeps its forward index (all its vectors)
and, for each dimension, the largest and smallest component. For a query the sum over
dimensions of the larger of q * max and q * min bounds every score in the block. Each query
block meets each group of blocks in one cell; there blocks are taken by descending bound and
scored through the forward index until the bound falls below the query's k-th score so far. The
k-th score within a query's own block, known before any blocks meet, is where that starts.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gigloom.llm.store import shipped, stored

BLOCK = 512  # vectors
GROUP = 16  # blocks that a cell holds
QUERIES = 512  # queries that a cell holds
_PART = "dim int, block long, ids array<long>, rows array<long>, vectors array<long>, high array<long>, low array<long>"


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows of a and b: by doubles where no sum can be rounded."""
    if a.size and b.size and float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2.0**53:
        return np.rint(a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def best(ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    if len(ids) > 4 * k:
        near = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
        return near[np.lexsort((ids[near], -score[near]))[:k]]
    return np.lexsort((ids, -score))[:k]


def _block(pdf: pd.DataFrame) -> pd.DataFrame:
    """One row for a block: ids, vectors end to end, and the extremes of each dimension."""
    m = np.array(pdf.v.to_list(), np.int64).reshape(len(pdf), -1)
    zero = np.zeros(0, np.int64)
    return pd.DataFrame([{"dim": pdf.dim.iloc[0], "block": pdf.block.iloc[0], "ids": pdf.id.to_numpy(), "rows": pdf.row.to_numpy(), "vectors": m.ravel(),
                          "high": m.max(axis=0) if m.size else zero, "low": m.min(axis=0) if m.size else zero}])


def _matrix(ids, flat) -> np.ndarray:
    return np.asarray(flat, np.int64).reshape(len(ids), -1)


def _seeds(k: int, every: int):
    """Of each block, its queries (by their rows) with the k-th best score within their own block."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids, own, m = np.array(row["ids"], np.int64), np.array(row["rows"], np.int64), _matrix(row["ids"], row["vectors"])
                at = np.flatnonzero(ids % every == 0)
                scores = _product(m[at], m) if len(at) else np.zeros((0, len(ids)), np.int64)
                floor = []
                for i, s in zip(at, scores):
                    s = s[own != own[i]]
                    floor.append(int(np.sort(s)[-k]) if len(s) >= k else None)
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["dim"]] * len(at), pa.int32()), pa.array(ids[at]), pa.array(own[at]),
                    pa.array([x for x in m[at]], pa.list_(pa.int64())), pa.array(floor, pa.int64())], ["dim", "query_id", "query_row", "v", "floor"])
    return run


def _searched(k: int):
    """A cell: one group of blocks and one block of queries."""
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            q = np.array(right.v.to_list(), np.int64).reshape(len(right), -1)
            qid, qrow = right.query_id.to_numpy(), right.query_row.to_numpy()
            kth = [list() if pd.isna(f) else [f] for f in right.floor]
            held = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in qid]
            floor = np.array([f[0] if f else np.iinfo(np.int64).min for f in kth], np.int64)
            high = np.array(left.high.to_list(), np.int64).reshape(len(left), -1)
            low = np.array(left.low.to_list(), np.int64).reshape(len(left), -1)
            up, down = np.maximum(q, 0), np.minimum(q, 0)
            bound = _product(up, high) + _product(down, low)
            order = np.argsort(-bound, axis=1, kind="stable")
            blocks = [(np.asarray(i, np.int64), np.asarray(r, np.int64), _matrix(i, v)) for i, r, v in zip(left.ids, left.rows, left.vectors)]
            for turn in range(len(left)):  # each query's next block by bound; queries of one block are scored together
                mine = order[:, turn]
                live = bound[np.arange(len(q)), mine] >= floor
                if not live.any():
                    break
                for b in np.unique(mine[live]):
                    at = np.flatnonzero(live & (mine == b))
                    ids, own, m = blocks[b]
                    for i, s in zip(at, _product(q[at], m)):
                        good = (own != qrow[i]) & (s >= floor[i])
                        if good.any():
                            hi, hs = np.append(held[i][0], ids[good]), np.append(held[i][1], s[good])
                            top = best(hi, hs, k)
                            held[i] = hi[top], hs[top]
                            if len(top) == k:
                                floor[i] = max(floor[i], held[i][1][-1])
            out = [(qid[i], qrow[i], a, b) for i, (ids, s) in enumerate(held) for a, b in zip(ids, s)]
        return pd.DataFrame(out, columns=["query_id", "query_row", "vec_id", "score"], dtype="int64")
    return run


def nearest(vectors: DataFrame, k: int = 10, every: int = 100, scale: int = 1024,
            vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for every row whose id is divisible by `every`, its k best others.

    Each component x counts as floor(scale * x); the score is the integer inner product; ties go
    to the smaller vec_id. Fewer than k others give fewer rows.

    Vectors that are null, hold a null or a component that isn't finite, or have a null id take
    no part. Vectors of different lengths aren't compared; empty ones score 0 with each other. Every
    row but the query's own is a candidate, also rows that repeat its id or its vector; a row that
    repeats a query's id is a query of its own, with its own ranks.
    Components of 2**40 or more times 1/scale have no defined score. An empty table gives no rows.

    A cell holds GROUP blocks and QUERIES queries, whatever the number of either; blocks of
    equal vectors are as large as others, as blocks are cut by number.
    """
    shipped(vectors.sparkSession)
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).cast("array<double>").alias("e"))
    bad = F.exists("e", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where("id is not null and e is not null").where(~bad).select(
        "id", F.size("e").alias("dim"), F.transform("e", lambda x: F.floor(x * scale)).alias("v")).withColumn(
        "row", F.monotonically_increasing_id())
    strong = F.expr("coalesce(array_position(v, array_max(v)) * 4096 + array_position(transform(v, x -> -x), array_max(transform(v, x -> -x))), 0)")
    rows = stored(rows.withColumn("way", strong))
    spread = rows.groupBy("dim", "way").agg(F.count("*").alias("n"))
    # a table, so that the join can split a way that a third of all vectors go
    cuts = stored(spread.select("dim", "way", F.ceil(F.col("n") / BLOCK).alias("cuts")))
    dealt = rows.join(cuts, ["dim", "way"]).withColumn("cut", F.pmod(F.xxhash64("row"), F.col("cuts")))
    # small ranges share a block: those of one dimension whose strongest components are the same or neighbours
    sized = stored(dealt.groupBy("dim", "way", "cut").agg(F.count("*").alias("n")))
    chunk = F.sum("n").over(Window.partitionBy("dim", F.expr("way div 4096")).orderBy("way", "cut").rowsBetween(Window.unboundedPreceding, -1))
    named = stored(sized.select("dim", "way", "cut", F.xxhash64("dim", F.expr("way div 4096"), F.floor(F.coalesce(chunk, F.lit(0)) / BLOCK)).alias("block")))
    blocks = stored(dealt.join(named, ["dim", "way", "cut"]).select("dim", "block", "id", "row", "v").groupBy("dim", "block").applyInPandas(_block, _PART))
    queries = stored(blocks.mapInArrow(_seeds(k, every), "dim int, query_id long, query_row long, v array<long>, floor long"))
    groups, sheets = max(1, -(-blocks.count() // GROUP)), max(1, -(-queries.count() // QUERIES))
    a = blocks.withColumn("g", F.pmod(F.xxhash64("block"), F.lit(groups))).withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(sheets - 1))))
    b = queries.withColumn("s", F.pmod(F.xxhash64("query_row"), F.lit(sheets)).cast("int")).withColumn(
        "g", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    found = a.groupBy("dim", "g", "s").cogroup(b.groupBy("dim", "g", "s")).applyInPandas(
        _searched(k), "query_id long, query_row long, vec_id long, score long")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
