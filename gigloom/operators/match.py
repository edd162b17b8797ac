"""Closest label: by vector and by spelling."""

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gigloom.functions.text import col, let
from gigloom.operators.keys import lookup_join, partitions

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 4096  # categories that a task compares at a time; up to so many go to every task
CELLS = 1 << 20  # scores that a task holds at a time


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-30)


class Categories:
    """Some categories in the order that decides equal scores, as one matrix for each length of vectors."""

    def __init__(self, rows):
        held = {}
        for category, rank, vec in sorted(rows, key=lambda r: (r[1] is None, r[1] or 0.0, r[0] is None, r[0] or "")):
            if all(x is not None for x in vec):
                held.setdefault(len(vec), []).append((category, rank, vec))
        self.rows = {n: [(c, r) for c, r, _ in some] for n, some in held.items()}
        self.matrix = {n: _unit(np.array([v for *_, v in some], np.float64).reshape(len(some), n)).T for n, some in held.items()}

    def best(self, vectors: pa.Array) -> tuple[list, list, list]:
        """(category, score, rank) of the first best category for each vector; nulls where none of its length can be scored."""
        out = ([None] * len(vectors), [None] * len(vectors), [None] * len(vectors))
        sizes = pc.list_value_length(vectors).fill_null(-1).to_numpy(zero_copy_only=False)
        for size, matrix in self.matrix.items():
            mine = np.flatnonzero(sizes == size)
            step = max(1, CELLS // max(1, matrix.shape[1]))
            for some in (mine[i:i + step] for i in range(0, len(mine), step)):
                flat = vectors.take(pa.array(some)).flatten()
                held = np.asarray(flat.fill_null(float("nan")), np.float64).reshape(len(some), size)
                scores = np.nan_to_num(_unit(held) @ matrix, nan=-np.inf)
                at = scores.argmax(axis=1)
                top = scores[np.arange(len(at)), at]
                for row, category, score in zip(some.tolist(), at.tolist(), top.tolist()):
                    if score > -np.inf:
                        out[0][row], out[2][row] = self.rows[size][category]
                        out[1][row] = score
        return out


def nearest(df: DataFrame, vec: str, categories: DataFrame, threshold: float, default: str | None = None,
            to: str = "label", block: int = BLOCK) -> DataFrame:
    """Category with the highest cosine at or above the threshold, else the default.

    `categories` has (category, rank, vec); equal scores go to the smaller rank, a null rank last. Vectors that are null, hold
    a null or NaN or have a length that no category has get the default.

    Up to `block` categories (they are counted by reading no more than that) go to every task as one matrix, and the label is a
    projection: rows don't move. More are cut into blocks that stream past the distinct vectors, and the best of all blocks is
    taken. Either way a task holds one block and CELLS scores, however many rows or equal vectors there are; the size of a block
    changes no answer.
    """
    kind = dict(categories.dtypes)["vec"]
    cats = categories.select("category", F.col("rank").cast("double").alias("rank"), "vec").where(F.col("vec").isNotNull())
    few = cats.limit(block + 1).collect()
    if len(few) <= block:
        held = Categories([tuple(r) for r in few])

        @F.arrow_udf("string")
        def label(vectors: pa.Array) -> pa.Array:
            names, scores, _ = held.best(vectors)
            return pa.array([n if s is not None and s >= threshold else default for n, s in zip(names, scores)], pa.string())

        return df.withColumn(to, label(F.col(vec).cast(kind)))
    won = _by_blocks(df.select(F.col(vec).cast(kind).alias("_vec")).where(F.col("_vec").isNotNull()).distinct(), cats, kind, block)
    hit = lookup_join(df.withColumn("_vec", F.col(vec).cast(kind)), won, ["_vec"]).drop("_vec")
    chosen = F.when(F.col("_near.score") >= threshold, F.col("_near.label")).otherwise(F.lit(default).cast("string"))
    return hit.withColumn(to, chosen).drop("_near")


def _streamed(batches):
    """Of rows in the order (bin, block, categories first): each vector's best category of each block."""
    now, rows, held = None, [], None
    for batch in batches:
        places = list(zip(*[batch.column(c).to_pylist() for c in ("bin", "block", "asks")]))
        cuts = [0] + [i for i in range(1, len(places)) if places[i] != places[i - 1]] + [len(places)]
        for i, j in zip(cuts, cuts[1:]):
            if places[i][:2] != now:
                now, rows, held = places[i][:2], [], None
            if not places[i][2]:
                rows.extend(zip(*[batch.column(c)[i:j].to_pylist() for c in ("category", "rank", "vec")]))
                continue
            held = held or Categories(rows)
            vectors = batch.column("vec")[i:j]
            names, scores, ranks = held.best(vectors)
            yield pa.RecordBatch.from_arrays([vectors, pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(ranks, pa.float64())],
                                             ["vec", "label", "score", "rank"])


def _by_blocks(asked: DataFrame, cats: DataFrame, kind: str, block: int) -> DataFrame:
    """_vec, _near (label, score): distinct vectors meet blocks of categories in as many bins as a shuffle has tasks."""
    bins, blocks = partitions(asked), -(-cats.count() // block)
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = asked.select(F.pmod(F.hash("_vec"), F.lit(bins)).alias("bin"), each(blocks).alias("block"), F.lit(True).alias("asks"),
                        F.lit(None).cast("string").alias("category"), F.lit(None).cast("double").alias("rank"), F.col("_vec").alias("vec"))
    right = cats.select(each(bins).alias("bin"), F.pmod(F.hash("category", "rank", "vec"), F.lit(blocks)).alias("block"),
                        F.lit(False).alias("asks"), "category", "rank", "vec")
    met = right.unionByName(left).repartition("bin", "block").sortWithinPartitions("bin", "block", "asks")
    scored = met.mapInArrow(_streamed, f"vec {kind}, label string, score double, rank double").where("score is not null")
    return scored.groupBy(F.col("vec").alias("_vec")).agg(F.max_by(F.struct("label", "score"), F.struct(
        F.col("score"), F.col("rank").isNotNull(), -F.col("rank"))).alias("_near"))


def cosine(a, b) -> Column:
    """Cosine of two array columns."""
    def dot(x, y):
        return F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")),
                           F.lit(0.0), lambda s, v: s + v)
    a, b = col(a), col(b)
    return dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))


def spellable(text, canon, threshold: float) -> Column:
    """Entries (name, size, order) whose length alone lets them reach the threshold: an edit distance is at least the difference."""
    names = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(len(name)).alias("size"), F.lit(-i).alias("order")) for i, name in enumerate(canon)])
    return let(F.length(text), lambda size: F.filter(
        names, lambda n: _spelled(F.abs(size - n["size"]), size, n["size"]) >= threshold))


def _spelled(edits, size, other) -> Column:
    longest = F.greatest(size, other)
    return F.when(longest > 0, 1 - edits / longest).otherwise(0.0)


def closest_spelling(c, canon, threshold: float = 0.85) -> Column:
    """Best of a short fixed list by edit similarity, null below the threshold.

    The list travels in the plan, so this is a projection; ties go to the earlier entry. The text is built once, and only
    entries of a length near its own are compared.
    """
    def scored(text):
        return F.transform(spellable(text, canon, threshold), lambda n: F.struct(
            _spelled(F.levenshtein(text, n["name"]), F.length(text), n["size"]).alias("score"), n["order"].alias("order"), n["name"].alias("name")))

    best = let(col(c), lambda text: F.array_max(scored(text)))
    return let(best, lambda b: F.when(b["score"] >= threshold, b["name"]))
