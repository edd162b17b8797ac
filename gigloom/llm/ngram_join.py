"""N-gram Jaccard join: connected groups of documents whose shingle sets are alike.

Adaptive multi-match prefixes. Shingles have one global order, rare ones first. If two sets
must share at least c of their shingles, the first n - c + l shingles of both share at least
l. Each document picks its own l: a longer prefix reads more of the index, but asks for more
matches before a pair is verified, and the cheaper sum of the two (from estimated shingle
frequencies) wins. A pair is verified when it shares at least the smaller of its two l.

Equal sets are one class from the start, so exact copies never meet in a join. A shingle that
more than HOT classes have in their prefix is not paired out: its classes are compared with one
pivot, which joins nearly all of a large group of near copies, and only classes outside the
pivot's component are then compared with the others, block against block.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gigloom.llm import sketch
from gigloom.llm.components import components
from gigloom.llm.store import shipped, stored
from gigloom.llm.words import by_row, mix, pieces, shingles, words

HOT = 64  # classes; a shingle in more prefixes goes the pivot's way
EXTRA = (1, 2, 3, 4, 6, 8, 12, 16)  # the l a document can pick
VERIFY = 0.2  # cost of verifying a candidate, per shingle, in index entries read
SKETCH_BITS = 21  # counters of the frequency estimate: 2**21 of 4 bytes, whatever the input's size
BLOCK_ROWS, BLOCK_SHINGLES = 256, 500_000  # classes and shingles of one side of a block comparison


def _sets(batch, width: int):
    """The sorted distinct shingle hashes of each row."""
    w = words(batch, "text")
    row, hashes = shingles(w.row, w.hashes(), width)
    cut = by_row(row, len(batch))
    return [np.unique(hashes[a:b]) for a, b in zip(cut[:-1], cut[1:])]


def _digests(sets) -> tuple[np.ndarray, np.ndarray]:
    one = np.array([mix(s).sum(dtype=np.uint64) for s in sets], np.uint64)
    two = np.array([mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64) for s in sets], np.uint64)
    return one.view(np.int64), two.view(np.int64)


def _summary(width: int):
    """Per document its set's size and digest; per task, a sketch of how many documents have each shingle."""
    def run(batches):
        counts = np.zeros(1 << SKETCH_BITS, np.int32)
        mask = np.uint64((1 << SKETCH_BITS) - 1)
        for batch in pieces(batches, "text"):
            sets = _sets(batch, width)
            counts += np.bincount((np.concatenate(sets) & mask).view(np.int64), minlength=len(counts)).astype(np.int32)
            d1, d2 = _digests(sets)
            n = len(batch)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(d1), pa.array(d2),
                pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], ["doc_id", "n", "d1", "d2", "slice", "counts"])
        yield pa.RecordBatch.from_arrays([*[pa.nulls(sketch.SLICES, pa.int64())] * 4, *sketch.sliced(counts)],
                                         ["doc_id", "n", "d1", "d2", "slice", "counts"])
    return run


def adaptive_prefix(found: np.ndarray, share: np.ndarray, num: int, den: int) -> tuple[np.ndarray, int]:
    """(prefix, l) of a set: `found` in global order, `share` the estimated frequency of each."""
    n = len(found)
    base = n - -(-num * n // den)  # of any partner, at most so many of this set's shingles are missing
    reads = np.cumsum(share[:base + max(EXTRA)])
    best, pick = None, 1
    for more in EXTRA:
        if base + more > n:
            break
        total = reads[base + more - 1]
        cost = total * (1 + VERIFY * n / more)
        if best is None or cost < best:
            best, pick = cost, more
    return found[:base + pick], pick


def _prefixes(width: int, num: int, den: int, often):
    def run(batches):
        df = often.value
        noise = float(df.mean())
        mask = np.uint64(len(df) - 1)
        for batch in pieces(batches, "text"):
            sets = _sets(batch, width)
            d1, d2 = _digests(sets)
            pre, pick = [], []
            for s in sets:
                share = df[(s & mask).view(np.int64)]
                order = np.argsort(share, kind="stable")  # equal frequencies stay in hash order
                p, m = adaptive_prefix(s[order], np.maximum(share[order] - noise, 0.0) + 0.1, num, den) if len(s) else (s, 1)
                pre.append(p.view(np.int64))
                pick.append(m)
            ends = np.concatenate([[0], np.cumsum([len(p) for p in pre])]).astype(np.int32)
            tokens = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(pre)))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(d1), pa.array(d2), pa.array([len(s) for s in sets], pa.int64()),
                pa.array(pick, pa.int64()), tokens], ["doc_id", "d1", "d2", "n", "l", "tokens"])
    return run


WANTED_BITS = 23


def _slot(col):
    return F.pmod(F.xxhash64(col), F.lit(1 << WANTED_BITS))


def _wanted(ids: DataFrame) -> np.ndarray:
    """A bit map of 2**WANTED_BITS bits over hashed ids: 1 MB whatever the number of ids; a superset of them."""
    words_ = ids.select(_slot("doc_id").alias("s")).groupBy(F.expr("s div 64").alias("i")).agg(
        F.expr("bit_or(shiftleft(1L, cast(s % 64 as int)))").alias("bits"))
    out = np.zeros(1 << (WANTED_BITS - 6), np.int64)
    found = words_.toPandas()
    out[found.i.to_numpy()] = found.bits.to_numpy()
    return out


def _full_sets(width: int, bits):
    def run(batches):
        have = bits.value.view(np.uint8)
        for batch in batches:
            slot = batch.column(2).to_numpy()
            batch = batch.filter(pa.array((have[slot >> 3] >> (slot & 7) & 1).astype(bool)))
            for piece in pieces([batch], "text"):
                sets = _sets(piece, width)
                d1, d2 = _digests(sets)
                ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    piece.column(0), pa.array(d1), pa.array(d2),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets).view(np.int64)))],
                    ["doc_id", "d1", "d2", "tokens"])
    return run


def _alike(na, nb, shared, num: int, den: int):
    return F.lit(den) * shared >= F.lit(num) * (na + nb - shared)


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Links (u, v) among pairs (a, b) of set keys, by the whole sets."""
    left = sets.select(F.col("d1").alias("a"), F.col("rep").alias("u"), F.col("tokens").alias("x"))
    right = sets.select(F.col("d1").alias("b"), F.col("rep").alias("v"), F.col("tokens").alias("y"))
    shared = F.size(F.array_intersect("x", "y"))
    return pairs.join(left, "a").join(right, "b").where(
        _alike(F.size("x"), F.size("y"), shared, num, den)).select("u", "v")


def _block_links(num: int, den: int):
    """Of one block of outliers and one of members: pairs of components that a link joins, found by one matrix product."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out, mem = pdf[pdf.outlier].reset_index(drop=True), pdf[~pdf.outlier].reset_index(drop=True)
        links = []
        if len(out) and len(mem):
            na, nb = out.tokens.map(len).to_numpy(), mem.tokens.map(len).to_numpy()
            ta, tb = np.concatenate(out.tokens.to_list()), np.concatenate(mem.tokens.to_list())
            common = np.intersect1d(ta, tb)
            ra, rb = np.repeat(np.arange(len(out)), na), np.repeat(np.arange(len(mem)), nb)
            ka, kb = np.isin(ta, common), np.isin(tb, common)
            ca, cb = np.searchsorted(common, ta[ka]), np.searchsorted(common, tb[kb])
            ra, rb = ra[ka], rb[kb]
            shared = np.zeros((len(out), len(mem)), np.float32)
            for low in range(0, len(common), 2048):
                x, y = np.zeros((len(out), 2048), np.float32), np.zeros((len(mem), 2048), np.float32)
                i, j = (ca >= low) & (ca < low + 2048), (cb >= low) & (cb < low + 2048)
                x[ra[i], ca[i] - low] = 1
                y[rb[j], cb[j] - low] = 1
                shared += x @ y.T
            shared = np.rint(shared).astype(np.int64)
            root = {}

            def find(k):
                while root.get(k, k) != k:
                    k = root[k]
                return k
            for i, j in zip(*np.nonzero(den * shared >= num * (na[:, None] + nb[None, :] - shared))):
                a, b = find(out.component[i]), find(mem.component[j])
                if a != b:
                    root[a] = b
                    links.append((out.component[i], mem.component[j]))
        return pd.DataFrame(links, columns=["u", "v"], dtype="int64")
    return run


def _across(groups: DataFrame, sets: DataFrame, found: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs of components `found` so far that some link within a pivot's group joins."""
    rows = groups.join(sets.select("d1", "rep", "d2", F.size("tokens").alias("n")), "d1")
    rows = stored(rows.join(found.select(F.col("node").alias("rep"), "component"), "rep", "left").withColumn(
        "component", F.coalesce("component", "rep")))
    by_part = rows.groupBy("pivot", "component").agg(F.count("*").alias("c"), F.sum("n").alias("t"))
    totals = stored(by_part.groupBy("pivot").agg(
        F.max_by("component", F.struct("c", "component")).alias("main"), F.sum("c").alias("all"), F.max("c").alias("most"),
        F.sum("t").alias("all_t"), F.max_by("t", F.struct("c", "component")).alias("main_t")).where("all > most"))
    blocks = lambda c, t, k: F.greatest(F.lit(1), F.ceil(F.expr(c) / (BLOCK_ROWS * k)), F.ceil(F.expr(t) / BLOCK_SHINGLES))
    rows = rows.join(totals, "pivot").withColumns({
        "bo": blocks("all - most", "all_t - main_t", 1), "bm": blocks("all", "all_t", 4), "h": F.xxhash64("d1", "d2", "pivot")})
    upto = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"{c} - 1")))
    outliers = rows.where("component <> main").select(
        "pivot", "d1", "d2", "rep", "component", F.lit(True).alias("outlier"), F.expr("pmod(h, bo)").alias("i"), upto("bm").alias("j"))
    members = rows.select(
        "pivot", "d1", "d2", "rep", "component", F.lit(False).alias("outlier"), upto("bo").alias("i"), F.expr("pmod(h, bm)").alias("j"))
    cells = outliers.unionByName(members).join(sets.select("d1", "d2", "tokens"), ["d1", "d2"])
    return cells.select("pivot", "i", "j", "outlier", "component", "tokens").groupBy("pivot", "i", "j").applyInPandas(
        _block_links(num, den), "u long, v long")


def groups_of_near_copies(docs: DataFrame, width: int = 5, similarity: tuple[int, int] = (80, 100),
                          doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id of every row of `docs`.

    Two documents link when den * |A and B| >= num * |A or B| for similarity (num, den) over
    their sets of distinct `width`-word shingles (words in lower-cased A-Z; a text of fewer
    words is one shingle). component_id is the smallest doc_id reachable by links.

    Null, empty and blank texts have no shingles and link with nothing. Rows with a null doc_id
    are returned with their n_shingles and no component. Rows that repeat a doc_id are one node:
    their texts' links are all its links, and each row is returned. An empty table gives no
    rows; other columns of `docs`, whatever their names, are not read. Texts of any length are
    read whole. Sets are compared by 64-bit shingle hashes.
    """
    num, den = similarity
    spark = docs.sparkSession
    shipped(spark)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    seen = stored(sketch.numbered(rows.mapInArrow(_summary(width), f"doc_id long, n long, d1 long, d2 long, {sketch.FIELDS}")))
    every = seen.where("slice is null").select("doc_id", "n", "d1", "d2")
    often = sketch.total(seen.where("slice is not null").select("slice", "part", "counts"), 1 << SKETCH_BITS)
    often = spark.sparkContext.broadcast(often)
    classes = stored(every.where("doc_id is not null and n > 0").groupBy("d1", "d2").agg(
        F.min("doc_id").alias("rep"), F.min("n").alias("n")))

    # the index: prefix shingles of one document of each class, without shingles that only one class has
    entries = rows.mapInArrow(_prefixes(width, num, den, often), "doc_id long, d1 long, d2 long, n long, l long, tokens array<long>")
    entries = entries.where("n > 0").withColumnRenamed("doc_id", "rep").join(
        classes.select("rep", "d1", "d2"), ["rep", "d1", "d2"], "left_semi").dropDuplicates(["rep", "d1", "d2"])
    entries = stored(entries.select("d1", F.expr("n * 32 + l").alias("nl"), F.explode("tokens").alias("token")))
    shared = stored(entries.groupBy("token").agg(F.count("*").alias("df")).where("df > 1"))  # a table, so that the join can split a hot shingle
    index = stored(entries.join(shared, "token"))

    few = index.where(F.col("df") <= HOT).select("token", "d1", F.expr("nl div 32").alias("n"), F.expr("nl % 32").alias("l"))
    a, b = few.selectExpr("token", "d1 AS a", "n AS na", "l AS la"), few.selectExpr("token", "d1 AS b", "n AS nb", "l AS lb")
    pairs = a.join(b, "token").where(
        (F.col("a") < F.col("b")) & (den * F.least("na", "nb") >= num * F.greatest("na", "nb"))).groupBy("a", "b").agg(
        F.count("*").alias("m"), F.min(F.least("la", "lb")).alias("need")).where("m >= need").select("a", "b")
    pairs = stored(pairs)

    hot = index.where(F.col("df") > HOT).select("token", "d1")
    rank = stored(hot.groupBy("d1").agg(F.count("*").alias("k")))
    pivots = stored(hot.join(rank, "d1").groupBy("token").agg(F.max_by("d1", F.struct("k", "d1")).alias("pivot")))
    groups = stored(hot.join(pivots, "token").select("pivot", "d1").distinct())

    keys = pairs.select(F.explode(F.array("a", "b")).alias("d1")).union(groups.select("d1")).distinct()
    needed = stored(classes.join(keys, "d1", "left_semi"))
    bits = spark.sparkContext.broadcast(_wanted(needed.select(F.col("rep").alias("doc_id"))))
    sets = rows.where("doc_id is not null").withColumn("slot", _slot("doc_id")).mapInArrow(
        _full_sets(width, bits), "doc_id long, d1 long, d2 long, tokens array<long>").withColumnRenamed("doc_id", "rep")
    sets = stored(sets.join(needed.select("rep", "d1", "d2"), ["rep", "d1", "d2"], "left_semi").dropDuplicates(["rep", "d1", "d2"]))

    links = _verified(pairs, sets, num, den).union(
        _verified(groups.where("pivot <> d1").select(F.col("pivot").alias("a"), F.col("d1").alias("b")), sets, num, den))
    reps = every.join(classes.select("d1", "d2", "rep"), ["d1", "d2"]).select("doc_id", "rep").where("doc_id is not null")
    repeated = reps.groupBy("doc_id").agg(F.min("rep").alias("m"), F.max("rep").alias("x")).where("m < x").select("doc_id", "m")
    links = stored(links.union(reps.join(repeated, "doc_id").select(F.col("rep").alias("u"), F.col("m").alias("v"))))
    found = stored(components(links))
    joined = components(stored(_across(groups, sets, found, num, den))).toDF("first", "last")

    root = classes.join(found.select(F.col("node").alias("rep"), "component"), "rep", "left").select(
        "d1", "d2", F.coalesce("component", "rep").alias("first")).join(joined, "first", "left").select(
        "d1", "d2", F.coalesce("last", "first").alias("component"))
    return every.join(root, ["d1", "d2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
