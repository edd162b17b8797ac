"""Repeated passages by line and sentence hashing: the earliest occurrence stays, later ones go.

A text is cut in units twice: into lines, and into sentences within lines. A unit's digest is of
its words alone, so case of A-Z and white space don't matter. Over all documents each digest has
one earliest occurrence (smallest doc_id, then smallest offset); every other one is a repeat.
Removed are repeated lines of MIN_LINE words or more, and runs of neighbouring repeated
sentences, across line ends too, of MIN_RUN words or more.

A passage may also begin and end within the host's sentences, or have none. So a smaller doc_id
is looked for by grams of GRAM words too, chosen by their content alone (winnowing: the smallest
hash of every GRAM neighbouring ones), then widened word by word to where the two texts differ.
Neighbouring matches of MIN_PASSAGE words or more go; any such passage holds a chosen gram.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from gigloom.llm.store import shipped, spare, stored
from gigloom.llm.words import mix, pieces, place_values, words

MIN_LINE = 5  # words of a line; shorter ones ("Yes.", "Chapter 1") repeat by chance
MIN_RUN = 25  # words of neighbouring repeated sentences
MIN_PASSAGE = 50  # words that an earlier document has, wherever they begin and end
GRAM = 16  # words of a gram, and neighbouring grams of which the smallest is chosen
BESIDE = 3  # words beside a repeated line or sentence; fewer agree by chance
SEEN_BITS = 1 << 27  # of the map that tells which grams may be repeated
_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".!?"]] = True
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _digest(hashes, first, salt: int) -> np.ndarray:
    """A digest of each run of word hashes that begins at `first`, by the words and their order."""
    place = np.arange(len(hashes)) - np.repeat(first, np.diff(np.append(first, len(hashes))))
    return mix(np.add.reduceat(mix(hashes + place.astype(np.uint64) * _STEP), first) ^ np.uint64(salt))


def units(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Every line of MIN_LINE words and every sentence of a batch: digest, doc_id, span, meta.

    span: first and end code point in the text, 32 bits each. meta: number of the first word in
    its text, words (24 bits), whether its text had it before, and whether it is a line.
    """
    w = words(batch, "text")
    n = len(w.start)
    if not n:
        return pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 4, ["digest", "doc_id", "span", "meta"])
    hashes, chars = w.hashes(), w.chars()
    lines = np.concatenate([[0], np.cumsum(w.raw == 10)])
    new_row = np.concatenate([[True], w.row[1:] != w.row[:-1]])
    new_line = new_row | np.concatenate([[True], lines[w.start[1:]] > lines[w.end[:-1]]])
    new_sentence = new_line | np.concatenate([[True], _ENDS[w.raw[w.end[:-1] - 1]]])
    out = []
    for kind, breaks in ((1, new_line), (0, new_sentence)):
        first = np.flatnonzero(breaks)
        last = np.append(first[1:], n) - 1
        row, size = w.row[first], last - first + 1
        digest = _digest(hashes, first, kind)
        base = chars[w.at[row]]
        order = np.lexsort((first, digest, row))
        again = np.zeros(len(first), bool)
        again[order[1:]] = (digest[order[1:]] == digest[order[:-1]]) & (row[order[1:]] == row[order[:-1]])
        number = first - np.searchsorted(w.row, row)
        keep = size >= MIN_LINE if kind else np.ones(len(first), bool)
        span = (chars[w.start[first]] - base) << 32 | (chars[w.end[last]] - base)
        meta = number << 26 | np.minimum(size, (1 << 24) - 1) << 2 | again << 1 | kind
        out.append([x[keep] for x in (digest.view(np.int64), row, span, meta)])
    digest, row, span, meta = (np.concatenate(x) for x in zip(*out))
    ids = batch.column(0).take(pa.array(row))
    return pa.RecordBatch.from_arrays([pa.array(digest), ids, pa.array(span), pa.array(meta)], ["digest", "doc_id", "span", "meta"])


def _units(batches):
    for batch in pieces(batches, "text"):
        yield units(batch)


def _sliding(x: np.ndarray, of) -> np.ndarray:
    """The smallest or largest (`of`) of every GRAM neighbours; GRAM is a power of two."""
    width = 1
    while width < GRAM:
        x = of(x[:-width], x[width:])
        width *= 2
    return x


def chosen_grams(w, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of the grams that are the smallest of any GRAM neighbouring grams of their text."""
    n = len(hashes)
    if n < 2 * GRAM - 1:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    up, down = place_values(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * up[:n], out=sums[1:])
    grams = mix((sums[GRAM:] - sums[:-GRAM]) * down[:n - GRAM + 1]) | np.uint64(1)
    least = _sliding(grams, np.minimum)
    least[w.row[:len(least)] != w.row[2 * GRAM - 2:]] = 0  # a window of two texts
    edge = np.zeros(GRAM - 1, np.uint64)
    at = np.flatnonzero(_sliding(np.concatenate([edge, least, edge]), np.maximum) == grams)
    return at, grams[at]


def _keys(batches):
    """(digest, doc_id) of every chosen gram of a text, once."""
    for batch in pieces(batches, "text"):
        w = words(batch, "text")
        at, grams = chosen_grams(w, w.hashes())
        row, order = w.row[at], np.lexsort((grams, w.row[at]))
        fresh = np.ones(len(at), bool)
        fresh[1:] = (grams[order[1:]] != grams[order[:-1]]) | (row[order[1:]] != row[order[:-1]])
        keep = order[fresh]
        yield pa.RecordBatch.from_arrays([pa.array(grams[keep].view(np.int64)), batch.column(0).take(pa.array(row[keep]))], ["digest", "doc_id"])


def _binary(rows: np.ndarray) -> pa.Array:
    """One binary value for each row of a matrix."""
    size = rows.shape[1] * rows.itemsize
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer((np.arange(len(rows) + 1) * size).astype(np.int32).tobytes()),
                                                          pa.py_buffer(np.ascontiguousarray(rows).tobytes())])


_AROUND = "digest long, doc_id long, place long, span long, beside binary, steps binary"


def _around(seen):
    """Chosen grams that may be repeated, with what is needed to widen them: GRAM - 1 words on each side.

    beside: 16 bits of each word's hash, 0 where the text ends; steps: code points to the next
    word's start (end, on the right), 255 for 255 or more, where widening stops.
    """
    far = np.arange(1, GRAM)

    def run(batches):
        bits = np.frombuffer(seen.value, np.uint8)
        for batch in pieces(batches, "text"):
            w = words(batch, "text")
            hashes, chars, firsts = w.hashes(), w.chars(), w.firsts()
            at, grams = chosen_grams(w, hashes)
            bit = grams & np.uint64(SEEN_BITS - 1)
            may = bits[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & 1 > 0
            at, grams = at[may], grams[may]
            row = w.row[at]
            start, end = chars[w.start], chars[w.end]
            short = np.maximum(hashes >> np.uint64(48), np.uint64(1)).astype(np.uint16)
            beside, steps = [], []
            for edge, place, step in ((start, at, -1), (end, at + GRAM - 1, 1)):
                i = place[:, None] + step * far
                there = (i >= firsts[row][:, None]) & (i < firsts[row + 1][:, None])
                i = np.where(there, i, 0)
                beside.append(np.where(there, short[i], 0).astype(np.uint16))
                steps.append(np.where(there, np.minimum(np.abs(edge[i] - edge[np.where(there, i - step, 0)]), 255), 255).astype(np.uint8))
            base = chars[w.at[row]]
            span = (start[at] - base) << 32 | (end[at + GRAM - 1] - base)
            yield pa.RecordBatch.from_arrays([
                pa.array(grams.view(np.int64)), batch.column(0).take(pa.array(row)), pa.array(at - firsts[row]), pa.array(span),
                _binary(np.hstack(beside)), _binary(np.hstack(steps))], ["digest", "doc_id", "place", "span", "beside", "steps"])
    return run


def _widened(batches):
    """Matched grams as far as the words beside them agree: span, meta (-1 less first word and number of words), first."""
    k = GRAM - 1
    for batch in batches:
        rows = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        here, there = (np.frombuffer(b"".join(rows[x].to_pylist()), np.uint16).reshape(-1, 2 * k) for x in ("beside", "theirs"))
        steps = np.frombuffer(b"".join(rows["steps"].to_pylist()), np.uint8).reshape(-1, 2 * k).astype(np.int64)
        same = (here == there) & (here > 0) & (steps < 255)
        on = [np.logical_and.accumulate(x, axis=1) for x in (same[:, :k], same[:, k:])]
        left, right = (x.sum(axis=1) for x in on)
        span = rows["span"].to_numpy()
        span = ((span >> 32) - (steps[:, :k] * on[0]).sum(axis=1)) << 32 | ((span & 0xFFFFFFFF) + (steps[:, k:] * on[1]).sum(axis=1))
        meta = -1 - ((rows["place"].to_numpy() - left) << 8 | (GRAM + left + right))
        yield pa.RecordBatch.from_arrays([rows["doc_id"], pa.array(span), pa.array(meta), rows["first"]], ["doc_id", "span", "meta", "first"])


def _matched_grams(rows: DataFrame) -> DataFrame:
    """doc_id, span, meta, first: the words around each chosen gram that the smallest doc_id with that gram has as well."""
    firsts = stored(rows.mapInArrow(_keys, "digest long, doc_id long").groupBy("digest").agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").drop("last"))
    bit = F.col("digest").bitwiseAND(F.lit(SEEN_BITS - 1)) + 1
    seen = bytearray(SEEN_BITS // 8)
    for r in firsts.groupBy(F.bitmap_bucket_number(bit).alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits")).toLocalIterator():
        seen[(r.k - 1) * len(r.bits):r.k * len(r.bits)] = r.bits
    shared = rows.sparkSession.sparkContext.broadcast(bytes(seen))
    met = stored(rows.mapInArrow(_around(shared), _AROUND).join(firsts, "digest"))
    # a table, so that the join can split a digest that a third of all documents have
    theirs = stored(met.where("doc_id = first").groupBy("digest").agg(F.min(F.struct("place", "beside")).alias("one")).select(
        "digest", F.col("one.beside").alias("theirs")))
    later = met.where("doc_id > first").join(theirs, "digest").select("doc_id", "place", "span", "beside", "steps", "theirs", "first")
    return later.mapInArrow(_widened, "doc_id long, span long, meta long, first long")


def _runs(found: list[tuple[int, int, int]]) -> list[list[int]]:
    """[start, end, first word, end word, first_doc_id] of neighbouring matched grams of MIN_PASSAGE words or more."""
    out: list[list[int]] = []
    for at, n, s, f in sorted((-1 - m >> 8, -1 - m & 0xFF, s, f) for s, m, f in found):
        if out and at <= out[-1][3]:
            if at + n > out[-1][3]:
                out[-1][1], out[-1][3] = s & 0xFFFFFFFF, at + n
            out[-1][4] = min(out[-1][4], f)
        else:
            out.append([s >> 32, s & 0xFFFFFFFF, at, at + n, f])
    return [x for x in out if x[3] - x[2] >= MIN_PASSAGE]


def _with_runs(cuts: list[list[int]], runs: list[list[int]]) -> list[list[int]]:
    """Cuts [start, end, first word, end word, first_doc_id] with what runs have besides them, BESIDE words or more at a time."""
    for run in runs:
        beside = [c for c in cuts if c[2] < run[3] and run[2] < c[3]]
        done = [c for c in cuts if not (c[2] < run[3] and run[2] < c[3])]
        joined: list[list[int]] = []
        for c in beside:
            if joined and c[2] - joined[-1][3] >= BESIDE:
                joined[-1] = [joined[-1][0], c[1], joined[-1][2], c[3], min(joined[-1][4], c[4], run[4])]
            else:
                joined.append(c)
        if not joined:
            joined = [run]
        if joined[0][2] - run[2] >= BESIDE:
            joined[0] = [run[0], joined[0][1], run[2], joined[0][3], min(joined[0][4], run[4])]
        if run[3] - joined[-1][3] >= BESIDE:
            joined[-1] = [joined[-1][0], run[1], joined[-1][2], run[3], min(joined[-1][4], run[4])]
        cuts = sorted(done + joined)
    return cuts


def passages(found: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int]]:
    """(start, end, words, first_doc_id) of what one text loses, from its repeated units and grams (span, meta, first)."""
    runs, found = _runs([x for x in found if x[1] < 0]), [x for x in found if x[1] >= 0]
    marks, cuts = sorted({(m >> 26, s, m >> 2 & 0xFFFFFF, f) for s, m, f in found if not m & 1}), []
    i = 0
    while i < len(marks):
        j = i + 1
        while j < len(marks) and marks[j][0] == marks[j - 1][0] + marks[j - 1][2]:
            j += 1
        if sum(x[2] for x in marks[i:j]) >= MIN_RUN:
            cuts.append((marks[i][1] >> 32, marks[j - 1][1] & 0xFFFFFFFF, marks[i][0], marks[j - 1][0] + marks[j - 1][2]))
        i = j
    cuts = sorted(cuts + [(s >> 32, s & 0xFFFFFFFF, m >> 26, (m >> 26) + (m >> 2 & 0xFFFFFF)) for s, m, f in found if m & 1])
    out: list[list[int]] = []
    for s, e, a, b in cuts:
        if out and s <= out[-1][1]:
            out[-1][1], out[-1][3] = max(out[-1][1], e), max(out[-1][3], b)
        else:
            out.append([s, e, a, b])
    done, k = [], 0
    for s, e, a, b in out:
        first = None
        while k < len(marks) and marks[k][1] >> 32 < e:
            if marks[k][1] >> 32 >= s:
                first = marks[k][3] if first is None else min(first, marks[k][3])
            k += 1
        done.append([s, e, a, b, first])
    return [(s, e, b - a, first) for s, e, a, b, first in _with_runs(done, runs)]


def _passages(batches):
    for batch in batches:
        cuts = [passages([(x["span"], x["meta"], x["first"]) for x in found]) for found in batch.column(1).to_pylist()]
        ids = np.repeat(batch.column(0).to_numpy(), [len(c) for c in cuts])
        flat = np.array([x for c in cuts for x in c], np.int64).reshape(-1, 4)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *(pa.array(flat[:, i]) for i in (0, 1, 2, 3))],
                                         ["doc_id", "start", "end", "n_words", "first_doc_id"])


def repeated_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", anywhere: bool = True) -> DataFrame:
    """doc_id, start, end, n_words, first_doc_id: one row per passage to remove.

    start and end are code point offsets in the original text; first_doc_id is the smallest
    doc_id that keeps a unit of the passage.

    Null, empty and blank texts have no units. Rows with a null doc_id are left alone: nothing
    is removed from them, and they aren't an earlier occurrence. Rows that repeat a doc_id count
    as one document. Ties don't occur, as offsets differ. An empty table gives no rows; other
    columns of `docs` are not read. Very long texts are read whole.

    Passages that begin or end within a sentence are found between documents, not within one,
    and only with `anywhere`; without it whole lines and sentences go, which is what op5's SQL says.

    A digest in a third of all documents is reduced to its smallest doc_id before the shuffle,
    and its occurrences are split by adaptive skew handling in the join. Grams that no other
    document has are mostly left out before the shuffle, by a map of SEEN_BITS bits.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).where("doc_id is not null")
    shipped(docs.sparkSession)
    schema = "digest long, doc_id long, span long, meta long"
    firsts = stored(rows.mapInArrow(_units, schema).where("meta & 2 = 0").groupBy("digest").agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").drop("last"))
    again = rows.mapInArrow(_units, schema).join(firsts, "digest", "left").where("meta & 2 <> 0 OR doc_id > first")
    again = again.select("doc_id", "span", "meta", F.coalesce("first", "doc_id").alias("first"))
    if anywhere:
        again = again.union(_matched_grams(rows))
    found = again.groupBy("doc_id").agg(F.collect_set(F.struct("span", "meta", "first")).alias("found"))
    return found.mapInArrow(_passages, "doc_id long, start long, end long, n_words long, first_doc_id long")


@F.pandas_udf(StringType())
def _without(text: pd.Series, cuts: pd.Series) -> pd.Series:
    def cut(t, spans):
        if t is None or spans is None:
            return t
        out, at = [], 0
        for x in spans:
            out.append(t[at:x["start"]])
            at = x["end"]
            while at < len(t) and t[at] in " \t":
                at += 1
            if t[at:at + 1] == "\n" and out[-1][-1:] in ("", "\n"):
                at += 1  # a whole line went
        return "".join(out) + t[at:]
    return pd.Series([cut(t, s) for t, s in zip(text, cuts)], dtype=object)


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with its repeated passages cut out of `text`; rows and other columns stay as they are.

    A text that loses nothing is unchanged to the byte. A text may end up empty. Null texts and rows with a null id stay as they
    are, rows that repeat an id and text are cut alike, an empty table stays empty. Other columns stay, whatever their names.
    """
    of, spans = spare(docs, "_cut_id"), spare(docs, "_cuts")
    cuts = repeated_passages(docs, doc_id, text).groupBy(F.col("doc_id").alias(of)).agg(
        F.sort_array(F.collect_list(F.struct("start", "end"))).alias(spans))
    joined = docs.join(cuts, docs[doc_id] == cuts[of], "left")
    return joined.withColumn(text, _without(F.col(text), F.col(spans))).select(*[F.col(f"`{c}`") for c in docs.columns])
