"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the bag of its character n-grams (3, 4, 6 and 8 bytes, with the blank before and after
it, so stems of letters that take two bytes are among them) and of itself, hashed to BUCKETS embeddings; so a misspelling shares most of its vectors with
the word it stands for. A window of WINDOW words is the average of its subwords' embeddings, and
a linear softmax over it tells the window's class. A text is as toxic as its worst window: one
insult in a long text counts as much as in a short one.

Labels are of texts, so training chooses windows: first every window has its text's label, then
only the windows that already stand out in a toxic text do. FOLDS models score the texts they
haven't learned from; a logistic fit on these, above a floor for texts that are labelled toxic
without a sign of it, turns the worst window into a probability. The model that scores learns from
all texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gigloom.llm.store import shipped, spare
from gigloom.llm.words import LOWER, pieces, place_values

BITS = 19
BUCKETS = 1 << BITS
DIM = 16
ORDERS = (3, 4, 6, 8)
WINDOW = 8
SAMPLE = 1500  # labelled texts of each class that are learned from, about; they are chosen by a hash of the id
BYTES = 6 << 20  # of the texts of each class in the sample, about: it bounds what the driver holds
LONG = 100_000  # code points; of a longer text so many are learned from, in pieces chosen by hash from its whole length
PIECE = 2000  # code points of such a piece
CUT = 1 << 18  # code points of the texts that are cut into subwords at a time
RATE, BATCH = 0.1, 128
ROUNDS = 6
FOLDS = 2
FLOORS = (0.0, 0.002, 0.005, 0.01, 0.02, 0.03, 0.05, 0.1)  # parts of toxic labels without a sign that the fit chooses from

_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_FOLD = LOWER.copy()
_FOLD[_BLANK] = 32
_PLAIN = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])  # letters, digits and all beyond ASCII


@dataclass
class Bags:
    """Subwords of texts: bucket of each, the word it belongs to, and the row of each word."""

    bucket: np.ndarray
    word: np.ndarray
    row: np.ndarray


def bags(texts: list[str | None]) -> Bags:
    parts = [(t or "").encode("utf-8", "replace") for t in texts]
    raw = _FOLD[np.frombuffer(b" " + b" ".join(parts) + b"  ", np.uint8)]
    # a sign counts within a word ("d*mn"), not beside it
    plain = _PLAIN[raw]
    beside = ~plain
    beside[1:-1] &= ~(plain[:-2] & plain[2:])
    raw[beside] = 32
    blank = raw == 32
    begins = np.flatnonzero(~blank[1:] & blank[:-1]) + 1
    at = 1 + np.concatenate([[0], np.cumsum([len(p) + 1 for p in parts])])
    row = np.searchsorted(at, begins, "right") - 1
    word = np.cumsum(np.concatenate([[False], ~blank[1:] & blank[:-1]])) - 1
    ends = np.flatnonzero(blank[1:] & ~blank[:-1]) + 1
    h = np.zeros(len(raw), np.uint32)
    inner = np.ones(len(raw), bool)  # no blank but the first and last byte
    found, owner = [], []
    for n in range(1, max(ORDERS) + 1):
        m = len(raw) - n + 1
        if m <= 0:
            break
        h = h[:m] * np.uint32(0x01000193) + raw[n - 1:] + np.uint32(1)
        if n >= 3:
            inner = inner[:m] & ~blank[n - 2:n - 2 + m]
        if n in ORDERS:
            i = np.flatnonzero(inner & ~blank[1:1 + m])
            found.append((h[i] * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS))
            owner.append(word[i + 1])
    up, down = place_values(len(raw))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(7)) * up[:len(raw)], out=sums[1:])
    whole = (sums[ends] - sums[begins]) * down[begins]
    found.append(((whole * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - BITS)).astype(np.uint32))
    owner.append(np.arange(len(begins)))
    return Bags(np.concatenate(found).astype(np.int32), np.concatenate(owner).astype(np.int32), row)


@dataclass
class Model:
    """What scoring needs of the embeddings and the softmax: each subword's part of a window's logit, and the fit."""

    part: np.ndarray
    bias: float
    slope: float
    offset: float
    floor: float = 0.0

    def probability(self, x: np.ndarray) -> np.ndarray:
        """Of the worst windows' logits; 0 where a text has no words."""
        p = self.floor + (1 - self.floor) / (1 + np.exp(-np.clip(self.slope * x + self.offset, -700, 700)))
        return np.where(np.isfinite(x), p, 0.0)


def worst(b: Bags, part: np.ndarray, bias: float, rows: int) -> np.ndarray:
    """The highest logit of any window of WINDOW neighbouring words of each row; -inf without words."""
    n = len(b.row)
    out = np.full(rows, -np.inf)
    if not n:
        return out
    sums = np.concatenate([[0.0], np.cumsum(np.bincount(b.word, part[b.bucket], minlength=n))])
    sizes = np.concatenate([[0], np.cumsum(np.bincount(b.word, minlength=n))])
    last = np.searchsorted(b.row, b.row, "right")  # end of the row of each word
    first = np.searchsorted(b.row, b.row, "left")
    start = np.arange(n)
    end = np.minimum(start + WINDOW, last)
    start = np.maximum(first, np.minimum(start, end - WINDOW))  # a row's last windows are as long as others
    np.maximum.at(out, b.row, (sums[end] - sums[start]) / (sizes[end] - sizes[start]) + bias)
    return out


def _windows(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Non-overlapping windows for training: (buckets in window order, where each window begins and the end, its text).

    Texts are cut a few at a time, so that only the buckets of all of them are held.
    """
    few = list(_few(texts))
    parts = [_cut(bags(texts[i:j])) for i, j in few]
    sizes = np.concatenate([np.diff(at) for _, at, _ in parts])
    return (np.concatenate([b for b, _, _ in parts]), np.concatenate([[0], np.cumsum(sizes)]),
            np.concatenate([row + i for (i, _), (_, _, row) in zip(few, parts)]))


def _few(texts: list[str]):
    """(first, end) of neighbouring texts of CUT code points at most, or one."""
    i = 0
    while i < len(texts):
        j, size = i + 1, len(texts[i])
        while j < len(texts) and size + len(texts[j]) <= CUT:
            size += len(texts[j])
            j += 1
        yield i, j
        i = j


def _cut(b: Bags) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if not len(b.row):
        return b.bucket, np.zeros(1, np.int64), b.row
    first = np.searchsorted(b.row, b.row, "left")
    number = (np.arange(len(b.row)) - first) // WINDOW
    fresh = np.concatenate([[True], (b.row[1:] != b.row[:-1]) | (number[1:] != number[:-1])])
    window = np.cumsum(fresh) - 1
    of = window[b.word]
    order = np.argsort(of, kind="stable")
    return b.bucket[order], np.searchsorted(of[order], np.arange(window[-1] + 2)), b.row[fresh]


def train(texts: list[str], labels: np.ndarray) -> Model | None:
    """The model of texts labelled 0 or 1, or None if a class is missing."""
    labels = np.asarray(labels, np.int64)
    if len(set(labels.tolist())) < 2:
        return None
    windows = _windows(texts)
    fold = np.zeros(len(texts), np.int64)
    for y in (0, 1):  # the same part of each class in each fold
        fold[labels == y] = np.arange((labels == y).sum()) % FOLDS

    def taught(use):
        part, bias = _embedded(windows, labels, use)
        return part, bias, np.concatenate([worst(bags(texts[i:j]), part, bias, j - i) for i, j in _few(texts)])
    part, bias, highest = taught(np.ones(len(texts), bool))
    if min(np.bincount(labels)) >= FOLDS:
        for k in range(FOLDS):
            highest = np.where(fold == k, taught(fold != k)[2], highest)
    return Model(part.astype(np.float32), bias, *_logistic(highest, labels))


def _embedded(windows: tuple[np.ndarray, np.ndarray, np.ndarray], labels: np.ndarray, use: np.ndarray) -> tuple[np.ndarray, float]:
    """(each subword's part of a logit, bias) of embeddings and softmax, learned from the texts in `use`."""
    bucket, at, row = windows
    rng = np.random.default_rng(5)
    # embeddings start at zero, and one that a single text has stays there: what is rare or unseen says nothing
    emb = np.zeros((BUCKETS, DIM), np.float32)
    shared = _in_several(bucket, np.repeat(row.astype(np.int32), np.diff(at)))
    top = rng.normal(0, 0.3, (DIM, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    positive, used = labels[row] == 1, use[row]
    target = positive.copy()  # of each window
    trained = used.copy()
    past = np.full(BUCKETS, 1e-8, np.float32)  # squared gradients of each embedding, so that rare subwords move as far as frequent ones
    past_top, past_bias = np.full((DIM, 2), 1e-8, np.float32), np.full(2, 1e-8, np.float32)
    for turn in range(ROUNDS):
        pos, neg = np.flatnonzero(trained & target), np.flatnonzero(used & ~positive)
        if turn:  # the negatives that look worst, and as many others
            logit = _logits(emb, top, bias, bucket, at)
            hard = neg[np.argsort(-logit[neg])[:len(pos)]]
            neg = np.concatenate([hard, rng.choice(neg, min(len(neg), max(4 * len(pos), 20_000)), replace=False)])
        else:
            neg = rng.choice(neg, min(len(neg), 2 * len(pos)), replace=False)
        todo = rng.permutation(np.concatenate([pos, neg]))
        for k in range(0, len(todo), BATCH):
            batch = np.sort(todo[k:k + BATCH])
            size = at[batch + 1] - at[batch]
            start = np.concatenate([[0], np.cumsum(size)[:-1]])
            ids = bucket[np.repeat(at[batch] - start, size) + np.arange(size.sum())]
            mean = np.add.reduceat(emb[ids], start, axis=0) / size[:, None]
            z = mean @ top + bias
            z = np.exp(z - z.max(axis=1, keepdims=True))
            g = z / z.sum(axis=1, keepdims=True)
            g[np.arange(len(batch)), (target & positive)[batch].astype(int)] -= 1
            back = g @ top.T
            for value, grad, sums in ((top, mean.T @ g / len(batch), past_top), (bias, g.mean(axis=0), past_bias)):
                sums += grad * grad
                value -= RATE * grad / np.sqrt(sums)
            order = np.argsort(ids, kind="stable")
            fresh = np.flatnonzero(np.concatenate([[True], ids[order][1:] != ids[order][:-1]]))
            step = np.add.reduceat(np.repeat(back / size[:, None], size, axis=0)[order], fresh, axis=0)
            which = ids[order][fresh]
            which, step = which[shared[which]], step[shared[which]]
            past[which] += (step * step).mean(axis=1)
            emb[which] -= RATE * step / np.sqrt(past[which])[:, None]
        logit = _logits(emb, top, bias, bucket, at)
        best = np.full(len(labels), -np.inf)
        np.maximum.at(best, row, logit)
        target = positive & ((logit >= best[row]) | (logit > 2.0))  # each toxic text's worst window, and all that are plainly toxic
        trained = used & (target | ~positive)
    return emb @ (top[:, 1] - top[:, 0]), float(bias[1] - bias[0])


def _in_several(bucket: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Which buckets two texts or more have; entries come text by text."""
    first, several = np.full(BUCKETS, -1, np.int32), np.zeros(BUCKETS, bool)
    for low in range(0, len(bucket), 1 << 20):
        b, t = bucket[low:low + (1 << 20)], text[low:low + (1 << 20)].astype(np.int32)
        new = first[b] == -1
        first[b[new][::-1]] = t[new][::-1]
        several[b[first[b] != t]] = True
    return several


def _logits(emb, top, bias, bucket, at) -> np.ndarray:
    part = emb @ (top[:, 1] - top[:, 0])
    return np.add.reduceat(part[bucket], at[:-1]) / np.diff(at) + bias[1] - bias[0]


def _logistic(x: np.ndarray, labels: np.ndarray) -> tuple[float, float, float]:
    """Slope, offset and floor of a logistic fit, with the class targets pulled in as in Platt scaling.

    The floor is the part of toxic labels that no window explains: of FLOORS the one under which
    the labels are likeliest. Each turn weighs a toxic label by how likely it is due to the words.
    """
    x, y = x[np.isfinite(x)], labels[np.isfinite(x)].astype(float)
    ones, zeros = y.sum(), (1 - y).sum()
    goal = np.where(y > 0, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    m, s = x.mean(), x.std() + 1e-9
    u = np.stack([(x - m) / s, np.ones(len(x))], axis=1)
    best = (-np.inf, 1.0, 0.0, 0.0)
    for floor in FLOORS:
        w = np.array([4.0, -2.0])
        for _ in range(100):
            p = 1 / (1 + np.exp(-np.clip(u @ w, -30, 30)))
            target = goal * np.where(y > 0, p / (p + floor * (1 - p)), 1.0)
            hess = (u * (p * (1 - p))[:, None]).T @ u + 1e-2 * np.eye(2)
            w = w - np.clip(np.linalg.solve(hess, u.T @ (p - target) + 1e-3 * w), -1, 1)
        w[0] = max(w[0], 1e-6)
        p = floor + (1 - floor) / (1 + np.exp(-np.clip(u @ w, -30, 30)))
        likely = float(np.sum(y * np.log(p) + (1 - y) * np.log(1 - p)))
        if likely > best[0]:
            best = likely, float(w[0]) / s, float(w[1] - w[0] * m / s), floor
    return best[1:]


def _sampled(batches):
    """Texts of over LONG code points as pieces from their whole length, LONG in all, about; others whole."""
    for batch in batches:
        out = []
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if len(t) > LONG:
                n = -(-len(t) // PIECE)
                some = np.sort(np.random.default_rng(abs(i)).permutation(n)[:LONG // PIECE])
                t = "\n".join(t[k * PIECE:(k + 1) * PIECE] for k in some)
            out.append(t)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string()), batch.column(2)], ["doc_id", "text", "y"])


def fit(docs: DataFrame, labels: DataFrame, learn: Column, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> Model | None:
    """Learn from about SAMPLE labelled texts of each class among the labelled ids where `learn` holds.

    The ids are chosen first, by a hash, so the texts of the others are never moved. Of the chosen
    texts, short and long, those first by the hash are learned from until a class has BYTES. A
    repeated id has the highest of its labels; null labels and ids don't count. A text of over LONG
    code points teaches by pieces of its whole length. Without labelled texts of both classes, in
    an empty table too, there is no model; other columns, clashing names too, are not read.
    """
    shipped(docs.sparkSession)
    marked = labels.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).where(
        F.col("doc_id").isNotNull() & F.col("y").isin(0, 1)).where(learn).groupBy("doc_id").agg(F.max("y").alias("y"))
    counts = {r.y: r["count"] for r in marked.groupBy("y").count().collect()}
    if len(counts) < 2:
        return None
    draw = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 20))
    limit = F.create_map(*[F.lit(x) for y, n in counts.items() for x in (y, min(1.0, 2 * SAMPLE / n) * (1 << 20))])[F.col("y")]
    chosen = marked.where(draw < limit)  # about 4 * SAMPLE ids
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).where(
        F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    sizes = texts.select("doc_id", F.least(F.octet_length("text"), F.lit(4 * LONG)).alias("size")).join(F.broadcast(chosen), "doc_id").groupBy(
        "doc_id", "y").agg(F.max("size").alias("size")).withColumn("draw", draw).collect()
    held, ids = dict.fromkeys(counts, 0), []
    for r in sorted(sizes, key=lambda r: (r.draw, r.doc_id)):
        if held[r.y] < BYTES:
            held[r.y] += r.size
            ids.append(r.doc_id)
    if not ids:
        return None
    kept = F.broadcast(docs.sparkSession.createDataFrame(pa.table({"doc_id": pa.array(sorted(ids), pa.int64())})))
    rows = texts.join(F.broadcast(chosen), "doc_id").join(kept, "doc_id").select("doc_id", "text", "y")
    rows = rows.mapInArrow(_sampled, "doc_id long, text string, y int").groupBy("doc_id").agg(F.min(F.struct("text", "y")).alias("one")).select("doc_id", "one.*")
    found = sorted(((r.doc_id, r.text, r.y) for r in rows.collect()), key=lambda r: r[0])
    order = np.random.default_rng(3).permutation(len(found))
    return train([found[i][1] for i in order], np.array([found[i][2] for i in order], np.int64))


def scored(docs: DataFrame, model: Model | None, text: str = "text", score: str = "score") -> DataFrame:
    """`docs` with score, the probability that the text is toxic.

    Null, empty and blank texts score 0, and so do all texts without a model. Other columns,
    repeated rows and their number stay; a column named like the new one is replaced. Every
    window of the whole text is scored.
    """
    shipped(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keep, whole = [c for c in docs.columns if c != score], spare(docs, "_text")

    def run(batches):
        known = shared.value
        for batch in pieces(batches, whole):
            texts = batch.column(batch.schema.get_field_index(whole)).to_pylist()
            p = np.zeros(len(texts))
            if known is not None and texts:
                p = known.probability(worst(bags(texts), known.part, known.bias, len(texts)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(p)], [*batch.schema.names[:-1], score])
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text).cast("string").alias(whole))
    return rows.mapInArrow(run, rows.drop(whole).schema.add(score, "double"))
