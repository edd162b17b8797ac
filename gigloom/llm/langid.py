"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

N-grams of one to three code points are hashed to DIMS features, weighted by their share of the
text and their inverse document frequency. Weights are learned by follow-the-regularised-leader
with elastic-net penalties, and probabilities are then calibrated by one temperature, fitted on
sampled texts that weren't trained on.
"""

from __future__ import annotations

import re
import tempfile
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gigloom.llm import sketch
from gigloom.llm.store import shipped, spare, stored
from gigloom.llm.words import pieces

DIMS = 1 << 16
ORDERS = (1, 2, 3)
SAMPLE = 1000  # labelled texts of each language that are learned from, about; they are chosen by hash
DENSE = 200  # languages up to which weights are one matrix; with more they are sparse rows, and the sample stays at DENSE * SAMPLE texts
LEAST = 20  # texts of each language in the sample, however many languages there are
CELLS = 2_000_000  # probabilities that a task holds at a time
ASIDE = 8_000_000  # probabilities that the temperature is fitted on, at most
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.3, 0.05  # follow-the-regularised-leader
ROWS = 256  # texts whose features are marked at a time
SCALE = 30.0  # of features: shares of n-grams are small
EPOCHS = 4
_LETTER = re.compile(r"[^\W\d_]")
_FOLD = np.arange(128, dtype=np.uint32)
_FOLD[[i for i in range(1, 128) if not chr(i).isalpha()]] = 32  # digits, signs and white space


def _ngrams(batch: pa.RecordBatch, column: str):
    """(feature, row) of every n-gram of a batch's texts, order by order."""
    texts = ["" if t is None else t.replace("\0", " ") for t in batch.column(batch.schema.get_field_index(column)).to_pylist()]
    raw = "\0".join([*texts, ""]).lower().encode("utf-32-le", "surrogatepass")
    code = np.frombuffer(raw, np.uint32).copy()
    plain = code < 128
    code[plain] = _FOLD[code[plain]]
    end = code == 0
    row = np.cumsum(end) - end
    keep = ~end
    h = np.zeros(len(code), np.uint32)
    for n in ORDERS:
        if n > 1:
            keep = keep[:-1] & ~end[n - 1:]
        h = (h[:len(keep)] * np.uint32(0x01000193)) ^ (code[n - 1:n - 1 + len(keep)] + np.uint32(1)) * np.uint32(0x9E3779B1)
        yield ((h * np.uint32(0x85EBCA6B)) >> np.uint32(16))[keep], row[:len(keep)][keep]


def features(batch: pa.RecordBatch, column: str) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text its distinct features and the share of its n-grams that each has."""
    parts = list(_ngrams(batch, column))
    found, rows = np.concatenate([p[0] for p in parts]).astype(np.int64), np.concatenate([p[1] for p in parts])
    keys, counts = np.unique(rows * DIMS + found, return_counts=True)
    cut = np.searchsorted(keys, np.arange(len(batch) + 1) * DIMS)
    return [(keys[a:b] % DIMS, counts[a:b] / max(1, counts[a:b].sum())) for a, b in zip(cut[:-1], cut[1:])]


def _present(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, int]:
    """How many texts of a batch have each feature, and how many have any."""
    seen, some = np.zeros(DIMS, np.int64), 0
    for low in range(0, len(batch), ROWS):
        part = batch.slice(low, ROWS)
        flags = np.zeros((len(part), DIMS), bool)
        for found, row in _ngrams(part, column):
            flags[row, found] = True
        seen += flags.sum(axis=0)
        some += int(flags.any(axis=1).sum())
    return seen, some


def _statistics(batches):
    """Document frequencies of all texts of a task, and the features of the texts marked as sample."""
    seen = np.zeros(DIMS + sketch.SLICES, np.int64)  # behind the features, the number of texts
    names = ["lang", "found", "share", "slice", "counts"]
    for batch in pieces(batches, "text"):
        has, some = _present(batch, "text")
        seen[:DIMS] += has
        seen[DIMS] += some
        picked = batch.filter(batch.column(2))
        if len(picked):
            rows = features(picked, "text")
            yield pa.RecordBatch.from_arrays([
                picked.column(0), pa.array([f.astype(np.int32).tobytes() for f, _ in rows], pa.binary()),
                pa.array([s.astype(np.float32).tobytes() for _, s in rows], pa.binary()),
                pa.nulls(len(rows), pa.int32()), pa.nulls(len(rows), pa.binary())], names)
    k = sketch.SLICES
    yield pa.RecordBatch.from_arrays([pa.nulls(k, pa.string()), pa.nulls(k, pa.binary()), pa.nulls(k, pa.binary()),
                                      *sketch.sliced(seen)], names)


@dataclass
class Sparse:
    """A matrix of features x languages of which most is zero: entries of row i are those from at[i] to at[i + 1]."""

    at: np.ndarray
    lang: np.ndarray
    value: np.ndarray
    langs: int

    def of(self, found: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The sum of the rows `found`, `x` times each."""
        size = self.at[found + 1] - self.at[found]
        i = np.repeat(self.at[found] - np.cumsum(size) + size, size) + np.arange(size.sum())
        return np.bincount(self.lang[i], np.repeat(x, size) * self.value[i], minlength=self.langs)

    def times(self, factor: np.ndarray) -> Sparse:
        """Each row times its factor."""
        return Sparse(self.at, self.lang, (self.value * np.repeat(factor, np.diff(self.at))).astype(np.float32), self.langs)


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray | Sparse  # DIMS x languages, with the inverse document frequencies in them
    bias: np.ndarray
    temperature: float


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _on_disk(shape: tuple[int, int]) -> np.ndarray:
    """Zeros in a nameless temporary file of the driver, which the system may take out of memory."""
    with tempfile.TemporaryFile() as f:
        return np.memmap(f, np.float32, "w+", shape=shape)


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], classes: int) -> tuple[np.ndarray | Sparse, np.ndarray, float]:
    """(weights, bias, temperature) from (class, features, values); every fifth row only sets the temperature."""
    dense = classes <= DENSE
    z, n = ((np.zeros if dense else _on_disk)((DIMS + 1, classes)) for _ in range(2))

    def weights(i):
        zi, ni = z[i], n[i]
        return np.where(np.abs(zi) > L1, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(ni)) / ALPHA + L2), 0.0)

    rng = np.random.default_rng(7)
    aside = [r for k, r in enumerate(rows) if k % 5 == 0]
    used = [r for k, r in enumerate(rows) if k % 5] or rows
    for _ in range(EPOCHS):
        for k in rng.permutation(len(used)):
            label, found, x = used[k]
            i, x = np.append(found, DIMS), np.append(x * SCALE, 1.0)
            w = weights(i)
            p = _softmax(x @ w)
            p[label] -= 1.0
            g = x[:, None] * p
            sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA
            z[i] += g - sigma * w
            n[i] += g * g
    aside = aside[:ASIDE // classes]
    if dense:
        w = weights(slice(None))
        bias, w = w[DIMS], w[:DIMS] * SCALE
        logits = np.array([x @ w[found] + bias for _, found, x in aside]).reshape(len(aside), classes)
    else:
        bias, w = weights(DIMS), _sparse(weights, classes)
        logits = np.array([w.of(found, x) + bias for _, found, x in aside]).reshape(len(aside), classes)
    labels = np.array([label for label, _, _ in aside])
    grid = np.exp(np.linspace(np.log(0.05), np.log(20), 200))
    loss = [-np.log(_softmax(logits / t)[np.arange(len(labels)), labels] + 1e-300).mean() + 1e-3 * np.log(t) ** 2 for t in grid]
    return w, bias, float(grid[int(np.argmin(loss))]) if len(aside) else 1.0


def _sparse(weights, classes: int) -> Sparse:
    """All rows of weights, ROWS at a time, times SCALE."""
    size, lang, value = [], [], []
    for low in range(0, DIMS, ROWS):
        w = weights(slice(low, low + ROWS))
        row, col = np.nonzero(w)
        size.append(np.bincount(row, minlength=ROWS))
        lang.append(col.astype(np.int32))
        value.append((w[row, col] * SCALE).astype(np.float32))
    return Sparse(np.concatenate([[0], np.cumsum(np.concatenate(size))]), np.concatenate(lang), np.concatenate(value), classes)


def fit(docs: DataFrame, learn: Column, lang: str = "lang", text: str = "text") -> Model:
    """Learn the languages of the rows where `learn` holds and lang isn't null.

    Every value of lang is learned. Document frequencies are of all those rows; weights are
    learned on about SAMPLE distinct texts of each language, chosen by a hash of the text, which the
    driver holds as hashed features; copies of a chosen text count once. With over DENSE languages it is as many fewer of each that the
    sample doesn't grow, but LEAST at least.
    """
    shipped(docs.sparkSession)
    rows = docs.where(learn & F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    counts = sorted(((r["count"], r["lang"]) for r in rows.groupBy("lang").count().collect()),
                    key=lambda x: x[1])
    langs = [name for _, name in counts]
    if not langs:
        return Model([], np.zeros((DIMS, 0), np.float32), np.zeros(0), 1.0)
    each = SAMPLE if len(langs) <= DENSE else max(LEAST, SAMPLE * DENSE // len(langs))
    shares = F.create_map(*[F.lit(x) for n, name in counts for x in (name, min(1.0, each / n))])
    mark = F.coalesce(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < shares[F.col("lang")] * (1 << 20), F.lit(False))
    seen = stored(sketch.numbered(rows.select("lang", "text", mark.alias("mark")).mapInArrow(
        _statistics, f"lang string, found binary, share binary, {sketch.FIELDS}")))
    df = sketch.total(seen.where("slice is not null").select("slice", "part", "counts"), DIMS + sketch.SLICES)
    idf = np.log((1.0 + df[DIMS]) / (1.0 + df[:DIMS])) + 1.0
    sample, place = [], {name: k for k, name in enumerate(langs)}
    for r in seen.where("slice is null").select("lang", "found", "share").distinct().orderBy("lang", F.xxhash64("found")).toLocalIterator():
        i = np.frombuffer(r.found, np.int32)
        sample.append((place[r.lang], i, (np.frombuffer(r.share, np.float32) * idf[i]).astype(np.float32)))
    order = np.random.default_rng(11).permutation(len(sample))
    w, bias, t = train([sample[k] for k in order], len(langs))
    return Model(langs, w.times(idf) if isinstance(w, Sparse) else (w * idf[:, None]).astype(np.float32), bias, t)


def scores(batch: pa.RecordBatch, column: str, model: Model) -> np.ndarray:
    """Calibrated probabilities of each language for each text of a batch."""
    if isinstance(model.weights, Sparse):
        z = [model.weights.of(found, share) for found, share in features(batch, column)]
        return _softmax((np.array(z).reshape(len(batch), len(model.langs)) + model.bias) / model.temperature)
    total, count = np.zeros((len(batch), len(model.langs))), np.zeros(len(batch))
    for found, row in _ngrams(batch, column):
        if len(found):
            first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
            total[row[first]] += np.add.reduceat(model.weights[found], first, axis=0, dtype=np.float64)
            count += np.bincount(row, minlength=len(batch))
    return _softmax((total / np.maximum(count, 1)[:, None] + model.bias) / model.temperature)


def _few(batches, rows: int):
    for batch in batches:
        for low in range(0, max(1, len(batch)), rows):
            yield batch.slice(low, rows)


def predict(docs: DataFrame, model: Model, text: str = "text", pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """`docs` with lang_pred and score: the likeliest language and its probability, or `und` and 0.

    `und`: the text is null or has no letter, or there is no language to choose from. Equal
    probabilities go to the first language in code point order. Other columns, repeated rows
    and their number stay as they are; columns named like the two new ones are replaced.
    """
    shipped(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keep, whole = [c for c in docs.columns if c not in (pred, score)], spare(docs, "_text")

    def run(batches):
        known = shared.value
        for batch in _few(pieces(batches, whole), max(1, CELLS // max(1, len(known.langs)))):
            texts = batch.column(batch.schema.get_field_index(whole)).to_pylist()
            p = scores(batch, whole, known) if known.langs else np.zeros((len(batch), 1))
            best = p.argmax(axis=1) if len(batch) else np.zeros(0, int)
            good = [bool(known.langs) and t is not None and bool(_LETTER.search(t)) for t in texts]
            yield pa.RecordBatch.from_arrays([
                *batch.columns[:-1], pa.array([known.langs[b] if g else "und" for b, g in zip(best, good)], pa.string()),
                pa.array([float(p[i, b]) if g else 0.0 for i, (b, g) in enumerate(zip(best, good))], pa.float64())],
                [*batch.schema.names[:-1], pred, score])
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text).cast("string").alias(whole))
    schema = rows.drop(whole).schema.add(pred, "string").add(score, "double")
    return rows.mapInArrow(run, schema)


def languages(docs: DataFrame, learn: Column, lang: str = "lang", text: str = "text", **names) -> DataFrame:
    """`docs` with the language of every row, learned from the rows where `learn` holds."""
    return predict(docs, fit(docs, learn, lang, text), text, **names)
