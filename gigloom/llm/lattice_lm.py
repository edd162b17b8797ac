"""LM scoring by subword lattice likelihood.

A word's probability under the subword model is the sum over all ways of cutting it into pieces
of an existing vocabulary, each piece at its own probability; one log-space forward recursion
over the lattice of pieces gives it. The vocabulary's scores (merge ranks) set the first piece
probabilities; expected counts over the distinct training words, from the same lattice run
forwards and backwards, replace them in ROUNDS rounds. Every byte is a piece, so every text has
a probability.

A text is its words and one end. Texts fall into CLASSES by a training column (the language), and
a text's probability is the sum over the classes of their share times the product over tokens:
    P(token | z) = max(c_z - D_z, 0) / N_z + (D_z * V_z / N_z) * P(token)
    P(token)     = max(c - D, 0) / N + (D * V / N) * lattice(token)
A token seen in training has its count less a discount; the mass that the discounts free goes
from a class to all classes, and from there to the lattice, so both lines sum to 1 over all words
and the end. Discounts are estimated from how many words occur once and twice. The text that is
scored never tells its class.

Every distinct word of the table is valued by the lattice once. The HEAD most frequent words are
known to every task; rarer ones are counted per document and meet their corpus counts and
values in a join by hash.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gigloom.llm.store import shipped, stored
from gigloom.llm.words import LOWER, pieces, words

HEAD = 200_000  # words whose counts every task holds, about: 16 bytes each
ROUNDS = 2
COUNT_CHUNK = 2 << 20  # bytes of text whose words are counted together
CELLS = 200_000  # bytes of words in one lattice block
CLASSES = 8  # of training texts: the most frequent ones, others are one more class
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SLOTS = 21


def vocabulary(path: str) -> tuple[list[bytes], np.ndarray]:
    """(pieces, first probabilities) of a sentencepiece file: lower-cased, a space where a word begins, and all bytes.

    A score is a merge rank; a piece starts at 1 / (rank + 10), as word frequencies fall.
    """
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    table = {bytes([b]): 1e-6 for b in range(256)}
    for i in range(model.get_piece_size()):
        if model.is_byte(i) or model.is_control(i) or model.is_unknown(i):
            continue
        raw = model.id_to_piece(i).replace("▁", " ").encode()
        if b" " in raw[1:]:
            continue
        piece = LOWER[np.frombuffer(raw, np.uint8)].tobytes()
        table[piece] = table.get(piece, 0.0) + 1.0 / (max(0.0, -model.get_score(i)) % 1e6 + 10.0)
    names = sorted(table)
    p = np.array([table[x] for x in names])
    return names, p / p.sum()


@dataclass
class Lattice:
    """All prefixes of the pieces in two hash tables, the piece that a prefix is, and log probabilities (one more: no piece)."""

    keys: np.ndarray
    piece: np.ndarray
    first: np.ndarray
    second: np.ndarray
    logp: np.ndarray

    @classmethod
    def of(cls, names: list[bytes], p: np.ndarray) -> Lattice:
        found: dict[int, int] = {}
        none = len(names)
        for i, x in enumerate(names):
            h = 0
            for n, b in enumerate(x, 1):
                h = (h * int(_STEP) + b + 1) & 0xFFFFFFFFFFFFFFFF
                if n == len(x):
                    found[h] = i
                else:
                    found.setdefault(h, none)
        keys = np.array([*found, 0], np.uint64)
        last = len(found)
        first, second = np.full(1 << _SLOTS, last, np.int32), np.full(1 << _SLOTS, last, np.int32)
        slot, other = cls._slots(keys[:-1])
        for i in range(last):
            if first[slot[i]] == last:
                first[slot[i]] = i
            elif second[other[i]] == last:
                second[other[i]] = i
            else:
                raise ValueError("two hash tables don't hold this vocabulary; raise _SLOTS")
        return cls(keys, np.array([*found.values(), none], np.int32), first, second, np.zeros(0)).weighed(p)

    def weighed(self, p: np.ndarray) -> Lattice:
        """The same pieces with other probabilities."""
        with np.errstate(divide="ignore"):
            return replace(self, logp=np.log(np.append(p, 0.0)))

    @staticmethod
    def _slots(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        shift = np.uint64(64 - _SLOTS)
        return (h * np.uint64(0xD6E8FEB86659FD93)) >> shift, (h * np.uint64(0xA0761D6478BD642F)) >> shift

    def _found(self, h: np.ndarray) -> np.ndarray:
        """Place of each hash among the keys; the last place is for hashes that aren't there."""
        a, b = self._slots(h)
        one = self.first[a]
        miss = np.flatnonzero(self.keys[one] != h)
        two = self.second[b[miss]]
        one[miss] = np.where(self.keys[two] == h[miss], two, len(self.keys) - 1)
        return one

    def arcs(self, grid: np.ndarray) -> list[np.ndarray]:
        """For each length the piece that starts at each byte of each word of a grid (words x bytes).

        A start whose bytes so far begin no piece is not looked up again.
        """
        words_, size = grid.shape
        none = len(self.logp) - 1
        h, at, col = np.zeros(words_ * size, np.uint64), np.arange(words_ * size), np.tile(np.arange(size), words_)
        flat, out = grid.ravel(), []
        for n in range(1, size + 1):
            inside = col + n <= size
            h, at, col = h[inside], at[inside], col[inside]
            h = h * _STEP + flat[at + n - 1] + np.uint64(1)
            key = self._found(h)
            some = key != len(self.keys) - 1
            h, at, col, key = h[some], at[some], col[some], key[some]
            if not len(h):
                break
            ids = np.full(words_ * size, none, np.int32)
            ids[at] = self.piece[key]
            out.append(np.ascontiguousarray(ids.reshape(words_, size).T))  # by start
        return out

    def _ways(self, arcs: list[np.ndarray], size: int) -> list[list[tuple[int, int]]]:
        """For each end the (start, length) of pieces that some word has there."""
        none, ways = len(self.logp) - 1, [[] for _ in range(size + 1)]
        for n, ids in enumerate(arcs, 1):
            for start in np.flatnonzero((ids != none).any(axis=1)):
                ways[start + n].append((int(start), n))
        return ways

    def forward(self, arcs: list[np.ndarray], size: int, ways=None) -> np.ndarray:
        """Log probability of all cuts of each word's first bytes, 0 to all."""
        alpha = np.full((size + 1, arcs[0].shape[1]), -np.inf)
        alpha[0] = 0.0
        for end, found in enumerate(ways or self._ways(arcs, size)):
            if found:
                x = np.stack([alpha[start] + self.logp[arcs[n - 1][start]] for start, n in found])
                top = x.max(axis=0)
                alpha[end] = top + np.log(np.exp(x - top).sum(axis=0))
        return alpha

    def expected(self, arcs: list[np.ndarray], size: int, weight: np.ndarray) -> np.ndarray:
        """How often each piece is used, over all cuts of the words."""
        ways = self._ways(arcs, size)
        alpha = self.forward(arcs, size, ways)
        beta = np.full_like(alpha, -np.inf)
        beta[size] = 0.0
        used = np.zeros(len(self.logp))
        starts: list[list[int]] = [[] for _ in range(size)]
        for found in ways:
            for start, n in found:
                starts[start].append(n)
        for start in range(size - 1, -1, -1):
            if not starts[start]:
                continue
            x = np.stack([beta[start + n] + self.logp[arcs[n - 1][start]] for n in starts[start]])
            top = np.maximum(x.max(axis=0), -1e300)  # no cut goes on from here
            beta[start] = top + np.log(np.maximum(np.exp(x - top).sum(axis=0), 1e-300))
            share = np.exp(x + (alpha[start] - alpha[size])) * weight
            for n, own in zip(starts[start], share):
                used += np.bincount(arcs[n - 1][start], own, minlength=len(used))
        return used[:-1]

    @staticmethod
    def blocks(found: list[bytes]):
        """(places, grid) of words of one length, a bounded number at a time."""
        size = np.array([len(w) for w in found], np.int64)
        order = np.argsort(size, kind="stable")
        i = 0
        while i < len(order):
            n = int(size[order[i]])
            j = min(int(np.searchsorted(size[order], n, "right")), i + max(1, CELLS // (n + 1)))
            raw = b"".join(b" " + found[k] for k in order[i:j])
            yield order[i:j], LOWER[np.frombuffer(raw, np.uint8).reshape(j - i, n + 1)].astype(np.uint64)
            i = j

    def words(self, found: list[bytes]) -> np.ndarray:
        """Log probability of each word."""
        out = np.zeros(len(found))
        for at, grid in self.blocks(found):
            out[at] = self.forward(self.arcs(grid), grid.shape[1])[-1]
        return out


def _counted(batches):
    """Words of a task's texts, how often its training texts have them (perhaps never), and the training texts' ends."""
    for batch in pieces(batches, "text", COUNT_CHUNK):
        w = words(batch, "text")
        h, kind = w.hashes(), batch.column(1).to_numpy().astype(np.int64)
        learn = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
        z = kind[w.row]
        _, where, back = np.unique(h + z.astype(np.uint64) * _STEP, return_index=True, return_inverse=True)
        n = np.bincount(back, learn[w.row], minlength=len(where)).astype(np.int64)
        low = LOWER[w.raw].tobytes()
        found = [low[a:b] for a, b in zip(w.start[where].tolist(), w.end[where].tolist())]
        texts = np.bincount(kind[learn])
        ends = np.flatnonzero(texts)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.concatenate([h[where].view(np.int64), np.zeros(len(ends), np.int64)])),
            pa.array([*found, *[b""] * len(ends)], pa.binary()), pa.array(np.concatenate([z[where], ends]).astype(np.int32)),
            pa.array(np.concatenate([n, texts[ends]]))], ["h", "word", "z", "n"])


def _gathered(batches, rows: int = 32_768):
    """Batches of about `rows` rows: words of one length are worked on together, so a batch should hold many."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += len(batch)
        if n >= rows:
            yield pa.concat_batches(held)
            held, n = [], 0
    if held:
        yield pa.concat_batches(held)


def _expected(lattice):
    def run(batches):
        model, used = lattice.value, None
        for batch in _gathered(batches):
            found = batch.column(0).to_pylist()
            for at, grid in model.blocks(found):
                one = model.expected(model.arcs(grid), grid.shape[1], np.ones(len(at)))
                used = one if used is None else used + one
        if used is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(used))), pa.array(used)], ["piece", "used"])
    return run


def _valued(lattice):
    """(h, word, counts ...) with the log probability of each word in place of the word."""
    def run(batches):
        for batch in _gathered(batches):
            value = lattice.value.words(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[2:], pa.array(value)],
                                             [batch.schema.names[0], *batch.schema.names[2:], "lattice"])
    return run


@dataclass
class Level:
    """Counts of one class, or of all: tokens, distinct tokens, ends, discount."""

    total: int
    distinct: int
    ends: int
    discount: float

    @classmethod
    def of(cls, total, distinct, ends, one, two) -> Level:
        return cls(total or 0, distinct or 0, ends or 0, one / (one + 2 * two) if one and two else 0.5)

    @property
    def freed(self) -> float:
        return self.discount * self.distinct / self.total if self.total else 1.0

    def seen(self, c):
        return np.maximum(c - self.discount, 0.0) / max(1, self.total)


@dataclass
class Model:
    all: Level
    classes: list[Level]
    head: np.ndarray  # word hashes, sorted
    counts: np.ndarray  # of the head's words, in each class
    lattice: np.ndarray  # their log probabilities there

    def base(self, c):
        return np.log10((c + 0.1) / (self.all.total + 0.1 * (self.all.distinct + 1)))

    def scores(self, c: np.ndarray, log_lattice: np.ndarray) -> np.ndarray:
        """log10 P of words in each class; c: their counts there; log_lattice: natural logs."""
        with np.errstate(divide="ignore"):
            back = np.logaddexp(np.log(self.all.seen(c.sum(axis=1))), np.log(self.all.freed) + log_lattice)
            out = [np.logaddexp(np.log(z.seen(c[:, k])), np.log(z.freed) + back) for k, z in enumerate(self.classes)]
        return np.stack(out, axis=1) / np.log(10)

    def end(self) -> np.ndarray:
        """log10 of each class's share and of an end in it."""
        if not self.all.total:
            return np.zeros(1)
        back = self.all.seen(self.all.ends)
        share = [(z.ends + 0.5) / (self.all.ends + 0.5 * len(self.classes)) for z in self.classes]
        return np.log10(share) + np.log10([z.seen(z.ends) + z.freed * back for z in self.classes])


def train(rows: DataFrame, path: str, head: int) -> tuple[DataFrame, Model]:
    """(h, n, c0, c1, ..., lattice of every word, the model) from `rows` (text, z, learn)."""
    spark = rows.sparkSession
    k = (rows.where("learn").agg(F.max("z")).first()[0] or 0) + 1
    each = [f"c{i}" for i in range(k)]
    counts = stored(rows.select("text", "z", "learn").mapInArrow(_counted, "h long, word binary, z int, n long").groupBy("h", "word").agg(
        F.sum("n").alias("n"), *[F.sum(F.when(F.col("z") == i, F.col("n")).otherwise(0)).alias(c) for i, c in enumerate(each)]))
    end = F.length("word") == 0
    told = counts.agg(*[x for c in ("n", *each) for x in (
        F.sum(c), F.count_if(F.col(c) > 0), F.sum(F.when(end, F.col(c))), F.count_if(F.col(c) == 1), F.count_if(F.col(c) == 2))]).first()
    levels = [Level.of(*told[i:i + 5]) for i in range(0, len(told), 5)]
    names, p = vocabulary(path)
    lattice = Lattice.of(names, p)
    for _ in range(ROUNDS if levels[0].total else 0):
        used = np.zeros(len(names))
        for r in counts.where(~end & (F.col("n") > 0)).select("word").mapInArrow(
                _expected(spark.sparkContext.broadcast(lattice)), "piece long, used double").groupBy("piece").agg(F.sum("used").alias("used")).collect():
            used[r.piece] = r.used  # one row per piece of the vocabulary
        lattice = lattice.weighed((used + 50.0 * p) / (used.sum() + 50.0))
    columns = ["n", *each]
    known = stored(counts.where(~end).select("h", "word", *columns).mapInArrow(
        _valued(spark.sparkContext.broadcast(lattice)), "h long, " + ", ".join(f"{c} long" for c in columns) + ", lattice double"))
    seen = known.where("n > 0")
    level = F.floor(F.log2("n") * 8)
    least, so_far = 0, 0
    for r in seen.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():  # at most some hundred levels
        if so_far + r["count"] > head:
            least = r.level + 1
            break
        so_far += r["count"]
    top = seen.where(level >= least).select("h", *each, "lattice").toPandas().drop_duplicates("h").sort_values("h")  # at most `head` rows
    return known, Model(levels[0], levels[1:], top["h"].to_numpy(np.int64), top[each].to_numpy(np.int64), top["lattice"].to_numpy(float))


def _fields(k: int) -> list[str]:
    return ["row", "doc_id", "n_tokens", "n_known", "base", *[f"s{i}" for i in range(k)], "h", "n"]


def _scored(shared):
    """A row of sums over its head words for each text, and a row for each other word that it has."""
    def run(batches):
        model = shared.value
        k = len(model.classes)
        row = TaskContext.get().partitionId() << 40
        base, score, end = model.base(model.counts.sum(axis=1)), model.scores(model.counts, model.lattice), model.end()
        for batch in pieces(batches, "text"):
            n = len(batch)
            w = words(batch, "text")
            keys, back = np.unique(w.hashes(), return_inverse=True)
            signed = keys.view(np.int64)
            at, known = np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
            if len(model.head):
                at = np.minimum(np.searchsorted(model.head, signed), len(model.head) - 1)
                known = model.head[at] == signed
            is_head = known[back]
            here, which = w.row[is_head], at[back[is_head]]
            none = pa.nulls(n, pa.int64())
            yield pa.RecordBatch.from_arrays([
                pa.array(row + np.arange(n)), batch.column(0), pa.array(w.counts() + 1),
                pa.array(np.bincount(here, minlength=n) + (1 if model.all.ends else 0)),
                pa.array(np.bincount(here, base[which], minlength=n) + float(model.base(model.all.ends))),
                *[pa.array(np.bincount(here, score[which, i], minlength=n) + end[i]) for i in range(k)], none, none], _fields(k))
            rare = np.flatnonzero(~is_head)
            if len(rare):
                order = rare[np.lexsort((back[rare], w.row[rare]))]
                first = np.flatnonzero(np.concatenate([[True], (back[order][1:] != back[order][:-1]) | (w.row[order][1:] != w.row[order][:-1])]))
                pick, m = order[first], len(first)
                yield pa.RecordBatch.from_arrays([
                    pa.array(row + w.row[pick]), *[pa.nulls(m, pa.int64())] * 3, *[pa.nulls(m, pa.float64())] * (k + 1),
                    pa.array(signed[back[pick]]), pa.array(np.diff(np.append(first, len(order))))], _fields(k))
            row += n
    return run


def scored(docs: DataFrame, learn: Column, classes: str | None = "lang", path: str = VOCABULARY, head: int = HEAD,
           doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of every row, learned where `learn` holds.

    score is log10 of the model's probability of the text, base_score that of single words with
    0.1 added to every count. `classes` names a column of the training rows, or none; a null
    there is a class like others. Null, empty and blank texts are one end token. Repeated rows
    and null ids are rows like others. Without a training row every word is unseen and only the
    lattice is left; the end is then certain. An empty table gives no rows; other columns aren't
    read. Texts and words of any length are read whole. Counts are of all training texts.
    """
    shipped(docs.sparkSession)
    kind = F.coalesce(F.col(classes).cast("string"), F.lit("")) if classes else F.lit("")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"),
                       F.coalesce(learn, F.lit(False)).alias("learn"), kind.alias("kind"))
    names = [r.kind for r in rows.where("learn").groupBy("kind").count().orderBy(F.desc("count"), "kind").limit(CLASSES + 1).collect()]
    names = names[:CLASSES] if len(names) > CLASSES else names
    z = F.lit(0)
    if names:
        z = F.coalesce(F.create_map(*[F.lit(x) for i, name in enumerate(names) for x in (name, i)])[F.col("kind")], F.lit(len(names)))
    known, model = train(rows.select("text", F.when(F.col("learn"), z).otherwise(0).cast("int").alias("z"), "learn"), path, head)
    k = len(model.classes)
    shared = rows.sparkSession.sparkContext.broadcast(model)
    types = ["long"] * 4 + ["double"] * (k + 1) + ["long", "long"]
    parts = stored(rows.select("doc_id", "text").mapInArrow(_scored(shared), ", ".join(f"{a} {b}" for a, b in zip(_fields(k), types))))

    def seen(c: str, level: Level) -> Column:
        return F.greatest(F.coalesce(F.col(c), F.lit(0)) - F.lit(level.discount), F.lit(0.0)) / F.lit(float(max(1, level.total)))

    def log_sum(seen_: Column, freed: float, log_back: Column) -> Column:
        back = F.lit(float(np.log(max(freed, 1e-300)))) + log_back
        top = F.greatest(F.log(seen_), back)  # the log of 0 is null, which greatest passes over
        return F.when(seen_ > 0, top + F.log(F.exp(F.log(seen_) - top) + F.exp(back - top))).otherwise(back)

    each = [f"c{i}" for i in range(k)]
    of_word = known.groupBy("h").agg(*[F.sum(c).alias(c) for c in ("n", *each)], F.max("lattice").alias("lattice"))
    rare = parts.where("h is not null").select("row", "h", F.col("n").alias("times")).join(of_word, "h")
    rare = rare.withColumn("back", log_sum(seen("n", model.all), model.all.freed, F.col("lattice")))
    c = F.coalesce(F.col("n"), F.lit(0))
    rare = rare.select(
        "row", F.lit(None).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("n_tokens"), F.when(c > 0, F.col("times")).otherwise(0).alias("n_known"),
        (F.col("times") * F.log10((c + 0.1) / F.lit(model.all.total + 0.1 * (model.all.distinct + 1)))).alias("base"),
        *[(F.col("times") * log_sum(seen(f"c{i}", level), level.freed, F.col("back")) / F.lit(float(np.log(10)))).alias(f"s{i}")
          for i, level in enumerate(model.classes)])
    own = parts.where("h is null").select(*rare.columns)
    sums = own.unionByName(rare).groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), *[F.sum(x).alias(x) for x in ("n_tokens", "n_known", "base", *[f"s{i}" for i in range(k)])])
    top = F.greatest(*[F.col(f"s{i}") for i in range(k)], F.lit(float("-inf")))
    share = sum((F.pow(F.lit(10.0), F.col(f"s{i}") - top) for i in range(k)), F.lit(0.0))
    return sums.select("doc_id", "n_tokens", "n_known", F.lit(model.all.total).cast("long").alias("train_tokens"),
                       F.col("base").alias("base_score"), (top + F.log10(share)).alias("score"))
