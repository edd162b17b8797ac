"""Cross-tokenizer alignment: which tokens of two tokenizers overlap, and how usual each pair of ids is in the corpus.

Pairs are counted outside memory. A task turns its texts' links into records (pair, text, links), sorted side-major (by B's id,
then A's) in runs of a bounded number of links; a run is dealt over PARTS radix parts of B's id and written as small zstd
chunks that tell their first pair. Runs of one part meet in groups of FAN: a heap of the open chunks, by their last pair, opens
the next chunks as the merge reaches them, so a task holds one chunk for each run. One merge counts each pair; summed over
the groups, pairs in side-major order give each B id's highest count. A second merge has these totals as one more run and
streams every record's contribution back to its text.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gigloom.llm.store import shipped, stored
from gigloom.llm.tokens import SHORT, Tokenizer, public
from gigloom.llm.words import pieces

PARTS = 16  # radix parts of B's ids
RUN = 1_000_000  # links of a run, but for a last text's
RUN_TEXTS = 1 << 16  # texts of a run
CHUNK = 8192  # records of a zstd chunk
FAN = 128  # runs merged together
HELD, HELD_BYTES = 400_000, 1 << 24  # stretches of text, and bytes of them, whose tokens are remembered
LEARNED = 8192  # stretches that are aligned at a time

# fixed value: how byte-level vocabularies of this kind cut a text before merging
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# every stretch but a text's first begins with a space after something else than white space: no token of either side spans
# such a place, so stretches are encoded and aligned apart
_BREAK = re.compile(r" (?<=\S )")


def byte_alphabet() -> dict[str, int]:
    """The bytes that the characters of a byte-level vocabulary stand for: printable ones for themselves, others from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def byte_ranks(a: Tokenizer) -> dict[bytes, int]:
    """The ids of a byte-level vocabulary by their bytes, without special tokens. Its merges are in the order of the ids they give."""
    alphabet, held = byte_alphabet(), json.loads(a.data)
    special = {x["content"] for x in held["added_tokens"]}
    return {bytes(alphabet[c] for c in t): i for t, i in held["model"]["vocab"].items() if t not in special}


class Column:
    """Rows of numbers that are added to; the space at least doubles."""

    def __init__(self, *shape: int):
        self.held, self.n = np.zeros((1024, *shape), np.int64), 0

    def add(self, rows: np.ndarray) -> None:
        if self.n + len(rows) > len(self.held):
            more = np.zeros((max(2 * len(self.held), self.n + len(rows)), *self.held.shape[1:]), np.int64)
            more[:self.n] = self.held[:self.n]
            self.held = more
        self.held[self.n:self.n + len(rows)] = rows
        self.n += len(rows)


class Aligner:
    """Tokens and links of texts, by stretches; they are remembered, those of over SHORT code points for one call, and forgotten
    all at once when there are many."""

    def __init__(self, a: Tokenizer, b: Tokenizer):
        import tiktoken
        ranks = byte_ranks(a)
        self.a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = b.load()
        self.bytes_a, self.bytes_b = _table(dict(zip(ranks.values(), ranks))), _table(dict(enumerate(map(self._piece, range(self.b.get_piece_size())))))
        self.len_a, self.len_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        self.width = len(self.bytes_a)
        ids = range(max(self.width, len(self.bytes_b)))
        self.said = [np.array([f"{i}{mark}" for i in ids], object) for mark in ",|;"]
        self.forget()

    def _piece(self, i: int) -> bytes:
        if self.b.is_byte(i):
            return bytes([int(self.b.id_to_piece(i)[3:5], 16)])
        return self.b.id_to_piece(i).replace("▁", " ").encode()

    def forget(self) -> None:
        """Start anew. `known` has each stretch's place in `groups` (as written), `counts` and `upto` (the end of its links)."""
        self.known, self.groups, self.size = {}, [], 0
        self.counts, self.links, self.upto = Column(4), Column(), Column()

    def learn(self, stretches: list[str]) -> None:
        """Remember new stretches (each stands for a space and itself)."""
        alone = [s for s in stretches if not s or s[-1].isspace()]
        plain = [s for s in stretches if s and not s[-1].isspace()]  # in a row they are a text whose breaks are these
        for some in [*([s] for s in alone), *(plain[i:i + LEARNED] for i in range(0, len(plain), LEARNED))]:
            self._learn(some)

    def _learn(self, stretches: list[str]) -> None:
        if not stretches:
            return
        text = " " + " ".join(stretches)
        a = self.a.encode_ordinary(text)
        b = self.b.encode(text[1:], num_threads=1) if len(text) > 1 else [self.b.piece_to_id("▁")]
        raw, first = text.encode(), len(self.groups)
        if b"".join([self.bytes_a[i] for i in a]) != raw or b"".join([self.bytes_b[i] for i in b]) != raw:
            if len(stretches) > 1:
                self._learn(stretches[:len(stretches) // 2])
                self._learn(stretches[len(stretches) // 2:])
                return
            self.known[stretches[0]] = first
            self.groups.append(None)
            self.counts.add(np.zeros((1, 4), np.int64))
            self.upto.add(np.array([self.links.n]))
            return
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        end_a, end_b = np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b])
        ends = np.union1d(end_a, end_b)  # two tokens overlap in one stretch between neighbouring ends
        both = np.intersect1d(end_a, end_b, assume_unique=True)
        upto_a, upto_b = np.searchsorted(end_a, both, "right"), np.searchsorted(end_b, both, "right")
        # in writing, a group's B tokens come after its A tokens
        written = np.empty(len(a) + len(b), object)
        at_a = np.arange(len(a)) + np.concatenate([[0], upto_b])[np.searchsorted(both, end_a)]
        at_b = np.arange(len(b)) + upto_a[np.searchsorted(both, end_b)]
        comma, bar, semicolon = self.said
        written[at_a], written[at_b] = comma[a], comma[b]
        written[at_a[upto_a - 1]], written[at_b[upto_b - 1]] = bar[a[upto_a - 1]], semicolon[b[upto_b - 1]]
        written = written.tolist()
        cuts = np.cumsum([len(s.encode()) + 1 for s in stretches])
        spans = np.stack([np.searchsorted(x, cuts, "right") for x in (end_a, end_b, both, ends)], axis=1)
        places = np.concatenate([[0], spans[:, 0] + spans[:, 1]]).tolist()
        self.groups.extend("".join(written[i:j]) for i, j in zip(places, places[1:]))
        self.counts.add(np.diff(spans, axis=0, prepend=0))
        self.upto.add(spans[:, 3] + self.links.n)
        self.links.add(b[np.searchsorted(end_b, ends)] * self.width + a[np.searchsorted(end_a, ends)])
        self.known.update(zip(stretches, range(first, first + len(stretches))))
        self.size += len(raw)

    def texts(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
        """For each text (n_a, n_b, n_groups, n_links) and the digest of its groups; of all links, the text and the pair."""
        split = [_BREAK.split(t) if t else [] for t in texts]
        if len(self.groups) > HELD or self.size > HELD_BYTES:
            self.forget()
        known, groups = self.known, self.groups
        new = list({s for stretches in split for s in stretches if s not in known})
        self.learn(new)
        used, digests = [[known[s] for s in stretches] for stretches in split], []
        for i, ids in enumerate(used):
            told = [groups[x] for x in ids]
            if None in told:
                used[i] = told = []
            digests.append(hashlib.sha256("".join(told)[:-1].encode()).hexdigest() if told else "")
        for s in new:
            if len(s) > SHORT:
                del known[s]
        flat = np.array([x for ids in used for x in ids], np.int64)
        text = np.repeat(np.arange(len(texts)), [len(ids) for ids in used])
        own = self.counts.held[flat]
        counts = np.zeros((len(texts), 4), np.int64)
        np.add.at(counts, text, own)
        n = own[:, 3]
        at = np.arange(n.sum()) + np.repeat(self.upto.held[flat] - np.cumsum(n), n)
        return counts, digests, np.repeat(text, n), self.links.held[at]


def _table(found: dict[int, bytes]) -> list[bytes]:
    return [found.get(i, b"") for i in range(max(found, default=-1) + 1)]


_aligners: dict[tuple[int, int], Aligner] = {}
_packer, _unpacker = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()

_FIELDS = [("doc", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
           ("groups_sha256", pa.string()), ("part", pa.int32()), ("run", pa.int64()), ("first", pa.int64()), ("opens", pa.int32()), ("chunk", pa.binary())]
_SCHEMA = ", ".join(f"{n} {({'int64': 'long', 'int32': 'int'}).get(str(t), str(t))}" for n, t in _FIELDS)


def _rows(**columns) -> pa.RecordBatch:
    """Rows with these columns; the rest are null."""
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([pa.array(columns[c], t) if c in columns else pa.nulls(n, t) for c, t in _FIELDS], [c for c, _ in _FIELDS])


def packed(*columns: np.ndarray) -> bytes:
    """One zstd frame: the number of records, then sorted pairs as steps, then the other columns."""
    pairs = np.diff(columns[0], prepend=0)
    return _packer.compress(b"".join([np.array([len(pairs)], np.int64).tobytes(), pairs.tobytes(), *[x.tobytes() for x in columns[1:]]]))


def unpacked(chunk: bytes, *kinds: type) -> list[np.ndarray]:
    raw = _unpacker.decompress(chunk)
    n, at = int(np.frombuffer(raw, np.int64, 1)[0]), 8
    out = [np.cumsum(np.frombuffer(raw, np.int64, n, at))]
    at += 8 * n
    for kind in kinds:
        out.append(np.frombuffer(raw, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return out


def _run(run: int, links: list[np.ndarray], texts: list[np.ndarray], width: int, n_parts: int, size: int) -> Iterator[pa.RecordBatch]:
    """A run's chunks, part by part: records (pair, text of the run, links), sorted by pair, then text."""
    pair, text = np.concatenate(links), np.concatenate(texts).astype(np.uint16)
    order = np.argsort(pair, kind="stable")
    pair, text = pair[order], text[order]
    new = np.flatnonzero(np.concatenate([[True], (pair[1:] != pair[:-1]) | (text[1:] != text[:-1])]))
    n = np.diff(np.append(new, len(pair))).astype(np.uint32)
    pair, text = pair[new], text[new]
    radix, opens = pair // width % n_parts, 1
    for part in range(n_parts):
        mine = np.flatnonzero(radix == part)
        cuts = [mine[i:i + size] for i in range(0, len(mine), size)]
        if cuts:
            yield _rows(part=[part] * len(cuts), run=[run] * len(cuts), first=[int(pair[c[0]]) for c in cuts],
                        opens=[opens] + [0] * (len(cuts) - 1), chunk=[packed(pair[c], text[c], n[c]) for c in cuts])
            opens = 0


def _linked(a: Tokenizer, b: Tokenizer):
    """Each text's counts and digest, and the runs of the task's links. A run's number is its first text's."""
    most, form = RUN, (PARTS, CHUNK)

    def run(batches):
        key = (hash(a.data), hash(b.data))
        if key not in _aligners:
            _aligners[key] = Aligner(a, b)
        aligner = _aligners[key]
        doc = base = TaskContext.get().partitionId() << 32
        links, texts, held = [], [], 0
        for batch in (b.slice(i, LEARNED) for b in pieces(batches, "text") for i in range(0, b.num_rows, LEARNED)):
            rows = [t or "" for t in batch.column("text").to_pylist()]
            counts, digests, text, pair = aligner.texts(rows)
            yield _rows(doc=np.arange(doc, doc + len(rows)), doc_id=batch.column("doc_id"), n_a=counts[:, 0], n_b=counts[:, 1],
                        n_groups=counts[:, 2], n_links=counts[:, 3], groups_sha256=digests)
            links.append(pair)
            texts.append(text + (doc - base))
            doc, held = doc + len(rows), held + len(pair)
            if held >= most or doc - base > RUN_TEXTS - LEARNED:
                if held:
                    yield from _run(base, links, texts, aligner.width, *form)
                links, texts, held, base = [], [], 0, doc
        if held:
            yield from _run(base, links, texts, aligner.width, *form)
    return run


class _Open:
    """A chunk that the merge has reached, and how far it is read."""

    def __init__(self, run: int, columns: list[np.ndarray]):
        self.run, self.columns, self.at = run, columns, 0
        self.last = int(columns[0][-1])

    def __lt__(self, other: _Open) -> bool:
        return self.last < other.last

    def upto(self, pair: int) -> list[np.ndarray]:
        end = int(np.searchsorted(self.columns[0], pair, "right"))
        out, self.at = [x[self.at:end] for x in self.columns], end
        return out


def merged(chunks: Iterator[tuple[int, int, bytes]], kinds) -> Iterator[list[tuple[int, list[np.ndarray]]]]:
    """The records of sorted runs in steps, as (run, columns) parts: a step has all records of its pairs, and pairs rise from step to step.

    chunks: (first pair, run, chunk) by rising first pair; kinds(run): the types of a chunk's columns beside the pairs.
    """
    heap, ahead = [], next(chunks, None)
    while heap or ahead:
        while ahead and (not heap or ahead[0] <= heap[0].last):
            heapq.heappush(heap, _Open(ahead[1], unpacked(ahead[2], *kinds(ahead[1]))))
            ahead = next(chunks, None)
        last = heap[0].last
        step = [(c.run, got) for c in heap if len((got := c.upto(last))[0])]
        while heap and heap[0].last <= last:
            heapq.heappop(heap)
        yield step


def _grouped(batches: Iterator[pa.RecordBatch]):
    """((part, lot), chunks) of each group of rows that follow one another."""
    rows = (r for batch in batches for r in zip(*[batch.column(c) for c in ("part", "lot", "first", "run", "chunk")]))
    row = next(rows, None)
    while row:
        group = (row[0].as_py(), row[1].as_py())

        def chunks():
            nonlocal row
            while row and (row[0].as_py(), row[1].as_py()) == group:
                yield row[2].as_py(), row[3].as_py(), row[4].as_py()
                row = next(rows, None)

        yield group, chunks()


_RECORD, _TOTAL = (np.uint16, np.uint32), (np.int64, np.uint8)


def _counted(batches):
    """(part, pair, n): each pair's links in each group of runs."""
    for (part, _), chunks in _grouped(batches):
        for step in merged(chunks, lambda run: _RECORD):
            pair = np.concatenate([x[0] for _, x in step])
            order = np.argsort(pair, kind="stable")
            pair, n = pair[order], np.concatenate([x[2] for _, x in step])[order].astype(np.int64)
            at = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), part, np.int32)), pa.array(pair[at]), pa.array(np.add.reduceat(n, at))],
                                             ["part", "pair", "n"])


def _totals(width: int):
    """Chunks of (pair, links, whether no pair of the same B id has more), from pairs in side-major order."""
    def chunk(part, pair, n):
        side = pair // width
        at = np.flatnonzero(np.concatenate([[True], side[1:] != side[:-1]]))
        best = np.repeat(np.maximum.reduceat(n, at), np.diff(np.append(at, len(pair))))
        cuts = range(0, len(pair), CHUNK)
        flag = (n == best).astype(np.uint8)
        return pa.RecordBatch.from_arrays([
            pa.array([part] * len(cuts), pa.int32()), pa.array([int(pair[i]) for i in cuts], pa.int64()),
            pa.array([packed(pair[i:i + CHUNK], n[i:i + CHUNK], flag[i:i + CHUNK]) for i in cuts], pa.binary())], ["part", "first", "chunk"])

    def run(batches):
        pairs, ns, size, now = [], [], 0, None
        for batch in batches:
            parts, pair, n = (batch.column(c).to_numpy() for c in ("part", "pair", "n"))
            cuts = np.flatnonzero(np.concatenate([[True], parts[1:] != parts[:-1]])).tolist() + [len(parts)]
            for i, j in zip(cuts, cuts[1:]):
                if size and (parts[i] != now or size > 8 * CHUNK):
                    # of the same part, the last B id's pairs wait for the rest of them
                    pairs, ns = [np.concatenate(pairs)], [np.concatenate(ns)]
                    whole = int(np.searchsorted(pairs[0], pairs[0][-1] // width * width)) if parts[i] == now else size
                    if whole:
                        yield chunk(now, pairs[0][:whole], ns[0][:whole])
                    pairs, ns, size = [pairs[0][whole:]], [ns[0][whole:]], size - whole
                now, size = int(parts[i]), size + j - i
                pairs.append(pair[i:j])
                ns.append(n[i:j])
        if size:
            yield chunk(now, np.concatenate(pairs), np.concatenate(ns))
    return run


def _returned(batches):
    """(doc, n_best, count_sum): what each group of runs adds to its texts; the run -1 has the totals."""
    for _, chunks in _grouped(batches):
        best, total = {}, {}
        for step in merged(chunks, lambda run: _TOTAL if run < 0 else _RECORD):
            known = [x for run, x in step if run < 0]
            pair, links, top = (np.concatenate(x) for x in zip(*known))
            for run, (mine, text, n) in step:
                if run < 0:
                    continue
                at = np.searchsorted(pair, mine)
                size = int(text.max()) + 1
                for held, add in ((best, n * top[at].astype(np.int64)), (total, n * links[at])):
                    if run not in held or len(held[run]) < size:
                        held[run] = np.concatenate([held.get(run, np.zeros(0, np.int64)), np.zeros(size - len(held.get(run, ())), np.int64)])
                    np.add.at(held[run], text, add)
        for run, sums in total.items():
            at = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(run + at), pa.array(best[run][at]), pa.array(sums[at])], ["doc", "n_best", "count_sum"])


def aligned(docs: DataFrame, a: Tokenizer | None = None, b: Tokenizer | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row.

    a: a byte-level vocabulary, given a space and the text; b: a piece vocabulary that adds this space itself. Byte offsets
    where tokens of both end cut them into groups; links are the pairs of an A and a B token that overlap. n_best: links whose
    pair of ids is linked as often in the corpus as any of its B id; count_sum: the sum of the pair's links in the corpus over
    the row's links. groups_sha256 is the digest of `a1,a2|b1;a3|b2,b3`.

    One row for each row, repeated ones too, each counted. A text that is null, empty or whose tokens don't spell it (one with
    U+2581) has no tokens: zeros and ''. A null id stays null. Texts of any length are read whole, ties all count as best.
    Other columns are ignored, whatever their names. An empty table gives no rows.

    A task holds one run while it reads texts, and one chunk for each of FAN runs while it merges. A pair that a third of all
    texts have is split over the groups of its part.
    """
    shipped(docs.sparkSession)
    a, b = a or public("byte_bpe_50k.json"), b or public("piece_bpe_32k.model")
    width = max(byte_ranks(a).values()) + 1
    told = stored(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(_linked(a, b), _SCHEMA))
    runs = told.where("part is not null")
    lots = max(1, -(-(runs.agg(F.sum("opens")).first()[0] or 0) // FAN))
    dealt = runs.select("part", F.pmod(F.xxhash64("run"), F.lit(lots)).cast("int").alias("lot"), "first", "run", "chunk")
    order = ("part", "lot", "first", "run")
    counts = dealt.repartition("part", "lot").sortWithinPartitions(*order).mapInArrow(_counted, "part int, pair long, n long")
    pairs = stored(counts.groupBy("part", "pair").agg(F.sum("n").alias("n")))
    totals = stored(pairs.repartition("part").sortWithinPartitions("part", "pair").mapInArrow(_totals(width), "part int, first long, chunk binary"))
    spread = totals.select("part", F.explode(F.sequence(F.lit(0), F.lit(lots - 1))).alias("lot"), "first", F.lit(-1).cast("long").alias("run"), "chunk")
    back = dealt.unionByName(spread).repartition("part", "lot").sortWithinPartitions(*order).mapInArrow(
        _returned, "doc long, n_best long, count_sum long")
    sums = stored(back.groupBy("doc").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")))
    heads = told.where("part is null").select("doc", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    zero = F.lit(0).cast("long")
    return heads.join(sums, "doc", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")
