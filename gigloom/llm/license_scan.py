"""License scans: winnowed fingerprints of templates pick candidates, banded alignment measures them.

A template's fingerprints are the smallest of every few neighbouring hashes of its GRAM-word
runs (winnowing), in an inverted index from hash to template and place. A text's runs look the
index up; hits of one template on about the same diagonal (place in the text less place in the
template) are one candidate. The template is then aligned, word by word, with the text around
that diagonal, within a band; the share of its words that match is the coverage. Candidates that
cover too little alone are chained: parts of BAND words or more that follow each other in text and
template, whatever stands between them, count together. A match must hold the words that tell its
license from the neighbours' (a version, "Lesser", a third clause), and of matches that share
their words only the largest counts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gigloom.llm.license_texts import REQUIRED, TEMPLATES
from gigloom.llm.store import shipped
from gigloom.llm.words import mix, pieces, words

GRAM = 3  # words of a fingerprinted run
WINDOW = 4  # neighbouring runs of which the smallest is kept
BAND = 8  # words that the text may be ahead of or behind the template
COVERAGE = 0.8
CLOSE = 0.6  # share of the words of a required phrase that must stand in their places; all, if it has up to SHORT
SHORT = 6
MATCH, MISMATCH, GAP = 2, -1, -1
_ALNUM = np.array([chr(b).isalnum() if b < 128 else True for b in range(256)])
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _runs(hashes: np.ndarray) -> np.ndarray:
    """A hash of every GRAM neighbouring words."""
    n = len(hashes) - GRAM + 1
    out = np.zeros(max(0, n), np.uint64)
    for k in range(GRAM):
        out = mix(out * _STEP + hashes[k:k + len(out)])
    return out


def winnowed(runs: np.ndarray, window: int) -> np.ndarray:
    """Places of the smallest hash of every `window` neighbours, the last one of equals."""
    n = len(runs)
    if n <= window:
        return np.array([n - 1 - int(np.argmin(runs[::-1]))]) if n else np.zeros(0, np.int64)
    return np.unique([i + window - 1 - int(np.argmin(runs[i:i + window][::-1])) for i in range(n - window + 1)])


@dataclass
class Index:
    names: list[str]
    words: list[np.ndarray]  # word hashes of each template
    hashes: np.ndarray  # of fingerprints, sorted
    template: np.ndarray
    place: np.ndarray
    required: list[list[np.ndarray]]  # word hashes of each phrase that a match of the template must hold

    @classmethod
    def of(cls, templates: dict[str, str], required: dict[str, tuple[str, ...]]) -> Index:
        names = sorted(templates)
        found, own = [], _hashed([templates[n] for n in names])
        for t, h in enumerate(own):
            runs = _runs(h)
            found += [(int(runs[i]), t, int(i)) for i in winnowed(runs, max(1, min(WINDOW, len(runs) // 3)))]
        found.sort()
        return cls(names, own, np.array([f[0] for f in found], np.uint64), np.array([f[1] for f in found], np.int64),
                   np.array([f[2] for f in found], np.int64), [_hashed(list(required.get(n, ()))) for n in names])


def _hashed(texts: list[str]) -> list[np.ndarray]:
    """Word hashes of each text."""
    w = words(pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"]), "text", _ALNUM)
    cut, hashes = w.firsts(), w.hashes()
    return [hashes[cut[t]:cut[t + 1]] for t in range(len(texts))]


def holds(text: np.ndarray, phrases: list[np.ndarray]) -> bool:
    """Whether each phrase stands in the text: word by word if it is short, else CLOSE of its words in their places."""
    for phrase in phrases:
        n, k = len(text) - len(phrase) + 1, len(phrase)
        if n <= 0:
            return False
        same = np.zeros(n, np.int64)
        for i, word in enumerate(phrase):
            same += text[i:i + n] == word
        if same.max() < (k if k <= SHORT else CLOSE * k):
            return False
    return True


def largest(found: list[tuple[int, int, int, list[tuple[int, int]]]], names: list[str], size: int) -> list:
    """Of (template, words matched, words of the template, spans of words) those that no larger one has most of the words of.

    The one with more matched words counts, of equals the one with more coverage, then the first by name and place.
    """
    taken, out = np.zeros(size, bool), []
    for x in sorted(found, key=lambda x: (-x[1], -x[1] / x[2], names[x[0]], x[3])):
        if 2 * sum(int(taken[a:b + 1].sum()) for a, b in x[3]) <= x[1]:
            out.append(x)
            for a, b in x[3]:
                taken[a:b + 1] = True
    return out


def aligned(template: np.ndarray, text: np.ndarray, shift: int, band: int) -> tuple[int, int, int]:
    """(matches, first and last matched place in the text) of the best alignment of a template with a text.

    Template word j may meet text words shift + j - band to shift + j + band.
    """
    return segment(template, text, shift, band)[:3]


def segment(template: np.ndarray, text: np.ndarray, shift: int, band: int) -> tuple[int, int, int, int, int]:
    """What `aligned` returns, and the first and last matched place in the template."""
    none = (0, 0, -1, -1, -1, -1)
    best, m, n = none, len(template), len(text)
    rows: dict[int, tuple] = {}  # text place -> (score, matches, first, last, first and last in the template) with the words so far
    for j in range(m):
        new: dict[int, tuple] = {}
        for i in range(max(0, shift + j - band), min(n, shift + j + band + 1)):
            before = rows.get(i - 1, none)
            if template[j] == text[i]:
                cell = (before[0] + MATCH, before[1] + 1, before[2] if before[2] >= 0 else i, i, before[4] if before[4] >= 0 else j, j)
            else:
                cell = max((before[0] + MISMATCH, *before[1:]), _worse(rows.get(i)), _worse(new.get(i - 1)), key=lambda c: c[:2])
            if cell[0] > 0:
                new[i] = cell
                best = max(best, cell, key=lambda c: c[:2])
        for i, cell in rows.items():  # a template word that the text lacks
            if i not in new and cell[0] + GAP > 0:
                new[i] = (cell[0] + GAP, *cell[1:])
        rows = new
    return best[1:]


def chained(parts: list[tuple[int, int, int, int, int]], size: int, least: float) -> list[tuple[int, list[tuple[int, int]]]]:
    """(matches, first and last place in the text of each part) of chains of parts that match `least` words of a template of `size` or more.

    Parts are (matches, first, last, first and last in the template). Words where two of a chain
    overlap are taken off. Of equal chains the one whose parts are nearest counts.
    """
    parts, out = sorted(set(parts), key=lambda x: x[1]), []
    while len(parts) > 1:
        total, end = np.zeros(size, np.int64), np.full(size, -1)  # of the best chain that ends at each template place
        owner, chain = np.full(size, -1), []
        for k, (n, a, b, p, q) in enumerate(parts):
            gain = total[:q] - np.maximum(np.maximum(np.arange(q) - p, end[:q] - a) + 1, 0)
            gain[(owner[:q] < 0) | (end[:q] >= b)] = 0
            i = q - 1 - int(np.argmax(gain[::-1])) if q else 0
            ahead = q > 0 and gain[i] > 0
            chain.append((n + int(gain[i]) if ahead else n, int(owner[i]) if ahead else -1))
            if chain[k][0] >= total[q]:
                total[q], end[q], owner[q] = chain[k][0], b, k
        k = max(range(len(parts)), key=lambda x: chain[x][0])
        n, used = chain[k][0], []
        if n < least:
            break
        while k >= 0:
            used.append(k)
            k = chain[k][1]
        out.append((n, [parts[i][1:3] for i in reversed(used)]))
        parts = [x for i, x in enumerate(parts) if i not in used]
    return out


def _worse(cell: tuple | None) -> tuple:
    return (cell[0] + GAP, *cell[1:]) if cell else (0, 0, -1, -1)


def _candidates(index: Index, row: np.ndarray, hashes: np.ndarray, first: np.ndarray):
    """(row, template, lowest and highest diagonal) of hits that belong together."""
    runs = _runs(hashes)
    whole = row[:len(runs)] == row[GRAM - 1:] if len(runs) else np.zeros(0, bool)
    low = np.searchsorted(index.hashes, runs, "left")
    hit = np.flatnonzero(whole & (index.hashes[np.minimum(low, len(index.hashes) - 1)] == runs)) if len(index.hashes) else np.zeros(0, np.int64)
    high = np.searchsorted(index.hashes, runs[hit], "right")
    times = high - low[hit]
    at = np.repeat(hit, times)
    entry = np.repeat(low[hit], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    diagonal = at - first[row[at]] - index.place[entry]
    found = sorted(zip(row[at].tolist(), index.template[entry].tolist(), diagonal.tolist()))
    k = 0
    while k < len(found):
        j, (r, t, d) = k + 1, found[k]
        band = _band(len(index.words[t]))
        while j < len(found) and found[j][:2] == (r, t) and found[j][2] - found[j - 1][2] <= band and found[j][2] - d <= 2 * band:
            j += 1
        yield r, t, d, found[j - 1][2]
        k = j


def _band(size: int) -> int:
    return max(1, min(BAND, size // 4))


def _scan(index: Index, coverage: float):
    def run(batches):
        for batch in pieces(batches, "text"):
            w = words(batch, "text", _ALNUM)
            hashes, first, chars = w.hashes(), w.firsts(), w.chars()
            found, parts, possible = {}, {}, {}

            def add(r, t, n, spans):
                if holds(hashes[first[r]:first[r + 1]][spans[0][0]:spans[-1][1] + 1], index.required[t]):
                    found.setdefault(r, []).append((t, n, len(index.words[t]), spans))
            for r, t, low, high in _candidates(index, w.row, hashes, first):
                own = hashes[first[r]:first[r + 1]]
                if (r, t) not in possible:
                    possible[r, t] = holds(own, index.required[t])
                if not possible[r, t]:
                    continue
                template = index.words[t]
                start = max(0, low - BAND)
                n, a, b, p, q = segment(template, own[start:high + len(template) + BAND], (low + high) // 2 - start, _band(len(template)) + (high - low + 1) // 2)
                if n >= coverage * len(template):
                    add(r, t, n, [(int(start + a), int(start + b))])
                elif n >= BAND:
                    parts.setdefault((r, t), []).append((n, int(start + a), int(start + b), p, q))
            for (r, t), some in parts.items():
                for n, spans in chained(some, len(index.words[t]), coverage * len(index.words[t])):
                    add(r, t, n, spans)
            rows = []
            for r, some in found.items():
                base = chars[w.at[r]]
                rows += [(r, t, int(chars[w.start[first[r] + spans[0][0]]] - base), int(chars[w.end[first[r] + spans[-1][1]]] - base), n)
                         for t, n, _, spans in largest(some, index.names, int(first[r + 1] - first[r]))]
            rows.sort()
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array([x[0] for x in rows], pa.int64())), pa.array([index.names[x[1]] for x in rows], pa.string()),
                pa.array([x[2] for x in rows], pa.int64()), pa.array([x[3] for x in rows], pa.int64()), pa.array([x[4] for x in rows], pa.int64()),
                pa.array([len(index.words[x[1]]) for x in rows], pa.int64())], ["doc_id", "license", "start", "end", "matched", "template_words"])
    return run


def licenses(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE,
             doc_id: str = "doc_id", text: str = "text", required: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """doc_id, license, start, end, matched, template_words, coverage: a row for every license found in a text.

    start and end are code point offsets of the first and last matched word; coverage is the
    share of the template's words that match in order. Words are runs of letters and digits,
    A-Z as a-z. Null, empty and blank texts have no license; null ids are returned as null;
    repeated rows are rows each; a license that stands in a text several times has a row for
    each place. Of templates that match the same words the one that matches most is reported. A match
    must hold each phrase that `required` names for its template. Empty tables give no rows; other columns are not read. Whole texts are scanned, row by row, without a
    shuffle; the index has the size of the templates. A template of fewer than GRAM words is
    never found. Words inserted into a notice don't hide it, however many, where the template's
    words between insertions are BAND or more.
    """
    shipped(docs.sparkSession)
    index = Index.of(TEMPLATES if templates is None else templates, REQUIRED if required is None and templates is None else required or {})
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    found = rows.mapInArrow(_scan(index, coverage), "doc_id long, license string, start long, end long, matched long, template_words long")
    return found.withColumn("coverage", F.col("matched") / F.col("template_words"))
