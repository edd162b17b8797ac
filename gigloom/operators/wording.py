"""Closest label by wording: a weighted blend of whole, partial and token similarity.

Similarity of two texts is 200 * LCS / (total length). The blend is the published one of
weighted-ratio matchers: whole and token similarity for texts of like length, partial
similarity (scaled down) where one is much longer.
"""

import math
import sys
from collections import Counter

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def common(a: str, b: str) -> int:
    """Length of the longest common subsequence, one big-integer step per character."""
    where = {}
    for i, ch in enumerate(a):
        where[ch] = where.get(ch, 0) | 1 << i
    full = (1 << len(a)) - 1
    open_ = full
    for ch in b:
        hit = open_ & where.get(ch, 0)
        open_ = (open_ + hit) | (open_ - hit)
    return len(a) - (open_ & full).bit_count()


def alike(a: str, b: str) -> float:
    total = len(a) + len(b)
    return 200.0 * common(a, b) / total if total else 100.0


def partial(a: str, b: str, floor: float = 0.0) -> float:
    """Best similarity of the shorter text with any stretch of the longer one.

    Texts that share too few characters to exceed `floor` are not compared further.
    """
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return 100.0 if not b else 0.0
    n = len(a)
    shared = sum((Counter(a) & Counter(b)).values())
    if 200.0 * shared / (n + shared) <= floor:
        return 0.0
    best = max(alike(a, b[max(i, 0):i + n]) for i in range(1 - n, len(b)))
    if len(b) == n and best < 100:
        best = max(best, max(alike(b, a[max(i, 0):i + n]) for i in range(1 - n, n)))
    return best


def tokens(a: str, b: str) -> float:
    """Whole similarity of sorted words, or of what the word sets share and do not share."""
    wa, wb = sorted(a.split()), sorted(b.split())
    sorted_score = alike(" ".join(wa), " ".join(wb))
    sa, sb = set(wa), set(wb)
    if not sa or not sb:
        return sorted_score
    both, ab, ba = " ".join(sorted(sa & sb)), " ".join(sorted(sa - sb)), " ".join(sorted(sb - sa))
    if both and not (ab and ba):
        return 100.0
    gap = 1 if both else 0
    la, lb = len(both) + gap + len(ab), len(both) + gap + len(ba)
    scores = [sorted_score, 100.0 - 100.0 * (len(ab) + len(ba) - 2 * common(ab, ba)) / (la + lb)]
    if both:
        scores += [100.0 - 100.0 * (gap + len(x)) / (len(both) + n) for x, n in ((ab, la), (ba, lb))]
    return max(scores)


def partial_tokens(a: str, b: str, floor: float = 0.0) -> float:
    wa, wb = sorted(a.split()), sorted(b.split())
    sa, sb = set(wa), set(wb)
    if sa & sb:
        return 100.0
    score = partial(" ".join(wa), " ".join(wb), floor)
    if len(sa) != len(wa) or len(sb) != len(wb):
        score = max(score, partial(" ".join(sorted(sa)), " ".join(sorted(sb)), floor))
    return score


def weighted(a: str, b: str, floor: float = 0.0) -> float:
    """The blended score; when it cannot exceed `floor`, some score that does not."""
    if not a or not b:
        return 0.0
    stretch = max(len(a), len(b)) / min(len(a), len(b))
    if stretch < 1.5:
        return max(alike(a, b), 0.95 * tokens(a, b))
    scale = 0.9 if stretch <= 8 else 0.6
    if 100 * scale <= floor:
        return min(alike(a, b), floor)
    return max(alike(a, b), scale * partial(a, b, floor / scale), 0.95 * scale * partial_tokens(a, b, floor / scale / 0.95))


class Labels:
    """A list of labels with what rules most of them out for a text before they are scored.

    Without a shared word a score is at most what the characters that both have allow, whatever their order: 200 * shared /
    (sum of the lengths) where whole texts are compared, 200 * shared / (shorter length + shared) where the shorter one meets a
    stretch of the longer. Both hold for the texts as they are, with sorted words and with distinct words. An index by word gives
    the labels that share one; of these, texts of like length are also compared by their shared words alone.
    """

    def __init__(self, labels, threshold: float):
        self.labels, self.threshold = list(labels), threshold
        self.at = {ch: i for i, ch in enumerate(sorted({ch for label in self.labels for ch in label}))}
        self.by_word = {}
        for i, label in enumerate(self.labels):
            for w in set(label.split()):
                self.by_word.setdefault(w, []).append(i)
        forms = [self.forms(label) for label in self.labels]
        self.counts = [np.array([f[k][0] for f in forms], np.int64).reshape(len(forms), len(self.at)) for k in range(3)]
        self.lengths = [np.array([f[k][1] for f in forms], np.int64) for k in range(3)]

    def forms(self, text: str):
        """(characters that labels have, length) of a text as it is, with single spaces, and with distinct words."""
        words = text.split()
        out = []
        for form in (text, " ".join(words), " ".join(set(words))):
            count = [0] * len(self.at)
            for ch in form:
                if ch in self.at:
                    count[self.at[ch]] += 1
            out.append((count, len(form)))
        return out

    def near(self, text: str) -> list[int]:
        """Places of the labels that can reach the threshold."""
        if not text or not self.labels:
            return []
        whole = self.lengths[0]
        stretch = np.maximum(whole, len(text)) / np.maximum(np.minimum(whole, len(text)), 1)
        scale = np.where(stretch < 1.5, 0.0, np.where(stretch <= 8, 0.9, 0.6))
        bound = np.zeros(len(self.labels))
        for (count, length), counts, lengths in zip(self.forms(text), self.counts, self.lengths):
            shared = np.minimum(counts, np.array(count, np.int64)).sum(axis=1)
            shorter = np.minimum(lengths, length)
            bound = np.maximum(bound, 200.0 * shared / np.maximum(lengths + length, 1))
            bound = np.maximum(bound, scale * 200.0 * shared / np.maximum(shorter + shared, 1))
        able = set(np.flatnonzero(bound >= self.threshold - 1e-6).tolist())
        words = set(text.split())
        for i in {i for w in words for i in self.by_word.get(w, ())} - able:
            if stretch[i] < 1.5:  # the shared words against either side's distinct words
                own = set(self.labels[i].split())
                both = len(" ".join(words & own))
                rest = min(len(" ".join(words)), self.lengths[2][i])
                if words <= own or own <= words or 190.0 * both / (both + rest) >= self.threshold - 1e-6:
                    able.add(i)
            elif stretch[i] <= 8:
                able.add(i)
        return sorted(able)

    def best(self, text: str) -> str | None:
        """First of the labels with the highest score, or None below the threshold."""
        best, top = None, math.nextafter(self.threshold, 0)
        for i in self.near(text):
            score = weighted(text, self.labels[i], top)
            if score > top:
                best, top = self.labels[i], score
        return best


def best_of(text: str, labels, threshold: float):
    """First of the labels with the highest score, or None below the threshold; every label is scored."""
    best, top = None, math.nextafter(threshold, 0)
    for label in labels:
        score = weighted(text, label, top)
        if score > top:
            best, top = label, score
    return best


def closest_wording(c, labels, threshold: float = 85.0):
    """Best label of a short fixed list per text; each distinct text of a batch is scored once, with the labels that can win."""
    held = Labels(labels, threshold)

    @F.pandas_udf("string")
    def best(texts: pd.Series) -> pd.Series:
        found = {t: held.best(t) for t in texts.dropna().unique()}
        return pd.Series([found.get(t) for t in texts], dtype=object)

    return best(F.col(c) if isinstance(c, str) else c)
