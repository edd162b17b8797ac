"""Public tokenizers in tasks.

The driver reads a vocabulary file once and its bytes go with the task, so executors need no file. A task's process keeps a
tokenizer it has loaded, and what it learned about short pieces of text, up to a fixed number of them.
"""

from __future__ import annotations

import hashlib
import os
from dataclasses import dataclass

SHORT = 48  # bytes (code points for `split`) of a piece that is remembered
HELD = 700_000  # pieces after which those not seen since are forgotten


@dataclass(frozen=True)
class Tokenizer:
    """A vocabulary file's bytes, which library reads it, and whether it drops white space."""

    kind: str
    data: bytes
    drops_space: bool = False

    @property
    def version(self) -> str:
        """A digest of all that a token count depends on: the file, the library and its release."""
        lib = __import__("tokenizers" if self.kind == "json" else "sentencepiece")
        return hashlib.sha256(f"{self.kind} {lib.__version__} {self.drops_space} ".encode() + self.data).hexdigest()

    def load(self):
        """The library's tokenizer, loaded once in each process."""
        key = (self.kind, hash(self.data))
        if key not in _loaded:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
            if self.kind == "json":
                import tokenizers
                _loaded[key] = tokenizers.Tokenizer.from_str(self.data.decode())
            else:
                import sentencepiece
                _loaded[key] = sentencepiece.SentencePieceProcessor(model_proto=self.data)
        return _loaded[key]

    def lengths(self, texts: list[str]) -> list[int]:
        """How many tokens the library gives each text, special strings handled as by default."""
        if self.kind == "json":
            return [len(e) for e in self.load().encode_batch_fast(texts, add_special_tokens=False)]
        return [len(ids) for ids in self.load().encode(texts, num_threads=1)]


_loaded: dict[tuple[str, int], object] = {}


def public(name: str, path: str | None = None) -> Tokenizer:
    """The public tokenizer `name`, read from `path` or from where the installed package has it."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path(name)
    with open(path, "rb") as f:
        return Tokenizer("json" if name.endswith(".json") else "model", f.read(), name.startswith("word_"))


class Lengths:
    """Token counts of texts by a tokenizer that drops white space, so that each word between it counts alone.

    Words of up to SHORT bytes are encoded once and remembered, those seen again longest; longer ones are encoded each time.
    """

    def __init__(self, tokenizer: Tokenizer):
        self.tokenizer, self.known, self.older = tokenizer, {}, {}

    def of(self, texts: list[str]) -> list[int]:
        if len(self.known) > HELD:
            self.known, self.older = {}, self.known
        words = [t.encode().split() for t in texts]
        known, older = self.known, self.older
        new = {w for ws in words for w in ws if w not in known}
        known.update((w, older[w]) for w in new if w in older)
        new = [w for w in new if w not in known]
        found = dict(zip(new, self.tokenizer.lengths([w.decode() for w in new])))
        known.update(found)
        counts = [sum(map(known.__getitem__, ws)) for ws in words]
        for w in new:
            if len(w) > SHORT:
                del known[w]
        return counts


_lengths: dict[int, Lengths] = {}


def lengths_of(tokenizer: Tokenizer, texts: list[str]) -> list[int]:
    """How many tokens each text has; by words where the tokenizer drops white space, else text by text."""
    if not tokenizer.drops_space:
        return tokenizer.lengths(texts)
    key = hash(tokenizer.data)
    if key not in _lengths:
        _lengths[key] = Lengths(tokenizer)
    return _lengths[key].of(texts)
