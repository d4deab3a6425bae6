"""Token ids of whole texts, by the tokenizers library, with repeated words encoded once.

The tokenizer drops white space and never joins across it, so the ids of a text are those of its
space-separated chunks in a row. A chunk is encoded by the library at its first sight and then
looked up; the tables are bounded, as invented or misspelt words never end.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache
from itertools import islice

#: Most chunks and words that a worker process remembers, and how many of them stay when there are more.
REMEMBERED, KEPT = 300_000, 100_000
#: Longer chunks are encoded each time.
LONGEST = 64

#: Letters that lower-case alike in Python and in the library, and punctuation without apostrophes.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_SIGNS = r"!-&(-/:-@\[-`{-~"
_ODD = re.compile(rf"[^{_LETTERS}{_SIGNS} ]")
_PARTS = re.compile(rf"[{_LETTERS}]+|[{_SIGNS}]+")


def _byte_symbols() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class _Table(dict):
    """What was seen, with its ids."""

    def forget(self) -> None:
        """Only what was seen first stays, which is most of what is common."""
        first = list(islice(self.items(), KEPT))
        self.clear()
        self.update(first)


class _Words(_Table):
    """Run of letters or of signs, in lower case -> its ids, by the model alone."""

    def __init__(self, model):
        super().__init__()
        self.model = model
        self.symbols = _byte_symbols()

    def __missing__(self, part: str) -> bytes:
        word = part if part.isascii() else "".join([self.symbols[b] for b in part.encode()])
        ids = array("I", [token.id for token in self.model.tokenize(word)]).tobytes()
        if len(part) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.forget()
            self[part] = ids
        return ids


class _Chunks(_Table):
    """Anything between spaces -> its ids, by the whole tokenizer."""

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer = tokenizer

    def __missing__(self, chunk: str) -> bytes:
        ids = array("I", self.tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes()
        if len(chunk) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.forget()
            self[chunk] = ids
        return ids


class TextEncoder:
    """``ids(text)``: the ids of a whole text as little-endian unsigned 32-bit integers.

    Which short cuts hold for a vocabulary is tried out when it is loaded: one that keeps white
    space, say, encodes every text whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.chunks = _Chunks(Tokenizer.from_file(path))
        self.words = _Words(self.chunks.tokenizer.model)
        whole = self.chunks.__missing__
        mixed, plain = "Two  words, that's <|endoftext|> 12 é", "Été the_  anea, The ##."
        self.by_chunk = self._chunks_of(mixed) == whole(mixed)
        self.by_part = self.by_chunk and self._parts_of(plain) == whole(plain)

    def _parts_of(self, text: str) -> bytes:
        return b"".join(map(self.words.__getitem__, _PARTS.findall(text.lower())))

    def _chunks_of(self, text: str) -> bytes:
        return b"".join(map(self.chunks.__getitem__, text.split(" ")))

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.by_chunk:
            return self.chunks.__missing__(text)
        text = text.replace("\n", " ")
        # The library looks for special tokens, which begin with "<|", before it splits.
        if not self.by_part or "<|" in text:
            return self._chunks_of(text)
        pieces, done = [], 0
        for odd in _ODD.finditer(text):
            if odd.start() >= done:
                start = text.rfind(" ", done, odd.start()) + 1 or done
                end = text.find(" ", odd.end())
                end = len(text) if end < 0 else end
                pieces += self._parts_of(text[done:start]), self.chunks[text[start:end]]
                done = end
        return b"".join(pieces) + self._parts_of(text[done:])


@lru_cache(maxsize=2)
def encoder(path: str) -> TextEncoder:
    """The encoder of this worker process: its tables last from task to task."""
    return TextEncoder(path)


def public_tokenizer(name: str = "word_bpe_49k.json") -> str:
    """Path of a public vocabulary file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
