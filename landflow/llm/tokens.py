"""Whole-text encoding with a public tokenizer, one cached chunk at a time.

Both vocabularies split a text into pre-tokens before any merge, and no
pre-token reaches from a non-space character into the white space after it.
A text is therefore the concatenation of its chunks (white space plus the
word after it), and each distinct chunk is encoded by the library only once
per worker. Chunks end only at plain ASCII spaces and line feeds between two
non-space characters; a text with any other white space goes to the library
whole.
"""

from __future__ import annotations

import os
import re
from array import array
from itertools import filterfalse

import numpy as np

# A text outside this shape (leading, trailing, doubled or exotic white space)
# is encoded whole. Special tokens hold no white space, so they stay inside a
# chunk; combining marks attach to the character before them, never to a space
# that a chunk starts with, except after a space itself, hence the mark test.
_PAIRS = ("  ", " \n", "\n ", "\n\n")
_ASCII = ("\0", "\t", "\r", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x1f")
_SPACES = re.compile(r"[\x00\t\r\x0b\x0c\x1c-\x1f\x85\xa0  -     　]")
_MARKS = re.compile(r"[ \n][̀-ͯ᪰-᫿᷀-᷿⃐-⃿︠-゙゚︯]")
# Trailing sentence marks are pre-tokens of their own after a letter.
_TAIL = re.compile(r"(?s)(.*[A-Za-z])([.,;:!?]+)\Z")

#: Characters of texts whose new chunks are looked up together.
TOGETHER = 1 << 15
#: Chunks that go to the library at once.
BATCH = 64

#: Bytes of distinct chunks that a worker keeps, about; beyond it new chunks are
#: encoded, not kept. A chunk takes some 210 bytes beside its text and ids.
CACHE_BYTES, ENTRY_BYTES = 192 << 20, 210


def tokenizer_path(name: str) -> str:
    """The file of a public tokenizer on this machine (executors have it too)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def vocabulary_size(path: str) -> int:
    """One more than the largest id of a tokenizer."""
    from tokenizers import Tokenizer

    return 1 + max(Tokenizer.from_file(path).get_vocab(with_added_tokens=True).values())


def odd(text: str) -> bool:
    """Whether a text (not empty) has to be encoded whole."""
    if text[0] in " \n" or text[-1] in " \n" or any(x in text for x in _PAIRS):
        return True
    if text.isascii():
        return any(x in text for x in _ASCII)
    return bool(_SPACES.search(text) or _MARKS.search(text))


class _Chunks(dict):
    """Ids of chunks: those kept, and those of the texts at hand."""

    new: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        return self.new[piece]


class ChunkEncoder:
    """Encodes texts to little-endian unsigned 32-bit ids, as bytes."""

    def __init__(self, path: str, most: int = CACHE_BYTES) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.left = most
        self.cache = _Chunks()

    def whole(self, text: str) -> bytes:
        return array("I", self.tok.encode(text, add_special_tokens=False).ids).tobytes()

    def _learn(self, new: set[str]) -> dict[str, bytes]:
        """Ids of pieces that aren't cached yet (and keep them, up to the bound)."""
        cache = self.cache
        split: dict[str, tuple[str, str]] = {}
        ask: set[str] = set()
        for p in new:
            m = _TAIL.match(p)
            if m:
                split[p] = (m[1], "\0" + m[2])
                ask.update(q for q in split[p] if q not in cache)
            else:
                ask.add(p)
        todo = list(ask)
        got: dict[str, bytes] = {}
        # "\0" marks a run of sentence marks after a letter (no space before)
        for lo in range(0, len(todo), BATCH):  # small batches: their encodings stay in the processor's cache
            part = todo[lo:lo + BATCH]
            for p, e in zip(part, self.tok.encode_batch_fast(list(map(self._source, part)), add_special_tokens=False)):
                got[p] = array("I", e.ids).tobytes()
        for p, (a, b) in split.items():
            got[p] = (got.get(a) or cache.get(a, b"")) + (got.get(b) or cache.get(b, b""))
        size = sum(map(len, got)) + sum(map(len, got.values())) + ENTRY_BYTES * len(got)
        if size <= self.left:
            cache.update(got)
            self.left -= size
        return got

    @staticmethod
    def _source(piece: str) -> str:
        if piece[0] == "\0":
            return piece[1:]
        return piece if piece[0] == "\n" else " " + piece

    def ids(self, text: str | None) -> bytes:
        return self.many([text])[0]

    def many(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text; the new chunks of some of them are encoded together."""
        out: list[bytes] = []
        held: list[tuple[bytes, list[str]]] = []
        size = 0
        for text in texts:
            held.append(self._parts(text))
            size += len(text or "")
            if size >= TOGETHER:
                out += self._joined(held)
                held, size = [], 0
        return out + self._joined(held)

    def _parts(self, text: str | None) -> tuple[bytes, list[str]]:
        """Ids of the first word (or of all, if the text is odd) and the pieces after it."""
        if not text:
            return b"", []
        if odd(text):
            return self.whole(text), []
        first, _, rest = text.partition(" ")
        if "\n" in first:
            if not rest:
                return self.whole(text), []
            first, _, rest = text.partition("\n")
            rest = "\n" + rest
        head = self.whole(first)
        if not rest:
            return head, []
        pieces = rest.replace("\n", " \n").split(" ")
        return head, pieces if pieces[0] else pieces[1:]

    def _joined(self, parts: list[tuple[bytes, list[str]]]) -> list[bytes]:
        new = set(filterfalse(self.cache.__contains__, set().union(*[pieces for _, pieces in parts])))
        self.cache.new = self._learn(new) if new else {}
        get = self.cache.__getitem__
        out = [head + b"".join(map(get, pieces)) for head, pieces in parts]
        self.cache.new = {}
        return out


_ENCODERS: dict[str, ChunkEncoder] = {}


def encoder(path: str, most: int = CACHE_BYTES) -> ChunkEncoder:
    """One encoder per worker, the one of the vocabulary used last; its cache
    outlives a task."""
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = ChunkEncoder(path, most)
    return _ENCODERS[path]


def as_ids(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype="<u4")
