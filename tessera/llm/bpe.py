"""Cached encoding of whole texts with a public ``tokenizers`` file.

A byte-pair tokenizer works word by word, and most words of a corpus repeat.
``Encoder`` cuts a text where the tokenizer's own splitting rule always cuts
(before white space; between a Latin letter and ASCII punctuation) and keeps the ids of
each piece, so the library encodes each distinct piece once per worker. Texts
with irregular white space take the exact general cut. The ids equal
``Tokenizer.encode(text, add_special_tokens=False)``; ``tests/llm`` compares them.

Memory is bounded: a cache is emptied when it holds ``CACHE_PIECES`` pieces.
"""

from __future__ import annotations

import re
import sys
from array import array

CACHE_PIECES = 600_000

# White space as the tokenizers' splitting rule sees it (Unicode White_Space).
_WS = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_PUNCT = "!-/:-@\\[-`{-~"
_CHUNK = re.compile(f"[{_WS}]*[^{_WS}]+|[{_WS}]+")
_SPACE = re.compile(f"[{_WS}]")
_SIMPLE = re.compile(f"([ \\n]?)([{_LETTERS}]+)([{_PUNCT}]*)")


def _packed(ids: list[int]) -> bytes:
    """Unsigned 32-bit little-endian bytes."""
    a = array("I", ids)
    if sys.byteorder != "little":
        a.byteswap()
    return a.tobytes()


def byte_alphabet() -> dict[int, str]:
    """The printable character that byte-level BPE uses for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.model = self.tok.model
        self.table = byte_alphabet()
        # lower-casing tokenizers of this family drop white space between words
        self.drops_space = self._ids("a b") == self._ids("a\n b")
        self.lowers = self.drops_space and self._ids("Ab") == self._ids("ab")
        self.words: dict[str, bytes | None] = {}
        self.parts: dict[str, bytes] = {}

    def _ids(self, text: str) -> bytes:
        return _packed(self.tok.encode(text, add_special_tokens=False).ids)

    def _model_ids(self, piece: str) -> bytes:
        """Ids of one pre-token of Latin letters (or of punctuation) by the BPE model itself."""
        if self.lowers:
            piece = piece.lower()
        got = self.parts.get(piece)
        if got is None:
            shown = piece.encode().decode("latin-1").translate(self.table)
            got = _packed([t.id for t in self.model.tokenize(shown)])
            self.parts[piece] = got
        return got

    def _piece(self, chunk: str) -> bytes:
        """Ids of a chunk that starts and ends where the tokenizer cuts."""
        m = _SIMPLE.fullmatch(chunk)
        if m is None:
            return self._ids(chunk)
        space, letters, tail = m.groups()
        if self.drops_space:
            out = self._model_ids(letters)
        elif space == "\n":
            out = self._model_ids("\n") + self._model_ids(letters)
        else:
            out = self._model_ids(space + letters)
        return out + self._model_ids(tail) if tail else out

    def _room(self) -> None:
        for cache in (self.words, self.parts):
            if len(cache) > CACHE_PIECES:
                cache.clear()

    def _learn(self, keys, chunk_of) -> None:
        words = self.words
        for k in keys:
            if k not in words:
                words[k] = chunk_of(k)

    def _dropping(self, text: str) -> bytes:
        # U+001C to U+001F are white space for str.split only
        if "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text:
            return self._ids(text)
        words, parts = self.words, text.split()
        try:
            return b"".join(map(words.__getitem__, parts))
        except KeyError:
            self._learn(parts, self._piece)
            return b"".join(map(words.__getitem__, parts))

    def _spaced(self, part: str) -> bytes | None:
        """Ids of `` part`` (or of ``\\npart``); None where the plain cut is not exact."""
        if not part or part == "\n" or _SPACE.search(part, 1 if part[0] == "\n" else 0):
            return None
        return self._piece(part if part[0] == "\n" else " " + part)

    def _keeping(self, text: str) -> bytes:
        words = self.words
        first, *parts = text.replace("\n", " \n").split(" ")
        if first and not _SPACE.search(first):
            try:
                try:
                    return self._piece(first) + b"".join(map(words.__getitem__, parts))
                except KeyError:
                    self._learn(parts, self._spaced)
                    return self._piece(first) + b"".join(map(words.__getitem__, parts))
            except TypeError:  # a part is None: irregular white space
                pass
        return b"".join(self._piece(c) for c in _CHUNK.findall(text))

    def encode(self, text: str | None) -> bytes:
        """The ids of the whole text; null and empty texts have none."""
        if not text:
            return b""
        self._room()
        return self._dropping(text) if self.drops_space else self._keeping(text)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process and file, so that its cache serves all tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def text_slices(batches, rows: int = 256):
    """Re-cut Arrow batches into slices of ``rows`` rows (bounds Python copies of long texts)."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)
