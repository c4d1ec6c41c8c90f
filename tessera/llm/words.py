"""Words of a text and their hashes."""

from __future__ import annotations

WORDS_CACHED = 500_000

_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Runs of ASCII letters and digits and of non-ASCII characters, lower-cased in A-Z."""
    return text.encode("utf-8", "surrogatepass").translate(_PLAIN).split() if text else []


def word_counts(texts: list[bytes | None]):
    """``words_of`` of all texts (UTF-8) counted at once: each text's words and its distinct words; the number and the
    count of each distinct word, text by text; the words by number."""
    import numpy as np
    import pyarrow as pa

    texts = [t or b"" for t in texts]
    data = np.frombuffer(b" ".join([*texts, b""]).translate(_PLAIN), np.uint8)   # ends with a blank
    held = data != 32
    change = np.flatnonzero(np.diff(held, prepend=False))
    first, end = change[::2], change[1::2]
    offsets = np.concatenate([[0], np.cumsum(end - first)])
    packed = data[held]
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), first.size, [None, pa.py_buffer(offsets), pa.py_buffer(packed)]).dictionary_encode()
    lengths = np.diff(np.searchsorted(first, np.cumsum([0, *[len(t) + 1 for t in texts]])))
    number = max(len(words.dictionary), 1)
    key = np.repeat(np.arange(len(texts)) * number, lengths)
    key += words.indices.to_numpy()
    key, counts = np.unique(key, return_counts=True)
    text, codes = np.divmod(key, number)
    return lengths, np.bincount(text, minlength=len(texts)), codes.astype(np.int32), counts, words.dictionary.cast(pa.binary())


def spaced_words(text: str | None) -> list[bytes]:
    """Runs without ASCII white space, lower-cased in A-Z."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


class _Hashes(dict):
    """XXH64 of each word; emptied when ``WORDS_CACHED`` words are held."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > WORDS_CACHED:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


WORD_HASHES = _Hashes()
