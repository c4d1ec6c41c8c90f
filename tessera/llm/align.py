"""Alignment of two tokenizers over the same bytes, with an associative monoid of fragments.

Two token sequences spell the same bytes. Where a token of both ends, the sequences are cut into
groups; tokens link where their byte ranges overlap, which is always inside one group.

A ``Fragment`` covers a byte range of both sequences: an open prefix (tokens up to the first common end;
their group may have begun before), closed groups (their text, counts and linked id pairs, tokens no
more) and an open suffix (tokens after the last common end). ``compose`` joins neighbours: the left
suffix and the right prefix close where ends meet. It is associative, so the fragments of a document may
be composed in any grouping.

A short text is composed in its task, from the fragments of words that the worker has met before: both
tokenizers always cut before a space or line feed that follows another character, so such fragments are
closed at both ends. A text over ``CHUNK`` characters is cut into chunks for different tasks. Each
tokenizer is cut at the first place behind the chunk's nominal end where it cuts in any text (``Cutter``),
so the two cover different bytes there and the fragment's ends are open. Rounds of a shuffle by
(row, chunk / ``FAN``) then compose ``FAN`` neighbours, until one fragment a document is left.

Counts over the corpus: whole documents are collected in blocks of about ``BLOCK_LINKS`` links, as numbers of
words in their worker's ``Store``; a block has each id pair once with its number. Pairs of all blocks are summed with partial aggregates, the totals
join back to the pairs of each block, and a document's sums are read from its block's array.

Defined cases: null and empty texts, and those that a tokenizer changes (its tokens spell other bytes),
have no tokens and zeros; a null doc_id stays null; repeated rows give repeated rows; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import pickle
import re
import string
from array import array
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.bpe import byte_alphabet, text_slices
from tessera.llm.common import landed

CHUNK = 1 << 16         # characters of a text that one task aligns
FAN = 16                # neighbouring fragments composed in one group
BLOCK_LINKS, BLOCK_DOCS = 1 << 21, 1 << 14   # a block of documents ends when it has as many
PIECES = 100_000        # words a worker remembers when a block begins; of more, the half most used stays
COUNTS = ("n_a", "n_b", "n_groups", "n_links")
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


# ---- the monoid ----

Tokens = tuple[list[int], list[int]]   # ids, and the byte places where they end


@dataclass
class Fragment:
    """``first`` and ``last`` are the outer common ends (none: all tokens are in the prefix).

    ``pairs`` counts the links of closed groups by ``b_id << 32 | a_id``.
    """

    a: Tokens = ((), ())
    b: Tokens = ((), ())
    first: int | None = None
    last: int | None = None
    a2: Tokens = ((), ())
    b2: Tokens = ((), ())
    text: bytes = b""
    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    pairs: Counter = field(default_factory=Counter)
    ok: bool = True     # both tokenizers kept the bytes


EMPTY = Fragment()
START = Fragment(first=0, last=0)   # the begin of a document is a common end


def _split(t: Tokens, at: int) -> tuple[Tokens, Tokens]:
    """Tokens that end at ``at`` or before, and the others."""
    k = int(np.searchsorted(t[1], at, "right"))
    return (t[0][:k], t[1][:k]), (t[0][k:], t[1][k:])


def _joined(x: Tokens, y: Tokens) -> Tokens:
    return [*x[0], *y[0]], [*x[1], *y[1]]


def groups(a: Tokens, b: Tokens) -> tuple[bytes, int, Counter]:
    """(text, number of groups, pairs) of two runs with the same begin and end.

    The sweep meets every overlapping pair once: the token that ends first gives way to its follower.
    """
    (ia, ea), (ib, eb) = a, b
    i = j = i0 = j0 = 0
    parts, links = [], []
    while i < len(ia):
        links.append(ib[j] << 32 | ia[i])
        if ea[i] < eb[j]:
            i += 1
        elif ea[i] > eb[j]:
            j += 1
        else:
            i, j = i + 1, j + 1
            parts.append(f"{','.join(map(str, ia[i0:i]))}|{','.join(map(str, ib[j0:j]))}")
            i0, j0 = i, j
    return ";".join(parts).encode(), len(parts), Counter(links)


def _from(start: int, a: Tokens, b: Tokens, ok: bool) -> Fragment:
    """Tokens that follow the common end ``start``."""
    common = np.intersect1d(a[1], b[1])
    if not common.size:
        return Fragment(first=start, last=start, a2=a, b2=b, ok=ok)
    last = int(common[-1])
    (a, a2), (b, b2) = _split(a, last), _split(b, last)
    text, n, pairs = groups(a, b)
    return Fragment(first=start, last=last, a2=a2, b2=b2, text=text, n_a=len(a[0]), n_b=len(b[0]), n_groups=n, pairs=pairs, ok=ok)


def fragment(a: Tokens, b: Tokens, ok: bool = True) -> Fragment:
    """The fragment of two runs of neighbouring tokens; their begins need not meet."""
    common = np.intersect1d(a[1], b[1])
    if not common.size:
        return Fragment(a=a, b=b, ok=ok)
    first = int(common[0])
    (a, a_rest), (b, b_rest) = _split(a, first), _split(b, first)
    out = _from(first, a_rest, b_rest, ok)
    out.a, out.b = a, b
    return out


def _chained(x: Fragment, y: Fragment) -> Fragment:
    """``x``, which ends with a common end, and the part of ``y`` that begins at it."""
    return Fragment(x.a, x.b, x.first, y.last, y.a2, y.b2, x.text + (b";" if x.text and y.text else b"") + y.text,
                    x.n_a + y.n_a, x.n_b + y.n_b, x.n_groups + y.n_groups, x.pairs + y.pairs, x.ok and y.ok)


def compose(x: Fragment, y: Fragment) -> Fragment:
    """``x`` followed by ``y``. Ends are absolute places in the document."""
    if x.first is None:
        out = fragment(_joined(x.a, y.a), _joined(x.b, y.b), x.ok and y.ok)
    else:
        out = _chained(x, _from(x.last, _joined(x.a2, y.a), _joined(x.b2, y.b), y.ok))
    # where y has a common end, its prefix ended there, and so does ``out``
    return out if y.first is None else _chained(out, y)


# ---- the two tokenizers ----

class Store:
    """Closed fragments by number: their counts and how many pair codes each has, all codes in a row, the groups' texts."""

    WIDTH = len(COUNTS) + 1

    def __init__(self):
        self.counts, self.codes, self.texts = array("I"), array("q"), []
        self.bad: set[int] = set()     # a tokenizer changed their bytes
        self.uses = np.zeros(0, "i8")  # by blocks that are done

    def add(self, counts: tuple, codes: array, text: bytes, ok: bool = True) -> int:
        n = len(self.texts)
        self.counts.extend((*counts, len(codes)))
        self.codes.extend(codes)
        self.texts.append(text)
        if not ok:
            self.bad.add(n)
        return n

    def extend(self, counts: np.ndarray, codes: np.ndarray, texts: list[bytes]) -> range:
        n = len(self.texts)
        self.counts.frombytes(counts.astype("u4").tobytes())
        self.codes.frombytes(codes.astype("i8").tobytes())
        self.texts += texts
        return range(n, len(self.texts))

    def read(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The counts of ``numbers``, and the places of their codes, one number's behind the other's."""
        counts = np.asarray(self.counts).reshape(-1, self.WIDTH)
        held = counts[:, -1].astype("i8")
        begins, held, counts = (np.cumsum(held) - held)[numbers], held[numbers], counts[numbers]
        places = np.repeat(begins - (np.cumsum(held) - held), held)
        places += np.arange(places.size)
        return counts, places

    def used(self) -> np.ndarray:
        """``uses`` of all numbers."""
        return np.concatenate([self.uses, np.zeros(len(self.texts) - self.uses.size, "i8")])

    def pairs(self, places: np.ndarray) -> np.ndarray:
        return np.asarray(self.codes)[places]


def _spelt(table: list[bytes], ids: list[int]) -> bytes:
    return b"".join(map(table.__getitem__, ids))


class Pair:
    """Tokenizer A (a byte-level ``tokenizers`` file) and B (a ``sentencepiece`` model) with their token bytes.

    Both read ``" " + text``: B's library adds the space itself.
    """

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")   # Spark deals out the work
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True   # their strings in a text are plain text
        back = {c: b for b, c in byte_alphabet().items()}
        vocab = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for t, i in vocab.items():
            self.bytes_a[i] = bytes(back[c] for c in t) if all(c in back for c in t) else t.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        plain = [p.replace("▁", " ") for i, p in enumerate(pieces) if not self.b.is_byte(i)]
        # no token holds two characters that are not in here: B cuts between them in any text
        self.inside = {p[k:k + 2] for p in plain for k in range(len(p) - 1)}
        if any(x[1] in " \n" and x[0] != " " for x in self.inside) or any("\n" in p for p in plain):
            raise ValueError("the piece model joins words over spaces or line feeds")
        self.lengths_a, self.lengths_b = [np.array([len(t) for t in x]) for x in (self.bytes_a, self.bytes_b)]
        self.size = max(len(self.bytes_a), len(self.bytes_b))
        self.names = [b"%d%c" % (i, c) for c in b",|;" for i in range(self.size)]   # inside a list, behind A's list, behind B's
        self.name_lengths = np.array([len(x) for x in self.names])
        self.words: dict[object, int | None] = {}   # numbers in the store
        self.store = Store()

    def forget(self) -> None:
        """Keep half of ``PIECES`` words, those that blocks used most."""
        old, self.store = self.store, Store()
        uses = old.used()
        kept = np.sort(np.argsort(-uses, kind="stable")[:PIECES // 2])
        counts, places = old.read(kept)
        self.store.extend(counts, old.pairs(places), [old.texts[n] for n in kept.tolist()])
        self.store.uses = uses[kept] >> 1   # later blocks weigh more
        place = np.full(uses.size, -1)
        place[kept] = np.arange(kept.size)
        self.store.bad = {int(place[n]) for n in old.bad if place[n] >= 0}
        place = place.tolist()
        self.words = {k: place[n] for k, n in self.words.items() if n is not None and place[n] >= 0}

    def _a_ids(self, piece: str) -> list[int]:
        return self.a.encode_batch_fast([piece], add_special_tokens=False)[0].ids   # without offsets

    def _b_ids(self, piece: str) -> list[int]:
        """B's ids of a piece that begins where B cuts; behind a line feed the library adds no space of its own."""
        return self.b.encode("\n" + piece)[2:]

    def tokens(self, part_a: str, part_b: str, at_a: int = 0, at_b: int = 0) -> tuple[Tokens, Tokens, bool]:
        """Both runs of tokens, from the given byte places on, and whether they spell the parts."""
        ids_a = self._a_ids(part_a)
        ids_b = self._b_ids(part_b) if part_b else []
        ok = _spelt(self.bytes_a, ids_a) == part_a.encode() and _spelt(self.bytes_b, ids_b) == part_b.encode()
        ends_a, ends_b = [(at + np.cumsum(t[np.array(ids, dtype=int)])).tolist() for at, t, ids in ((at_a, self.lengths_a, ids_a), (at_b, self.lengths_b, ids_b))]
        return (ids_a, ends_a), (ids_b, ends_b), ok

    def learn(self, keys) -> None:
        """Put the words of unknown ``keys`` into ``words``; None for a key that is no plain word.

        A key is a word that follows a space, a line feed with a word, or ``(piece,)`` for any other piece.
        """
        words, pieces, marked = self.words, {}, {}
        for key in keys:
            if not isinstance(key, str):
                pieces[key] = key[0]
            elif not _PLAIN.fullmatch(key):
                words[key] = None
            else:
                head = key.rstrip(_MARKS)
                n = len(head)
                if n < len(key) and head[-1:].isalpha() and key[n - 1:n + 1] not in self.inside:
                    tail = key[n:]
                    marked[key] = head, (tail,)   # both tokenizers cut before the marks
                    pieces[(tail,)] = tail
                    pieces[head] = self._piece(head)
                else:
                    pieces[key] = self._piece(key)
        todo = [k for k in pieces if k not in words]
        words.update((k, self._alone(k[0])) for k in todo if not isinstance(k, str))
        todo = [k for k in todo if isinstance(k, str)]
        for a in range(0, len(todo), RUN):
            some = todo[a:a + RUN]
            words.update(zip(some, self._aligned([pieces[k] for k in some])))
        if marked:
            words.update(zip(marked, self._neighbours([(words[head], words[tail]) for head, tail in marked.values()])))

    @staticmethod
    def _piece(key: str) -> str:
        return key if key[0] == "\n" else " " + key

    def _alone(self, piece: str) -> int:
        """The closed fragment of any piece."""
        a, b, ok = self.tokens(piece, piece)
        if not ok:
            return self.store.add((0,) * len(COUNTS), array("q"), b"", False)
        text, n, pairs = groups(a, b)
        return self.store.add((len(a[0]), len(b[0]), n, pairs.total()), array("q", pairs.elements()), text)

    def _aligned(self, pieces: list[str]) -> list[int]:
        """The closed fragments of words, encoded as one run: both tokenizers cut where they meet."""
        text = "".join(pieces)
        spelt = text.encode()
        flat_a, flat_b = self._a_ids(text), self._b_ids(text)
        kept = _spelt(self.bytes_a, flat_a) == spelt == _spelt(self.bytes_b, flat_b)
        if kept:
            a, b = np.array(flat_a, dtype="i8"), np.array(flat_b, dtype="i8")
            size_a, size_b = self.lengths_a[a], self.lengths_b[b]
            end_a, end_b = np.cumsum(size_a), np.cumsum(size_b)
            end = np.cumsum([len(p) for p in pieces] if len(text) == len(spelt) else [len(p.encode()) for p in pieces])
            upto_a, upto_b = np.searchsorted(end_a, end, "right"), np.searchsorted(end_b, end, "right")
            kept = not ((end_a[upto_a - 1] != end).any() or (end_b[upto_b - 1] != end).any())
        if not kept:   # the words with changed bytes are sought in halves
            half = len(pieces) // 2
            return [*self._aligned(pieces[:half]), *self._aligned(pieces[half:])] if half > 3 else [self._alone(p) for p in pieces]
        first, last = np.searchsorted(end_b, end_a - size_a, "right"), np.searchsorted(end_b - size_b, end_a, "left")
        n = last - first
        links = np.cumsum(n)
        at = np.repeat(first - (links - n), n) + np.arange(links[-1])
        codes = (b[at] << 32) | np.repeat(a, n)
        # the text: in each group A's ids, then B's, each with the separator behind it
        close_a, close_b = np.isin(end_a, end_b), np.isin(end_b, end_a)
        group_a, group_b = np.cumsum(close_a) - close_a, np.cumsum(close_b) - close_b
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        shown = np.concatenate([a + self.size * close_a, b + 2 * self.size * close_b])[order]
        names = b"".join(map(self.names.__getitem__, shown.tolist()))
        upto = np.cumsum(self.name_lengths[shown])[upto_a + upto_b - 1].tolist()
        links = links[upto_a - 1]
        counts = np.diff(np.stack([upto_a, upto_b, group_a[upto_a - 1] + 1, links, links], 1), axis=0, prepend=0)
        return self.store.extend(counts, codes, [names[x:y - 1] for x, y in zip([0, *upto], upto)])

    def _neighbours(self, both: list[tuple[int, int]]) -> range:
        """Closed fragments, each of two that are one behind the other."""
        store = self.store
        counts, places = store.read(np.array(both).ravel())
        out = store.extend(counts[::2] + counts[1::2], store.pairs(places), [store.texts[x] + b";" + store.texts[y] for x, y in both])
        if store.bad:
            store.bad.update(n for n, xy in zip(out, both) if not store.bad.isdisjoint(xy))
        return out


RUN = 1024              # words encoded as one run
_MARKS = string.punctuation
_PLAIN = re.compile(r"\n?\S+")
_CUT = re.compile(r"(?<=\S)(?=[ \n])")   # both tokenizers cut here
# A cuts here: before white space that follows another character, and between a letter or digit and a mark
_CUT_A = re.compile(r"(?<=\S)(?=\s)|(?<=[A-Za-z0-9À-ÖØ-öø-ÿぁ-ゖァ-ヺ一-鿿가-힣])(?=[!-/:-@\[-`{-~、。！，：；？])")
_PAIRS: dict = {}


def pair(path_a: str, path_b: str) -> Pair:
    """One pair per worker process, so that its memory of words serves all tasks."""
    if (path_a, path_b) not in _PAIRS:
        _PAIRS[path_a, path_b] = Pair(path_a, path_b)
    return _PAIRS[path_a, path_b]


# ---- long texts: chunks, fragments, tree reduction ----

class Cutter:
    """The chunks of a text: for each tokenizer the part that begins in it."""

    def __init__(self, both: Pair, text: str):
        self.both, self.text = both, " " + text

    def _a(self, at: int) -> int:
        m = _CUT_A.search(self.text, at)
        return m.start() if m else len(self.text)

    def _b(self, at: int) -> int:
        t, inside = self.text, self.both.inside
        return next((p for p in range(at, len(t)) if t[p - 1:p + 1] not in inside), len(t))

    def chunks(self, size: int):
        """(chunk, part of A, part of B, byte place of A's part, of B's part)."""
        n = len(self.text)
        ends = [(self._a(p), self._b(p)) for p in range(size, n, size)] + [(n, n)]
        a = b = byte_a = byte_b = 0
        for k, (a2, b2) in enumerate(ends):
            yield k, self.text[a:a2], self.text[b:b2], byte_a, byte_b
            byte_a, byte_b = byte_a + len(self.text[a:a2].encode()), byte_b + len(self.text[b:b2].encode())
            a, b = a2, b2


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    names, types = zip(*[f.strip().split(" ", 1) for f in schema.split(",")])
    cols = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(cols, types)], names=names)


CHUNKS = "row long, doc_id long, chunk long, part_a string, part_b string, at_a long, at_b long"
FRAGMENTS = "row long, doc_id long, chunk long, fragment binary"


def _whole_fragments(long_docs: DataFrame, path_a: str, path_b: str, size: int) -> DataFrame:
    """One fragment a row: chunks to tasks, then ``FAN`` neighbours at a time."""

    def cut(batches):
        both = pair(path_a, path_b)
        for b in text_slices(batches, 1):
            row, doc, text = (c[0].as_py() for c in b.columns)
            for k, *parts in Cutter(both, text).chunks(size):
                yield _batch([(row, doc, k, *parts)], CHUNKS)

    def align(batches):
        both = pair(path_a, path_b)
        for b in text_slices(batches, 1):
            row, doc, k, part_a, part_b, at_a, at_b = (c[0].as_py() for c in b.columns)
            f = fragment(*both.tokens(part_a, part_b, at_a, at_b))
            yield _batch([(row, doc, k, pickle.dumps(f if k else compose(START, f)))], FRAGMENTS)

    def reduce(t: pa.Table) -> pa.Table:
        out = None
        for i in np.argsort(t["chunk"].to_numpy()):
            f = pickle.loads(t["fragment"][int(i)].as_py())
            out = f if out is None else compose(out, f)
        first = t.slice(0, 1)
        return pa.Table.from_batches([_batch([(first["row"][0].as_py(), first["doc_id"][0].as_py(), first["chunk"][0].as_py() // FAN, pickle.dumps(out))], FRAGMENTS)])

    numbered = long_docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    chunks = landed(numbered.mapInArrow(cut, CHUNKS), "align-chunks")   # stored, so row numbers stay
    most = chunks.agg(F.max("chunk")).first()[0]
    level = chunks.repartition("row", "chunk").mapInArrow(align, FRAGMENTS)
    while most:
        level = level.groupBy("row", F.floor(F.col("chunk") / FAN).alias("part")).applyInArrow(reduce, FRAGMENTS)
        most //= FAN
    return level.select("doc_id", "fragment")


# ---- blocks of documents ----

class Block:
    """Documents whose words (or whole long texts) are numbered entries of a store with their pairs."""

    def __init__(self, both: Pair, whole: bool = False):
        if not whole and len(both.words) > PIECES:
            both.forget()   # not inside a block, which has numbers of the store
        self.both, self.store = both, Store() if whole else both.store
        self.times = array("q")   # of whole texts: how often they have each code
        self.docs, self.links = [], 0

    def _entries(self, every: list[list]) -> list[array | None]:
        """The numbers of lists of keys; None for a list with a key that is no plain word."""
        words = self.both.words
        self.both.learn(set().union(*every).difference(words))
        out = []
        for keys in every:
            try:
                out.append(array("I", map(words.__getitem__, keys)))
            except TypeError:
                out.append(None)
        return out

    def take_texts(self, docs: list[tuple]) -> None:
        """(doc_id, text) rows."""
        texts = [" " + t if t else None for _, t in docs]
        every = self._entries([t.replace("\n", " \n").split(" ")[1:] if t else [] for t in texts])
        odd = [i for i, e in enumerate(every) if e is None]   # irregular white space: the exact cut
        for i, e in zip(odd, self._entries([[(p,) for p in _CUT.split(texts[i])] for i in odd])):
            every[i] = e
        for (doc, _), e in zip(docs, every):
            self._take(doc, e)

    def _take(self, doc_id, entries: array) -> None:
        bad, texts = self.store.bad, self.store.texts
        if bad and not bad.isdisjoint(entries):
            entries = array("I")
        sha = hashlib.sha256(b";".join(map(texts.__getitem__, entries))).hexdigest() if entries else ""
        self.docs.append((doc_id, entries, sha))
        self.links += 4 * len(entries)

    def take_fragment(self, doc_id, f: Fragment) -> None:
        """A whole long document: one entry."""
        whole = f.ok and not (f.a2[0] or f.b2[0])
        n = self.store.add((f.n_a, f.n_b, f.n_groups, f.pairs.total()), array("q", f.pairs.keys()), f.text, whole)
        self.times.extend(f.pairs.values())
        self._take(doc_id, array("I", [n]))
        self.links += len(f.pairs)
        self.store.texts[-1] = b""

    def full(self) -> bool:
        return self.links >= BLOCK_LINKS or len(self.docs) >= BLOCK_DOCS

    def row(self, number: int) -> tuple:
        """(block, pairs, their numbers, the documents as packed arrays)."""
        import zstandard

        entries = np.frombuffer(b"".join(e.tobytes() for _, e, _ in self.docs), "u4")
        sizes = np.array([len(e) for _, e, _ in self.docs], dtype="i8")
        used = np.bincount(entries, minlength=len(self.store.texts))
        self.store.uses = self.store.used() + used
        numbers = np.flatnonzero(used)   # the block numbers its own entries
        place = np.zeros(used.size, "u4")
        place[numbers] = np.arange(numbers.size)
        entries, used = place[entries], used[numbers]
        counts, places = self.store.read(numbers)
        lengths = counts[:, -1].astype("i8")
        weights = np.repeat(used.astype("f8"), lengths)   # sums stay below 2^53, so that doubles are exact
        times = np.ones(places.size, "u4")
        if self.times:
            times = np.asarray(self.times)[places].astype("u4")
            weights *= times
        codes = self.store.pairs(places)
        del places
        pairs, at = np.unique(codes, return_inverse=True)
        del codes
        total = np.bincount(at, weights=weights, minlength=pairs.size).astype(np.int64)
        del weights
        per_doc = np.stack([_sums(c[entries], sizes) for c in counts.T[:-1]], 1)
        held = (at.astype("u4"), times, lengths.astype("u4"), entries, sizes.astype("u4"), per_doc, [d for d, *_ in self.docs], [s for *_, s in self.docs])
        return number, pairs, total, zstandard.compress(pickle.dumps(held))


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums over consecutive runs of ``sizes`` rows, empty runs included."""
    total = np.concatenate([np.zeros((1, *values.shape[1:]), np.int64), np.cumsum(values, axis=0, dtype=np.int64)])
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


BLOCKS = "block long, pairs array<long>, times array<long>, docs binary"


def _blocks(docs: DataFrame, path_a: str, path_b: str, whole: bool) -> DataFrame:
    """Blocks of (doc_id, text) rows, or of (doc_id, fragment) rows where ``whole``."""

    def build(batches):
        from pyspark import TaskContext

        both, number = pair(path_a, path_b), TaskContext.get().partitionId() << 32
        block = Block(both, whole)
        for b in text_slices(batches, 64):
            rows = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
            if whole:
                for doc, held in rows:
                    block.take_fragment(doc, pickle.loads(held))
            else:
                block.take_texts(rows)
            if block.full():
                yield _batch([block.row(number)], BLOCKS)
                block, number = Block(both, whole), number + 1
        if block.docs:
            yield _batch([block.row(number)], BLOCKS)

    return docs.mapInArrow(build, BLOCKS)


def _finished(batches):
    """Documents of each block with the sums of their links' counts."""
    import zstandard

    for b in batches:
        for r in range(b.num_rows):
            at, times, lengths, entries, sizes, counts, ids, shas = pickle.loads(zstandard.decompress(b.column(0)[r].as_py()))
            found = b.column(1)[r].values
            order = np.argsort(found.field("pair").to_numpy()) if found is not None else np.zeros(0, int)
            count, best = [found.field(n).to_numpy(zero_copy_only=False)[order].astype(np.int64) if order.size else np.zeros(0, np.int64) for n in ("count", "best")]
            times = times.astype(np.int64)
            per_entry = _sums(np.stack([times * best[at], times * count[at]], 1), lengths.astype(np.int64))
            per_doc = _sums(per_entry[entries], sizes.astype(np.int64))
            cols = [pa.array(ids, pa.int64()), *[pa.array(counts[:, k]) for k in range(4)], pa.array(per_doc[:, 0]), pa.array(per_doc[:, 1]), pa.array(shas, pa.string())]
            yield pa.RecordBatch.from_arrays(cols, names=[f.split()[0] for f in RESULT.split(", ")])


def align_tokenizers(docs: DataFrame, path_a: str, path_b: str, chunk: int = CHUNK) -> DataFrame:
    """Per document: tokens of A and B, groups, links, how their id pairs count in the corpus, and the groups' digest."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    long = F.coalesce(F.length("text"), F.lit(0)) > chunk
    blocks = _blocks(rows.where(~long), path_a, path_b, whole=False)
    if not rows.where(long).isEmpty():
        blocks = blocks.unionByName(_blocks(_whole_fragments(rows.where(long), path_a, path_b, chunk), path_a, path_b, whole=True))
    blocks = landed(blocks, "align-blocks")
    pairs = blocks.select("block", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("block", F.col("p.pairs").alias("pair"), F.col("p.times").alias("n"))
    totals = pairs.groupBy("pair").agg(F.sum("n").alias("count"))
    b_id = F.shiftright("pair", 32)
    tops = totals.groupBy(b_id.alias("b")).agg(F.max("count").alias("top"))
    totals = totals.withColumn("b", b_id).join(tops, "b").select("pair", "count", (F.col("count") == F.col("top")).alias("best"))
    marked = pairs.select("block", "pair").join(totals, "pair").groupBy("block").agg(F.collect_list(F.struct("pair", "count", "best")).alias("found"))
    return blocks.select("block", "docs").join(marked, "block", "left").select("docs", "found").mapInArrow(_finished, RESULT)
