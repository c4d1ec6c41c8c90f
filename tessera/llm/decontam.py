"""Benchmark decontamination: item-sized windows of the documents against benchmark items.

Words are runs of ASCII letters and digits and non-ASCII characters, lower-cased in A-Z; a
shingle is five words (a shorter item is one shingle). For an item of L words, every window of L
words that shares a shingle with an item of that length gets a SimHash (windows that share
none have similarity zero). The items' SimHashes stand in a multi-index: 8 blocks of 8 bits, each
listing the items within 2 bits of every block value, so all items within ``RADIUS`` < 24 bits of
a window are found. Candidates are verified exactly: the weighted
similarity of the two shingle bags (each shingle weighs its count; sum of minima
over sum of maxima) must reach ``threshold``.

The items are taken in blocks of bounded size; each block is broadcast and all documents pass it.

Defined cases: null, empty and wordless texts or items match nothing; a document shorter than an
item is one window; repeated items are reported each, repeated documents too; of equal similarities the
first window counts; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.bpe import text_slices
from tessera.llm.simhash import popcount
from tessera.llm.words import WORD_HASHES, words_of

SHINGLE, THRESHOLD, RADIUS = 5, 0.8, 22
ITEM_BLOCK, ITEM_BYTES = 20_000, 8 << 20   # items and text bytes of one broadcast block
STRETCH = 1 << 15                          # window starts fingerprinted at once
HITS = "doc_id long, item_id long, similarity double, start long, words long, distance int"

def gram_hashes(words: list[bytes], k: int) -> np.ndarray:
    """A 64-bit hash of each run of k words."""
    h = np.fromiter(map(WORD_HASHES.__getitem__, words), dtype=np.uint64, count=len(words))
    n = h.size - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = (out * np.uint64(0x9E3779B97F4A7C15)) ^ h[i:i + n]
        out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def _bits(h: np.ndarray) -> np.ndarray:
    return np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _number(bits: np.ndarray) -> np.ndarray:
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()


def bag(words: list[bytes], k: int) -> Counter:
    return Counter(b" ".join(words[i:i + k]) for i in range(len(words) - k + 1))


def similarity(a: Counter, b: Counter) -> float:
    """Sum of the smaller counts over sum of the larger counts."""
    low = sum(min(n, b[s]) for s, n in a.items() if s in b)
    high = sum(a.values()) + sum(b.values()) - low
    return low / high if high else 0.0


@dataclass
class _Length:
    """The items of one length: words, shingle length, ids, bags, fingerprints, multi-index."""

    words: int
    k: int
    items: list[int | None]
    bags: list[Counter]
    prints: np.ndarray
    starts: list[np.ndarray]   # per block: first entry of each block value (257)
    entries: list[np.ndarray]  # per block: items by block value

    def near(self, fp: np.ndarray, radius: int) -> list[tuple[int, int, int]]:
        """(window, item, distance) of all items within ``radius`` < 24 bits of the windows."""
        pairs = []
        for b, (start, entry) in enumerate(zip(self.starts, self.entries)):
            v = ((fp >> np.uint64(8 * b)) & np.uint64(255)).astype(np.int64)
            n = start[v + 1] - start[v]
            at = np.repeat(np.arange(fp.size), n)
            k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            pairs.append(at * len(self.items) + entry[start[v][at] + k])
        w, i = np.divmod(np.unique(np.concatenate(pairs)), len(self.items))
        d = popcount(fp[w] ^ self.prints[i])
        keep = d <= radius
        return list(zip(w[keep].tolist(), i[keep].tolist(), d[keep].tolist()))


class ItemIndex:
    """Seeds and multi-index of one block of items."""

    def __init__(self, items: list[tuple[int | None, str | None]]):
        by_length = defaultdict(list)
        for item, text in items:
            w = words_of(text)
            if w:
                by_length[len(w)].append((item, w))
        self.lengths: list[_Length] = []
        near = [np.flatnonzero(popcount(np.arange(256, dtype=np.uint64) ^ np.uint64(v)) <= 2) for v in range(256)]
        seeds = defaultdict(lambda: ([], []))  # shingle length: hashes, number of the item length
        for n in sorted(by_length):
            k = min(SHINGLE, n)
            group = by_length[n]
            hashes = [gram_hashes(w, k) for _, w in group]
            fp = _number(np.array([2 * _bits(h).sum(axis=0, dtype=np.int64) > h.size for h in hashes], dtype=np.uint8))
            starts, entries = [], []
            for b in range(8):
                v = ((fp >> np.uint64(8 * b)) & np.uint64(255)).astype(np.int64)
                value = np.concatenate([near[x] for x in v])
                item = np.repeat(np.arange(fp.size), [near[x].size for x in v])
                order = np.argsort(value, kind="stable")
                starts.append(np.searchsorted(value[order], np.arange(257)))
                entries.append(item[order])
            for h in hashes:
                seeds[k][0].append(h)
                seeds[k][1].append(np.full(h.size, len(self.lengths)))
            self.lengths.append(_Length(n, k, [i for i, _ in group], [bag(w, k) for _, w in group], fp, starts, entries))
        self.seeds = {}
        for k, (h, at) in seeds.items():
            both = np.unique(np.stack([np.concatenate(h), np.concatenate(at).astype(np.uint64)]), axis=1)
            self.seeds[k] = (both[0], both[1].astype(np.int64))

    def hits(self, text: str | None, radius: int = RADIUS, threshold: float = THRESHOLD) -> list[tuple]:
        """(item_id, similarity, start, words, distance) of the best window of each item found."""
        words = words_of(text)
        out = []
        for k, (seed, length) in self.seeds.items():
            grams = gram_hashes(words, k)
            a, z = np.searchsorted(seed, grams, "left"), np.searchsorted(seed, grams, "right")
            found = np.flatnonzero(z > a)
            if not found.size:
                continue
            n = (z - a)[found]
            at = np.repeat(found, n)
            lengths = length[np.repeat(a[found], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
            for number in np.unique(lengths):
                out += self._windows(words, grams, at[lengths == number], self.lengths[number], radius, threshold)
        return out

    def _windows(self, words, grams, seeds, group: _Length, radius, threshold) -> list[tuple]:
        m = min(group.words - group.k + 1, grams.size)
        last = grams.size - m
        # every start whose window holds a seed: runs around the seeds, merged
        low, high = np.maximum(seeds - m + 1, 0), np.minimum(seeds, last)
        low, high = low[low <= high], high[low <= high]
        step = np.zeros(last + 2, np.int64)
        np.add.at(step, low, 1)
        np.add.at(step, high + 1, -1)
        starts = np.flatnonzero(np.cumsum(step)[:-1] > 0)
        best: dict[int, tuple] = {}
        for c in range(0, starts.size, STRETCH):
            # starts may lie far apart: sum the bits of each stretch of positions
            for run in np.split(starts[c:c + STRETCH], np.flatnonzero(np.diff(starts[c:c + STRETCH]) > m) + 1):
                a = run[0]
                total = np.zeros((run[-1] + m - a + 1, 64), np.int32)
                np.cumsum(_bits(grams[a:run[-1] + m]), axis=0, dtype=np.int32, out=total[1:])
                ones = total[run - a + m] - total[run - a]
                for w, i, d in group.near(_number((2 * ones > m).astype(np.uint8)), radius):
                    s = int(run[w])
                    size = min(group.words, len(words) - s)
                    sim = similarity(bag(words[s:s + size], group.k), group.bags[i])
                    if sim >= threshold and (i not in best or sim > best[i][0]):
                        best[i] = (sim, s, size, d)
        return [(group.items[i], sim, s, size, d) for i, (sim, s, size, d) in sorted(best.items())]


def item_blocks(benchmark: DataFrame):
    """The items in blocks whose size is bounded by number and by bytes."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    size = items.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("b")).first()
    blocks = max(1, math.ceil(size["n"] / ITEM_BLOCK), math.ceil((size["b"] or 0) / ITEM_BYTES))
    key = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for b in range(blocks):
        yield sorted(((r["item_id"], r["text"]) for r in items.where(key == b).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))


_MADE: dict[str, ItemIndex] = {}


class _Held:
    """A broadcast block of items; each worker process builds its index once."""

    def __init__(self, docs: DataFrame, rows: list[tuple]):
        self.key = uuid.uuid4().hex
        self.rows = docs.sparkSession.sparkContext.broadcast(rows)

    def index(self) -> ItemIndex:
        if self.key not in _MADE:
            _MADE.clear()
            _MADE[self.key] = ItemIndex(self.rows.value)
        return _MADE[self.key]


def contamination(docs: DataFrame, benchmark: DataFrame, radius: int = RADIUS, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document and item found in it: doc_id, item_id, similarity, start, words, distance."""
    out = None
    kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int32())
    names = ["doc_id", "item_id", "similarity", "start", "words", "distance"]
    for rows in item_blocks(benchmark):
        held = _Held(docs, rows)

        def search(batches, held=held):
            index = held.index()
            for b in text_slices(batches):
                found = [(d, *h) for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist())
                         for h in index.hits(t, radius, threshold)]
                cols = list(zip(*found)) or [()] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)

        part = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(search, HITS)
        out = part if out is None else out.unionByName(part)
    return out


def uncontaminated(docs: DataFrame, benchmark: DataFrame, radius: int = RADIUS, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns."""

    def clean(held: _Held):
        @F.pandas_udf("boolean")
        def check(texts: pd.Series) -> pd.Series:
            index = held.index()
            return pd.Series([not index.hits(t, radius, threshold) for t in texts], dtype=bool)

        return check

    for rows in item_blocks(benchmark):
        docs = docs.where(clean(_Held(docs, rows))(F.col("text").cast("string")))
    return docs
