"""Token-id shards with a minimal perfect hash index over document ids.

``write_store`` encodes documents in ascending id order into shard files of the raw
ids; ``read_store`` reads every document back through the index of its shard, and
``lookup`` reads given ids only.

Shard file (all numbers little-endian): a header of ``HEADER`` (magic, bytes per
id, documents, distinct non-null keys, rows with null id, ids, levels), then
  ids       raw ids, 2 bytes each if the vocabulary fits, else 4
  ends      u64 per document: ids up to its end
  doc_ids   i64 per document, ascending (rows with null id first, stored as 0)
  slots     per key, in the order of the hash: u32 fingerprint, u32 rows, u64 first row
  sizes     u64 bits of each hash level
  bits      the levels' bit arrays, each padded to 64 bits
  ranks     u64 set bits before each 64-bit word
The hash is built level by level: keys that fall alone on a bit of a level own it,
the others go to the next level; a key's slot is the rank of its bit. A foreign id
is refused by the fingerprint (error 2**-32) and by the key stored with the row.

Defined cases: null text is empty (end id only); repeated ids keep all rows, ordered
by a hash of the text and the text; null ids come first; an empty table gives no rows.
"""

from __future__ import annotations

import math
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.bpe import encoder, text_slices
from tessera.llm.common import landed
from tessera.llm.files import committed, opened
from tessera.session import scratch_folder

HEADER = struct.Struct("<8sQQQQQQ")
MAGIC = b"IDSHARD1"
SHARD_BYTES = 24 << 20  # text bytes in a shard
SLOT = np.dtype([("mark", "<u4"), ("rows", "<u4"), ("first", "<u8")])
MANIFEST = "path string, shard int, n_docs long, n_ids long, low long, high long, nulls long"
ROWS = "doc_id long, shard_path string, start long, n_tokens long, ids_crc32 long"


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit mixing of keys (multiply and xor-shift rounds)."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray, ranks: np.ndarray):
        self.sizes, self.bits, self.ranks = sizes, bits, ranks
        self.base = np.concatenate([[0], np.cumsum(sizes)]).astype(np.uint64)

    @classmethod
    def build(cls, keys: np.ndarray, room: float = 2.0) -> "PerfectHash":
        sizes, flags, left = [], [], keys.astype(np.uint64)
        while left.size:
            m = 64 * max(1, math.ceil(room * left.size / 64))
            at = (mixed(left, len(sizes)) % np.uint64(m)).astype(np.int64)
            taken = np.bincount(at, minlength=m)
            flags.append(taken == 1)
            sizes.append(m)
            left = left[taken[at] != 1]
            if len(sizes) > 200:
                raise ValueError("keys are not distinct")
        flat = np.concatenate(flags) if flags else np.zeros(0, bool)
        bits = np.packbits(flat, bitorder="little").view("<u8") if flat.size else np.zeros(0, "<u8")
        per_word = flat.reshape(-1, 64).sum(axis=1) if flat.size else np.zeros(0, np.int64)
        ranks = (np.cumsum(per_word) - per_word).astype("<u8")
        return cls(np.array(sizes, dtype="<u8"), bits, ranks)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 where no level has its bit."""
        keys = keys.astype(np.uint64)
        out, todo = np.full(keys.size, -1, np.int64), np.arange(keys.size)
        for level, m in enumerate(self.sizes):
            if not todo.size:
                break
            at = mixed(keys[todo], level) % np.uint64(m) + self.base[level]
            word, bit = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            hit = (self.bits[word] >> bit) & np.uint64(1) == 1
            below = self.bits[word[hit]] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
            ones = np.unpackbits(below.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=1) if below.size else 0
            out[todo[hit]] = self.ranks[word[hit]].astype(np.int64) + ones
            todo = todo[~hit]
        return out


def _marks(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys, 1000) >> np.uint64(32)).astype("<u4")


def write_shard(path: str, ids: list[bytes], doc_ids: list[int | None], wide: bool) -> int:
    """Write one shard from each document's u32 id bytes, in ascending id order; number of ids."""
    lengths = np.array([len(x) // 4 for x in ids], dtype=np.int64)
    payload = np.frombuffer(b"".join(ids), dtype="<u4")
    nulls = sum(x is None for x in doc_ids)
    keys = np.array([0 if x is None else x for x in doc_ids], dtype="<i8")
    distinct, first, rows = np.unique(keys[nulls:], return_index=True, return_counts=True)
    ph = PerfectHash.build(distinct.view(np.uint64))
    slots = np.zeros(distinct.size, SLOT)
    at = ph.slots(distinct.view(np.uint64))
    slots["mark"][at], slots["rows"][at], slots["first"][at] = _marks(distinct.view(np.uint64)), rows, first + nulls
    with committed(path) as out:
        out.write(HEADER.pack(MAGIC, 4 if wide else 2, len(ids), distinct.size, nulls, payload.size, ph.sizes.size))
        for part in (payload if wide else payload.astype("<u2"), np.cumsum(lengths).astype("<u8"), keys, slots,
                     ph.sizes, ph.bits, ph.ranks):
            out.write(part.tobytes())
    return int(payload.size)


class Shard:
    """Keyed access to one shard file; ids are read from the file only when asked for."""

    def __init__(self, path: str):
        self.file = opened(path)
        magic, self.width, docs, keys, self.nulls, ids, levels = HEADER.unpack(self.file.read_at(HEADER.size, 0))
        if magic != MAGIC:
            raise ValueError(f"{path} is no id shard")
        self.at = HEADER.size + self.width * ids
        self.ends, self.doc_ids, self.slots = self._next("<u8", docs), self._next("<i8", docs), self._next(SLOT, keys)
        sizes = self._next("<u8", levels)
        words = int(sizes.sum()) // 64
        self.hash = PerfectHash(sizes, self._next("<u8", words), self._next("<u8", words))

    def _next(self, kind, n: int) -> np.ndarray:
        kind = np.dtype(kind)
        got = np.frombuffer(self.file.read_at(kind.itemsize * n, self.at), dtype=kind)
        self.at += kind.itemsize * n
        return got

    def rows_of(self, keys: np.ndarray) -> list[range]:
        """The rows of each (non-null) key; empty where the shard has none."""
        k = keys.astype(np.int64).view(np.uint64)
        out, marks = [], _marks(k)
        for key, slot, mark in zip(keys.tolist(), self.hash.slots(k).tolist(), marks.tolist()):
            s = self.slots[slot] if slot >= 0 else None
            known = s is not None and s["mark"] == mark and self.doc_ids[int(s["first"])] == key
            out.append(range(int(s["first"]), int(s["first"]) + int(s["rows"])) if known else range(0))
        return out

    def place(self, row: int) -> tuple[int, int]:
        """(ids before the row in this shard, its ids)."""
        start = int(self.ends[row - 1]) if row else 0
        return start, int(self.ends[row]) - start

    def ids(self, row: int) -> np.ndarray:
        start, n = self.place(row)
        got = self.file.read_at(self.width * n, HEADER.size + self.width * start)
        return np.frombuffer(got, dtype="<u4" if self.width == 4 else "<u2").astype("<u4")


def write_store(docs: DataFrame, tokenizer_path: str, end_id: int, folder: str, wide: bool | None = None,
                shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write all shards; returns the manifest, one landed row per shard with the ids before it (``base``)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    shards = max(1, math.ceil(size / shard_bytes))
    end = np.array([end_id], dtype="<u4").tobytes()

    def write(batches):
        enc, part = encoder(tokenizer_path), TaskContext.get().partitionId()
        big = wide if wide is not None else max(enc.tok.get_vocab_size(), end_id + 1) > 65536
        ids, keys = [], []
        for b in text_slices(batches, 2048):
            keys += b.column(0).to_pylist()
            ids += [enc.encode(t) + end for t in b.column(1).to_pylist()]
        if ids:
            path = f"{folder}/shard-{part:06d}.ids"
            n = write_shard(path, ids, keys, big)
            known = [k for k in keys if k is not None]
            row = (path, part, len(ids), n, known[0] if known else None, known[-1] if known else None, len(keys) - len(known))
            kinds = (pa.string(), pa.int32(), *[pa.int64()] * 5)
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)],
                                             names=["path", "shard", "n_docs", "n_ids", "low", "high", "nulls"])

    mark = F.xxhash64("text")
    parts = (docs.repartitionByRange(shards, F.col("doc_id").asc_nulls_first(), mark)
             .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), mark, "text").mapInArrow(write, MANIFEST))
    manifest = landed(parts, "id-shards")
    before = F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    return manifest.withColumn("base", F.coalesce(before, F.lit(0)))


def read_store(manifest: DataFrame) -> DataFrame:
    """Every stored document, found through its shard's index, with a checksum of its ids."""

    def read(batches):
        for b in batches:
            for path, base in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                s = Shard(path)
                keys = np.unique(s.doc_ids[s.nulls:])
                found = [(None, r) for r in range(s.nulls)]
                for key, rows in zip(keys.tolist(), s.rows_of(keys)):
                    found += [(key, r) for r in rows]
                out = []
                for key, r in found:
                    start, n = s.place(r)
                    out.append((key, path, base + start, n, zlib.crc32(s.ids(r).tobytes())))
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()))],
                    names=["doc_id", "shard_path", "start", "n_tokens", "ids_crc32"])

    shards = manifest.select("path", "base", "shard")
    n = max(1, manifest.count())
    return shards.repartitionByRange(n, "shard").select("path", "base").mapInArrow(read, ROWS)


def lookup(manifest: DataFrame, keys: DataFrame) -> DataFrame:
    """Stored rows of the given ``doc_id`` values: doc_id, n_tokens, ids.

    A key goes to the shards whose id range holds it (one, but for an id whose rows
    straddle a boundary) and there costs one hash and one read.
    """
    table = [(r["path"], r["low"], r["high"]) for r in manifest.where("low is not null").orderBy("shard").collect()]
    low = np.array([t[1] for t in table], dtype=np.int64)
    high = np.array([t[2] for t in table], dtype=np.int64)
    paths = [t[0] for t in table]

    def route(batches):
        for b in batches:
            k = np.array([x for x in b.column(0).to_pylist() if x is not None], dtype=np.int64)
            a, z = np.searchsorted(high, k, "left"), np.searchsorted(low, k, "right")
            pairs = [(int(x), paths[j]) for x, i, e in zip(k, a, z) for j in range(i, e)]
            cols = list(zip(*pairs)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string())],
                                             names=["doc_id", "path"])

    def fetch(batches):
        held: dict[str, Shard] = {}
        for b in batches:
            out = []
            for key, path in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if path not in held:
                    held.clear()
                    held[path] = Shard(path)
                s = held[path]
                for r in s.rows_of(np.array([key], dtype=np.int64))[0]:
                    out.append((key, s.place(r)[1], s.ids(r).tolist()))
            cols = list(zip(*out)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.list_(pa.int64())))],
                names=["doc_id", "n_tokens", "ids"])

    routed = keys.select(F.col("doc_id").cast("long")).distinct().mapInArrow(route, "doc_id long, path string")
    return (routed.repartition("path").sortWithinPartitions("path")
            .mapInArrow(fetch, "doc_id long, n_tokens long, ids array<long>"))


def token_store(spark: SparkSession, docs: DataFrame, tokenizer_path: str, end_id: int, folder: str | None = None) -> DataFrame:
    """Write a store and read it back whole."""
    return read_store(write_store(docs, tokenizer_path, end_id, folder or scratch_folder(spark, "store")))
