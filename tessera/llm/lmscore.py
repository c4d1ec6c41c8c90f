"""Cross-entropy difference of documents under a target and a background bigram model.

Background: all documents; target: the texts of an in-domain table. Both models count the same events
over one vocabulary, the words of both corpora (runs without ASCII white space, lower-cased in
A-Z): the words of a text and its end, each after the word before it (or the start).
    p_b(w) = c_b(w) / N_b                      p_b(w|v) = (c_b(vw) + MU p_b(w)) / (c_b(v) + MU)
    p_t(w) = (c_t(w) + NU p_b(w)) / (N_t + NU)   p_t(w|v) = (c_t(vw) + MU p_t(w)) / (c_t(v) + MU)
A document's score is its mean loss under the target less its mean loss under the background; low
scores read like the target.

Texts are dealt to blocks by a hash. A block counts its distinct words and word pairs (64-bit hashes)
and sends them, sorted and packed, to count buckets (ranges of the hash); a bucket sums all blocks and answers each block with
the totals of the keys it sent, in the same order; the block then scores its texts. A key crosses the
network once per block that holds it, however often it occurs, and no task holds more than a block or a bucket.

Defined cases: null and wordless documents have one event, their end; without target texts the target
model is the background's unigram model under the same smoothing; repeated rows count and are scored each; an empty
documents table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.words import WORD_HASHES, spaced_words

MU, NU = 2.0, 1000.0
BLOCK_BYTES = 12 << 20
START, END = np.uint64(0x5354415254), np.uint64(0x454E44)
SCORES = "doc_id long, n_events long, h_target double, h_background double, score double"
SENT = "bucket int, block int, keys binary, seen binary"
TOTALS = "block int, bucket int, background binary, target binary"


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def events(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Keys of each event's word and of its word pair; the end is the last event."""
    words = spaced_words(text)
    h = np.empty(len(words) + 2, np.uint64)
    h[0], h[-1] = START, END
    h[1:-1] = np.fromiter(map(WORD_HASHES.__getitem__, words), dtype=np.uint64, count=len(words))
    with np.errstate(over="ignore"):
        return mix(h[1:]), mix(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + mix(h[1:] + np.uint64(1)))


def _block_keys(texts: list[str | None]):
    """All events of a block: distinct keys, counts, and each text's places among the keys."""
    word, pair, sizes = [], [], []
    for t in texts:
        w, p = events(t)
        word.append(w)
        pair.append(p)
        sizes.append(w.size)
    both = np.concatenate(word + pair) if texts else np.zeros(0, np.uint64)
    keys, at, counts = np.unique(both, return_inverse=True, return_counts=True)
    n = both.size // 2
    return keys, counts, at[:n], at[n:], np.array(sizes, dtype=np.int64)


def _bounds(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's run of the ascending keys begins, and the end of the last."""
    b = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    return np.searchsorted(b, np.arange(buckets + 1))


def packed(a: np.ndarray) -> bytes:
    """Little-endian numbers by byte planes, which shuffle compression shrinks: leading bytes of
    ascending keys and of small counts hardly change."""
    return np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T.tobytes()


def unpacked(b: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(b, np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def n_events(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[^ \\t-\\r]+")) + 1


def cross_entropy_difference(docs: DataFrame, target: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_events, h_target, h_background, score for every row of ``docs``; ``target`` has ``text``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    target = target.select(F.col("text").cast("string").alias("text"))

    def size(df):
        r = df.agg(F.sum(F.octet_length("text")).alias("b"), F.sum(n_events(F.col("text"))).alias("n")).first()
        return r["b"] or 0, r["n"] or 0

    (doc_bytes, n_back), (target_bytes, n_target) = size(docs), size(target)
    blocks = max(1, math.ceil(doc_bytes / block_bytes))
    target_blocks = max(1, math.ceil(target_bytes / block_bytes))
    buckets = max(4, blocks)
    docs = docs.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int"))
    # blocks of the target are numbered below zero; its rows are spread evenly
    aim = target.withColumn("block", (-1 - F.pmod(F.xxhash64("text", F.monotonically_increasing_id()), F.lit(target_blocks))).cast("int"))

    def count(key, table):
        keys, counts, *_ = _block_keys(table["text"].to_pylist())
        at = _bounds(keys, buckets)
        parts = [slice(a, z) for a, z in zip(at, at[1:])]
        return pa.table([pa.array(range(buckets), pa.int32()), pa.array([key[0].as_py()] * buckets, pa.int32()),
                         pa.array([packed(keys[p]) for p in parts], pa.binary()),
                         pa.array([packed(counts[p].astype("<u4")) for p in parts], pa.binary())],
                        names=["bucket", "block", "keys", "seen"])

    def total(key, table):
        rows = [(b, unpacked(k, "<u8"), unpacked(n, "<u4"))
                for b, k, n in zip(table["block"].to_pylist(), table["keys"].to_pylist(), table["seen"].to_pylist())]
        keys = np.unique(np.concatenate([k for _, k, _ in rows]))
        back, aimed = np.zeros(keys.size, np.int64), np.zeros(keys.size, np.int64)
        places = [np.searchsorted(keys, k) for _, k, _ in rows]
        for (b, _, n), at in zip(rows, places):
            (back if b >= 0 else aimed)[at] += n
        asked = [(b, at) for (b, _, _), at in zip(rows, places) if b >= 0]
        return pa.table([pa.array([b for b, _ in asked], pa.int32()), pa.array([key[0].as_py()] * len(asked), pa.int32()),
                         pa.array([packed(back[at]) for _, at in asked], pa.binary()),
                         pa.array([packed(aimed[at]) for _, at in asked], pa.binary())],
                        names=["block", "bucket", "background", "target"])

    def score(key, texts, totals):
        keys, _, word, pair, sizes = _block_keys(texts["text"].to_pylist())
        at = _bounds(keys, buckets)
        back, aimed = np.zeros(keys.size), np.zeros(keys.size)
        for b, x, y in zip(totals["bucket"].to_pylist(), totals["background"].to_pylist(), totals["target"].to_pylist()):
            back[at[b]:at[b + 1]], aimed[at[b]:at[b + 1]] = unpacked(x, "<i8"), unpacked(y, "<i8")
        ends = np.cumsum(sizes)
        begins = ends - sizes
        # the word before each event; before the first stands the start, as frequent as the end
        before = np.empty_like(word)
        before[1:] = word[:-1]
        before[begins[sizes > 0]] = word[ends[sizes > 0] - 1]
        p_b = back[word] / n_back
        h_b = -np.log((back[pair] + MU * p_b) / (back[before] + MU))
        p_t = (aimed[word] + NU * p_b) / (n_target + NU)
        h_t = -np.log((aimed[pair] + MU * p_t) / (aimed[before] + MU))
        mean_t, mean_b = np.add.reduceat(h_t, begins) / sizes, np.add.reduceat(h_b, begins) / sizes
        return pa.table([texts["doc_id"], pa.array(sizes), pa.array(mean_t), pa.array(mean_b), pa.array(mean_t - mean_b)],
                        names=["doc_id", "n_events", "h_target", "h_background", "score"])

    # the same columns as below, so that the texts are dealt to their blocks once
    sent = docs.groupBy("block").applyInArrow(count, SENT).unionByName(
        aim.select("block", "text").groupBy("block").applyInArrow(count, SENT))
    totals = sent.groupBy("bucket").applyInArrow(total, TOTALS)
    return docs.groupBy("block").cogroup(totals.groupBy("block")).applyInArrow(score, SCORES)
