"""Language identification with bit-sliced Bloom filters of character n-grams.

One Bloom filter per language, stored by slice: cell i holds a bit mask of the languages whose
filter has bit i set (one 64-bit word for each 64 languages), so one lookup (the AND of a gram's
``HASHES`` cells) gives all languages that contain the gram. A text is decided by counting, per language, the grams whose
mask has its bit; the count is corrected for the false positives expected from that
language's fill, and the largest corrected count wins (ties: the language with more training texts).

Grams are runs of ``GRAM`` bytes of the lower-cased UTF-8 text in which everything but letters is one
space. A gram belongs to a language if its share of that language's grams is at least
``SHARE`` of the largest share any language gives it and it was seen ``SEEN`` times.

The filters are fitted on about ``per_language`` texts of each language (those with the smallest
hashes); every text is classified whole. Any number of languages is learned; the broadcast model takes
8 MB for each 64 of them, and the driver holds one row a language.

Defined cases: null texts and texts without a letter are ``und`` with score 0; so is every text
when nothing can be learned; a text without a known gram gets the language with most
training texts and score 0; repeated rows are classified each; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.bpe import text_slices
from tessera.llm.common import fold, landed

GRAM, HASHES, CELLS = 4, 3, 1 << 20
SHARE, SEEN, PER_LANGUAGE = 0.3, 3, 4_000
STRETCH = 1 << 20  # bytes of a text whose grams are held at once

#: the eight bits of each byte value
_BIT_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(float)
_TABLE = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def letters_of(text: str | None) -> bytes:
    """Lower-cased UTF-8 with a space for every ASCII character that is no letter; empty if there is no letter."""
    if not text:
        return b""
    raw = text.lower().encode("utf-8", "surrogatepass").translate(_TABLE)
    if not raw.isascii() or not raw.strip():
        if not any(map(str.isalpha, text)):
            return b""
    return raw


def grams(raw: bytes):
    """The grams of a text as 32-bit numbers, in stretches; words are set apart by single spaces."""
    raw = b" " + b" ".join(raw.split()) + b" "
    for a in range(0, max(1, len(raw) - GRAM + 1), STRETCH):
        b = np.frombuffer(raw[a:a + STRETCH + GRAM - 1], np.uint8).astype(np.uint32)
        n = b.size - GRAM + 1
        if n > 0:
            yield (b[:n] << np.uint32(24)) | (b[1:n + 1] << np.uint32(16)) | (b[2:n + 2] << np.uint32(8)) | b[3:n + 3]


def positions(g: np.ndarray, hashes: int = HASHES, cells: int = CELLS) -> list[np.ndarray]:
    """The cells of each gram (double hashing)."""
    with np.errstate(over="ignore"):
        x = g.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        step = (x >> np.uint64(32)) | np.uint64(1)
        return [((x + np.uint64(i) * step) & np.uint64(cells - 1)).astype(np.int64) for i in range(hashes)]


@dataclass
class LanguageModel:
    languages: list[str]   # bit order; most training texts first
    masks: np.ndarray      # languages per cell: cells x words of 64 languages

    def __post_init__(self):
        self.false = (self._bits(self.masks) / max(1, len(self.masks))) ** HASHES

    def _bits(self, masks: np.ndarray) -> np.ndarray:
        """How many of the mask rows have each language's bit."""
        columns = masks.astype("<u8").view(np.uint8).reshape(len(masks), -1)
        used = range((len(self.languages) + 7) // 8)
        counts = [np.bincount(columns[:, k], minlength=256) @ _BIT_OF_BYTE for k in used]
        return np.concatenate([np.zeros(0), *counts])[:len(self.languages)]

    def counts(self, text: str | None) -> np.ndarray | None:
        """Corrected grams per language; None for a text without a letter."""
        raw = letters_of(text)
        if not raw or not self.languages:
            return None
        hits, n = np.zeros(len(self.languages)), 0
        for g in grams(raw):
            seen = None
            for at in positions(g, HASHES, len(self.masks)):
                cell = self.masks[at]
                seen = cell if seen is None else seen & cell
            n += g.size
            hits += self._bits(seen)
        return np.maximum(0.0, (hits - n * self.false) / (1 - np.minimum(self.false, 0.999)))

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, its share of all corrected counts)."""
        c = self.counts(text)
        if c is None:
            return "und", 0.0
        k, total = int(c.argmax()), float(c.sum())
        return self.languages[k], float(c[k] / total) if total else 0.0


def fit_languages(docs: DataFrame, folds: int = 4, held_out: int = 2, per_language: int = PER_LANGUAGE) -> LanguageModel:
    """Fit on the training folds' rows with a language."""
    known = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                         F.col("lang").cast("string").alias("lang"))
             .where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), folds) != held_out)))
    sizes = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()
    languages = [r["lang"] for r in sizes]
    if not languages:
        return LanguageModel([], np.zeros((CELLS, 1), np.uint64))
    # rows by a hash threshold per language: about ``per_language`` each, without a sort
    table = docs.sparkSession.createDataFrame([(r["lang"], k, min(1.0, per_language / r["count"])) for k, r in enumerate(sizes)], "lang string, k int, share double")
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 32)) / F.lit(float(1 << 32))
    rows = known.join(F.broadcast(table), "lang").where(draw < F.col("share")).select("k", "text")   # one row a language

    def count(batches):
        """Per task: how often each (language, gram) stands in its texts."""
        held: dict[int, list[np.ndarray]] = {}
        size = 0

        def flush():
            out = [np.unique(np.concatenate(g), return_counts=True) for g in held.values()]
            ks = np.concatenate([np.full(u.size, k, np.int32) for k, (u, _) in zip(held, out)])
            return pa.RecordBatch.from_arrays(
                [pa.array(ks), pa.array(np.concatenate([u for u, _ in out]).astype(np.int64)),
                 pa.array(np.concatenate([c for _, c in out]).astype(np.int64))], names=["k", "gram", "n"])

        for b in text_slices(batches):
            for k, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for g in grams(letters_of(text)):
                    held.setdefault(k, []).append(g)
                    size += g.size
            if size > 8 << 20:
                yield flush()
                held, size = {}, 0
        if size:
            yield flush()

    seen = rows.mapInArrow(count, "k int, gram long, n long").groupBy("k", "gram").agg(F.sum("n").alias("n"))
    seen = landed(seen, "gram-counts")
    totals = seen.groupBy("k").agg(F.sum("n").cast("double").alias("total"))
    best = seen.join(F.broadcast(totals), "k").select("k", "gram", "n", (F.col("n") / F.col("total")).alias("share")) \
        .withColumn("best", F.max("share").over(Window.partitionBy("gram")))
    member = best.where((F.col("share") >= SHARE * F.col("best")) & (F.col("n") >= SEEN))

    def cells(batches):
        for b in batches:
            k, g = b.column(0).to_numpy(), b.column(1).to_numpy().astype(np.uint32)
            at = np.concatenate(positions(g))
            mask = np.tile(np.uint64(1) << (k % 64).astype(np.uint64), HASHES)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.tile(k // 64, HASHES)), pa.array(mask.view(np.int64))], names=["cell", "word", "mask"])

    slices = member.select("k", "gram").mapInArrow(cells, "cell long, word int, mask long").groupBy("cell", "word").agg(F.bit_or("mask").alias("mask"))
    got = slices.toPandas()  # at most CELLS rows for each 64 languages
    masks = np.zeros((CELLS, -(-len(languages) // 64)), np.uint64)
    masks[got["cell"].to_numpy(), got["word"].to_numpy()] = got["mask"].to_numpy().astype(np.int64).view(np.uint64)
    return LanguageModel(languages, masks)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred, score of each whole text. The model (8 bytes a cell and 64 languages) is broadcast."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def read(batches):
        m = held.value
        for b in text_slices(batches):
            got = [m.predict(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
                names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(read, "doc_id long, lang_pred string, score double")


def languages(docs: DataFrame, folds: int = 4, held_out: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row."""
    out = identify(docs, fit_languages(docs, folds, held_out))
    return out.select("doc_id", (fold(F.col("doc_id"), folds) == held_out).alias("held_out"), "lang_pred", "score")
