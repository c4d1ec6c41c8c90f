"""Best-fit packing of token sequences by the sum-of-squares rule.

Documents are encoded, an end id is appended, and only documents longer than the
capacity are cut. Every piece is then placed in the open bin (or a new one) for
which the sum of the squared counts of open bins per residual gap becomes
smallest; ties go to the smaller gap. Each Spark partition packs its own pieces,
longest first; bins that stay open are packed once more as whole items, so a
partition's end leaves no waste of its own. State per task: one counter and one
stack of open bins per gap.

Defined cases: null or empty text is one piece with the end id only; repeated
rows are packed each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.bpe import encoder, text_slices
from tessera.llm.common import landed

PIECES_PER_TASK = 200_000
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer_path: str, end_id: int = 0, capacity: int = 2048) -> DataFrame:
    """One row per piece: whole documents, or runs of ``capacity`` ids of longer ones."""
    end = np.array([end_id], dtype="<u4").tobytes()
    width = 4 * capacity

    def cut(batches):
        enc = encoder(tokenizer_path)
        for b in text_slices(batches, 2048):
            rows = []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = enc.encode(text) + end
                for k, at in enumerate(range(0, len(ids), width)):
                    part = ids[at:at + width]
                    rows.append((doc_id, k, at // 4, len(part) // 4, zlib.crc32(part)))
            cols = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, PIECE_SCHEMA)


class SumOfSquares:
    """Open bins of one task, as counts and stacks by residual gap."""

    def __init__(self, capacity: int, first_id: int):
        self.capacity, self.next_id = capacity, first_id
        self.count = np.zeros(capacity + 1, dtype=np.int64)  # count[0] stays 0: full bins are closed
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]

    def place(self, size: int) -> tuple[int, int]:
        """(bin, offset) of an item of 1..capacity units."""
        c, n = self.capacity, self.count
        # change of the sum when the item goes into a bin with gap g: closing a bin
        # takes 2n(g)-1 away; else one bin moves from gap g to g-size
        change = 2 * (n[:c - size] - n[size:c]) + 2
        if size < c:
            change[0] -= 1
            change = np.where(n[size:c] > 0, change, np.iinfo(np.int64).max)
            k = int(change.argmin())
            fresh = 2 * int(n[c - size]) + 1
            if change[k] <= fresh:
                gap = size + k
                b = self.open[gap].pop()
                n[gap] -= 1
                if k:
                    self.open[k].append(b)
                    n[k] += 1
                return b, c - gap
        b, self.next_id = self.next_id, self.next_id + 1
        if size < c:
            self.open[c - size].append(b)
            n[c - size] += 1
        return b, 0


def _packed(df: DataFrame, size: str, capacity: int, tasks: int, high: int) -> DataFrame:
    """Adds (bin, offset); the bins of a task are numbered from ``high | task << 40``."""

    def pack(frames):
        bins = SumOfSquares(capacity, high | TaskContext.get().partitionId() << 40)
        for pdf in frames:
            placed = [bins.place(s) for s in pdf[size].tolist()]
            at = np.array(placed, dtype=np.int64).reshape(-1, 2)
            yield pd.concat([pdf.reset_index(drop=True), pd.DataFrame({"bin": at[:, 0], "offset": at[:, 1]})], axis=1)

    schema = ", ".join(f"{n} {t}" for n, t in df.dtypes) + ", bin long, offset long"
    return (df.repartition(tasks).sortWithinPartitions(F.col(size).desc(), *[c for c in df.columns if c != size])
            .mapInPandas(pack, schema))


def pack(piece_rows: DataFrame, capacity: int = 2048, pieces_per_task: int = PIECES_PER_TASK) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to landed piece rows."""
    tasks = max(1, math.ceil(piece_rows.count() / pieces_per_task))
    first = landed(_packed(piece_rows, "length", capacity, tasks, 0), "packed")
    # bins that stayed open are items of the second round
    open_bins = first.groupBy("bin").agg(F.sum("length").alias("fill")).where(F.col("fill") < capacity)
    n_open = first.agg((F.countDistinct("bin")).alias("n")).first()["n"]
    again = _packed(open_bins.withColumnRenamed("bin", "item"), "fill", capacity,
                    max(1, math.ceil(n_open / pieces_per_task)), 1 << 62)
    again = again.select(F.col("item").alias("bin"), F.col("bin").alias("merged"), F.col("offset").alias("shift"))
    return (first.join(again, "bin", "left")
            .select(*piece_rows.columns, F.coalesce("merged", "bin").alias("sequence_id"),
                    (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset")))


def best_fit_packing(docs: DataFrame, tokenizer_path: str, end_id: int = 0, capacity: int = 2048) -> DataFrame:
    """Every document's pieces with their place: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(landed(pieces(docs, tokenizer_path, end_id, capacity), "pieces"), capacity)
