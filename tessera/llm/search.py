"""Exact top-k BM25 search over a sharded inverted index with block-max WAND.

``build_index`` turns every stretch of ``SHARD_DOCS`` documents into one index shard: sorted terms,
postings (document, count) and document lengths, as packed columns. Document frequencies and the mean length
are summed over all shards, so scores of different shards compare. ``search`` runs each query on every shard and
merges the best ``k`` exactly.

The commonest terms of a shard (in a ``TABLE_SHARE``-th of its documents, ``TABLE_TERMS`` at most) have a row of impacts each,
a place for every document, and its maxima over blocks of ``BLOCK`` documents. ``TABLE_QUERIES`` queries, alike in language and length,
meet a shard together, each with the k-th best score so far as the threshold (``Shard.together``):

1. Blocks of documents: one matrix product of the queries with the block maxima, and each query's largest impacts of its other
   terms, bound every score in a block. Blocks that none of the queries can need are shut; a query that needs none is done.
2. Sums in single precision over the documents left: a term that many of these queries and of the documents have is
   summed in a second product with its row, where this takes less time than its postings (``POSTING_COST``); of the
   others every posting is added to its query's and document's place.
3. A document whose sum reaches the threshold, less the most that single precision can have lost, is scored exactly from
   its own postings. While there is no threshold yet, these are the documents that reach the k-th largest sum, likewise.

Fewer than ``FEW_QUERIES`` queries left by step 1 go one at a time by pivots (``Shard.top``). Each term's postings are cut into blocks
of ``BLOCK`` postings with their first and last document and their largest impact. Every document gets the sum of the maxima of the
blocks that span it, as one difference array over block ends and its cumulative sum; of terms with one block
only the documents are read, so their maximum stands at these and not between. Documents below the threshold are no pivots.
The pivots' postings in one-block terms are scored, which lowers the bounds and leaves fewer pivots. Of the other
terms only blocks that span a pivot are opened, and in them only the pivots' postings are scored. While there
is no threshold yet, the pivots with the largest bounds go first.

Inside a shard documents stand by their commonest word and their length: block maxima are tight where
neighbours are alike, and a block seldom spans documents of another language.

The threshold goes along from shard to shard of a task. One of ``FIRST_SHARDS`` shards goes first, and the k-th best score in these is
the threshold that every task starts with on the others. A score is the exactly rounded sum of its parts (``fsum``), so
equal documents of different shards tie.

BM25: idf = ln(1 + (N - df + 0.5) / (df + 0.5)), impact = tf (k1 + 1) / (tf + k1 (1 - b + b len / mean)).
A query made from a document (``document_queries``) has all distinct terms of its whole text; a term counts once in
a query. Ties in score go to the smaller doc_id (null last).

Queries pass in blocks of bounded numbers of queries and of terms; a block is broadcast, meets all shards, and its hits are stored
before the next block starts. A task has at most ``TASK_SHARDS`` shards and sends k rows a query.

Defined cases: null and wordless texts are documents of length zero that nothing finds, and queries
without rows; a null doc_id is never a query, as a hit it comes last of a tie; repeated ids are one query of all their
texts, repeated rows are documents of their own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from contextlib import contextmanager
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.bpe import text_slices
from tessera.llm.common import landed
from tessera.llm.words import word_counts, words_of

SHARD_DOCS, SHARD_BYTES, BLOCK = 8192, 12 << 20, 64
K1, B = 1.2, 0.75
QUERY_BLOCK, QUERY_TERMS = 8192, 1 << 21   # queries of one broadcast, and the terms of all of them
TASK_SHARDS, FIRST_SHARDS = 16, 16
TABLE_TERMS, TABLE_SHARE, TABLE_QUERIES = 2048, 64, 256   # a table is 64 MB at most
POSTING_COST, SLICE, FEW_QUERIES = 400, 1 << 16, 8   # places of a product that take the time of one posting; postings looked up at once
SLACK = 2e-9   # scores are compared after rounding to nine places
FIELDS = ("doc_ids", "known", "lengths", "terms", "dfs", "docs", "counts")
INDEX = ", ".join(f"{f} binary" for f in FIELDS)
HITS = "query_id long, doc_id long, score double"


def _packed(x: np.ndarray | bytes) -> bytes:
    import zstandard

    return zstandard.compress(x if isinstance(x, bytes) else np.ascontiguousarray(x).tobytes(), 1)


def _unpacked(x, kind: str = "<i4") -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.decompress(x), kind)


def _lines(words: pa.Array) -> bytes:
    lines = pc.binary_join_element_wise(words, b"", b"\n")
    ends = np.frombuffer(lines.buffers()[1], np.int32)[lines.offset:lines.offset + len(lines) + 1]
    return lines.buffers()[2].to_pybytes()[ends[0]:ends[-1]] if len(lines) else b""


def _terms(x) -> pa.Array:
    return pa.array(bytes(_unpacked(x, "u1")).split(b"\n")[:-1], pa.binary())   # no term holds a line feed


@contextmanager
def _rows_a_batch(spark: SparkSession, rows: int):
    """Python gets batches of so many rows: some texts, or a shard at a time and not all shards of a task."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def build_index(docs: DataFrame) -> DataFrame:
    """The landed index, one row per shard."""

    def shard(ids: list, parts: list) -> pa.RecordBatch:
        lengths, sizes, codes, counts = [np.concatenate([p[i] for p in parts], dtype=np.int64) for i in range(4)]
        each = pa.concat_arrays([p[4] for p in parts]).dictionary_encode()   # the words of each part
        words = each.dictionary
        order = pc.array_sort_indices(words).to_numpy()
        rank = np.empty(order.size, np.int64)
        rank[order] = np.arange(order.size)
        codes += np.repeat(np.cumsum([0, *[len(p[4]) for p in parts[:-1]]]), [p[2].size for p in parts])
        term = rank[each.indices.to_numpy()][codes]
        # neighbours alike: by their commonest word (its language), then by length
        worded, lead = np.flatnonzero(sizes), np.full(len(ids), -1)
        if worded.size:
            lead[worded] = np.maximum.reduceat(counts * order.size + term, (np.cumsum(sizes) - sizes)[worded]) % order.size
        by_lead = np.lexsort((lengths, lead))
        place = np.empty(len(ids), np.int64)
        place[by_lead] = np.arange(len(ids))
        key = term * len(ids)   # (term, document)
        key += np.repeat(place, sizes)
        by_term = np.argsort(key)
        ids = [ids[i] for i in by_lead]
        known = np.array([i is not None for i in ids], np.uint8)
        row = (np.array([i or 0 for i in ids], "<i8"), known, lengths[by_lead].astype("<i4"),
               _lines(words.take(pa.array(order))), np.bincount(term, minlength=order.size).astype("<i4"),
               (key[by_term] % len(ids)).astype("<i4"), counts[by_term].astype("<i4"))
        return pa.RecordBatch.from_arrays([pa.array([_packed(v)], pa.binary()) for v in row], names=list(FIELDS))

    def build(batches):
        ids, parts, size = [], [], 0
        for b in text_slices(batches, 512):
            ids += b.column(0).to_pylist()
            parts.append(word_counts(b.column(1).cast(pa.binary()).to_pylist()))
            size += b.nbytes
            if len(ids) >= SHARD_DOCS or size >= SHARD_BYTES:
                yield shard(ids, parts)
                ids, parts, size = [], [], 0
        if ids:
            yield shard(ids, parts)

    with _rows_a_batch(docs.sparkSession, 512):
        return landed(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(build, INDEX), "bm25-index")


def statistics(index: DataFrame) -> tuple[DataFrame, int, float]:
    """(term, df) over all shards, number of documents and their mean length."""

    def terms(batches):
        for b in batches:
            for t, f in zip(b.column(0), b.column(1)):
                yield pa.RecordBatch.from_arrays([_terms(t.as_py()), pa.array(_unpacked(f.as_py()), pa.int64())], names=["term", "df"])

    def sizes(batches):
        for b in batches:
            lengths = [_unpacked(x) for x in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([x.size for x in lengths], pa.int64()),
                                              pa.array([int(x.sum()) for x in lengths], pa.int64())], names=["n", "words"])

    dfs = index.select("terms", "dfs").mapInArrow(terms, "term binary, df long").groupBy("term").agg(F.sum("df").alias("df"))
    row = index.select("lengths").mapInArrow(sizes, "n long, words long").agg(F.sum("n").alias("n"), F.sum("words").alias("w")).first()
    n = row["n"] or 0
    return dfs, n, (row["w"] or 0) / n if n else 0.0


def document_queries(rows: DataFrame, dfs: DataFrame, n: int) -> DataFrame:
    """(query_id, terms, weights) of the given documents: all their distinct terms with the idf."""

    def read(batches):
        for b in text_slices(batches):
            out = [(i, w) for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for w in set(words_of(t))]
            cols = list(zip(*out)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.binary())], names=["query_id", "term"])

    terms = rows.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(read, "query_id long, term binary")
    idf = F.log(1 + (F.lit(float(n)) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    pairs = F.sort_array(F.collect_list(F.struct("term", idf.alias("idf"))))
    asked = terms.distinct().join(dfs, "term").groupBy("query_id").agg(pairs.alias("p"))
    return asked.select("query_id", F.col("p.term").alias("terms"), F.col("p.idf").alias("weights"))


class Shard:
    """One index shard in memory: postings by term and by document, and the blocks over them.

    ``read`` counts the postings whose impact was looked up for a query, ``met`` those of all its terms; ``shut`` the
    places of documents (one a query) that the table's product left out.
    """

    def __init__(self, row: dict, mean: float):
        self.ids, self.known = _unpacked(row["doc_ids"], "<i8"), _unpacked(row["known"], "u1").astype(bool)
        lengths = _unpacked(row["lengths"])
        self.terms, self.dfs = _terms(row["terms"]), _unpacked(row["dfs"]).astype(np.int64)
        self.docs, tf = _unpacked(row["docs"]), _unpacked(row["counts"])
        self.n, self.read, self.met, self.shut = lengths.size, 0, 0, 0
        norm = K1 * (1 - B + B * lengths / mean)
        self.impact = tf * (K1 + 1) / (tf + norm[self.docs])
        self.start = np.concatenate([[0], np.cumsum(self.dfs)])
        self.top_impact = np.maximum.reduceat(self.impact, self.start[:-1]) if self.dfs.size else np.zeros(0)
        # each posting in four bytes: the document in the last bits of its impact, which is cut there
        bits = max(self.n - 1, 1).bit_length()
        self.doc_bits, self.cut = np.int32((1 << bits) - 1), 2.0 ** (bits - 23)
        self.posting = (self.impact.astype(np.float32).view(np.int32) & ~self.doc_bits) | self.docs
        # rows of the commonest terms, and their maxima over blocks of documents
        common = np.flatnonzero(self.dfs * TABLE_SHARE >= self.n)
        common = common[np.argsort(-self.dfs[common], kind="stable")[:TABLE_TERMS]]
        self.row = np.full(self.dfs.size, -1)
        self.row[common] = np.arange(common.size)
        self.table, self.counted = np.zeros((common.size, self.n), np.float32), self.dfs[common]
        post = _ranges(self.start[common], self.start[common + 1])
        self.table[np.repeat(np.arange(common.size), self.counted), self.docs[post]] = self.impact[post]
        self.table_max = np.maximum.reduceat(self.table, np.arange(0, self.n, BLOCK), axis=1)
        self.about = np.empty(self.dfs.size, [("df", "<i4"), ("row", "<i4"), ("start", "<i4"), ("top", "<f4")])
        self.about["df"], self.about["row"], self.about["start"], self.about["top"] = self.dfs, self.row, self.start[:-1], self.top_impact

    @cached_property
    def blocks(self) -> tuple[np.ndarray, ...]:
        """First block of each term, first posting of each block, its first and last document and its largest impact."""
        blocks = -(-self.dfs // BLOCK)
        block = np.concatenate([[0], np.cumsum(blocks)])
        begin = np.repeat(self.start[:-1], blocks) + BLOCK * (np.arange(block[-1]) - np.repeat(block[:-1], blocks))
        most = np.maximum.reduceat(self.impact, begin) if begin.size else np.zeros(0)
        begin = np.append(begin, self.start[-1])
        return block, begin, self.docs[begin[:-1]], self.docs[begin[1:] - 1], most

    @cached_property
    def by_doc(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start of each document's postings in document order, their terms and impacts."""
        order = np.argsort(self.docs.astype(np.uint16) if self.n <= 1 << 16 else self.docs, kind="stable")
        terms = np.repeat(np.arange(self.dfs.size, dtype=np.int32), self.dfs)[order]
        return np.concatenate([[0], np.cumsum(np.bincount(self.docs, minlength=self.n))]), terms, self.impact[order]

    @cached_property
    def weight_of(self) -> np.ndarray:
        """A query's weight of every term, zeros between queries."""
        return np.zeros(self.dfs.size)

    def _sum(self, docs: np.ndarray, parts: np.ndarray) -> np.ndarray:
        return np.bincount(docs, weights=parts, minlength=self.n).astype(float)

    def tops(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int, best: list[list[tuple]]) -> list[list[tuple]]:
        """``top`` for each of the queries (terms, weights), together."""
        cut = np.concatenate([[0], np.cumsum([t.size for t, _ in queries])]).astype(np.int64)
        return self.together(cut, np.concatenate([t for t, _ in queries]), np.concatenate([w for _, w in queries]), k, best, np.zeros(len(queries)))

    def together(self, cut: np.ndarray, terms: np.ndarray, weights: np.ndarray, k: int, best: list[list[tuple]], floor: np.ndarray) -> list[list[tuple]]:
        """The k best of ``best`` and this shard for each query, terms ``cut[i]:cut[i + 1]``; hits below its ``floor`` may be left out."""
        count, sizes = len(best), np.diff(cut)
        least = np.array([_least(b, k, f) for b, f in zip(best, floor.tolist())])
        rounding = (sizes + 16) * 2.0 ** -23 + self.cut   # of a sum of so many parts, none below zero, in single precision: twice the most
        about = self.about.view(np.complex128).take(terms).view(self.about.dtype)   # 16 bytes a term
        row, who = about["row"], np.repeat(np.arange(count), sizes)
        self.met += int(about["df"].sum(dtype=np.int64))
        tabled = row >= 0
        asked = np.zeros((count, len(self.table)), np.float32)
        asked[who[tabled], row[tabled]] = weights[tabled]
        rest = np.bincount(who, np.where(tabled, 0.0, weights * about["top"]), count)
        near = ((asked @ self.table_max) + rest[:, None]) * (1 + rounding)[:, None] >= least[:, None]
        shut = np.repeat(~near.any(0), BLOCK)[:self.n]
        self.shut += int(shut.sum()) * count
        chosen = np.flatnonzero(near.any(1))
        out = list(best)
        if chosen.size < FEW_QUERIES:
            for i in chosen:
                out[i] = self._pivots(terms[cut[i]:cut[i + 1]], weights[cut[i]:cut[i + 1]], k, best[i], least[i])
            return out
        if chosen.size < count:
            mine = near.any(1)[who]
            sums = self._sums(asked[chosen], (np.cumsum(near.any(1)) - 1)[who[mine]], weights[mine], about[mine], shut)
        else:
            sums = self._sums(asked, who, weights, about, shut)
        enough = np.maximum(least[chosen] * (1 - rounding[chosen]), np.finfo(np.float32).tiny)
        found = sums >= enough.astype(np.float32)[:, None]
        for j in np.flatnonzero(found.any(1)):
            i, docs = chosen[j], np.flatnonzero(found[j])
            if docs.size > k:
                sure = np.partition(sums[j, docs], docs.size - k)[docs.size - k] * (1 - 2 * rounding[i])
                docs = docs[sums[j, docs] >= sure - SLACK]
            out[i] = self._exact(terms[cut[i]:cut[i + 1]], weights[cut[i]:cut[i + 1]], docs, k, best[i])
        return out

    def _sums(self, asked: np.ndarray, who: np.ndarray, weights: np.ndarray, about: np.ndarray, shut: np.ndarray) -> np.ndarray:
        """Scores of all documents for all queries in single precision, -inf where ``shut``.

        The terms that many of the queries and of the documents have are summed in a product with their rows of the table, the
        others posting by posting."""
        row, open_ = about["row"], np.flatnonzero(~shut)
        tabled = row >= 0
        product = np.bincount(row[tabled], minlength=len(self.table)) * self.counted * POSTING_COST >= len(asked) * open_.size
        rows = np.flatnonzero(product)
        if open_.size == self.n:
            sums = asked[:, rows] @ self.table[rows]
        else:
            sums = np.full((len(asked), self.n), -np.inf, np.float32)
            sums[:, open_] = asked[:, rows] @ self.table[np.ix_(rows, open_)]
        listed = ~tabled
        listed[tabled] = ~product[row[tabled]]
        about, places, weights = about[listed], who[listed] * self.n, weights[listed].astype(np.float32)
        df, first = about["df"].astype(np.int64), about["start"].astype(np.int64)
        upto = np.concatenate([[0], np.cumsum(df)])
        self.read += int(upto[-1])
        flat, steps = sums.reshape(-1), np.arange(SLICE + self.n)
        slices = np.unique(np.append(np.searchsorted(upto, np.arange(0, upto[-1], SLICE)), df.size))
        for a, z in zip(slices[:-1], slices[1:]):
            n = df[a:z]
            post = np.repeat(first[a:z] - upto[a:z] + upto[a], n)
            post += steps[:post.size]
            found = self.posting.take(post)
            place = np.repeat(places[a:z], n)
            place += found & self.doc_bits
            found &= ~self.doc_bits
            np.add.at(flat, place, found.view(np.float32) * np.repeat(weights[a:z], n))
        return sums

    def _exact(self, terms: np.ndarray, weights: np.ndarray, docs: np.ndarray, k: int, best: list[tuple]) -> list[tuple]:
        """``best`` with the given documents, from all their postings."""
        start, term, impact = self.by_doc
        self.weight_of[terms] = weights
        best = list(best)
        for d in docs.tolist():
            mine = slice(start[d], start[d + 1])
            parts = self.weight_of[term[mine]] * impact[mine]
            parts = parts[parts > 0].tolist()
            self.read += len(parts)
            best.append((math.fsum(parts), int(self.ids[d]) if self.known[d] else None))   # exactly rounded
        self.weight_of[terms] = 0.0
        return sorted(best, key=_place)[:k]

    def top(self, terms: np.ndarray, weights: np.ndarray, k: int, best: list[tuple] = ()) -> list[tuple[float, int | None]]:
        """The k best (score, doc_id) of ``best`` and this shard; ``terms`` are its term numbers."""
        self.met += int(self.dfs[terms].sum())
        return self._pivots(terms, weights, k, list(best), _least(best, k))

    def _pivots(self, terms: np.ndarray, weights: np.ndarray, k: int, best: list[tuple], least: float) -> list[tuple]:
        if weights @ self.top_impact[terms] < least:
            return best
        first_block, _, first, last, most = self.blocks
        short = self.dfs[terms] <= BLOCK
        # terms of one block: documents with the block's maximum
        t, w = terms[short], weights[short]
        post = _ranges(self.start[t], self.start[t + 1])
        sizes = self.dfs[t]
        docs = self.docs[post]
        # terms of several blocks: a block's maximum from its first document to its last
        t2, w2 = terms[~short], weights[~short]
        block = _ranges(first_block[t2], first_block[t2 + 1])
        part = np.repeat(w2, first_block[t2 + 1] - first_block[t2]) * most[block]
        change = np.bincount(first[block], part, self.n + 1) - np.bincount(last[block] + 1, part, self.n + 1)
        span = np.cumsum(change, dtype=float)[:self.n]
        span += SLACK / 4   # the cumulative sum rounds
        bound = span + self._sum(docs, np.repeat(w * most[first_block[t]], sizes))
        near = self._sum(docs, np.ones(docs.size)) > 0
        near |= span > SLACK / 2
        pivot = near & (bound >= least)
        # the pivots' postings in terms of one block
        held = np.flatnonzero(pivot[docs])
        self.read += held.size
        docs, parts = docs[held], np.repeat(w, sizes)[held] * self.impact[post[held]]
        bound = span + self._sum(docs, parts)
        pivot &= bound >= least
        while True:
            rest = np.flatnonzero(pivot)
            if not rest.size:
                return best
            # without a threshold the most promising pivots go first
            chosen, more = rest, len(best) < k and rest.size > 8 * k
            if more:
                chosen = rest[np.argpartition(-bound[rest], 4 * k)[:4 * k]]
            best = self._scored(chosen, docs, parts, block, w2, t2, k, best, least)
            if not more:
                return best
            pivot[chosen] = False
            pivot &= bound >= _least(best, k, least + SLACK)

    def _scored(self, chosen: np.ndarray, docs: np.ndarray, parts: np.ndarray, block: np.ndarray, weights: np.ndarray,
                terms: np.ndarray, k: int, best: list[tuple], least: float) -> list[tuple]:
        """``best`` with the ``chosen`` documents; of the terms' blocks those that span none of them stay shut."""
        first_block, begin, first, last, _ = self.blocks
        asked = np.zeros(self.n + 1, np.int64)
        asked[chosen + 1] = 1
        before = np.cumsum(asked)   # chosen documents below each one
        weight = np.repeat(weights, first_block[terms + 1] - first_block[terms])
        open_ = before[last[block] + 1] > before[first[block]]
        block, weight = block[open_], weight[open_]
        post = _ranges(begin[block], begin[block + 1])
        inside = asked[self.docs[post] + 1] > 0
        weight = np.repeat(weight, begin[block + 1] - begin[block])[inside]
        post = post[inside]
        self.read += post.size
        mine = asked[docs + 1] > 0
        docs, parts = np.concatenate([docs[mine], self.docs[post]]), np.concatenate([parts[mine], weight * self.impact[post]])
        scores = self._sum(docs, parts)[chosen]
        low = _least(best, k, least + SLACK) + SLACK
        if chosen.size > k:   # all that tie with the k-th stay until ids decide
            low = max(low, np.partition(scores, chosen.size - k)[chosen.size - k])
        taken = chosen[(scores >= low - SLACK) & (scores > 0)]
        if taken.size:
            place = np.full(self.n, -1)
            place[taken] = np.arange(taken.size)
            at = place[docs]
            held = np.flatnonzero(at >= 0)
            held = held[np.argsort(at[held], kind="stable")]
            cut = np.searchsorted(at[held], np.arange(taken.size + 1))
            for i, d in enumerate(taken):   # exactly rounded
                best = [*best, (math.fsum(parts[held[cut[i]:cut[i + 1]]].tolist()), int(self.ids[d]) if self.known[d] else None)]
        return sorted(best, key=_place)[:k]


def _least(best: list[tuple], k: int, floor: float = 0.0) -> float:
    """The score below which a document is none of the k best."""
    return max(floor, best[-1][0] if len(best) == k else 0.0) - SLACK


def _place(hit: tuple):
    score, doc = hit
    return -round(score, 9), doc is None, doc or 0


def _ranges(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one after the other."""
    n = end - start
    return np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())


def search(index: DataFrame, queries: DataFrame, mean: float, k: int = 10) -> DataFrame:
    """The k best documents of each query, with their rank."""
    queries = landed(queries, "bm25-queries")
    size = queries.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("terms")).alias("terms")).first()
    blocks = max(1, math.ceil(size["n"] / QUERY_BLOCK), math.ceil((size["terms"] or 0) / QUERY_TERMS))
    sc, shards, out = index.sparkSession.sparkContext, index.count(), None
    order = Window.partitionBy("query_id").orderBy(F.desc(F.round("score", 9)), F.col("doc_id").asc_nulls_last())
    first = F.pmod(F.xxhash64("doc_ids"), F.lit(FIRST_SHARDS)) == 0
    # one of FIRST_SHARDS shards goes first and gives each query the threshold that it starts with on the others
    rounds = [(index.where(first), shards / FIRST_SHARDS), (index.where(~first), shards)] if shards >= 2 * FIRST_SHARDS else [(index, shards)]
    for n in range(blocks):
        # queries alike (by their commonest term and their length) next to each other: they need the same terms and blocks of documents
        part = queries.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == n) \
            .orderBy(F.expr("terms[array_position(weights, array_min(weights)) - 1]"), F.size("terms"), "query_id").select("query_id", "terms", "weights").toArrow().combine_chunks()
        ids, terms, weights = [c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in part.columns]
        cut = np.concatenate([[0], np.cumsum(pc.list_value_length(terms).to_numpy(zero_copy_only=False).astype(np.int64))])
        coded = terms.flatten().dictionary_encode()
        held = sc.broadcast((ids.to_pylist(), cut, coded.dictionary, coded.indices.to_numpy(), weights.flatten().to_numpy()))
        floor = np.zeros(len(ids))
        for i, (some, size) in enumerate(rounds):

            def run(batches, held=held, floor=floor):
                ids, cut, every, coded, weights = held.value
                best: list[list[tuple]] = [[] for _ in ids]
                for b in batches:
                    for r in range(b.num_rows):
                        shard = None  # one at a time
                        shard = Shard({c: b.column(c)[r].as_py() for c in FIELDS}, mean)
                        number = pc.index_in(every, value_set=shard.terms).fill_null(-1).to_numpy()
                        for i in range(0, len(ids), TABLE_QUERIES):
                            z = min(i + TABLE_QUERIES, len(ids))
                            t = number[coded[cut[i]:cut[z]]]
                            there = t >= 0
                            mine = np.concatenate([[0], np.cumsum(there)])[cut[i:z + 1] - cut[i]]
                            best[i:z] = shard.together(mine, t[there], weights[cut[i]:cut[z]][there], k, best[i:z], floor[i:z])
                hits = [(query, d, s) for query, found in zip(ids, best) for s, d in found]
                if hits:
                    cols = list(zip(*hits))
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.float64()))],
                                                     names=["query_id", "doc_id", "score"])

            tasks = max((1 + (size == shards)) * sc.defaultParallelism, math.ceil(size / TASK_SHARDS))
            with _rows_a_batch(index.sparkSession, 1):
                got = landed(some.coalesce(tasks).mapInArrow(run, HITS), "bm25-hits")
            out = got if out is None else out.unionByName(got)
            if i + 1 < len(rounds):   # the k-th best score of the first shards
                kth = got.withColumn("rank", F.row_number().over(order)).where(F.col("rank") == k).select("query_id", "score").toArrow()
                known = dict(zip(kth["query_id"].to_pylist(), kth["score"].to_pylist()))
                floor = np.array([known.get(q, 0.0) for q in ids.to_pylist()])
        held.unpersist()
    return out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "doc_id", F.round("score", 6).alias("score"))


def similar_documents(docs: DataFrame, every: int = 100, k: int = 10) -> DataFrame:
    """Queries from all terms of each document whose id is divisible by ``every``, against all documents."""
    index = build_index(docs)
    dfs, n, mean = statistics(index)
    return search(index, document_queries(docs.where(F.col("doc_id") % every == 0), dfs, n), mean, k)
