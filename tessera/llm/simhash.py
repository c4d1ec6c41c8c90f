"""SimHash near-duplicates with a Gray-order hierarchical index.

``fingerprints`` gives each text a 64-bit SimHash of its word shingles. ``components``
links fingerprints that differ in at most ``radius`` bits and labels the connected
groups. Equal fingerprints are one row before any search.

The index is spread over cells: the 64 bits are cut into ``radius + 1`` blocks, and a
cell holds the fingerprints that agree on one block, so two fingerprints within the
radius share a cell. A cell of more than ``CELL_ROWS`` rows is cut again the same
way, over the bits not yet shared, and so on; a cell that agrees on all but few bits
is bounded by their combinations. Inside a cell the fingerprints are sorted by Gray rank.
Runs of ranks that agree on their leading bits form the nodes of a tree, each with
the bit pattern its members share; pairs of nodes go down the tree together, carry
the number of differing bits so far, and whole groups are dropped once that exceeds
the radius. Each cell then emits one edge per fingerprint and local group, so a
dense cell of n fingerprints gives at most n edges and no link is lost.

Defined cases: null and wordless texts have fingerprint zero and are linked like any
other; a text with fewer words than a shingle is one shingle; repeated rows keep their
rows; a group whose ids are all null has a null component; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.bpe import text_slices
from tessera.llm.common import free_name, landed

BITS = 64
CELL_ROWS = 50_000
STEP = 4        # bits per tree level
HASHES = 1 << 15  # shingle hashes held at once, whatever the length of a text


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of a text: a bit is set if it is set in over half of the shingles' XXH64 (seed 42)."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    counts = np.zeros(BITS, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for a in range(0, n, HASHES):
        z = min(n, a + HASHES)
        cols = [words[a + k:z + k] for k in range(shingle)] if len(words) >= shingle else [[b" ".join(words)]]
        h = np.fromiter((digest(b" ".join(s), 42) for s in zip(*cols)), dtype="<u8", count=z - a)
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id and its fingerprint as a signed 64-bit number."""

    def score(batches):
        for b in text_slices(batches):
            fp = np.array([fingerprint(t, shingle) for t in b.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(score, "doc_id long, fp long")


def gray_rank(fp: np.ndarray) -> np.ndarray:
    """Position of a bit pattern in the reflected Gray order."""
    g = fp.astype(np.uint64).copy()
    for s in (1, 2, 4, 8, 16, 32):
        g ^= g >> np.uint64(s)
    return g


def popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x.astype(np.uint64)).astype(np.int64)


def _pairs_within(cell: np.ndarray, fp: np.ndarray, radius: int, limit: int = 1 << 20):
    """Index pairs (i < j) of equal cell and at most ``radius`` differing bits.

    ``cell`` and, within it, the Gray rank of ``fp`` are ascending. Level l has one node per cell and
    run of equal leading bits; ``limit`` bounds the node pairs that are expanded at once.
    """
    n = fp.size
    levels = []  # (first row of each node, its shared bit pattern, node of each row)
    for bits in range(0, BITS + 1, STEP):
        mask = np.uint64(((1 << bits) - 1) << (BITS - bits)) if bits else np.uint64(0)
        shared = fp & mask
        new = np.ones(n, bool)
        new[1:] = (cell[1:] != cell[:-1]) | (shared[1:] != shared[:-1])
        first = np.flatnonzero(new)
        levels.append((first, shared[first], np.cumsum(new) - 1))
    children = []  # first child of each node, with the end
    for (first, _, _), (_, _, node_below) in zip(levels, levels[1:]):
        children.append(np.append(node_below[first], node_below[-1] + 1))
    todo = [(0, np.arange(levels[0][0].size), np.arange(levels[0][0].size))]
    while todo:
        level, u, v = todo.pop()
        if u.size > limit:
            todo += [(level, u[k:k + limit], v[k:k + limit]) for k in range(0, u.size, limit)]
            continue
        if level == len(children):  # one node per fingerprint: they are distinct
            keep = u < v
            yield levels[level][0][u[keep]], levels[level][0][v[keep]]
            continue
        kids = children[level]
        # a node alone with itself and of one row has no pairs
        rows = np.append(levels[level][0], n)
        live = (u != v) | (rows[u + 1] - rows[u] > 1)
        u, v = u[live], v[live]
        nu, nv = kids[u + 1] - kids[u], kids[v + 1] - kids[v]
        size = nu * nv
        at = np.repeat(np.arange(u.size), size)
        k = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        cu, cv = kids[u][at] + k // nv[at], kids[v][at] + k % nv[at]
        pattern = levels[level + 1][1]
        keep = (cu <= cv) & (popcount(pattern[cu] ^ pattern[cv]) <= radius)
        todo.append((level + 1, cu[keep], cv[keep]))


def _roots(n: int, pairs) -> np.ndarray:
    """Smallest index of each index's connected group."""
    root = np.arange(n)
    for a, b in pairs:
        while a.size:
            ra, rb = root[a], root[b]
            differ = ra != rb
            a, b, ra, rb = a[differ], b[differ], ra[differ], rb[differ]
            np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:
                up = root[root]
                if (up == root).all():
                    break
                root = up
    return root


def cell_edges(cell: np.ndarray, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (fingerprint, first fingerprint of its group) of whole cells, each row's cell given."""
    order = np.lexsort((gray_rank(fp), cell))
    cell, fp = cell[order], fp[order]
    root = _roots(fp.size, _pairs_within(cell, fp, radius))
    moved = root != np.arange(fp.size)
    return fp[moved], fp[root[moved]]


def _mask(bits: list[int]) -> int:
    m = sum(1 << b for b in bits)
    return m - (1 << 64) if m >= 1 << 63 else m


def _blocks(bits: list[int], parts: int) -> list[list[int]]:
    return [bits[len(bits) * k // parts:len(bits) * (k + 1) // parts] for k in range(parts)]


def _cells(points: DataFrame, radius: int) -> DataFrame:
    """(cell_mask, cell, fp): fingerprints within the radius share a cell; no cell of one row."""
    done = None
    # masks of one depth and the bits they leave
    depth = [(0, list(range(BITS)))]
    rows = points.select(F.lit(0).cast("long").alias("cell_mask"), F.lit(0).cast("long").alias("cell"), "fp")
    while True:
        finer = {}
        for mask, rest in depth:
            finer[mask] = [(mask | _mask(b), [x for x in rest if x not in b]) for b in _blocks(rest, radius + 1)]
        split = F.create_map(*[x for m, subs in finer.items() for x in (F.lit(m), F.array(*[F.lit(s) for s, _ in subs]))])
        rows = (rows.select("fp", F.explode(split[F.col("cell_mask")]).alias("cell_mask"))
                .withColumn("cell", F.col("fp").bitwiseAND(F.col("cell_mask"))))
        counts = rows.groupBy("cell_mask", "cell").count().where("count > 1")
        depth = [s for subs in finer.values() for s in subs]
        last = max(len(rest) for _, rest in depth) <= 18
        rows = landed(rows.join(counts, ["cell_mask", "cell"]), "cells")
        small = rows if last else rows.where(F.col("count") <= CELL_ROWS)
        small = small.select("cell_mask", "cell", "fp")
        done = small if done is None else done.unionByName(small)
        large = rows.where(F.col("count") > CELL_ROWS)
        if last or large.isEmpty():
            return done
        rows = large.select("cell_mask", "cell", "fp")


def links(points: DataFrame, radius: int) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``fp`` that keep all groups connected."""

    def search(batches):
        held = None
        for b in batches:
            t = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
            mask, cell = t["cell_mask"].to_numpy(), t["cell"].to_numpy()
            new = np.flatnonzero((mask[1:] != mask[:-1]) | (cell[1:] != cell[:-1])) + 1
            cut = int(new[-1]) if new.size else 0  # the last cell may go on in the next batch
            held = t.slice(cut)
            if cut:
                yield _edges(t.slice(0, cut), radius)
        if held is not None and held.num_rows:
            yield _edges(held, radius)

    return (_cells(points, radius).repartition("cell_mask", "cell").sortWithinPartitions("cell_mask", "cell")
            .mapInArrow(search, "a long, b long").where("a <> b").distinct())


def _edges(t: pa.Table, radius: int) -> pa.RecordBatch:
    mask, cell = t["cell_mask"].to_numpy(), t["cell"].to_numpy()
    number = np.zeros(t.num_rows, np.int64)
    number[1:] = np.cumsum((mask[1:] != mask[:-1]) | (cell[1:] != cell[:-1]))
    a, b = cell_edges(number, t["fp"].to_numpy().view(np.uint64), radius)
    return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])


def connected(edges: DataFrame) -> DataFrame:
    """(fp, root): the smallest member of each connected group, for members of edges.

    Alternates the large-star and small-star steps until nothing changes; each step
    aggregates per node before it shuffles, and its edges are landed.
    """
    spark = edges.sparkSession

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.select(F.col("a").alias("n"), F.col("b").alias("m"))
        if large:
            both = both.unionByName(e.select(F.col("b").alias("n"), F.col("a").alias("m")))
        else:
            both = both.select(F.greatest("n", "m").alias("n"), F.least("n", "m").alias("m"))
        low = both.groupBy("n").agg(F.min("m").alias("low")).withColumn("low", F.least("n", "low"))
        moved = both.join(low, "n")
        if large:
            out = moved.where("m > n").select(F.col("m").alias("a"), F.col("low").alias("b"))
        else:
            out = moved.select(F.col("m").alias("a"), F.col("low").alias("b")).unionByName(
                low.select(F.col("n").alias("a"), F.col("low").alias("b")))
        return out.where("a <> b").distinct()

    digest = None
    current = edges
    while True:
        current = landed(star(star(current, True), False), "edges")
        row = current.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if tuple(row) == digest:
            return current.select(F.col("a").alias("fp"), F.col("b").alias("root"))
        digest = tuple(row)


def components(marked: DataFrame, radius: int = 2) -> DataFrame:
    """Adds ``component_id``, the smallest doc_id reachable, to landed (doc_id, fp) rows."""
    points = landed(marked.groupBy("fp").agg(F.min("doc_id").alias("low")), "points")
    roots = connected(links(points.select("fp"), radius))
    named = points.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    named = named.join(lowest, "root").select("fp", "component_id")
    return marked.join(named, "fp")


def hex_fingerprint(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def simhash_components(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every row of ``docs``."""
    marked = landed(fingerprints(docs, shingle), "fingerprints")
    return components(marked, radius).select("doc_id", hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def one_per_component(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """One row of each near-duplicate group, with all columns: the smallest doc_id (null last).

    Rows are told apart by their place in the scan of ``docs``, which must be a stored table.
    """
    row, columns = free_name(docs, "row"), docs.columns
    placed = docs.withColumn(row, F.monotonically_increasing_id())
    marked = landed(fingerprints(placed.select(F.col(row).alias("doc_id"), "text"), shingle)
                    .withColumnRenamed("doc_id", "row"), "fingerprints")
    ids = placed.select(F.col(row).alias("row"), F.col("doc_id").cast("long").alias("id"))
    marked = marked.join(ids, "row")
    # smallest (null last, id, row) first
    first = F.min(F.struct(F.col("id").isNull().alias("unknown"), "id", "row"))
    points = landed(marked.groupBy("fp").agg(first.alias("low")), "points")
    roots = connected(links(points.select("fp"), radius))
    named = points.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    keep = named.groupBy("root").agg(F.min("low").alias("low")).select(F.col("low.row").alias(row))
    return placed.join(keep, row, "left_semi").select(*columns)
