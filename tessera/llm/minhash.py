"""MinHash near-duplicates by an inverted join on signature coordinates.

``signatures`` gives each text its set of distinct word shingles, as 64-bit hashes, and from it a MinHash
signature of ``COORDINATES`` numbers. Equal sets are one row before any search. Two sets with a Jaccard
similarity of 0.8 agree on 51 of 64 coordinates in the mean; pairs that agree on ``MATCHES`` (32) or more are
candidates, so a pair at the limit is missed with a probability under 1e-6, and candidates are confirmed on their full sets.

1. Postings: a set is posted under each (coordinate, value). Values are put in order of how many sets hold them,
   rarest first. Two sets that agree on 32 of 64 share one of their first 33 postings in any common
   order (prefix), so only these stay, and of them those that more than one set holds.
2. Merging: in each posting list, signatures are compared by collisions, one byte a coordinate. Pairs that are
   already in one group are skipped: a list of n members gives at most n - 1 links, and a list of near copies
   is done after a few passes. The links' connected groups are clusters.
3. Confirmation: the same merging runs in each cluster, on the full shingle sets and with the exact rule
   100 * intersection >= percent * union. The links' connected groups are the result.

Lists and clusters of up to ``GROUP_ROWS`` members (and ``GROUP_SHINGLES`` shingles) are merged whole in a task.
Larger ones are dealt to blocks (``_large``): rounds compare all blocks with a member of the largest group so
far, as long as that at least halves the members outside it; then the members left outside are compared with
all blocks. No pair is dropped, no task holds a whole large list, and at most one link per member and group is emitted.

Defined cases: null and wordless texts have no shingles, are linked with nothing and keep their own id (null stays
null); a text of fewer words than a shingle is one shingle; repeated rows and equal sets are linked; a group
whose ids are all null has a null component; ``kept`` is true where doc_id and component are equal or both
null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.bpe import text_slices
from tessera.llm.common import landed
from tessera.llm.simhash import connected
from tessera.llm.words import WORD_HASHES, spaced_words

COORDINATES, MATCHES = 64, 32
GROUP_ROWS, GROUP_SHINGLES = 4096, 1 << 22   # members of a list, shingles of a cluster, merged in one task
ROUNDS = 8                                   # of comparing a large group's blocks with one member
EDGES = "a long, b long"

_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)]


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    for m in _MIX[1:]:
        x = (x ^ (x >> np.uint64(33))) * m
    return x ^ (x >> np.uint64(33))


#: odd multipliers of the coordinates
FACTORS = _mixed(np.arange(1, COORDINATES + 1, dtype=np.uint64) * _MIX[0]) | np.uint64(1)


def shingle_set(text: str | None, shingle: int = 2) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a text; fewer words are one shingle, no words none."""
    words = spaced_words(text)
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(WORD_HASHES.__getitem__, words), np.uint64, len(words))
    width = min(shingle, h.size)
    x = np.full(h.size - width + 1, np.uint64(width))
    for k in range(width):   # order matters
        x = _mixed(x * _MIX[0] + h[k:k + x.size])
    return np.unique(x)


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """The signatures (rows of ``COORDINATES`` 32-bit numbers) of sets that are not empty."""
    every = np.concatenate(sets)
    starts = np.cumsum([0, *[s.size for s in sets]])[:-1]
    out = np.empty((len(sets), COORDINATES), np.uint32)
    for k, f in enumerate(FACTORS):
        out[:, k] = np.minimum.reduceat((every * f) >> np.uint64(32), starts)
    return out


SIGNATURES = "row long, doc_id long, n_shingles long, digest binary, signature binary"


def signatures(rows: DataFrame, shingle: int = 2) -> DataFrame:
    """Set size, digest of the set and signature of (row, doc_id, text) rows; null digests where no words are."""

    def work(batches):
        import xxhash

        for b in text_slices(batches, 128):
            sets = [shingle_set(t, shingle) for t in b.column(2).to_pylist()]
            full = [s for s in sets if s.size]
            made = iter(minima(full)) if full else iter(())
            yield pa.RecordBatch.from_arrays([
                b.column(0), b.column(1), pa.array([s.size for s in sets], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) if s.size else None for s in sets], pa.binary()),
                pa.array([next(made).tobytes() if s.size else None for s in sets], pa.binary())],
                names=[f.split()[0] for f in SIGNATURES.split(", ")])

    return rows.mapInArrow(work, SIGNATURES)


def postings(sets: DataFrame) -> DataFrame:
    """Landed (cv, item, count): each set's prefix postings that other sets hold too; ``count`` sets hold the value."""

    def expand(batches):
        high = (np.arange(COORDINATES, dtype=np.int64) << 32)
        for b in text_slices(batches, 1024):
            values = np.frombuffer(b"".join(b.column(1).to_pylist()), "<u4").reshape(-1, COORDINATES)
            cv = (values.astype(np.int64) | high).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(cv), pa.array(np.repeat(b.column(0).to_numpy(), COORDINATES))], names=["cv", "item"])

    every = sets.select("item", "signature").mapInArrow(expand, "cv long, item long")
    shared = every.groupBy("cv").count().where("count > 1")
    held = every.join(shared, "cv").groupBy("item").agg(F.sort_array(F.collect_list(F.struct("count", "cv"))).alias("held"))
    # values that no other set holds are the rarest: they come first and need no posting
    prefix = COORDINATES - MATCHES + 1 - (COORDINATES - F.size("held"))
    kept = held.where(prefix > 0).select("item", F.explode(F.slice("held", 1, prefix)).alias("p"))
    return landed(kept.select(F.col("p.cv").alias("cv"), "item", F.col("p.count").alias("count")), "postings")


# ---- links inside a group ----

class Signatures:
    """Members compared by collisions of their signatures (one byte a coordinate) and by their sizes."""

    def __init__(self, sizes: np.ndarray, payloads: list[bytes], percent: int):
        self.sizes, self.percent = sizes, percent
        self.held = np.frombuffer(b"".join(payloads), np.uint8).reshape(-1, COORDINATES)

    def links(self, i: int, others: np.ndarray) -> np.ndarray:
        n, m = self.sizes[i], self.sizes[others]
        near = 100 * np.minimum(n, m) >= self.percent * np.maximum(n, m)
        return near & ((self.held[others] == self.held[i]).sum(1) >= MATCHES)


class Sets:
    """Members compared by their full shingle sets."""

    def __init__(self, sizes: np.ndarray, payloads: list[str], percent: int, shingle: int):
        sets = [shingle_set(t, shingle) for t in payloads]
        self.sizes, self.percent = np.array([s.size for s in sets]), percent
        self.every, self.ends = np.concatenate(sets), np.cumsum(self.sizes)

    def links(self, i: int, others: np.ndarray) -> np.ndarray:
        mine = self.every[self.ends[i] - self.sizes[i]:self.ends[i]]
        sizes = self.sizes[others]
        ends = np.cumsum(sizes)
        at = np.repeat(self.ends[others] - ends, sizes) + np.arange(ends[-1])
        found = self.every[at]
        place = np.minimum(np.searchsorted(mine, found), mine.size - 1)
        both = np.add.reduceat(mine[place] == found, ends - sizes, dtype=np.int64)
        return 100 * both >= self.percent * (mine.size + sizes - both)


def merge(member, root: np.ndarray, ask: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links (i, j) that join all linked members, given the groups ``root`` they are in already.

    Members of one group are not compared. Passes start from the largest group while each brings in an eighth of
    the members outside it, then from the members outside. With ``ask``, only these compare themselves with all.
    """
    root, out = root.copy(), []

    def step(i: int, others: np.ndarray) -> int:
        hits = others[member.links(i, others)]
        labels, first = np.unique(root[hits], return_index=True)
        out.extend((i, int(hits[k])) for k in first)
        if labels.size:
            root[np.isin(root, labels)] = root[i]
        return hits.size

    if ask is not None:
        for i in ask:
            others = np.flatnonzero(root != root[i])
            if others.size:
                step(int(i), others)
        return out
    asked, tried = np.zeros(root.size, bool), np.zeros(root.size, bool)
    pays = True
    while True:
        labels, place = np.unique(root, return_inverse=True)
        big = labels[np.bincount(place).argmax()]
        outside = np.flatnonzero(root != big)
        if not outside.size:
            return out
        if pays:
            inside = np.flatnonzero((root == big) & ~tried)
            if inside.size:
                tried[inside[0]] = True
                pays = 8 * step(int(inside[0]), outside) >= outside.size
                continue
            pays = False
        left = outside[~asked[outside]]
        if not left.size:
            return out
        i = int(left[0])
        asked[i] = tried[i] = True
        step(i, np.flatnonzero(root != root[i]))


def _edges(items: np.ndarray, links: list[tuple[int, int]]) -> pa.RecordBatch:
    pairs = np.array(links, dtype=np.int64).reshape(-1, 2)
    a, b = items[pairs[:, 0]], items[pairs[:, 1]]
    return pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], names=["a", "b"])


def _small(rows: DataFrame, kind) -> DataFrame:
    """Links inside groups of (grp, item, n, payload) rows that fit in a task."""

    def work(batches):
        held = None
        for b in batches:
            t = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
            new = np.flatnonzero(np.diff(t["grp"].to_numpy())) + 1
            cut = int(new[-1]) if new.size else 0   # the last group may go on in the next batch
            held = t.slice(cut)
            yield from groups(t.slice(0, cut), [0, *new.tolist()])
        if held is not None:
            yield from groups(held, [0, held.num_rows])

    def groups(t, ends):
        items, sizes, payloads = t["item"].to_numpy(), t["n"].to_numpy(), t["payload"].to_pylist()
        for a, z in zip(ends, ends[1:]):
            if z - a > 1:
                links = merge(kind(sizes[a:z], payloads[a:z]), np.arange(z - a))
                if links:
                    yield _edges(items[a:z], links)

    return rows.repartition("grp").sortWithinPartitions("grp").mapInArrow(work, EDGES)


def _large(rows: DataFrame, kind, known: DataFrame) -> DataFrame:
    """Links inside groups of landed (grp, item, n, payload, blocks) rows, dealt to ``blocks`` blocks.

    ``known`` are links (a, b) found before; the result is landed and does not repeat them.
    """

    def pivot_pass(t: pa.Table) -> pa.Table:
        items, pivot = t["item"].to_numpy(), t["pivot"].to_numpy(zero_copy_only=False).astype(bool)
        at = np.flatnonzero(pivot)
        if not at.size or pivot.all():
            return pa.Table.from_batches([_edges(items, [])])
        others, i = np.flatnonzero(~pivot), int(at[0])
        hits = others[kind(t["n"].to_numpy(), t["payload"].to_pylist()).links(i, others)]
        return pa.Table.from_batches([_edges(items, [(i, int(j)) for j in hits])])

    def tile(t: pa.Table) -> pa.Table:
        order = np.lexsort((~t["pivot"].to_numpy(zero_copy_only=False).astype(bool), t["item"].to_numpy()))
        t = t.take(pa.array(order))   # a member that asks comes once, as such
        items = t["item"].to_numpy()
        t = t.filter(pa.array(np.concatenate([[True], items[1:] != items[:-1]])))
        items, asks = t["item"].to_numpy(), np.flatnonzero(t["pivot"].to_numpy(zero_copy_only=False))
        links = merge(kind(t["n"].to_numpy(), t["payload"].to_pylist()), t["root"].to_numpy(), asks)
        return pa.Table.from_batches([_edges(items, links)])

    def grouped():
        """Rows with their present group, and per grp the largest one."""
        roots = connected(known if found is None else known.unionByName(found))
        named = landed(rows.join(roots.withColumnRenamed("fp", "item"), "item", "left").withColumn("root", F.coalesce("root", "item")), "members")
        sizes = named.groupBy("grp", "root").agg(F.count(F.lit(1)).alias("k"))
        big = sizes.groupBy("grp").agg(F.max(F.struct("k", "root")).alias("top"), F.sum("k").alias("all"), F.count(F.lit(1)).alias("groups"))
        big = big.where("groups > 1").select("grp", F.col("top.root").alias("big"), (F.col("all") - F.col("top.k")).alias("outside"))
        return named, landed(big, "largest")

    found, before = None, None
    names = ["grp", "block", "item", "n", "payload", "pivot"]
    for r in range(ROUNDS + 1):
        named, big = grouped()
        outside = big.agg(F.sum("outside")).first()[0] or 0
        if not outside:
            return found if found is not None else known.where("false")
        if r == ROUNDS or (before is not None and 2 * outside > before):
            break
        before = outside
        active = named.join(big, "grp")
        first = active.where("root = big").groupBy("grp").agg(F.min(F.struct(F.xxhash64("item", F.lit(r)).alias("h"), "item")).alias("p"))
        first = first.select("grp", F.col("p.item").alias("item"))
        pivots = named.join(first, ["grp", "item"]).select("grp", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "item", "n", "payload", F.lit(True).alias("pivot"))
        others = active.where("root <> big").select("grp", F.pmod(F.xxhash64("item"), "blocks").alias("block"), "item", "n", "payload", F.lit(False).alias("pivot"))
        got = others.unionByName(pivots.select(*names)).groupBy("grp", "block").applyInArrow(pivot_pass, EDGES)
        found = landed(got if found is None else found.unionByName(got), "pivot-links")
    # the members outside ask all blocks
    active = named.join(big, "grp").withColumn("asking", F.ceil(F.col("outside") / GROUP_ROWS))
    asking = active.where("root <> big").withColumn("block", F.pmod(F.xxhash64("item"), F.col("asking"))).withColumn("pivot", F.lit(True)) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    asked = active.withColumn("other", F.pmod(F.xxhash64("item"), "blocks")).withColumn("pivot", F.lit(False)) \
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("asking") - 1)))
    names = ["grp", "block", "other", "item", "n", "payload", "pivot", "root"]
    cast = [F.col(c).cast("long") if c in ("block", "other") else F.col(c) for c in names]
    got = asking.select(*cast).unionByName(asked.select(*cast)).groupBy("grp", "block", "other").applyInArrow(tile, EDGES)
    return landed(got if found is None else found.unionByName(got), "tile-links")


def _links(small: DataFrame, large: DataFrame | None, kind) -> DataFrame:
    """Landed links inside all groups."""
    found = landed(_small(small, kind).distinct(), "links")
    if large is None:
        return found
    return landed(found.unionByName(_large(landed(large, "large-groups"), kind, found)), "all-links")


def clusters(sets: DataFrame, percent: int = 80) -> DataFrame:
    """(item, cluster) of sets that have a candidate partner, from landed (item, n, signature) rows."""
    posts = postings(sets)
    packed = sets.select("item", "n", F.col("signature").alias("payload"))

    def narrow(batches):   # the low byte of each coordinate
        for b in text_slices(batches, 4096):
            low = np.frombuffer(b"".join(b.column(2).to_pylist()), np.uint8)[::4].reshape(-1, COORDINATES)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([x.tobytes() for x in low], pa.binary())], names=["item", "n", "payload"])

    rows = posts.join(packed.mapInArrow(narrow, "item long, n long, payload binary"), "item").select(F.col("cv").alias("grp"), "item", "n", "payload", "count")
    large, hot = None, posts.where(F.col("count") > GROUP_ROWS)
    if not hot.isEmpty():
        hot = hot.groupBy(F.col("cv").alias("grp")).agg(F.ceil(F.count(F.lit(1)) / GROUP_ROWS).alias("blocks"))
        large = rows.where(F.col("count") > GROUP_ROWS).drop("count").join(hot, "grp")
    found = _links(rows.where(F.col("count") <= GROUP_ROWS).drop("count"), large, lambda n, p: Signatures(n, p, percent))
    named = connected(found).select(F.col("fp").alias("item"), F.col("root").alias("cluster"))
    return named.unionByName(named.select(F.col("cluster").alias("item"), "cluster").distinct())   # a root names itself


def minhash_components(docs: DataFrame, shingle: int = 2, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs``.

    Rows are told apart by their place in the scan of ``docs``, which must be a stored table.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    marked = landed(signatures(rows, shingle), "signatures")
    sets = landed(marked.where("digest is not null").groupBy("digest").agg(F.min("row").alias("item"), F.min("doc_id").alias("low")), "sets")
    first = landed(marked.select(F.col("row").alias("item"), F.col("n_shingles").alias("n"), "signature").join(sets.select("item"), "item"), "first")
    near = landed(clusters(first, percent), "clusters")
    sizes = near.join(first.select("item", "n"), "item").groupBy("cluster").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("total"))
    blocks = F.greatest(F.ceil(F.col("k") / GROUP_ROWS), F.ceil(F.col("total") / GROUP_SHINGLES))
    near = landed(near.join(sizes.select("cluster", blocks.alias("blocks")), "cluster"), "near")
    texts = rows.select(F.col("row").alias("item"), F.col("text").alias("payload")).join(near, "item") \
        .join(first.select("item", "n"), "item").select(F.col("cluster").alias("grp"), "item", "n", "payload", "blocks")
    large = None if near.where("blocks > 1").isEmpty() else texts.where("blocks > 1")
    confirmed = _links(texts.where("blocks = 1").drop("blocks"), large, lambda n, p: Sets(n, p, percent, shingle))
    roots = connected(confirmed).withColumnRenamed("fp", "item")
    named = sets.join(roots, "item", "left").withColumn("root", F.coalesce("root", "item"))
    lowest = named.groupBy("root").agg(F.min("low").alias("lowest"))
    named = named.join(lowest, "root").select("digest", "lowest")
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("lowest"))
    return marked.select("doc_id", "n_shingles", "digest").join(named, "digest", "left") \
        .select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
