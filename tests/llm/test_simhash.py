import numpy as np
import xxhash
from pyspark.sql import functions as F

from tessera.llm import simhash
from tessera.llm.simhash import connected, fingerprint, fingerprints, links, one_per_component, simhash_components

from .conftest import got, rows


def plain(text):
    """The contract's fingerprint, bit by bit."""
    words = (text or "").encode().lower().split()
    s = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(x, seed=42) for x in s]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def groups(pairs, radius):
    """Smallest id of each row's group, by comparing all fingerprints."""
    prints = sorted({f for _, f in pairs})
    root = {f: f for f in prints}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(prints):
        for b in prints[i + 1:]:
            if bin(a ^ b).count("1") <= radius:
                root[find(b)] = find(a)
    low = {}
    for d, f in pairs:
        if d is not None:
            low[find(f)] = min(d, low.get(find(f), d))
    return [(d, f, low.get(find(f))) for d, f in pairs]


def test_fingerprint(spark):
    texts = [r[1] for r in rows()] + [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(40).collect()]
    for t in texts:
        assert fingerprint(t) == plain(t)
    short = spark.sql("select xxhash64('a b c') as h").first()["h"]  # Spark's own XXH64 has the same seed
    assert fingerprint("A b\tC") == short % 2**64


def check(docs, pairs):
    out = simhash_components(docs)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    want = sorted(((d, f"{f:016x}", c) for d, f, c in groups(pairs, 2)), key=key)
    assert sorted((tuple(r) for r in out.collect()), key=key) == want
    return want


def test_components_equal_all_pairs(spark, odd, none):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = check(docs, [(r["doc_id"], plain(r["text"])) for r in docs.collect()])
    assert len({c for *_, c in want}) < len(want)
    check(odd, [(r[0], plain(r[1])) for r in rows()])
    assert simhash_components(none).collect() == []


def dense(n=400, seed=5):
    """Fingerprints around few centres: chains, stars and dense groups."""
    rng = np.random.default_rng(seed)
    out = set()
    for c in rng.integers(0, 2**63, 6).tolist():
        for _ in range(n // 8):
            x = c
            for b in rng.integers(0, 64, rng.integers(0, 7)).tolist():
                x ^= 1 << b
            out.add(x)
    out |= set(rng.integers(0, 2**63, n // 4).tolist()) | {0, 1, 2**63 + 3, 2**64 - 1}
    return sorted(out)


def test_links_and_hot_cells(spark, monkeypatch):
    prints = dense()
    signed = [x - 2**64 if x >= 2**63 else x for x in prints]
    points = spark.createDataFrame([(x,) for x in signed], "fp long")
    want = {}
    for d, f, c in groups(list(enumerate(prints)), 2):
        want.setdefault(c, set()).add(signed[d])
    for limit in (50_000, 3):  # whole cells, and cells cut again and again
        monkeypatch.setattr(simhash, "CELL_ROWS", limit)
        found = {}
        for fp, root in got(connected(links(points, 2))):
            found.setdefault(root, {root}).add(fp)
        assert sorted(map(sorted, found.values())) == sorted(sorted(g) for g in want.values() if len(g) > 1)


def test_edges_per_cell_are_linear():
    prints = np.array(sorted({1 << a | 1 << b for a in range(40) for b in range(40)}), dtype=np.uint64)
    a, b = simhash.cell_edges(np.zeros(prints.size, np.int64), prints, 2)
    assert a.size < prints.size and np.unique(b).size == 1


def test_one_row_of_each_group_stays(odd, none):
    kept = one_per_component(odd)
    assert kept.columns == odd.columns
    out = got(kept.select("doc_id", "text"))
    # empty texts, near copies and repeated rows leave their smallest id; no text is lost
    assert [r[0] for r in out] == [0, 3, 4, 5, 7, 8, 9]
    assert one_per_component(none).collect() == []
    assert fingerprints(odd).where(F.col("fp").isNull()).count() == 0
