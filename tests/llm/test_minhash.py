"""MinHash near-duplicates against comparing all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import minhash
from tessera.llm.minhash import COORDINATES, MATCHES, merge, minhash_components, minima, postings, shingle_set

from .conftest import got, rows

SF = "/root/testdata/sf0.001"


def plain_set(text):
    w = (text or "").encode().lower().split()
    return frozenset(zip(w, w[1:])) if len(w) > 1 else frozenset(w)


def plain(docs):
    """The contract's rows, by comparing all pairs of sets."""
    sets = [plain_set(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[i + 1:], i + 1):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                root[find(j)] = find(i)
    low = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            low[find(i)] = min(d, low.get(find(i), d))
    return [(d, len(s), low.get(find(i)), d == low.get(find(i))) for i, ((d, _), s) in enumerate(zip(docs, sets))]


def key(r):
    return tuple((v is not None, v if v is not None else 0) for v in r)


def near_copies(n=260, seed=4):
    """Chains and stars around few texts: many pairs lie close to the limit."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    out = []
    for _ in range(4):
        base = rng.sample(words, 60)
        for _ in range(n // 5):
            t = list(base if rng.random() < 0.6 else out[-1].split() if out else base)
            for _ in range(rng.randint(0, 5)):
                t[rng.randrange(len(t))] = rng.choice(words)
            out.append(" ".join(t))
    common = "the same passage in many documents that are not alike at all "
    return out + [common + " ".join(rng.sample(words, 40)) for _ in range(n // 5)]


@pytest.fixture(scope="module")
def copies(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("copies") / "documents.parquet")
    spark.createDataFrame(list(enumerate(near_copies())), "doc_id long, text string").repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def test_documents(spark, odd, none):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    want = plain([(r["doc_id"], r["text"]) for r in table.collect()])
    assert got(minhash_components(table)) == sorted(want, key=key) and len({r[2] for r in want}) < len(want)
    assert got(minhash_components(odd)) == sorted(plain([(r[0], r[1]) for r in rows()]), key=key)
    assert minhash_components(none).collect() == []


@pytest.mark.parametrize("limit", [4096, 40, 7])
def test_hot_lists_and_clusters(copies, monkeypatch, limit):
    """Whole groups, and groups dealt to blocks."""
    monkeypatch.setattr(minhash, "GROUP_ROWS", limit)
    want = plain([(r["doc_id"], r["text"]) for r in copies.collect()])
    assert len({r[2] for r in want}) < len(want)
    assert got(minhash_components(copies)) == sorted(want, key=key)


def test_large_texts_are_dealt_out(copies, monkeypatch):
    monkeypatch.setattr(minhash, "GROUP_SHINGLES", 500)
    want = plain([(r["doc_id"], r["text"]) for r in copies.collect()])
    assert got(minhash_components(copies)) == sorted(want, key=key)


def test_sets_and_signatures():
    for t in [None, "", " ", "One", "a b", "A b a b", "a b c", "é x\té y"]:
        assert shingle_set(t).size == len(plain_set(t))
    assert shingle_set("a b")[0] != shingle_set("b a")[0] and shingle_set("a")[0] != shingle_set("b")[0]
    rng = np.random.default_rng(2)
    for share in (0.5, 0.8, 0.95):   # the share of equal coordinates estimates the similarity
        found = []
        for _ in range(60):
            every = rng.integers(0, 2**63, 400).astype(np.uint64)
            k = int(400 * share)
            a, b = minima([every[:k + (400 - k) // 2], np.concatenate([every[:k], every[k + (400 - k) // 2:]])])
            found.append((a == b).mean())
        assert abs(np.mean(found) - share) < 0.03


def test_postings_are_a_prefix(spark):
    """Sets that agree on MATCHES coordinates share a posting, whatever values are common."""
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**32, COORDINATES)
    out = []
    for i in range(80):
        s = rng.integers(0, 2**32, COORDINATES)
        s[:10] = base[:10]                             # very common values
        if i % 2:
            s = out[-1][1].copy()
            s[rng.permutation(COORDINATES)[:COORDINATES - MATCHES]] += 1
        out.append((i, s))
    sets = spark.createDataFrame([(i, 100, bytearray(s.astype("<u4").tobytes())) for i, s in out], "item long, n long, signature binary")
    lists = {}
    for r in postings(sets).collect():
        lists.setdefault(r["item"], set()).add(r["cv"])
    assert all(lists[i] & lists[i + 1] for i in range(0, 80, 2))
    assert max(map(len, lists.values())) <= COORDINATES - MATCHES + 1


def test_merging_skips_members_of_one_group():
    class Near:
        asked = 0

        def links(self, i, others):
            Near.asked += others.size
            return np.abs(others - i) <= 300

    links = merge(Near(), np.arange(1000))
    assert len(links) == 999 and Near.asked < 10_000     # all pairs are 499,500
    assert merge(Near(), np.zeros(5, int)) == []


def test_edges_are_linear(copies):
    posts = postings(copies.select(F.col("doc_id").alias("item"), F.lit(60).cast("long").alias("n"),
                                   F.lit(bytearray(4 * COORDINATES)).alias("signature")))
    assert posts.count() == copies.count() * (COORDINATES - MATCHES + 1)
