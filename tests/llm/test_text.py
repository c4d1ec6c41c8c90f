"""Decontamination, search, cross-entropy and WARC against brute force."""

import base64
import gzip
import hashlib
import io
import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import decontam, search, warc
from tessera.llm.decontam import ItemIndex, bag, contamination, similarity, uncontaminated
from tessera.llm.lmscore import MU, NU, cross_entropy_difference
from tessera.llm.search import B, K1, build_index, document_queries, similar_documents, statistics
from tessera.llm.words import spaced_words, word_counts, words_of

from .conftest import LONG, got, rows

SF = "/root/testdata/sf0.001"
ITEM = "the quick brown fox jumps over a lazy dog while seven wizards mix potions in the dark cellar below"


# --- decontamination

def all_windows(text, items, threshold=0.8):
    """Best similarity of each item over all windows of its length."""
    words, out = words_of(text), {}
    for item, t in items:
        w = words_of(t)
        if not w or not words:
            continue
        k, size = min(5, len(w)), len(w)
        best = max((similarity(bag(words[s:s + size], k), bag(w, k)), -s) for s in range(max(1, len(words) - size + 1)))
        if best[0] >= threshold:
            out[item] = (best[0], -best[1])
    return out


def test_windows_equal_brute_force():
    rng = np.random.default_rng(8)
    vocab = [f"w{i}" for i in range(60)]
    text = lambda n: " ".join(rng.choice(vocab, n))
    items = [(k, text(int(rng.integers(5, 60)))) for k in range(30)] + [(90, "only three words"), (91, ITEM), (92, ITEM)]
    docs = [text(200) for _ in range(20)] + [None, "", "w1", "only three words", "Only, THREE words!"]
    for k in range(60):  # exact and altered passages at the start, inside and at the end
        w = items[k % 30][1].split()
        for _ in range(k // 20):
            w[int(rng.integers(len(w)))] = "changed"
        docs.append(" ".join([text(k % 7), *w, text(k % 5)]))
    docs += [ITEM, "x " + ITEM + " y " + ITEM, " ".join(ITEM.split()[:-2]), (LONG[:9000] + ITEM + LONG[:9000])]
    index = ItemIndex(items)
    for d in docs:
        assert {h[0]: (h[1], h[2]) for h in index.hits(d)} == all_windows(d, items), d and d[:60]


def test_multi_index_finds_all_within_radius():
    rng = np.random.default_rng(9)
    index = ItemIndex([(k, " ".join(f"a{x}" for x in rng.integers(0, 999, 12))) for k in range(50)])
    group = index.lengths[0]
    fp = np.array([int(p) ^ sum(1 << int(b) for b in rng.choice(64, n, replace=False)) for p in group.prints for n in (0, 5, 14, 22, 23)], dtype=np.uint64)
    found = {(w, i) for w, i, _ in group.near(fp, 22)}
    exact = {(w, i) for w, f in enumerate(fp.tolist()) for i, p in enumerate(group.prints.tolist()) if bin(f ^ p).count("1") <= 22}
    assert found == exact


def test_contamination_table(spark, odd, none, monkeypatch):
    items = spark.createDataFrame([(1, ITEM, 1), (2, None, 2), (3, "", 3), (None, "near copy of a text with many words that nobody else has written here", 4), (4, "zzz", 5)],
                                  "item_id long, text string, doc_id long")
    want = [(None, None), (5, None), (5, None), (5, None), (6, None)]
    for block in (20_000, 2):  # one block of items, or several
        monkeypatch.setattr(decontam, "ITEM_BLOCK", block)
        assert got(contamination(odd, items).select("doc_id", "item_id")) == want
        clean = uncontaminated(odd, items)
        assert clean.columns == odd.columns and clean.count() == len(rows()) - 5
    assert contamination(none, items).collect() == [] and contamination(odd, items.where("false")).collect() == []
    docs, bench = spark.read.parquet(f"{SF}/documents.parquet").where("n_chars < 2500"), spark.read.parquet(f"{SF}/benchmark.parquet")
    listed = [(r["item_id"], r["text"]) for r in bench.collect()]
    brute = sorted((r["doc_id"], i, round(s, 9)) for r in docs.collect() for i, (s, _) in all_windows(r["text"], listed).items())
    out = contamination(docs, bench)
    assert sorted((r["doc_id"], r["item_id"], round(r["similarity"], 9)) for r in out.collect()) == brute and brute


# --- search

def brute_search(docs, every, k):
    texts = [(d, Counter(words_of(t))) for d, t in docs]
    n, mean = len(texts), sum(c.total() for _, c in texts) / len(texts)
    df = Counter(w for _, c in texts for w in c)
    idf = {w: math.log(1 + (n - f + 0.5) / (f + 0.5)) for w, f in df.items()}
    asked = defaultdict(Counter)
    for d, c in texts:
        if d is not None and d % every == 0 and c:
            asked[d].update(c)
    out = []
    for q, c in asked.items():
        hits = []
        for d, t in texts:
            s = sum(idf[w] * t[w] * (K1 + 1) / (t[w] + K1 * (1 - B + B * t.total() / mean)) for w in sorted(c) if w in t)
            if s > 0:
                hits.append((-round(s, 9), d is None, d or 0, s))
        out += [(q, r + 1, None if h[1] else h[2], round(h[3], 6)) for r, h in enumerate(sorted(hits)[:k])]
    return sorted(out, key=lambda r: r[:2])


@pytest.mark.parametrize("shard,block", [(8192, 64), (16, 2)])
def test_search_equals_brute_force(spark, odd, monkeypatch, shard, block):
    monkeypatch.setattr(search, "SHARD_DOCS", shard)
    monkeypatch.setattr(search, "BLOCK", block)
    monkeypatch.setattr(search, "QUERY_BLOCK", 3)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for df, data, every in ((docs, [(r["doc_id"], r["text"]) for r in docs.collect()], 25), (odd, [(r[0], r[1]) for r in rows()], 1)):
        out = sorted((tuple(r) for r in similar_documents(df, every, 5).collect()), key=lambda r: r[:2])
        want = brute_search(data, every, 5)
        assert [r[:3] for r in out] == [r[:3] for r in want]
        assert np.allclose([r[3] for r in out], [r[3] for r in want], atol=2e-6)


def test_search_in_blocks_of_terms(spark, monkeypatch):
    """All distinct terms of a query document count, in blocks of bounded terms."""
    monkeypatch.setattr(search, "QUERY_TERMS", 500)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    data = [(r["doc_id"], r["text"]) for r in docs.collect()]
    out = sorted((tuple(r) for r in similar_documents(docs, 25, 5).collect()), key=lambda r: r[:2])
    want = brute_search(data, 25, 5)
    assert [r[:3] for r in out] == [r[:3] for r in want]
    assert np.allclose([r[3] for r in out], [r[3] for r in want], atol=2e-6)


def test_search_empty(none):
    assert similar_documents(none).collect() == []


def held(spark, texts):
    index = build_index(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1))
    dfs, n, mean = statistics(index)
    shard = search.Shard(index.first().asDict(), mean)
    names = shard.terms.to_pylist()
    return shard, {w: i for i, w in enumerate(names)}, {bytes(r["term"]): r["df"] for r in dfs.collect()}


def asked(shard, number, weights, k, best=()):
    """The answer, and the postings whose impact was computed of those that the terms have."""
    shard.read = shard.met = 0
    out = shard.top(np.array([number[w] for w in weights]), np.array(list(weights.values())), k, best)
    return out, shard.read, shard.met


def test_blocks_are_skipped(spark):
    """Pivots leave postings of common and of rare terms unread; the answer is that of all documents."""
    texts = [f"common filler w{i}" for i in range(640)] + ["rare rare rare common"] + ["rare " + "pad " * 400 for _ in range(30)]
    shard, number, df = held(spark, texts)
    assert df[b"common"] == 641 and df[b"rare"] == 31
    (best, *_), read, met = asked(shard, number, {b"common": 0.001, b"rare": 6.0}, 1)
    assert best[1] == 640 and met == 672 and read < met // 2
    # a threshold that the common term alone cannot reach: its blocks stay shut but for the pivot's
    out, read, _ = asked(shard, number, {b"common": 0.001, b"rare": 6.0}, 1, [(best[0] - 1, 5)])
    assert out == [best] and read <= 1 + search.BLOCK + 31
    # a threshold above the shard's largest impacts: nothing is read
    assert asked(shard, number, {b"common": 0.001, b"rare": 6.0}, 1, [(99.0, 5)])[:2] == ([(99.0, 5)], 0)
    # rare terms whose documents stay below the threshold are no pivots
    out, read, met = asked(shard, number, {b"rare": 6.0, **{b"w%d" % i: 0.01 for i in range(300)}}, 1, [(best[0] - 1, 5)])
    assert out[0][1] == 640 and read < 31 + 300 and met == 331


def test_common_terms_of_many_queries_together(spark):
    """One product for the common terms of a block of queries: the answers of one query after the other, most postings not looked up."""
    rng = np.random.default_rng(1)
    words = {lang: [f"{lang}{i}" for i in range(40)] for lang in "ab"}
    lang = ["a"] * 300 + ["b"] * 300
    texts = [" ".join([*rng.choice(words[x], 60), f"own{i}", f"pair{i // 2}"]) for i, x in enumerate(lang)]
    shard, number, df = held(spark, texts)
    idf = {w: math.log(1 + (600 - f + 0.5) / (f + 0.5)) for w, f in df.items()}
    queries = []
    for i in range(0, 300, 15):
        mine = sorted(set(words_of(texts[i])))
        queries.append((np.array([number[w] for w in mine]), np.array([idf[w] for w in mine])))
    one_by_one = [shard.top(t, w, 5) for t, w in queries]
    met, shard.read, shard.met = shard.met, 0, 0
    assert shard.tops(queries, 5, [[] for _ in queries]) == one_by_one
    assert shard.met == met and shard.read < met // 20 and shard.shut == 0
    # with thresholds of earlier shards, documents of the other language stay out of the product
    assert shard.tops(queries, 5, one_by_one)[0][0] == one_by_one[0][0] and shard.shut >= 20 * 200


def test_queries_are_not_searched_one_by_one(spark, monkeypatch):
    """A block of queries is summed together, and hits are ranked by exact scores, closer than single precision tells."""
    texts = [f"{'word ' * 2}q{i % 20} {'pad ' * (3000 + i)}" for i in range(400)] + [f"q{i}" for i in range(20)]
    shard, number, df = held(spark, texts)
    queries = [(np.array([number[b"word"], number[b"q%d" % i]]), np.array([2.0, 1e-3])) for i in range(20)]
    one_by_one = [shard.top(t, w, 5) for t, w in queries]
    assert [d for _, d in one_by_one[3]] == [3, 0, 1, 2, 4]
    monkeypatch.delattr(search.Shard, "top")
    if hasattr(search.Shard, "_pivots"):
        monkeypatch.delattr(search.Shard, "_pivots")
    assert shard.tops(queries, 5, [[] for _ in queries]) == one_by_one


def test_first_shards_give_thresholds(spark, monkeypatch):
    """Hits that the first shards rule out are left out of the others; the answer is that of all documents."""
    monkeypatch.setattr(search, "FIRST_SHARDS", 3)
    names, landed = [], search.landed
    monkeypatch.setattr(search, "landed", lambda df, name: names.append(name) or landed(df, name))
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(12)
    records = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    out = sorted((tuple(r) for r in similar_documents(docs, 10, 5).collect()), key=lambda r: r[:2])
    want = brute_search([(r["doc_id"], r["text"]) for r in docs.collect()], 10, 5)
    assert [r[:3] for r in out] == [r[:3] for r in want]
    assert np.allclose([r[3] for r in out], [r[3] for r in want], atol=2e-6)
    assert names.count("bm25-hits") == 2 and spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == records


def test_floor_leaves_hits_out(spark, monkeypatch):
    shard, number, _ = held(spark, [f"a b{i % 9} c{i}" for i in range(300)])
    cut, terms, weights = np.array([0, 2, 4]), np.array([number[b"a"], number[b"b1"], number[b"a"], number[b"c7"]]), np.array([0.1, 1.0, 0.1, 5.0])
    for few in (1, 8):
        monkeypatch.setattr(search, "FEW_QUERIES", few)
        (x, y), (u, v) = [shard.together(cut, terms, weights, 3, [[], []], floor) for floor in (np.zeros(2), np.array([1e3, 2.0]))]
        assert [d for _, d in x] == [1, 10, 19] and y[0][1] == 7 and len(y) == 3
        assert u == [] and v == y[:1]


def test_word_counts():
    """Words of many texts counted at once are those of each text."""
    texts = [None, "", "a", "b a B", " x", "é\n日本 A1-b", "\x00z\x0b\x1cq\x85\xa0r", "tail "]
    for some in (texts, texts[::-1], [None], []):
        lengths, sizes, codes, counts, words = word_counts([t and t.encode() for t in some])
        pairs = iter(zip(words.take(codes).to_pylist(), counts.tolist()))
        assert [{w: n for w, n in (next(pairs) for _ in range(k))} for k in sizes] == [Counter(words_of(t)) for t in some]
        assert lengths.tolist() == [len(words_of(t)) for t in some] and not list(pairs)


def test_alike_documents_are_neighbours(spark):
    shard, number, _ = held(spark, [f"{'der der' if i % 2 else 'the the'} x{i}" for i in range(400)])
    the = shard.docs[shard.start[number[b"the"]]:shard.start[number[b"the"] + 1]]
    assert the[-1] - the[0] == 199


def test_queries_have_all_terms(spark):
    df = spark.createDataFrame([(0, "a a a b c"), (0, "a d"), (1, "a b"), (100, None), (None, "a")], "doc_id long, text string")
    dfs, n, _ = statistics(build_index(df))
    q = document_queries(df.where("doc_id % 100 = 0"), dfs, n).collect()
    assert n == 5 and [(r["query_id"], r["terms"]) for r in q] == [(0, [b"a", b"b", b"c", b"d"])]


# --- cross-entropy difference

def brute_scores(docs, target):
    def count(texts):
        uni, pair = Counter(), Counter()
        for t in texts:
            w = [0, *spaced_words(t), 1]
            uni.update(w[1:])
            pair.update(zip(w, w[1:]))
        return uni, pair

    (ub, pb), (ut, pt) = count(t for _, t in docs), count(target)
    nb, nt = ub.total(), ut.total()
    out = []
    for d, t in docs:
        w = [0, *spaced_words(t), 1]
        lt = lb = 0.0
        for v, x in zip(w, w[1:]):
            h = 1 if v == 0 else v
            qb = ub[x] / nb
            qt = (ut[x] + NU * qb) / (nt + NU)
            lb -= math.log((pb[v, x] + MU * qb) / (ub[h] + MU))
            lt -= math.log((pt[v, x] + MU * qt) / (ut[h] + MU))
        n = len(w) - 1
        out.append((d, n, round(lt / n, 6), round(lb / n, 6), round((lt - lb) / n, 6)))
    return out


@pytest.mark.parametrize("block_bytes", [12 << 20, 20_000])
def test_cross_entropy_equals_brute_force(spark, odd, none, block_bytes):
    talk = spark.read.parquet(f"{SF}/conversations.parquet")
    said = [r["text"] for r in talk.collect()] + [None, ""]
    aim = talk.select("text").unionByName(spark.createDataFrame([(None,), ("",)], "text string"))
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1:])
    for df, data in ((docs, [(r["doc_id"], r["text"]) for r in docs.collect()]), (odd, [(r[0], r[1]) for r in rows()])):
        for t, heard in ((aim, said), (aim.where("false"), [])):
            out = sorted((tuple(r) for r in cross_entropy_difference(df, t, block_bytes).collect()), key=key)
            want = sorted(brute_scores(data, heard), key=key)
            assert [r[:2] for r in out] == [r[:2] for r in want]
            assert np.allclose([r[2:] for r in out], [r[2:] for r in want], atol=2e-6)
    assert cross_entropy_difference(none, aim).collect() == []


# --- WARC

def test_warc_round_trip(spark, tmp_path):
    data = [(1, "http://a/x", "<p>é</p>", "q"), (2, "http://b", "<p>é</p>", "q"), (3, None, None, "q"), (4, "u\r\nv%0A", "", "q"), (5, "http://c", "WARC/1.1\r\n\r\n" * 3, None),
            (5, "http://c", "WARC/1.1\r\n\r\n" * 3, None), (None, "http://d", "<p>é</p>", None), (None, "z", "alone", None), (7, "http://e", LONG, None)]
    path = str(tmp_path / "pages")
    spark.createDataFrame(data, "page_id long, url string, html string, digest string").coalesce(2).write.parquet(path)
    pages = spark.read.parquet(path)
    out = got(warc.warc_round_trip(spark, pages, folder=str(tmp_path / "w")))

    def row(page, html, kind="response", to=None):
        raw = (html or "").encode()
        return (page, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), kind, to)

    key = lambda r: tuple((v is not None, v if v is not None else 0) for v in r)
    assert out == sorted([row(1, data[0][2]), row(2, data[0][2], "revisit", 1), row(3, None), row(4, "", "revisit", 3), row(5, data[4][2]),
                          row(5, data[4][2], "revisit", 5), row(None, data[0][2], "revisit", 1), row(None, "alone"), row(7, LONG)], key=key)
    small = got(warc.warc_round_trip(spark, pages, least=20).select("page_id", "record_type"))
    assert sum(k == "revisit" for _, k in small) == 1  # only the repeated page 5 is as long
    assert warc.warc_round_trip(spark, pages.where("false")).collect() == []


def test_captures_are_nested_rows(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a/x?y=1", "hello")], "page_id long, url string, html string")
    archives = warc.write_archives(pages, str(tmp_path / "w"))
    r = warc.transactions(warc.read_records(archives)).first()
    assert bytes(r["capture"]["block"]).endswith(b"\r\n\r\nhello") and r["capture"]["target_uri"] == "http://a/x?y=1"
    assert bytes(r["requests"][0]["block"]).startswith(b"GET /x?y=1 HTTP/1.1\r\nHost: a\r\n")
    assert bytes(r["metadata"][0]["block"]) == b"page-id: 1\r\n"
    # every record is a gzip member of its own; plain archives are read too
    path = archives.first()["path"]
    raw = gzip.decompress(open(path, "rb").read())
    assert [h["warc-type"] for h, _ in warc.parse_records(io.BytesIO(raw))] == ["request", "response", "metadata"]
    with pytest.raises(ValueError):
        list(warc.parse_records(io.BytesIO(raw[:-20])))


def test_archives_are_cut_by_size(spark, tmp_path):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    archives = warc.write_archives(pages, str(tmp_path / "w"), archive_bytes=50_000)
    a = archives.agg(F.count("*").alias("n"), F.sum("captures").alias("c")).first()
    assert a["n"] > 2 and a["c"] == pages.count()
    assert warc.read_records(archives).groupBy("record_type").count().count() == 3
