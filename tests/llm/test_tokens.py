import functools
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tessera.llm.bpe import Encoder
from tessera.llm.packing import SumOfSquares, best_fit_packing
from tessera.llm.tokenstore import PerfectHash, Shard, lookup, read_store, token_store, write_shard, write_store

from .conftest import got, rows

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "\n", "a  b", " a", "a\n\n\nb", "a \n b", "it's we'll I'D", "x\t\ty \r\n z", "½5a3", "naïve Straße ÀÉ ŒUVRE",
       "<|endoftext|> a<|endoftext|>b", "日本語 テスト。", "éa ́", "a\x1cb!!\x1c!!", "　x y ", "İstanbul ΣΑΣ",
       "foo_bar __x__ don't 'tis", "hello,world!  \n", "\n\n lead", "tail\n", "ſ ß K", "a\u0000b ​", "SS!! Aa,\nBb."]


library = functools.lru_cache(Tokenizer.from_file)


def ids(path, text):
    return np.array(library(path).encode(text or "", add_special_tokens=False).ids, dtype="<u4")


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_encoder_equals_library(path, spark):
    enc, tok = Encoder(path), Tokenizer.from_file(path)
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    for t in [*ODD, *["we " + t + " of" for t in ODD], *texts[:120], ODD[4] * 50]:
        assert enc.encode(t) == np.array(tok.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes(), t[:80]
    assert enc.encode(None) == b""


def test_sum_of_squares_rule():
    rng = np.random.default_rng(3)
    sizes, cap = rng.integers(1, 31, 400).tolist(), 30
    bins, fill, seen = SumOfSquares(cap, 0), {}, []
    for s in sizes:
        options = {None: None}
        options |= {cap - f: b for b, f in fill.items() if cap - f >= s}

        def cost(gap):
            after = {b: f for b, f in fill.items()}
            after[options[gap]] = s if gap is None else cap - gap + s
            counts = np.bincount([cap - f for f in after.values()], minlength=cap + 1)
            return int((counts[1:] ** 2).sum())

        best = min(map(cost, options))
        b, at = bins.place(s)
        seen.append((b, at))
        gap = cap - fill[b] if b in fill else None
        assert at == fill.get(b, 0) and cost(gap) == best
        fill[b] = at + s
        assert fill[b] <= cap
    assert len(fill) < sum(sizes) / cap * 1.2


def check_packing(out, documents, cap=2048):
    """Every document's ids are there once, sequences have no gaps and fit."""
    expected = sorted((d if d is not None else -1, k, at, len(x[at:at + cap]), zlib.crc32(x[at:at + cap].tobytes()))
                      for d, t in documents for x in [np.append(ids(WORD, t), 0).astype("<u4")] for k, at in enumerate(range(0, x.size, cap)))
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out) == expected
    places = {}
    for r in out:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for p in places.values():
        at = 0
        for offset, length in sorted(p):
            assert offset == at
            at += length
        assert at <= cap
    return len(places)


def test_packing_odd_rows(odd, none):
    n = check_packing(best_fit_packing(odd, WORD).collect(), [(r[0], r[1]) for r in rows()])
    assert n == 20  # 40,001 ids and a few more
    assert best_fit_packing(none, WORD).collect() == []


def test_packing_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = best_fit_packing(docs, WORD).collect()
    n = check_packing(out, [(r["doc_id"], r["text"]) for r in docs.collect()])
    assert n <= 1.03 * sum(r["length"] for r in out) / 2048 + 1


def test_perfect_hash():
    keys = np.unique(np.random.default_rng(1).integers(0, 2**63, 5000, dtype=np.uint64))
    ph = PerfectHash.build(keys)
    assert sorted(ph.slots(keys).tolist()) == list(range(keys.size))
    assert PerfectHash.build(keys[:0]).slots(keys[:3]).tolist() == [-1] * 3


@pytest.mark.parametrize("wide", [False, True])
def test_shard_file(tmp_path, wide):
    docs = [(None, [9]), (-5, [1, 2, 3]), (7, []), (7, [4]), (2**62, [65535])]
    path = str(tmp_path / "x.ids")
    assert write_shard(path, [np.array(x, "<u4").tobytes() for _, x in docs], [d for d, _ in docs], wide) == 6
    s = Shard(path)
    assert [list(r) for r in s.rows_of(np.array([-5, 7, 2**62, 8, 0]))] == [[1], [2, 3], [4], [], []]
    assert [s.ids(r).tolist() for r in range(5)] == [x for _, x in docs]


def expected_store(documents):
    order = sorted(documents, key=lambda d: (d[0] is not None, d[0] or 0))
    out, at = [], 0
    for d, t in order:
        x = np.append(ids(BYTE, t), 2).astype("<u4")
        out.append((d, at, x.size, zlib.crc32(x.tobytes())))
        at += x.size
    return out


def test_store_round_trip(spark, odd, none):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = got(token_store(spark, docs, BYTE, 2).select("doc_id", "start", "n_tokens", "ids_crc32"))
    assert out == expected_store([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert token_store(spark, none, BYTE, 2).collect() == []
    odd_out = token_store(spark, odd, BYTE, 2).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    want = expected_store([(r[0], r[1]) for r in rows()])
    key = lambda r: (r[0] is not None, r[0] or 0, r[2], r[3])
    assert sorted((tuple(r) for r in odd_out), key=key)[2:] == sorted(want, key=key)[2:]
    assert sum(r["n_tokens"] for r in odd_out) == sum(r[2] for r in want)
    at = 0
    for r in sorted(odd_out, key=lambda r: r["start"]):  # gapless
        assert r["start"] == at
        at += r["n_tokens"]


def test_store_lookup(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    manifest = write_store(docs, BYTE, 2, str(tmp_path / "store"), shard_bytes=60_000)
    assert manifest.count() > 4
    keys = spark.createDataFrame([(3,), (150,), (3,), (99_999,), (None,)], "doc_id long")
    out = {r["doc_id"]: r["ids"] for r in lookup(manifest, keys).collect()}
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert out == {d: [*ids(BYTE, text[d]).tolist(), 2] for d in (3, 150)}
    assert read_store(manifest).count() == docs.count()
