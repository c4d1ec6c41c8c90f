"""Two tokenizers over the same bytes, against whole-text encodings and plain loops."""

import hashlib
import pickle
import random
from collections import Counter
from functools import reduce

import pytest
import sentencepiece
import zstandard
from tokenizers import Tokenizer

from tessera.llm import align
from tessera.llm.align import EMPTY, START, Cutter, align_tokenizers, compose, fragment, pair
from tessera.llm.bpe import byte_alphabet
from tessera.llm.queries import tokenizer

from .conftest import got, rows

A, B = tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"
BACK = {c: b for b, c in byte_alphabet().items()}


def spans(tokens):
    out, at = [], 0
    for i, spelt in tokens:
        out.append((i, at, at + len(spelt)))
        at += len(spelt)
    return out


class Plain:
    """The contract, with the libraries' encodings of whole texts."""

    def __init__(self):
        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)

    def both(self, text):
        a = [(i, bytes(BACK[c] for c in self.a.id_to_token(i))) for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in self.b.encode(text):
            p = self.b.id_to_piece(i)
            b.append((i, bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()))
        whole = (" " + text).encode()
        return (spans(a), spans(b)) if b"".join(x for _, x in a) == whole == b"".join(x for _, x in b) else ([], [])

    def rows(self, docs):
        found, count = [], Counter()
        for doc, text in docs:
            a, b = self.both(text) if text else ([], [])
            ends = sorted({z for *_, z in a} & {z for *_, z in b})
            links = [(x, y) for x, s, e in a for y, u, v in b if s < v and u < e] if len(a) < 3000 else sweep(a, b)
            parts, low = [], 0
            for e in ends:
                parts.append(",".join(str(x) for x, s, z in a if low < z <= e) + "|" + ",".join(str(x) for x, s, z in b if low < z <= e) if len(a) < 3000 else None)
                low = e
            if len(a) >= 3000:
                parts = long_parts(a, b, ends)
            count.update(links)
            found.append((doc, len(a), len(b), len(ends), links, hashlib.sha256(";".join(parts).encode()).hexdigest() if parts else ""))
        top = {}
        for (x, y), n in count.items():
            top[y] = max(n, top.get(y, 0))
        return [(d, na, nb, ng, len(k), sum(count[x] == top[x[1]] for x in k), sum(count[x] for x in k), sha) for d, na, nb, ng, k, sha in found]


def sweep(a, b):
    """All overlapping pairs of two sorted lists of spans."""
    out, k = [], 0
    for x, s, e in a:
        while b[k][2] <= s:
            k += 1
        j = k
        while j < len(b) and b[j][1] < e:
            out.append((x, b[j][0]))
            j += 1
    return out


def long_parts(a, b, ends):
    at = {e: i for i, e in enumerate(ends)}
    groups = [([], []) for _ in ends]
    for side, tokens in enumerate((a, b)):
        g = 0
        for x, _, z in tokens:
            groups[g][side].append(str(x))
            g = at[z] + 1 if z in at else g
    return [",".join(x) + "|" + ",".join(y) for x, y in groups]


ODD = ["a", " lead", "two  spaces ", "tab\tin\n\nlines \n x\n", "it's <|endoftext|> </s> <s>", "▁under", "a▁b", "日本語のテキスト。改行\nなし", "😀😀 x",
       "\x00nul \x1c sep\x85 　wide", "ﬁ é é", "https://example.org/a?b=c&d=e#f", " ", "\n", "  \n ", "x" * 300, "don't we've I'LL 3.14,2.7", "\r\nab\r\n cd"]


def test_words_equal_whole_texts(spark):
    plain, both = Plain(), pair(A, B)
    rng = random.Random(3)
    alphabet = ["a", "the", " ", "  ", "\n", "\t", "é", "。", "日", "'s", "▁", ".", "\r", "\x1c", "1", "Ünder", "<s>", "😀", "　"]
    texts = ODD + ["".join(rng.choices(alphabet, k=rng.randint(1, 25))) for _ in range(400)]
    texts += [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").limit(20).collect()]
    for t in texts:
        block = align.Block(both)
        block.take_texts([(1, t)])
        _, pairs, times, packed = block.row(0)
        a, b = plain.both(t)
        links = Counter(y << 32 | x for x, y in (sweep(a, b) if a else []))
        assert dict(zip(pairs, times)) == {**dict.fromkeys(pairs, 0), **links}, t


def test_known_words_are_not_encoded_again(monkeypatch):
    """Neither before a run of marks, nor much used ones when memory was full; a changed word costs only few others a call."""
    both, seen = align.Pair(A, B), []
    encode = both._a_ids
    monkeypatch.setattr(both, "_a_ids", lambda piece: seen.append(piece) or encode(piece))
    monkeypatch.setattr(align, "PIECES", 20)
    known = lambda: [p for p in seen for w in ("alpha", "beta", "gamma") if w in p]
    block = align.Block(both)
    block.take_texts([(1, " ".join(["alpha beta gamma"] * 3))])
    assert known()
    seen.clear()
    block.take_texts([(2, 'alpha" beta... gamma&&& alpha"). beta?!')])
    assert seen and not known()
    seen.clear()
    block.take_texts([(3, " ".join(f"w{k}x" for k in range(500)) + " a▁b")])
    assert len(seen) < 50 and len(block.store.bad) == 1 and block.docs[-1][2] == ""
    block.row(0)
    block = align.Block(both)
    assert len(both.words) <= 10
    seen.clear()
    block.take_texts([(4, "alpha beta gamma w3x")])
    assert seen and not known()


def test_blocks_with_little_memory(spark, monkeypatch):
    """Blocks whose worker forgets words again and again."""
    plain, both, rng = Plain(), align.Pair(A, B), random.Random(5)
    monkeypatch.setattr(align, "PIECES", 40)
    docs = list(enumerate(ODD * 2 + [r["text"][:2000] for r in spark.read.parquet(f"{SF}/documents.parquet").limit(40).collect()] + [None, "", "x▁b..."]))
    rng.shuffle(docs)
    for k in range(0, len(docs), 7):
        some = docs[k:k + 7]
        block = align.Block(both)
        assert len(both.words) <= 40
        for doc in some:
            block.take_texts([doc])
        _, pairs, times, packed = block.row(0)
        *_, counts, ids, shas = pickle.loads(zstandard.decompress(packed))
        want = plain.rows(some)
        assert [(d, *c, s) for d, c, s in zip(ids, counts.tolist(), shas)] == [(*w[:5], w[7]) for w in want]
        links = Counter()
        for _, t in some:
            a, b = plain.both(t) if t else ([], [])
            links.update(y << 32 | x for x, y in (sweep(a, b) if a else []))
        assert dict(zip(pairs.tolist(), times.tolist())) == links


def pieces_of(tokens, cuts):
    """A run of (id, end) dealt to byte ranges by where tokens begin."""
    out, at = [([], []) for _ in range(len(cuts) + 1)], 0
    for i, s, e in tokens:
        k = sum(c <= s for c in cuts)
        out[k][0].append(i)
        out[k][1].append(e)
    return out


def test_composition_is_associative():
    """Fragments of any byte ranges, in any grouping, give the whole."""
    rng = random.Random(8)
    for _ in range(300):
        n = rng.randint(1, 30)
        a, b = [[(rng.randint(0, 9), s, e) for s, e in zip([0, *c], [*c, n])] for c in (sorted(rng.sample(range(1, n), rng.randint(0, n - 1))) for _ in "ab")]
        cuts = sorted(rng.sample(range(1, n), rng.randint(0, min(6, n - 1)))) if n > 1 else []
        # each sequence is cut at places of its own
        parts = [fragment(x, y) for x, y in zip(pieces_of(a, cuts), pieces_of(b, [min(n, c + rng.randint(0, 2)) for c in cuts]))]
        whole = compose(START, fragment(([x[0] for x in a], [x[2] for x in a]), ([x[0] for x in b], [x[2] for x in b])))

        def tree(p):
            if len(p) == 1:
                return p[0]
            k = rng.randint(1, len(p) - 1)
            return compose(tree(p[:k]), tree(p[k:]))

        for got_ in (reduce(compose, parts, START), compose(START, tree(parts)), tree([START, *parts, EMPTY])):
            assert got_.text == whole.text and got_.pairs == whole.pairs and not got_.a2[0] and not got_.b2[0]
            assert (got_.n_a, got_.n_b, got_.n_groups) == (len(a), len(b), whole.n_groups) == (whole.n_a, whole.n_b, whole.n_groups)
        assert whole.pairs == Counter(y << 32 | x for x, s, e in a for y, u, v in b if s < v and u < e)


@pytest.mark.parametrize("size", [3, 17, 200])
def test_chunks_equal_whole_texts(size):
    plain, both = Plain(), pair(A, B)
    opened = 0
    for t in [*ODD, " ".join(ODD) * 3, "日本語、テキスト。改行なし" * 40, "camelCase,snake_case;" * 20]:
        parts = [fragment(*both.tokens(*rest)) for _, *rest in Cutter(both, t).chunks(size)]
        opened += sum(bool(f.a[0] and f.a2[0]) or f.first is None for f in parts)
        f = reduce(compose, parts, START)
        a, b = plain.both(t)
        assert f.ok == bool(a), t
        if a:
            assert f.pairs == Counter(y << 32 | x for x, y in sweep(a, b)) and not f.a2[0] and not f.b2[0]
            assert f.text == ";".join(long_parts(a, b, sorted({z for *_, z in a} & {z for *_, z in b}))).encode()
    assert opened


def test_documents(spark, odd, none, monkeypatch):
    key = lambda r: tuple((v is not None, v if v is not None else 0) for v in r)
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = Plain().rows(docs)
    table = spark.read.parquet(f"{SF}/documents.parquet")
    assert got(align_tokenizers(table, A, B)) == sorted(want, key=key)
    monkeypatch.setattr(align, "BLOCK_DOCS", 7)
    assert got(align_tokenizers(table, A, B, chunk=500)) == sorted(want, key=key)
    docs = [(r[0], r[1]) for r in rows()]
    want = sorted(Plain().rows(docs), key=key)
    assert got(align_tokenizers(odd, A, B)) == want
    assert got(align_tokenizers(odd, A, B, chunk=20)) == want     # several levels of the tree
    assert align_tokenizers(none, A, B).collect() == []
    docs = list(enumerate(ODD))
    assert got(align_tokenizers(spark.createDataFrame(docs, "doc_id long, text string"), A, B, chunk=8)) == sorted(Plain().rows(docs), key=key)
