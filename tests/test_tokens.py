"""Token table edges."""

from pyspark.sql import functions as F

from tessera.constants import BOS_ID, EOS_ID, LABEL_IGNORE, PAD_ID, UNK_ID
from tessera.operators.tokens import build_vocabulary, encode, pad_batch, padding_efficiency, size_batches


def test_length_edges_and_empty_text(spark):
    texts = [("a", 1, " ".join(["w"] * 2877)), ("a", 2, " ".join(["w"] * 2878)),
             ("a", 3, " ".join(["w"] * 2879)), ("a", 4, "  \n\t "), ("a", 5, "w zz")]
    df = spark.createDataFrame(texts, "source string, row_id long, text string")
    vocab = build_vocabulary(df, 10)
    enc = {r["row_id"]: r for r in encode(df, vocab, ["source", "row_id"], max_len=2880).collect()}
    assert [enc[i]["n_tokens"] for i in (1, 2, 3)] == [2879, 2880, 2880]
    assert [enc[i]["n_dropped"] for i in (1, 2, 3)] == [0, 0, 1]
    assert enc[4]["input_ids"] == [BOS_ID, EOS_ID] and enc[4]["n_tokens"] == 2
    w_id = {r["token"]: r["id"] for r in vocab.collect()}["w"]
    assert w_id == 4 and enc[5]["input_ids"][:2] == [BOS_ID, w_id]
    small = build_vocabulary(df, 1)
    enc2 = {r["row_id"]: r for r in encode(df, small, ["source", "row_id"], max_len=2880).collect()}
    assert enc2[5]["input_ids"] == [BOS_ID, w_id, UNK_ID, EOS_ID]


def test_vocabulary_order_and_ties(spark):
    df = spark.createDataFrame([("s", 1, "b a c a b d")], "source string, row_id long, text string")
    got = [(r["token"], r["id"], r["cnt"]) for r in build_vocabulary(df, 3).orderBy("id").collect()]
    assert got == [("a", 4, 2), ("b", 5, 2), ("c", 6, 1)]


def padded(spark, rows, **kw):
    """Samples (batch, lane) whose ids are stored under their own key."""
    ids = spark.createDataFrame([(k, x, len(x)) for k, (_, _, x) in enumerate(rows)], "key long, input_ids array<int>, n_tokens int")
    samples = spark.createDataFrame([(k, b, lane) for k, (b, lane, _) in enumerate(rows)], "key long, batch_id long, lane int")
    sized = size_batches(samples, ids, ["key"])
    return sized, pad_batch(sized, ids, ["key"], **kw)


def test_pad_to_multiple_of_8(spark):
    rows = [(0, 0, list(range(1, 8))), (0, 1, [5]), (1, 0, list(range(1, 9))), (2, 0, list(range(1, 10))),
            (2, 1, [1, 2])]
    sized, out = padded(spark, rows)
    p = {(r["batch_id"], r["lane"]): r for r in out.collect()}
    assert p[(0, 0)]["padded_len"] == 8 and p[(1, 0)]["padded_len"] == 8 and p[(2, 0)]["padded_len"] == 16
    r = p[(0, 1)]
    assert r["padded_ids"] == [5] + [PAD_ID] * 7
    assert r["attention_mask"] == [1] + [0] * 7
    assert r["labels"] == [5] + [LABEL_IGNORE] * 7
    eff = {r["batch_id"]: r["efficiency"] for r in padding_efficiency(sized).collect()}
    assert eff[0] == 8 / 16 and eff[1] == 1.0 and eff[2] == 11 / 32


def test_labels_follow_pad_id(spark):
    # pad falling back to EOS masks every EOS too
    _, out = padded(spark, [(0, 0, [2, 7, 1]), (0, 1, [2, 1])], pad_id=EOS_ID)
    r = {x["lane"]: x["labels"] for x in out.collect()}
    assert r[0] == [2, 7, LABEL_IGNORE] + [LABEL_IGNORE] * 5
    assert F is not None


def test_encode_beyond_the_lookup_bound(spark, monkeypatch):
    from tessera.operators import tokens
    df = spark.createDataFrame([("s", i, " ".join(f"w{j * i % 23}" for j in range(i % 17))) for i in range(80)] + [("s", 90, None)],
                               "source string, row_id long, text string")
    vocab = build_vocabulary(df, 12)
    read = lambda: sorted(map(tuple, encode(df, vocab, ["source", "row_id"], max_len=10).collect()))
    small = read()
    monkeypatch.setattr(tokens, "LOOKUP_ROWS", 0)
    assert read() == small and any(UNK_ID in r[2] for r in small)


def test_hook_beyond_the_lookup_bound(spark, monkeypatch):
    """A large vocabulary does not pass through the driver, and the ids stay the same."""
    from tessera.functions.hooks import whitespace_tokenizer
    from tessera.operators import tokens
    df = spark.createDataFrame([("s", i, " ".join(f"w{j * i % 23}" for j in range(i % 17))) for i in range(80)] + [("s", 90, None)],
                               "source string, row_id long, text string")
    vocab = build_vocabulary(df, 12)
    keep = [F.length("text").alias("chars")]
    read = lambda: sorted(map(tuple, tokens.encode_with(df, whitespace_tokenizer(vocab, 10), ["source", "row_id"], max_len=10, keep=keep)
                              .collect()), key=lambda r: r[:2])
    small = read()
    monkeypatch.setattr(tokens, "LOOKUP_ROWS", 0)
    monkeypatch.setattr(type(df), "toLocalIterator", None)
    assert read() == small and any(UNK_ID in r[3] for r in small)


def test_hook_keeps_the_end_token(spark):
    from tessera.operators.tokens import encode_with
    df = spark.createDataFrame([("s", 1, "x")], "source string, row_id long, text string")
    for ids, want in (([2, 10, 11, 12, 13, 14, EOS_ID], [2, 10, 11, 12, EOS_ID]), ([2, 3, 4, 5, 6, 7], [2, 3, 4, 5, 6])):
        assert encode_with(df, lambda t, ids=ids: [ids for _ in t], ["row_id"], max_len=5).first()["input_ids"] == want


def test_vocabulary_of_all_words(spark):
    df = spark.createDataFrame([("s", i, " ".join(f"w{j}" for j in range(i % 17 + 1))) for i in range(300)],
                               "source string, row_id long, text string")
    every = [(r["token"], r["id"]) for r in build_vocabulary(df).orderBy("id").collect()]
    assert len(every) == 17 and every[:12] == [(r["token"], r["id"]) for r in build_vocabulary(df, 12).orderBy("id").collect()]


def test_only_rare_words_are_joined(spark, monkeypatch):
    """Beyond the bound the frequent words are looked up; the plan's join meets the other words only."""
    from tessera.operators import tokens
    rows = [("s", i, " ".join(["the"] * 20 + [f"w{j * i % 23}" for j in range(i % 17)])) for i in range(80)] + [("s", 90, None), ("s", 91, "")]
    df = spark.createDataFrame(rows, "source string, row_id long, text string")
    vocab = build_vocabulary(df, 12)
    read = lambda: sorted(map(tuple, encode(df, vocab, ["source", "row_id"], max_len=30).collect()))
    small = read()
    monkeypatch.setattr(tokens, "LOOKUP_ROWS", 5)
    stored = []
    cut = tokens.cut_lineage
    monkeypatch.setattr(tokens, "cut_lineage", lambda d: stored.append(cut(d)) or stored[-1])
    assert read() == small
    rare = [w for r in stored[0].select("_f.rare").collect() for w in r[0]]
    assert rare and "the" not in rare
