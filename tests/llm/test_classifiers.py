import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm.langid import CELLS, HASHES, SEEN, SHARE, LanguageModel, fit_languages, grams, identify, languages, letters_of, positions
from tessera.llm.quality import STATS, RuleModel, fit_quality, quality_scores, statistics, tree_rules, with_statistics
from tessera.llm.toxicity import KINDS, PATTERNS, VOTERS, Hits, LabelModel, Lexicon, ToxicityModel, fit_toxicity, patterns, score_toxicity, toxicity_scores

from .conftest import LONG, rows

SF = "/root/testdata/sf0.01"


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def held_out(scores, labels, column):
    r = scores.where("held_out").join(labels.where(f"{column} is not null"), "doc_id")
    return [(x["predicted"], x[column]) for x in r.collect()]


def test_quality_held_out(spark, odd, none):
    docs, labels = table(spark, "documents"), table(spark, "labels")
    out = quality_scores(docs, labels)
    got = held_out(out, labels, "quality")
    assert len(got) > 50 and np.mean([p == y for p, y in got]) >= 0.95
    r = out.agg(F.count("*").alias("n"), F.min("score").alias("a"), F.max("score").alias("z"), F.count("score").alias("k")).first()
    assert r["n"] == r["k"] == docs.count() and 0 <= r["a"] <= r["z"] <= 1
    odd_out = quality_scores(odd, labels.withColumn("lang", F.lit("x")))
    assert odd_out.count() == len(rows()) and odd_out.where("score is null").count() == 0
    assert quality_scores(none, labels).collect() == []


def test_quality_without_labels(odd, no_labels, spark):
    assert {r["score"] < 1e-9 for r in quality_scores(odd, no_labels).collect()} == {True}
    one = spark.createDataFrame([(d, 1) for d in range(9)], "doc_id long, quality int")
    assert {r["predicted"] for r in quality_scores(odd, one).collect()} == {1}


def test_rules_compile_to_columns(spark):
    debug = """RandomForestClassificationModel: uid=x
  Tree 0 (weight 1.0):
    If (feature 0 <= 2.5)
     If (feature 3 <= 0.5)
      Predict: 1.0
     Else (feature 3 > 0.5)
      Predict: 0.0
    Else (feature 0 > 2.5)
     Predict: 0.0
"""
    rules = tree_rules(debug)
    assert rules == {((STATS[0], False, 2.5),), ((STATS[0], True, 2.5),),
                     ((STATS[3], False, 0.5), (STATS[0], False, 2.5)), ((STATS[3], True, 0.5), (STATS[0], False, 2.5))}
    model = RuleModel(-1.0, [(r, 1.0 + k) for k, r in enumerate(sorted(rules))])
    texts = ["", "a b", "word " * 40, "12 34 5", None, LONG]
    out = with_statistics(spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")).select("doc_id", model.column().alias("s"))
    for r in out.collect():
        x = dict(zip(STATS, statistics(texts[r["doc_id"]])))
        z = model.bias + sum(w for rule, w in model.weights if all((x[s] > t) == above for s, above, t in rule))
        assert abs(r["s"] - 1 / (1 + np.exp(-z))) < 1e-9


def test_toxicity_held_out(spark, odd, none, no_labels):
    docs, labels = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    docs = docs.join(labels.select("doc_id"), "doc_id", "left_semi")
    out = toxicity_scores(docs, labels)
    got = held_out(out, labels, "toxic")
    hits = sum(p and y for p, y in got)
    assert hits / sum(y for _, y in got) >= 0.85 and hits / sum(p for p, _ in got) >= 0.95
    assert {r["score"] < 1e-9 for r in toxicity_scores(odd, no_labels).collect()} == {True}
    few = spark.createDataFrame([(d, int(d == 5)) for d in range(9)], "doc_id long, toxic int")
    assert toxicity_scores(odd, few).where("score between 0 and 1").count() == len(rows())
    assert toxicity_scores(none, few).collect() == []
    clash = score_toxicity(odd, ToxicityModel(Lexicon([], []), -3.0), "__s")
    assert clash.columns == [*odd.columns, "__s"]


def test_label_model_beats_the_unweighted_vote(spark):
    """The classifier trained on the label model's posteriors finds what a majority of voters leaves out, and spoils nothing."""
    docs, labels = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    docs = docs.join(labels.select("doc_id"), "doc_id", "left_semi")
    found = {}
    for name, weigh in (("model", None), ("vote", lambda v: v.mean(1)), ("lexicons", lambda v: v[:, :len(KINDS)].mean(1))):
        model = fit_toxicity(docs, labels, weigh=weigh)
        scored = score_toxicity(docs.select("doc_id", "text"), model).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
        scored = scored.withColumn("held_out", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)
        got = held_out(scored, labels, "toxic")
        hits, told, real = sum(p and y for p, y in got), sum(p for p, _ in got), sum(y for _, y in got)
        found[name] = 2 * hits / max(1, told + real)
    assert found["model"] > 0.9 and found["model"] > max(found["vote"], found["lexicons"]) + 0.1


def test_lexicon_hits_whole_words_beginnings_and_endings():
    lex = Lexicon(["bad", "éva"], ["bad", "xyz"], ["zzy", "bad"], strong=1)
    h = lex.hits("BAD, badly. Xyzzy abad évah éva")
    assert (h.words, h.strong, h.stems, h.ends, h.places) == ({0, 1}, {0}, {0, 1}, {0, 1}, [0.0])
    assert lex.hits("a bad").words == {0} and lex.hits("") == Hits() and Lexicon([], []).hits("x") == Hits()
    votes = dict(zip(KINDS, lex.votes("BAD, badly.", lex.hits("BAD, badly."))))
    assert votes == {k: k == "strong words, commoner half" for k in KINDS}


def test_pattern_voters():
    def fired(text, words=()):
        return {n for n, x in zip(PATTERNS, patterns(text, Lexicon(list(words), []).hits(text))) if x}

    assert fired("") == set() and fired("some calm words") == set()
    assert fired("STOP THAT NOISE") == {"shouting"} and fired("no! no!! no!!!") == {"exclaims"}
    assert fired("d**n h4te sooooo") == {"masked", "digits inside", "stretched"}
    assert fired("vile x" + " x" * 30 + " mean", ["vile", "mean"]) == {"two hits", "hits in both halves", "dense hits"}
    assert len(PATTERNS) + len(KINDS) == VOTERS <= 16


def drawn(rng, n, share=0.1):
    """Votes of a known model, with a copy of voter 2, and the classes."""
    y = rng.random(n) < share
    fire = [(0.7, 0.02), (0.5, 0.05), (0.6, 0.1), (0.4, 0.01)]
    v = np.stack([rng.random(n) < np.where(y, a, b) for a, b in fire], axis=1).astype(int)
    return y, np.column_stack([v, np.where(rng.random(n) < 0.9, v[:, 2], 1 - v[:, 2])]), fire


def test_label_model_finds_accuracies_and_correlation():
    """From votes of all, and labels of one row in fifty."""
    rng = np.random.default_rng(2)
    y, v, fire = drawn(rng, 20_000, 0.3)
    seen, at = np.unique(v, axis=0, return_inverse=True)
    told = np.zeros((len(seen), 2))
    np.add.at(told, (at[:400], y[:400].astype(int)), 1)
    m = LabelModel().fit(seen, np.bincount(at).astype(float), told)
    assert abs(m.prior[1] - 0.3) < 0.05
    for j, (a, b) in enumerate(fire):
        assert abs(m.accuracy[1, j] - a) < 0.1 and abs(m.accuracy[0, j] - b) < 0.06
    assert m.correlation[4, 2] == max(m.correlation[i, j] for i in range(5) for j in range(i))
    assert m.parent[2] == 4 or m.parent[4] == 2


def test_unlabelled_votes_teach_the_label_model():
    """Few and wrong labels: votes of all rows set the accuracies right, where the labels alone mislead."""
    rng = np.random.default_rng(7)
    y, v, _ = drawn(rng, 30_000)
    seen, at = np.unique(v, axis=0, return_inverse=True)
    told = np.zeros((len(seen), 2))
    wrong = np.where(rng.random(200) < 0.2, ~y[:200], y[:200])
    np.add.at(told, (at[:200], wrong.astype(int)), 1)
    weight = np.bincount(at).astype(float)
    full, alone = LabelModel().fit(seen, weight, told), LabelModel().fit(seen, told.sum(1), told)
    right = [((m._odds(seen)[at] > 0) == y).mean() for m in (full, alone)]
    assert right[0] > 0.95 and right[0] > right[1]


def test_toxicity_fit_uses_training_fold_only(spark):
    docs = spark.createDataFrame([(d, "awful text" if d % 2 else "fine text") for d in range(200)], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = fit_toxicity(docs, labels), fit_toxicity(docs, flipped)
    assert a.lexicon == b.lexicon and a.bias == b.bias and a.score("awful") > 0.5 > a.score("fine")
    q = labels.withColumnRenamed("toxic", "quality")
    q2 = flipped.withColumnRenamed("toxic", "quality")
    assert fit_quality(docs, q) == fit_quality(docs, q2)


def test_language_held_out(spark, odd, none):
    docs = table(spark, "documents")
    out = languages(docs).join(docs.select("doc_id", "lang"), "doc_id")
    r = out.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("a")).first()
    assert r["a"] >= 0.97 and out.where("score not between 0 and 1 or score is null").count() == 0
    got = {(r["doc_id"], r["lang_pred"]) for r in languages(odd).collect()}
    assert {(0, "und"), (1, "und"), (2, "und"), (8, "und"), (None, "und")} <= got and (7, "en") in got and len(got) <= len(rows())
    assert languages(none).collect() == []
    assert {r["lang_pred"] for r in languages(odd.drop("lang").withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_bloom_slices_have_no_false_negatives_and_correct_counts():
    rng = np.random.default_rng(4)
    masks, sets = np.zeros((1 << 14, 1), np.uint64), [np.unique(rng.integers(0, 2**32, 2500).astype(np.uint32)) for _ in range(3)]
    for k, s in enumerate(sets):
        for at in positions(s, HASHES, len(masks)):
            np.bitwise_or.at(masks[:, 0], at, np.uint64(1 << k))
    m = LanguageModel(["a", "b", "c"], masks)
    for k, s in enumerate(sets):
        seen = np.bitwise_and.reduce([masks[at] for at in positions(s, HASHES, len(masks))])
        assert ((seen >> np.uint64(k)) & np.uint64(1)).all()
    other = rng.integers(0, 2**32, 200_000).astype(np.uint32)
    seen = np.bitwise_and.reduce([masks[at] for at in positions(other, HASHES, len(masks))])
    for k in range(3):  # false positives are as many as the correction takes away
        assert abs(((seen >> np.uint64(k)) & np.uint64(1)).mean() - m.false[k]) < 0.01


def test_grams_cut_in_stretches(monkeypatch):
    from tessera.llm import langid

    raw = letters_of(LONG[:5000] + "é")
    whole = np.concatenate(list(grams(raw)))
    monkeypatch.setattr(langid, "STRETCH", 64)
    assert (np.concatenate(list(grams(raw))) == whole).all()
    assert letters_of("12 34 !") == letters_of(None) == b"" and letters_of("Ä1") != b""


def test_language_fit_ignores_held_out_fold(spark):
    docs = table(spark, "documents").limit(300)
    wrong = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit("zz")).otherwise(F.col("lang")))
    a, b = fit_languages(docs), fit_languages(wrong)
    assert a.languages == b.languages and (a.masks == b.masks).all()
    assert identify(docs, a).columns == ["doc_id", "lang_pred", "score"]


def plain_languages(docs):
    """Languages by plain sets of grams: (doc_id, prediction, known grams of each language)."""
    train, order = {}, {}
    for d, t, lang in docs:
        if d is not None and lang is not None and zlib.crc32(str(d).encode()) % 4 != 2:
            order[lang] = order.get(lang, 0) + 1
            for g in grams(letters_of(t)):
                train.setdefault(lang, Counter()).update(g.tolist())
    names = sorted(order, key=lambda x: (-order[x], x))
    share = {x: {g: n / c.total() for g, n in c.items()} for x, c in train.items()}
    best = Counter()
    for x in share.values():
        for g, p in x.items():
            best[g] = max(best[g], p)
    sets = {x: {g for g, p in share.get(x, {}).items() if p >= SHARE * best[g] and train[x][g] >= SEEN} for x in names}
    out = []
    for d, t, _ in docs:
        raw = letters_of(t)
        if not raw:
            out.append((d, "und", None))
            continue
        held = [g for part in grams(raw) for g in part.tolist()]
        counts = [sum(g in sets[x] for g in held) for x in names]
        out.append((d, names[int(np.argmax(counts))], counts))
    return out


def test_languages_equal_plain_sets(spark):
    """The whole query against sets of grams: the filters and the correction change no prediction that sets decide."""
    docs = table(spark, "documents")
    want = plain_languages([(r["doc_id"], r["text"], r["lang"]) for r in docs.collect()])
    got = {r["doc_id"]: r["lang_pred"] for r in languages(docs).collect()}
    clear = {d: p for d, p, c in want if c is None or len(c) < 2 or sorted(c)[-1] - sorted(c)[-2] > 2}
    assert len(clear) > 0.9 * len(want) and {d: got[d] for d in clear} == clear
    model, text = fit_languages(docs), {r["doc_id"]: r["text"] for r in docs.collect()}
    for d, _, c in want[:100]:
        if c is not None:
            assert np.allclose(model.counts(text[d]), c, atol=3 + 0.01 * max(c))


@pytest.mark.parametrize("n", [65, 130])
def test_more_languages_than_a_word_has_bits(spark, n):
    rng = np.random.default_rng(n)
    spoken = [["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(25)] for _ in range(n)]
    rows = [(d, " ".join(rng.choice(spoken[d % n], 30)), f"l{d % n:03d}") for d in range(12 * n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = fit_languages(docs)
    assert model.masks.shape == (CELLS, -(-n // 64)) and sorted(model.languages) == sorted({r[2] for r in rows})
    got = {r["doc_id"]: r["lang_pred"] for r in languages(docs).collect()}
    assert np.mean([got[d] == x for d, _, x in rows]) > 0.99
    clear = {d: p for d, p, c in plain_languages(rows) if sorted(c)[-1] - sorted(c)[-2] > 2}
    assert len(clear) > 0.9 * len(rows) and {d: got[d] for d in clear} == clear
