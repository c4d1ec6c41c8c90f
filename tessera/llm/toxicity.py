"""Toxicity scores by weak supervision.

1. Voters. Words, word beginnings and word endings that labelled toxic texts use far more often than
   clean ones form lexicons of different kinds, one voter each; further voters look at how hits lie together
   (density, repetition, both halves, neighbours) and at how a text is written (shouting, exclamation marks, masked
   letters, digits inside words, stretched letters). A voter fires or not: ``VOTERS`` bits a text.
2. Label model. All documents vote, labelled or not; their vote patterns are counted by Spark. A generative mixture
   of two classes explains how often voters fire together: per class a tree of voters, each depending on the one
   it correlates with most (given the class) and on the class. EM estimates accuracies and correlations from the counts
   of all documents. Labels only say which class is which: the labelled rows' patterns are added with a mass of
   ``ANCHOR`` of the corpus, and a logistic line over the labelled rows calibrates the posterior.
3. Classifier. A logistic regression on lexicon hits and patterns is fitted to the label model's posterior
   labels, of labelled and unlabelled rows, so it also weighs words that the voters hold together. A row's own label
   enters nowhere but in the lexicons, the anchor and the calibration.

The lexicons come from at most ``sample`` labelled rows (see ``labelled_sample``), the classifier is fitted on these and about as many
unlabelled rows with the smallest hashes; votes are counted over all documents, and every text is scored whole.

Defined cases: null and empty texts are scored like texts without hits; without labelled rows of
both classes every score is the share of toxic rows (0 if there are none); repeated
rows are scored each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.bpe import text_slices
from tessera.llm.common import fold, labelled_sample, landed

SAMPLE = 20_000
LEXICON = 600          # words, and as many word beginnings, at most
STEMS = (4, 5, 6)      # lengths of word beginnings
ENDS = (4, 5)          # lengths of word endings
STRONG, WEAK = 20, 5   # how much more often toxic texts use a word
COMMON, WIDER = 0.01, 1.3   # toxic texts that hold a term, at least; how many more a beginning or ending has than any word with it
ANCHOR = 0.05
KINDS = ("strong words, commoner half", "strong words, rarer half", "weak words", *[f"beginnings of {n}" for n in STEMS], "endings")
PATTERNS = ("two hits", "four hits", "dense hits", "hits in both halves", "shouting", "exclaims", "masked", "digits inside", "stretched")
VOTERS = len(KINDS) + len(PATTERNS)   # 2 ** 16 vote patterns at most

_WORD = re.compile(r"[^\W\d_]+")
_MASKED = re.compile(r"[^\W\d_]\*{2,}[^\W\d_]|[^\W\d_][@$#*]{2,}")
_INSIDE = re.compile(r"[^\W\d_][013457]{1,2}[^\W\d_]")
_STRETCHED = re.compile(r"([^\W\d_])\1{3,}")


@dataclass
class Lexicon:
    """Words (the first ``strong`` of them strong ones), stems and endings; the automaton is built once per worker."""

    words: list[str]
    stems: list[str]
    ends: list[str] = field(default_factory=list)
    strong: int | None = None
    _finder: object = field(default=None, repr=False, compare=False)

    def __getstate__(self):
        return {**self.__dict__, "_finder": None}

    @property
    def n_strong(self) -> int:
        return len(self.words) if self.strong is None else self.strong

    def finder(self):
        if self._finder is None:
            import ahocorasick

            a = ahocorasick.Automaton()
            for kind, terms in enumerate((self.words, self.stems, self.ends)):
                for k, w in enumerate(terms):
                    a.add_word(w, a.get(w, []) + [(kind, k, len(w))])
            a.make_automaton()
            self._finder = a
        return self._finder

    def hits(self, text: str) -> "Hits":
        """The words that stand in the text, the stems that begin a word of it, the endings that end one."""
        out = Hits()
        if not (self.words or self.stems or self.ends):
            return out
        low = text.lower()
        for end, found in self.finder().iter(low):
            last = end + 1 == len(low) or not low[end + 1].isalpha()
            for kind, k, n in found:
                at = end + 1 - n
                begins = not at or not low[at - 1].isalpha()
                if kind == 0 and begins and last:
                    out.words.add(k)
                    if k < self.n_strong:
                        out.strong.add(k)
                        out.places.append(at / len(low))
                elif kind == 1 and begins:
                    out.stems.add(k)
                elif kind == 2 and last and not begins:
                    out.ends.add(k)
        return out

    def votes(self, text: str, hits: "Hits") -> list[bool]:
        strong = self.n_strong
        lengths = {len(self.stems[k]) for k in hits.stems}
        kinds = [any(k < (strong + 1) // 2 for k in hits.words), any((strong + 1) // 2 <= k < strong for k in hits.words),
                 any(k >= strong for k in hits.words), *[n in lengths for n in STEMS], bool(hits.ends)]
        return kinds + patterns(text, hits)


@dataclass
class Hits:
    words: set[int] = field(default_factory=set)
    strong: set[int] = field(default_factory=set)
    stems: set[int] = field(default_factory=set)
    ends: set[int] = field(default_factory=set)
    places: list[float] = field(default_factory=list)   # of strong words, 0 to 1


def patterns(text: str, hits: Hits) -> list[bool]:
    n = max(1, len(text))
    upper = sum(map(text.count, "AEIOURST"))
    lower = sum(map(text.count, "aeiourst"))
    places = hits.places
    return [len(hits.strong) >= 2, len(hits.strong) >= 4, 500 * len(places) > n, bool(places) and min(places) < 0.5 <= max(places),
            upper > lower, 100 * text.count("!") > n, bool(text.count("*") and _MASKED.search(text)),
            bool(_INSIDE.search(text)), bool(_STRETCHED.search(text))]


class LabelModel:
    """Two classes; in each, voters form a tree: P(votes, y) = P(y) prod P(v_j | v_parent(j), y)."""

    def __init__(self, rounds: int = 200, pseudo: float = 0.5):
        self.rounds, self.pseudo, self.slope, self.shift = rounds, pseudo, 1.0, 0.0

    def fit(self, seen: np.ndarray, weight: np.ndarray, told: np.ndarray, anchor: float = ANCHOR) -> "LabelModel":
        """``seen``: distinct 0/1 vote rows; ``weight``: how many documents vote so; ``told``: how many labelled
        rows of class 0 and 1 do (two columns). The labelled rows begin EM, stay in it with a mass of ``anchor`` of all
        documents, and calibrate the posterior."""
        held = told * (anchor * max(1.0, weight.sum()) / max(1.0, told.sum()))
        self._maximise(seen, told.T.astype(float) if told.sum() else np.stack([weight / 2, weight / 2]))
        post = None
        for _ in range(self.rounds):
            new = self.posterior(seen)
            if post is not None and np.abs(new - post).max() < 1e-6:
                break
            post = new
            self._maximise(seen, np.stack([weight * (1 - post), weight * post]) + held.T)
        self._calibrate(seen, told)
        return self

    def _calibrate(self, seen: np.ndarray, told: np.ndarray) -> None:
        """A logistic line from the posterior's log odds to the labels."""
        n = told.sum(1)
        if not (told.sum(0) > 0).all():
            return
        odds = self._odds(seen)
        slope, shift = _logistic(odds[n > 0][:, None], told[n > 0, 1] / n[n > 0], n[n > 0], ridge=0.01)
        if slope > 0:
            self.slope, self.shift = float(slope), float(shift)

    def _maximise(self, v: np.ndarray, mass: np.ndarray) -> None:
        """The parameters from the mass of each vote row in each class."""
        m = v.shape[1]
        self.prior = (mass.sum(1) + self.pseudo) / (mass.sum() + 2 * self.pseudo)
        joint = np.zeros((2, m, m, 2, 2))  # class, i, j, value of i, value of j
        one = v.astype(float)
        for y in (0, 1):
            t = one.T * mass[y]
            both = t @ one
            each = t.sum(1)
            total = mass[y].sum()
            joint[y, :, :, 1, 1], joint[y, :, :, 1, 0] = both, each[:, None] - both
            joint[y, :, :, 0, 1] = each[None, :] - both
            joint[y, :, :, 0, 0] = total - each[:, None] - each[None, :] + both
        joint = np.maximum(joint, 0) + self.pseudo / 4
        p = joint / joint.sum(axis=(3, 4), keepdims=True)
        pi, pj = p.sum(4, keepdims=True), p.sum(3, keepdims=True)
        info = (p * np.log(p / (pi * pj))).sum(axis=(3, 4))
        info = np.einsum("y,yij->ij", self.prior, info)  # correlation given the class
        self.parent = [-1] * m
        inside, gain, via = {0}, info[0].copy(), np.zeros(m, int)
        while len(inside) < m:  # maximum spanning tree
            j = max((k for k in range(m) if k not in inside), key=lambda k: gain[k])
            self.parent[j] = int(via[j])
            inside.add(j)
            better = info[j] > gain
            gain[better], via[better] = info[j][better], j
        self.correlation = info
        self.accuracy = np.stack([p[y, np.arange(m), np.arange(m), 1, 1] + p[y, np.arange(m), np.arange(m), 1, 0] for y in (0, 1)])
        self.table = np.zeros((2, m, 2, 2))  # class, voter, value of parent, value of voter
        for y in (0, 1):
            for j, q in enumerate(self.parent):
                if q < 0:
                    fire = (mass[y] @ one[:, j] + self.pseudo) / (mass[y].sum() + 2 * self.pseudo)
                    self.table[y, j, :, 1], self.table[y, j, :, 0] = fire, 1 - fire
                else:
                    self.table[y, j] = p[y, q, j] / p[y, q, j].sum(axis=1, keepdims=True)

    def _odds(self, v: np.ndarray) -> np.ndarray:
        v = v.astype(int)
        logs = np.log(self.prior)[:, None] + np.zeros((2, v.shape[0]))
        for j, q in enumerate(self.parent):
            up = v[:, q] if q >= 0 else np.zeros(v.shape[0], int)
            logs += np.log(self.table[:, j, up, v[:, j]])
        return np.clip(logs[1] - logs[0], -50, 50)

    def posterior(self, v: np.ndarray) -> np.ndarray:
        """P(toxic) of vote rows, calibrated once the model is fitted."""
        return 1 / (1 + np.exp(-np.clip(self.slope * self._odds(v) + self.shift, -500, 500)))


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    bias: float = 0.0
    weights: np.ndarray | None = None   # of words, stems, endings and patterns, in this order
    label_model: LabelModel | None = None

    def score(self, text: str | None) -> float:
        text = text or ""
        z = self.bias
        if self.weights is not None:
            hits = self.lexicon.hits(text)
            z += float(self.weights[_features(self.lexicon, hits, patterns(text, hits))].sum())
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def _features(lex: Lexicon, hits: Hits, fired: list[bool]) -> list[int]:
    """Numbers of the features that a text has."""
    a, b = len(lex.words), len(lex.words) + len(lex.stems)
    c = b + len(lex.ends)
    return [*sorted(hits.words), *[a + k for k in sorted(hits.stems)], *[b + k for k in sorted(hits.ends)], *[c + k for k, x in enumerate(fired) if x]]


def _mine(rows: DataFrame, limit: int) -> Lexicon:
    """Words, stems and endings that stand in a share of ``COMMON`` of the toxic texts or more, ``STRONG`` (words: or ``WEAK``) times as
    often as in clean ones. A stem or ending that is no more than one of these words is left out."""

    def count(batches):
        """Per slice: toxic and clean texts that hold each word (0), word beginning (1) and word ending (2)."""
        for b in text_slices(batches):
            seen: dict[tuple[str, int], list[int]] = {}
            for label, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found = set(_WORD.findall((text or "").lower()))
                terms = {(w, 0) for w in found} | {(w[:n], 1) for w in found for n in STEMS if len(w) > n} | {(w[-n:], 2) for w in found for n in ENDS if len(w) > n}
                for term in terms:
                    seen.setdefault(term, [0, 0])[label] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([t for t, _ in seen], pa.string()), pa.array([k for _, k in seen], pa.int32()),
                 pa.array([c[1] for c in seen.values()], pa.int64()), pa.array([c[0] for c in seen.values()], pa.int64())],
                names=["term", "kind", "toxic", "clean"])

    n = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(n) < 2:
        return Lexicon([], [])
    counts = (rows.select("label", "text").mapInArrow(count, "term string, kind int, toxic long, clean long")
              .groupBy("term", "kind").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))
    ratio = (F.col("toxic") / F.lit(n[1])) / ((F.col("clean") + 0.5) / F.lit(n[0] + 1))
    kept = landed(counts.where(F.col("toxic") >= F.greatest(F.lit(3), F.lit(COMMON * n[1]))).withColumn("ratio", ratio).where(F.col("ratio") >= WEAK), "toxic-terms")

    def top(kind: int, low: float, high: float = float("inf")) -> list[tuple[str, int]]:
        found = kept.where((F.col("kind") == kind) & (F.col("ratio") >= low) & (F.col("ratio") < high))
        return [(r["term"], r["toxic"]) for r in found.orderBy(F.desc("toxic"), "term").limit(limit).collect()]

    strong, weak = top(0, STRONG), top(0, WEAK, STRONG)
    stems = [t for t, k in top(1, STRONG) if all(k >= WIDER * m for w, m in strong + weak if w.startswith(t))]
    ends = [t for t, k in top(2, STRONG) if all(k >= WIDER * m for w, m in strong + weak if w.endswith(t))]
    return Lexicon([w for w, _ in strong + weak], stems, ends, len(strong))


def _logistic(x: np.ndarray, target: np.ndarray, weight: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Ridge logistic regression on soft targets of weighted rows by Newton steps; the last weight is the bias."""
    x = np.hstack([x, np.ones((x.shape[0], 1))])
    w, keep = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    keep[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (weight * (p - target)) + keep * w
        h = (x.T * (weight * np.maximum(p * (1 - p), 1e-6))) @ x + np.diag(keep)
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _voted(texts: DataFrame, lex: Lexicon, column: str) -> DataFrame:
    """Adds ``votes`` (a bit a voter) and the ``features`` of each text to (``column``, text) rows."""

    def read(batches):
        for b in text_slices(batches):
            masks, features = [], []
            for t in b.column(1).to_pylist():
                t = t or ""
                hits = lex.hits(t)
                fired = lex.votes(t, hits)
                masks.append(sum(1 << k for k, x in enumerate(fired) if x))
                features.append(_features(lex, hits, fired[len(KINDS):]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(masks, pa.int32()), pa.array(features, pa.list_(pa.int32()))],
                                             names=[column, "votes", "features"])

    return texts.select(F.col(column).cast("int").alias(column), "text").mapInArrow(read, f"{column} int, votes int, features array<int>")


def fit_toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5, sample: int = SAMPLE, lexicon: int = LEXICON, weigh=None) -> ToxicityModel:
    """Fit on at most ``sample`` labelled rows outside fold 0, about as many unlabelled ones, and the votes of all.

    ``weigh(votes)`` replaces the label model's posterior of 0/1 vote rows (to compare with).
    """
    picked = labelled_sample(labels, "toxic", folds, sample)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = landed(texts.join(F.broadcast(picked), "doc_id").select("label", "text"), "toxic-sample")
    lex = _mine(rows, lexicon)
    share = rows.agg(F.avg("label").alias("p"), F.min("label").alias("a"), F.max("label").alias("b")).first()
    if share["a"] == share["b"]:
        p = min(max(share["p"] or 0.0, 0.0), 1.0)
        return ToxicityModel(lex, bias=float(np.log(p / (1 - p))) if 0 < p < 1 else (40.0 if p else -40.0))
    # every document votes; a row for each of the 2 ** VOTERS patterns at most
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 31)).cast("int").alias("draw")
    voted = landed(_voted(texts.select(draw, "text"), lex, "draw"), "toxic-votes")
    every = voted.groupBy("votes").count().toArrow().to_pydict()
    told = _voted(rows, lex, "label").select("label", "votes", "features").toArrow().to_pydict()
    mask = np.array(every["votes"], dtype=np.int64)
    seen = ((mask[:, None] >> np.arange(VOTERS)) & 1).astype(np.int8)
    place = {m: k for k, m in enumerate(every["votes"])}
    labelled = np.zeros((mask.size, 2))
    np.add.at(labelled, ([place[m] for m in told["votes"]], told["label"]), 1)
    model = LabelModel().fit(seen, np.array(every["count"], dtype=float), labelled)
    post = dict(zip(every["votes"], (weigh(seen) if weigh else model.posterior(seen)).tolist()))
    # the classifier's rows: the labelled ones and about as many others; texts with the same features are one weighted row
    most = int(min(1.0, sample / max(1, sum(every["count"]))) * (1 << 31))
    other = voted.where(F.col("draw") < most).groupBy("votes", "features").count().toArrow().to_pydict()
    rows_seen: dict[tuple, list[float]] = {}
    for votes, features, n in [*zip(told["votes"], told["features"], [1] * len(told["votes"])), *zip(other["votes"], other["features"], other["count"])]:
        cell = rows_seen.setdefault(tuple(features), [0.0, 0.0])
        cell[0] += n
        cell[1] += n * post[votes]
    x = np.zeros((len(rows_seen), len(lex.words) + len(lex.stems) + len(lex.ends) + len(PATTERNS)))
    for i, features in enumerate(rows_seen):
        x[i, list(features)] = 1
    weight, total = np.array(list(rows_seen.values())).T
    w = _logistic(x, total / weight, weight)
    return ToxicityModel(lex, float(w[-1]), w[:-1], model)


def score_toxicity(docs: DataFrame, model: ToxicityModel, column: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score of each whole text."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) for t in texts], dtype=float)

    return docs.withColumn(column, score(F.col("text").cast("string")))


def toxicity_scores(docs: DataFrame, labels: DataFrame, folds: int = 5, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    scored = score_toxicity(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), fit_toxicity(docs, labels, folds))
    return scored.select("doc_id", (fold(F.col("doc_id"), folds) == 0).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
