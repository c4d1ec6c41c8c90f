"""Quality classifier: a sparse ensemble of rules.

Statistics of a text (``STATS``) feed a random forest of shallow trees; every path from a root
to a node is a conjunction of thresholds, a rule. A lasso logistic regression over the rules
keeps few of them, and the kept rules with their weights are compiled into one Spark
column expression over the statistics.

The fit uses at most ``sample`` labelled rows (see ``labelled_sample``); every text is scored whole.

Defined cases: null and empty texts have all statistics zero and are scored by the same rules;
without labelled rows of both classes every score is the share of label 1 (0 if there are
none); repeated rows are scored each; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import fold, labelled_sample, landed

SAMPLE = 20_000
STATS = ("words", "word_length", "longest_word", "letters", "upper", "digits", "marks", "spaces", "bars", "bangs",
         "symbols", "stops", "unique_words", "top_word", "repeats", "lines", "line_words", "same_lines", "ended_lines",
         "entropy", "odd_ends")

_ODD_END = re.compile(rb"[!-/:-@\[-`{-~]{2,}$")
_LETTER = np.array([chr(b).isalpha() if b < 128 else True for b in range(256)])
_UPPER = np.array([65 <= b <= 90 for b in range(256)])
_DIGIT = np.array([48 <= b <= 57 for b in range(256)])
_MARK = np.array([33 <= b < 127 and not chr(b).isalnum() for b in range(256)])
_SPACE = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])
_SYMBOL = np.array([chr(b) in "#$%&*@^~<>{}[]\\|_=+" for b in range(256)])


def statistics(text: str | None) -> tuple[float, ...]:
    """The values of ``STATS`` for one whole text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return (0.0,) * len(STATS)
    n, size = len(words), len(raw)
    byte = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    share = byte[byte > 0] / size
    count = Counter(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    again = sum(map(bytes.__eq__, words, words[1:]))
    odd = sum(c for w, c in count.items() if w[-1:] in b"!#$%&*" and _ODD_END.search(w))
    return (math.log1p(n), (size - byte[_SPACE].sum()) / n, float(min(100, max(map(len, count)))),
            byte[_LETTER].sum() / size, byte[_UPPER].sum() / size, byte[_DIGIT].sum() / size, byte[_MARK].sum() / size,
            byte[_SPACE].sum() / size, byte[124] / n, byte[33] / n, byte[_SYMBOL].sum() / size, byte[46] / n,
            len(count) / n, max(count.values()) / n, again / n, math.log1p(len(lines)), n / len(lines),
            1 - len(set(lines)) / len(lines), sum(x.rstrip()[-1:] in b".!?" for x in lines) / len(lines),
            float(-(share * np.log2(share)).sum()), odd / n)


def with_statistics(docs: DataFrame, name: str = "stats") -> DataFrame:
    """Adds a struct of the statistics."""
    schema = "struct<" + ",".join(f"{s}:double" for s in STATS) + ">"

    @F.pandas_udf(schema)
    def measure(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([statistics(t) for t in texts], columns=list(STATS), dtype=float)

    return docs.withColumn(name, measure(F.col("text").cast("string")))


# A rule is a tuple of (statistic, is_above, threshold).
Rule = tuple[tuple[str, bool, float], ...]

_NODE = re.compile(r"^(\s*)(If|Else) \(feature (\d+) (<=|>) (\S+)\)$")


def tree_rules(debug: str) -> set[Rule]:
    """All root-to-node paths of the trees printed in a model's debug text."""
    rules, path = set(), []
    for line in debug.splitlines():
        m = _NODE.match(line)
        if m is None:
            if line.strip().startswith("Tree"):
                path = []
            continue
        depth = len(m[1])
        path = [p for p in path if p[0] < depth] + [(depth, (STATS[int(m[3])], m[4] == ">", float(m[5])))]
        tight: dict[tuple[str, bool], float] = {}
        for _, (stat, above, at) in path:  # one bound per statistic and side
            old = tight.get((stat, above), at)
            tight[stat, above] = max(old, at) if above else min(old, at)
        rules.add(tuple(sorted((s, a, t) for (s, a), t in tight.items())))
    return rules


def rule_column(rule: Rule, stats: str) -> Column:
    out = None
    for stat, above, at in rule:
        c = F.col(f"{stats}.{stat}")
        c = c > F.lit(at) if above else c <= F.lit(at)
        out = c if out is None else out & c
    return out


@dataclass
class RuleModel:
    bias: float
    weights: list[tuple[Rule, float]]

    def column(self, stats: str = "stats") -> Column:
        """The score as one column expression."""
        z = F.lit(float(self.bias))
        for rule, w in self.weights:
            z = z + F.when(rule_column(rule, stats), F.lit(float(w))).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-z))


def _constant(p: float) -> RuleModel:
    return RuleModel(math.log(p / (1 - p)) if 0 < p < 1 else (40.0 if p else -40.0), [])


def fit_quality(docs: DataFrame, labels: DataFrame, folds: int = 5, sample: int = SAMPLE, trees: int = 12, depth: int = 3,
                lasso: float = 0.001, seed: int = 7) -> RuleModel:
    """Fit on at most ``sample`` labelled rows outside fold 0."""
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    picked = labelled_sample(labels, "quality", folds, sample)
    rows = with_statistics(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(picked), "doc_id"))
    rows = landed(rows.select("doc_id", "label", "stats.*"), "quality-sample")
    share = rows.agg(F.avg("label").alias("p"), F.min("label").alias("a"), F.max("label").alias("b")).first()
    if share["a"] == share["b"]:
        return _constant(share["p"] or 0.0)
    rows = rows.repartition(4, "doc_id").sortWithinPartitions("doc_id", *STATS)
    points = VectorAssembler(inputCols=list(STATS), outputCol="features").transform(rows).select("features", F.col("label").cast("double"), "doc_id", *STATS)
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="onethird",
                                    subsamplingRate=0.7, minInstancesPerNode=5).fit(points)
    rules = sorted(tree_rules(forest.toDebugString))
    if not rules:
        return _constant(share["p"])
    flags = landed(points.select("label", F.struct(*STATS).alias("stats"))
                   .select("label", *[rule_column(r, "stats").cast("double").alias(f"r{k}") for k, r in enumerate(rules)]), "quality-rules")
    held = VectorAssembler(inputCols=[f"r{k}" for k in range(len(rules))], outputCol="features").transform(flags).select("features", "label")
    lr = LogisticRegression(elasticNetParam=1.0, regParam=lasso, maxIter=100, standardization=False).fit(held)
    weights = [(r, float(w)) for r, w in zip(rules, lr.coefficients.toArray()) if abs(w) > 1e-9]
    return RuleModel(float(lr.intercept), weights)


def quality_scores(docs: DataFrame, labels: DataFrame, folds: int = 5, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    model = fit_quality(docs, labels, folds)
    rows = with_statistics(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    return (rows.select("doc_id", (fold(F.col("doc_id"), folds) == 0).alias("held_out"), model.column().alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
