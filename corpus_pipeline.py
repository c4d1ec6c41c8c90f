"""The corpus pipeline: filter, deduplicate, decontaminate and pack ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes a stage's rows as
Parquet in the shared checkpoint folder and reads them back as the next stage's ``docs``. All
stages but the last return the columns they were given.

In every stage a null text is an empty one, whole texts count however long they are, columns of other names
(also those that operators use inside) go through untouched, repeated rows are rows of their own, and an empty table
gives an empty one. ``docs`` must be a stored table: rows are told apart by their place in it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import free_name, landed, read_table
from tessera.llm.decontam import uncontaminated
from tessera.llm.packing import best_fit_packing
from tessera.llm.quality import fit_quality, with_statistics
from tessera.llm.queries import tokenizer
from tessera.llm.simhash import one_per_component
from tessera.llm.toxicity import fit_toxicity, score_toxicity


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5 stay; without labels of both classes those of the share of toxic labels (none: all stay)."""
    model, score = fit_toxicity(docs, read_table(spark, sf_dir, "labels")), free_name(docs, "score")
    return score_toxicity(docs, model, score).where(F.col(score) < 0.5).drop(score)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.3 or more stay; empty texts are scored like others, equal texts alike."""
    model, stats = fit_quality(docs, read_table(spark, sf_dir, "labels")), free_name(docs, "stats")
    return with_statistics(docs, stats).where(model.column(stats) >= 0.3).drop(stats)


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one with the smallest id (null last; of equal ids the
    first in the table). Empty texts are one group."""
    return one_per_component(docs, shingle=3, radius=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item stay; empty documents and items match nothing."""
    return uncontaminated(docs, read_table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece in sequences of at most 2048 ids; an empty text is its end id, a longer one is cut."""
    return best_fit_packing(docs, tokenizer("word_bpe_49k.json"), 0, 2048)


STAGES = [
    ("toxicity", toxicity),
    ("quality", quality),
    ("simhash", simhash),
    ("decontamination", decontamination),
    ("packing", packing),
]

# Trained models, XXH64 and a tokenizer are beyond SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = landed(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
