"""End-to-end corpus plans: pre-training (CPT) and chat fine-tuning (SFT).

Both are single lazy plans: scan -> format -> union -> shuffle position /
exact split. Nothing passes through the driver except the split cutoff key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.constants import CPT_VAL_SHARE, SEED, SFT_VAL_SHARE
from tessera.functions.chat import DEFAULT_CHAT, ChatFormat, build_conversation, render_chat
from tessera.functions.templates import dictionary_text, literature_text, map_overwrite
from tessera.functions.text import build_user_content, clean_field
from tessera.operators.mix import assign_split, union_all
from tessera.sources import fixtures

SFT_KEY = ["source", "row_id", "turn"]
# union order of the two instruction sources per model (27B reads technical first)
SFT_ORDER = {"12b": ["dialogue", "technical"], "27b": ["technical", "dialogue"]}


def formatted_literature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 -> P1 (map overwrites ``text``)."""
    lit_df = fixtures.literature(spark, sf_dir)
    ordinal = F.substring("source", 4, 10).cast("int")
    return map_overwrite(lit_df, literature_text()).withColumn("source_ord", ordinal)


def formatted_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2 -> P2."""
    return map_overwrite(fixtures.dictionary(spark, sf_dir), dictionary_text()) \
        .withColumn("source_ord", F.lit(17))


def cpt_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formatted literature and dictionary, aligned by name."""
    return union_all([formatted_literature(spark, sf_dir), formatted_dictionary(spark, sf_dir)])


def cpt_split(spark: SparkSession, sf_dir: str, share: float = CPT_VAL_SHARE, seed: int = SEED) -> DataFrame:
    """O2: the pre-training corpus with an exact 5% validation split."""
    return assign_split(cpt_corpus(spark, sf_dir), share, seed)


def dialogue_rows(spark: SparkSession, sf_dir: str, fmt: ChatFormat = DEFAULT_CHAT) -> DataFrame:
    """S3 -> P5-P9: instruction rows rendered to chat text."""
    d = fixtures.dialogue(spark, sf_dir)
    conv = build_conversation(build_user_content("instruction", "input"), clean_field("output"))
    return d.select(F.lit("dialogue").alias("source"), "row_id", "turn",
                    render_chat(conv, fmt).alias("text"))


def technical_rows(spark: SparkSession, sf_dir: str, fmt: ChatFormat = DEFAULT_CHAT) -> DataFrame:
    """S4 -> P5, P6, P8, P9."""
    t = fixtures.technical(spark, sf_dir)
    conv = build_conversation(clean_field("Input"), clean_field("Output"))
    return t.select(F.lit("technical").alias("source"), "row_id", "turn",
                    render_chat(conv, fmt).alias("text"))


def sft_corpus(spark: SparkSession, sf_dir: str, model: str = "12b",
               fmt: ChatFormat = DEFAULT_CHAT) -> DataFrame:
    """The two converted sources appended, with their union ordinal."""
    parts = {"dialogue": dialogue_rows(spark, sf_dir, fmt), "technical": technical_rows(spark, sf_dir, fmt)}
    order = SFT_ORDER[model]
    return union_all([parts[name].withColumn("source_ord", F.lit(i)) for i, name in enumerate(order)])


def sft_split(spark: SparkSession, sf_dir: str, share: float = SFT_VAL_SHARE, seed: int = SEED,
              model: str = "12b") -> DataFrame:
    """O3: the chat corpus with an exact 10% validation split."""
    return assign_split(sft_corpus(spark, sf_dir, model), share, seed, key_cols=SFT_KEY)
