"""Registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import read_table
from tessera.llm.oracles import ORACLES  # noqa: F401


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.quality import quality_scores

    return quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), folds=5, threshold=0.3)


def op2_simhash_gray(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.simhash import simhash_components

    return simhash_components(read_table(spark, sf_dir, "documents"), shingle=3, radius=2)


def op3_bm25_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.search import similar_documents

    return similar_documents(read_table(spark, sf_dir, "documents"), every=100, k=10)


def op4_language_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.langid import languages

    return languages(read_table(spark, sf_dir, "documents"), folds=4, held_out=2)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.warc import warc_round_trip

    return warc_round_trip(spark, read_table(spark, sf_dir, "pages"), least=0)


def op6_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.lmscore import cross_entropy_difference

    scores = cross_entropy_difference(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "conversations"))
    return scores.select("doc_id", "n_events", *[F.round(c, 6).alias(c) for c in ("h_target", "h_background", "score")])


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.decontam import contamination

    return contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.toxicity import toxicity_scores

    return toxicity_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), folds=5, threshold=0.5)


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.packing import best_fit_packing

    return best_fit_packing(read_table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), 0, 2048)


def op10_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.tokenstore import token_store

    rows = token_store(spark, read_table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), 2)
    return rows.select("doc_id", "start", "n_tokens", "ids_crc32")


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.fim import fill_in_middle, restore_middle

    rows = restore_middle(fill_in_middle(read_table(spark, sf_dir, "documents"), salt="1"))
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2("restored", 256).alias("restored_sha256"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.align import align_tokenizers

    return align_tokenizers(read_table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"))


def op13_minhash_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.minhash import minhash_components

    return minhash_components(read_table(spark, sf_dir, "documents"), shingle=2, percent=80)


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_simhash_gray": op2_simhash_gray,
    "op3_bm25_search": op3_bm25_search,
    "op4_language_bloom": op4_language_bloom,
    "op5_warc": op5_warc,
    "op6_cross_entropy": op6_cross_entropy,
    "op7_decontamination": op7_decontamination,
    "op8_toxicity": op8_toxicity,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_token_store": op10_token_store,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_token_alignment": op12_token_alignment,
    "op13_minhash_join": op13_minhash_join,
}
