"""Preparing training tables from files, end to end (the two entry points).

``prepare_pretraining``: text sources + dictionary -> templates -> union ->
exact split -> vocabulary -> token table, written per split.
``prepare_chat``: instruction files -> cleaned two-turn conversations ->
chat text -> union -> exact split -> token table, written per split.

Each returns the output path and the row counts per split; the work runs
as Spark jobs (the only driver values are counts and the split cutoff).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.constants import CPT_VAL_SHARE, MAX_SEQ_LENGTH, SEED, SFT_VAL_SHARE
from tessera.functions.chat import DEFAULT_CHAT, ChatFormat, build_conversation, render_chat
from tessera.functions.templates import dictionary_text, literature_text
from tessera.functions.text import build_user_content, clean_field
from tessera.operators.mix import seeded_shuffle, split_with_counts, union_all
from tessera.operators.tokens import build_vocabulary, encode
from tessera.sources.readers import SOURCE_KEY
from tessera.sources.sinks import write_corpus


def pretraining_text(literature: DataFrame, dictionary: DataFrame) -> DataFrame:
    """P1 + P2 + U2 over reader output (``source, source_ord, file, row_id, title, text``)."""
    lit_df = literature.withColumn("text", literature_text())
    dic_df = dictionary.withColumn("text", dictionary_text())
    return union_all([lit_df, dic_df])


def chat_text(dialogue: DataFrame, technical: DataFrame, fmt: ChatFormat = DEFAULT_CHAT,
              dialogue_first: bool = True) -> DataFrame:
    """P5-P9 + U3 over reader output."""
    d = dialogue.select("source", "file", "row_id", render_chat(build_conversation(
        build_user_content("instruction", "input"), clean_field("output")), fmt).alias("text"))
    t = technical.select("source", "file", "row_id", render_chat(build_conversation(
        clean_field("Input"), clean_field("Output")), fmt).alias("text"))
    parts = [d, t] if dialogue_first else [t, d]
    return union_all([p.withColumn("source_ord", F.lit(i)) for i, p in enumerate(parts)])


def token_table(text: DataFrame, share: float, seed: int, key: list[str], vocab: DataFrame | None = None,
                vocab_size: int | None = None, max_len: int = MAX_SEQ_LENGTH) -> tuple[DataFrame, dict, DataFrame]:
    """Split, vocabulary of the training rows, ids and shuffled position ``pos``; row counts per split.

    ``split`` is an expression of the key, so it rides along with the encoding; ``pos`` comes from the keys alone.
    """
    split, n, n_val = split_with_counts(text, share, seed, key_cols=key)
    vocab = vocab if vocab is not None else build_vocabulary(split.where(F.col("split") == "train"), vocab_size)
    enc = encode(split, vocab, key, max_len=max_len, keep=[F.col("split")])
    table = enc.join(seeded_shuffle(text.select(*key), seed, key), key, "inner")
    return table, {"train": n - n_val, "val": n_val}, vocab


def _tokenize_and_write(text: DataFrame, share: float, seed: int, vocab: DataFrame | None, vocab_size: int | None,
                        max_len: int, out: str | None, key: list[str]):
    table, counts, vocab = token_table(text, share, seed, key, vocab, vocab_size, max_len)
    return write_corpus(table, out), counts, vocab


def prepare_pretraining(spark: SparkSession, literature: DataFrame, dictionary: DataFrame,
                        out: str | None = None, vocab: DataFrame | None = None, vocab_size: int | None = None,
                        max_len: int = MAX_SEQ_LENGTH, share: float = CPT_VAL_SHARE, seed: int = SEED):
    """Entry 1: the pre-training token table. Returns ``(path, counts, vocab)``."""
    return _tokenize_and_write(pretraining_text(literature, dictionary), share, seed, vocab, vocab_size,
                               max_len, out, SOURCE_KEY)


def prepare_chat(spark: SparkSession, dialogue: DataFrame, technical: DataFrame, out: str | None = None,
                 vocab: DataFrame | None = None, vocab_size: int | None = None, max_len: int = MAX_SEQ_LENGTH,
                 share: float = SFT_VAL_SHARE, seed: int = SEED, fmt: ChatFormat = DEFAULT_CHAT,
                 dialogue_first: bool = True):
    """Entry 2: the chat fine-tuning token table. Returns ``(path, counts, vocab)``."""
    return _tokenize_and_write(chat_text(dialogue, technical, fmt, dialogue_first), share, seed, vocab,
                               vocab_size, max_len, out, SOURCE_KEY)


def plan_steps(n_train: int, b: int, a: int, g: int, epochs: float, eval_every: int) -> dict:
    """A3 for one run, as plain numbers (the counts come from the split)."""
    from math import ceil

    from tessera.constants import SPLIT_NUM
    save = ceil(n_train / (b * a * g * SPLIT_NUM * 10))
    max_steps = int(save * ceil(SPLIT_NUM * epochs) * 10)
    return {"save_steps": save, "max_steps": max_steps, "eval_steps": eval_every * save}


def write_batch_manifest(spark: SparkSession, token_table: str, b: int, a: int, g: int, epochs: float,
                         eval_every: int, out: str | None = None, seed: int = SEED, key=SOURCE_KEY,
                         multiple: int = 8):
    """T5 + T6 over a written token table: every training sample of the run
    with its step, accumulation slot, device, lane and batch, and the batch's
    padded length. Written partitioned by a step range. Returns ``(path, plan)``."""
    from tessera.operators.tokens import assign_microbatch, size_batches
    from tessera.session import scratch_folder

    tokens = spark.read.parquet(token_table).where(F.col("split") == "train")
    n_train = tokens.count()
    plan = plan_steps(n_train, b, a, g, epochs, eval_every)
    samples = assign_microbatch(tokens.select(*key), n_train, b, a, g, plan["max_steps"], seed, list(key))
    m = size_batches(samples, tokens, list(key), multiple).drop("n_pad")
    m = m.withColumn("step_block", (F.floor((F.col("step") - 1) / F.lit(max(1, plan["save_steps"])))).cast("bigint"))
    path = out or scratch_folder(spark, "manifest")
    m.repartitionByRange("step", "device", "slot", "lane").write.mode("overwrite") \
        .partitionBy("step_block").parquet(path)
    return path, dict(plan, n_train=n_train)
