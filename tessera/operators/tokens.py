"""Token tables and batch manifest.

The default tokeniser is a whitespace vocabulary built by Spark (T1); a
trained tokeniser can be plugged in through ``encode_with`` (an iterator
``pandas_udf``: the tokeniser loads once per Python worker).

Scale notes
* Word counts are a partial aggregate, so frequent words combine map-side.
* The vocabulary holds all words unless the caller sets a size.
* ``encode`` is map-only while the vocabulary's measured size is at most ``LOOKUP_ROWS`` (broadcast
  once, looked up per Arrow batch, texts stay where they are). Of a larger vocabulary the ``FREQUENT_ROWS`` lowest
  ids, the most frequent words, are looked up so; only the other words fetch their ids by a join, and go back in order.
* Lengths need no ids: batches are padded from word counts, and id arrays move
  once, only for the operators that return them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.constants import (BOS_ID, BOS_TEXT, EOS_ID, EOS_TEXT, FIRST_WORD_ID, LABEL_IGNORE,
                               MAX_SEQ_LENGTH, PAD_ID, PAD_MULTIPLE, UNK_ID)
from tessera.functions.hooks import TableTokenizer
from tessera.session import cut_lineage

WORD_SPLIT = "[ \\t\\n\\r]+"
LOOKUP_ROWS = 1_000_000  # vocabulary rows that are shipped to every executor
FREQUENT_ROWS = 200_000  # of a larger vocabulary: each Python worker holds them while the join runs


def words(text: Column) -> Column:
    """Whitespace-separated non-empty pieces of ``text`` (codegen'd, no lambda)."""
    return F.array_remove(F.split(text, WORD_SPLIT), "")


def build_vocabulary(corpus: DataFrame, vocab_size: int | None = None, text: str = "text") -> DataFrame:
    """``(token, id, cnt)`` of all words, or of the ``vocab_size`` most frequent ones.

    Order ``(count desc, token)``, ranked by a distributed sort; ids start after the special tokens.
    """
    from tessera.operators.mix import global_rank

    counts = corpus.select(F.explode(F.split(F.col(text), WORD_SPLIT)).alias("token")) \
        .where(F.col("token") != "").groupBy("token").agg(F.count(F.lit(1)).cast("bigint").alias("cnt"))
    ranked = global_rank(counts, [F.col("cnt").desc(), F.col("token").asc()], out="_r")
    if vocab_size is not None:
        ranked = ranked.where(F.col("_r") < vocab_size)
    return ranked.select("token", (F.col("_r") + FIRST_WORD_ID).cast("int").alias("id"), "cnt")


def token_lengths(text: Column, max_len: int = MAX_SEQ_LENGTH, add_special: bool = True) -> dict[str, Column]:
    """``n_words``, ``n_tokens`` and ``n_dropped`` of a text, which need no vocabulary."""
    special = 2 if add_special else 0
    n = F.coalesce(F.greatest(F.size(words(text)), F.lit(0)), F.lit(0))
    return {"n_words": n.cast("int"), "n_tokens": (F.least(n, F.lit(max_len - special)) + special).cast("int"),
            "n_dropped": F.greatest(n - (max_len - special), F.lit(0)).cast("int")}


def encode(df: DataFrame, vocab: DataFrame, key_cols: list[str], text: str = "text",
           max_len: int = MAX_SEQ_LENGTH, add_special: bool = True, keep: list[Column] = ()) -> DataFrame:
    """T2 + T3: ``input_ids`` cut to ``max_len`` including BOS/EOS; unknown -> UNK.

    Adds ``n_words`` (before truncation), ``n_tokens`` and ``n_dropped``. Further columns
    of ``df``, or expressions over them, stay with ``keep``.
    """
    budget = max_len - 2 if add_special else max_len
    cut = F.coalesce(F.slice(words(F.col(text)), 1, budget), F.array().cast("array<string>"))
    d = df.select(*key_cols, *keep, cut.alias("_w"), *[c.alias(n) for n, c in token_lengths(F.col(text), max_len, add_special).items()])
    whole = vocab.select("token", "id").limit(LOOKUP_ROWS + 1).count() <= LOOKUP_ROWS
    most = LOOKUP_ROWS if whole else min(LOOKUP_ROWS, FREQUENT_ROWS)
    frequent = vocab if whole else vocab.where(F.col("id") < FIRST_WORD_ID + most)
    held = frequent.select("token", "id").limit(most).toArrow()   # bounded by the guard
    if whole:
        ids = _lookup(vocab.sparkSession, held, UNK_ID)(F.col("_w"))["ids"]
    else:
        # stored: both branches must see the same row numbers; a rare word fetches its id, a row's ids go back in order
        found = _lookup(vocab.sparkSession, held)(F.col("_w"))
        d = cut_lineage(d.withColumn("_f", found).drop("_w").withColumn("_row", F.monotonically_increasing_id()))
        placed = d.select("_row", F.posexplode("_f.rare").alias("pos", "token")).join(vocab.select("token", "id"), "token", "left")
        rare = placed.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("pos", F.coalesce("id", F.lit(UNK_ID)).alias("id")))).alias("_m"))
        d = d.join(rare, "_row", "left")
        ids = _filled(F.col("_f.ids"), F.coalesce(F.col("_m.id"), F.array().cast("array<int>")))
    if add_special:
        ids = F.concat(F.array(F.lit(BOS_ID)), ids, F.array(F.lit(EOS_ID)))
    kept = [c for c in d.columns if c not in (*key_cols, "_w", "_f", "_m", "_row", "n_words", "n_tokens", "n_dropped")]
    return d.select(*key_cols, *kept, ids.alias("input_ids"), "n_tokens", "n_dropped", "n_words")


_TABLES: dict[int, dict] = {}   # of this worker process: broadcast id -> word -> id


def _lookup(spark, vocab: pa.Table, unknown: int | None = None):
    """Arrow-batched word -> id lookup in a broadcast vocabulary of checked size: the ids, ``unknown``
    where a word is not held; with null there, also those words in order.

    The table is built once per worker; a batch looks up its distinct words.
    """
    held = spark.sparkContext.broadcast((vocab["token"].combine_chunks(), vocab["id"].combine_chunks()))
    name = held._jbroadcast.id()

    @F.arrow_udf("struct<ids: array<int>, rare: array<string>>")
    def look_up(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        if name not in _TABLES:
            tokens, ids = held.value
            _TABLES.clear()   # one vocabulary at a time
            _TABLES[name] = dict(zip(tokens.to_pylist(), ids.to_pylist()))
        table = _TABLES[name]
        for b in batches:
            words_ = b.flatten()
            coded = words_.dictionary_encode()
            known = pa.array([table.get(w, unknown) for w in coded.dictionary.to_pylist()], pa.int32())
            found = pc.take(known, coded.indices)
            missing = np.concatenate([[0], np.cumsum(pc.is_null(found).to_numpy(zero_copy_only=False))])
            lengths = pc.fill_null(pc.list_value_length(b), 0).to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(lengths)])
            yield pa.StructArray.from_arrays([
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), found),
                pa.ListArray.from_arrays(pa.array(missing[ends], pa.int32()), words_.filter(pc.is_null(found)))], names=["ids", "rare"])

    return look_up


def _filled(ids: Column, rare: Column) -> Column:
    """The null ids of each row replaced by its ``rare`` ids, in order."""
    @F.arrow_udf("array<int>")
    def fill(a: pa.Array, b: pa.Array) -> pa.Array:
        flat = a.flatten()
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(a).to_numpy(zero_copy_only=False))])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pc.replace_with_mask(flat, pc.is_null(flat), b.flatten()))

    return fill(ids, rare)


def encode_with(df: DataFrame, tokenize, key_cols: list[str], text: str = "text",
                max_len: int = MAX_SEQ_LENGTH, keep: list[Column] = ()) -> DataFrame:
    """Encode with a user tokeniser ``tokenize(list[str]) -> list[list[int]]``.

    Runs as an iterator pandas UDF over Arrow batches. Ids beyond ``max_len`` are cut
    from the content: an EOS at the end stays. A ``hooks.TableTokenizer`` gets the ids of
    each row's words by a join.
    """
    def cut(ids: list[int]) -> list[int]:
        if len(ids) <= max_len:
            return ids
        return ids[:max_len - 1] + [EOS_ID] if ids[-1] == EOS_ID else ids[:max_len]

    @F.pandas_udf("array<int>")
    def _enc(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            out = tokenize(s.fillna("").tolist())
            yield pd.Series([cut(list(x)) for x in out])

    if isinstance(tokenize, TableTokenizer):
        bound = tokenize.bound

        @F.pandas_udf("array<int>")
        def _enc_joined(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
            for s, tokens, ids in batches:
                vocab = {w: int(i) for ws, ns in zip(tokens, ids) for w, i in zip(ws, ns)}
                yield pd.Series([cut(x) for x in bound(vocab)(s.fillna("").tolist())])

        # stored: both branches must see the same row numbers
        d = cut_lineage(df.select(*key_cols, *keep, F.col(text).alias("_text"), F.monotonically_increasing_id().alias("_row")))
        seen = F.array_distinct(F.slice(words(F.col("_text")), 1, tokenize.max_len - 2))
        pairs = d.select("_row", F.explode(seen).alias("token")).join(tokenize.table, "token")
        found = pairs.groupBy("_row").agg(F.collect_list(F.struct("token", "id")).alias("_m"))
        d = d.join(found, "_row", "left")
        ids = _enc_joined("_text", F.coalesce(F.col("_m.token"), F.array().cast("array<string>")),
                          F.coalesce(F.col("_m.id"), F.array().cast("array<int>")))
        return d.withColumn("input_ids", ids).drop("_row", "_text", "_m").withColumn("n_tokens", F.size("input_ids").cast("int"))
    return df.select(*key_cols, *keep, _enc(F.col(text)).alias("input_ids")) \
        .withColumn("n_tokens", F.size("input_ids").cast("int"))


def id_checksums(ids: str = "input_ids") -> list[Column]:
    """Exact integer summaries of an id array: sum and position-weighted sum."""
    s = F.aggregate(F.col(ids), F.lit(0).cast("bigint"), lambda acc, x: acc + x.cast("bigint"))
    ws = F.aggregate(F.transform(F.col(ids), lambda x, i: x.cast("bigint") * i.cast("bigint")),
                     F.lit(0).cast("bigint"), lambda acc, x: acc + x)
    return [s.alias("id_sum"), ws.alias("id_wsum")]


def truncation_report(corpus: DataFrame, text: str = "text", max_len: int = MAX_SEQ_LENGTH) -> DataFrame:
    """T4: per source, rows truncated, words dropped and kept, doubled BOS/EOS text (one pass)."""
    cols = token_lengths(F.col(text), max_len)
    d = corpus.select("source", *[c.alias(n) for n, c in cols.items()], F.col(text).startswith(BOS_TEXT).alias("_dbos"),
                      F.col(text).endswith(EOS_TEXT).alias("_deos"))
    kept = (F.col("n_words") - F.col("n_dropped"))
    return d.groupBy("source").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_rows"),
        F.sum(F.when(F.col("n_dropped") > 0, 1).otherwise(0)).cast("bigint").alias("n_truncated"),
        F.sum("n_dropped").cast("bigint").alias("n_dropped"),
        F.sum(kept).cast("bigint").alias("n_kept"),
        F.sum(F.when(F.col("_dbos"), 1).otherwise(0)).cast("bigint").alias("n_double_bos"),
        F.sum(F.when(F.col("_deos"), 1).otherwise(0)).cast("bigint").alias("n_double_eos"),
    ).withColumn("kept_ratio", F.when(F.col("n_kept") + F.col("n_dropped") > 0,
                                      F.col("n_kept").cast("double") /
                                      (F.col("n_kept") + F.col("n_dropped")).cast("double")))


def assign_microbatch(train: DataFrame, n_train: int, b: int, a: int, g: int, max_steps: int,
                      seed: int, key_cols: list[str]) -> DataFrame:
    """T5: every training sample of the run as ``(epoch, sample, step, slot, device, lane, batch_id)``.

    Each epoch is its own seeded permutation (exact positions, see
    ``mix.global_position``); ``sample = epoch * n + pos``; samples past
    ``max_steps`` are not drawn.
    """
    from tessera.operators.mix import global_position

    per_step = b * g * a
    total = max_steps * per_step
    epochs = max(1, -(-total // n_train)) if n_train else 0
    d = train.select(*key_cols).withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    d = global_position(d, f"shuffle|{seed}", ["epoch", *key_cols], out="pos", partition_cols=["epoch"])
    sample = (F.col("epoch").cast("bigint") * F.lit(n_train) + F.col("pos"))
    return _placed(d.withColumn("sample", sample).where(F.col("sample") < F.lit(total)), b, a, g, key_cols)


def _placed(d: DataFrame, b: int, a: int, g: int, key_cols: list[str]) -> DataFrame:
    """Step, slot, device, lane and batch of each ``sample``."""
    per_step = b * g * a
    micro = F.floor(F.col("sample") / F.lit(b)).cast("bigint")
    return d.select(*key_cols, F.col("epoch").cast("int").alias("epoch"), "sample",
                    (F.floor(F.col("sample") / F.lit(per_step)) + 1).cast("bigint").alias("step"),
                    (F.floor(micro / F.lit(g)) % F.lit(a)).cast("int").alias("slot"),
                    (micro % F.lit(g)).cast("int").alias("device"),
                    (F.col("sample") % F.lit(b)).cast("int").alias("lane"),
                    micro.alias("batch_id"))


def keyed_microbatch(rows: DataFrame, n_train: int, b: int, a: int, g: int, max_steps: int, seed: int, key_cols: list[str]) -> DataFrame:
    """T5 with ``permute.position``: ``rows`` have one dense number (``row``) for all epochs, an epoch's order is
    arithmetic on it. Map-only; ``permute.row_at`` finds the row of any place of the manifest without it."""
    from tessera.operators.permute import position

    per_step = b * g * a
    total = max_steps * per_step
    epochs = max(1, -(-total // n_train)) if n_train else 0
    d = rows.select(*key_cols, "row").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))) if epochs else F.lit(0))
    d = position(d, "row", n_train, seed, F.col("epoch"), out="pos")
    d = d.withColumn("sample", F.col("epoch").cast("bigint") * n_train + F.col("pos")).where(F.col("sample") < total)
    return _placed(d, b, a, g, key_cols)


def size_batches(samples: DataFrame, lengths: DataFrame, key_cols: list[str], multiple: int = PAD_MULTIPLE) -> DataFrame:
    """T6 on lengths: each sample with ``n_tokens``, its batch's ``padded_len`` (the longest,
    rounded up to ``multiple``) and ``n_pad``. A batch holds ``b`` samples; no ids move."""
    d = samples.join(lengths.select(*key_cols, "n_tokens"), key_cols, "inner")
    longest = F.max("n_tokens").over(Window.partitionBy("batch_id"))
    d = d.withColumn("padded_len", (F.ceil(longest / F.lit(multiple)) * F.lit(multiple)).cast("int"))
    return d.withColumn("n_pad", (F.col("padded_len") - F.col("n_tokens")).cast("int"))


def pad_batch(sized: DataFrame, encoded: DataFrame, key_cols: list[str], pad_id: int = PAD_ID) -> DataFrame:
    """Right-padded ids, attention mask and causal labels (padding -> -100) of sized samples."""
    d = sized.join(encoded.select(*key_cols, "input_ids"), key_cols, "inner")
    d = d.withColumn("padded_ids", F.concat("input_ids", F.array_repeat(F.lit(pad_id), F.col("n_pad"))))
    d = d.withColumn("attention_mask", F.concat(F.array_repeat(F.lit(1), F.col("n_tokens")),
                                                F.array_repeat(F.lit(0), F.col("n_pad"))))
    # the collator's rule: every id equal to the pad id is ignored in the loss
    return d.withColumn("labels", F.transform("padded_ids", lambda x: F.when(x == F.lit(pad_id), F.lit(LABEL_IGNORE))
                                              .otherwise(x)))


def padding_efficiency(sized: DataFrame) -> DataFrame:
    """Real tokens / padded tokens per batch, from lengths."""
    return sized.groupBy("batch_id").agg(
        F.sum("n_tokens").cast("bigint").alias("real_tokens"),
        F.sum("padded_len").cast("bigint").alias("padded_tokens")) \
        .withColumn("efficiency", F.col("real_tokens").cast("double") / F.col("padded_tokens").cast("double"))
