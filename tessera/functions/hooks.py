"""User-function hooks.

* X1 ``map_batches`` - a batched column function ``f(pandas.DataFrame) ->
  pandas.DataFrame`` over Arrow batches (``mapInPandas``); the engine's own
  transforms never need it, they are column expressions.
* X2 ``whitespace_tokenizer`` - a plain-Python tokeniser object built from a
  Spark vocabulary, usable with ``operators.tokens.encode_with``; any other
  tokeniser with ``__call__(list[str]) -> list[list[int]]`` plugs in the same way.
* X3 event hooks are the per-run processors of ``streaming.checkpoints``
  (``stateful(stream, fn)`` takes any user processor).
"""

from __future__ import annotations

import re
from functools import partial

from pyspark.sql import DataFrame

from tessera.constants import BOS_ID, EOS_ID, MAX_SEQ_LENGTH, UNK_ID


def map_batches(df: DataFrame, f, schema) -> DataFrame:
    """Apply ``f`` to every Arrow batch of ``df`` (no shuffle)."""

    def run(batches):
        for pdf in batches:
            yield f(pdf)

    return df.mapInPandas(run, schema)


class WhitespaceTokenizer:
    """Word-level tokeniser: BOS, word ids (unknown -> UNK), EOS, cut to ``max_len``.

    ``vocab`` is a dict or a Spark broadcast of one (resolved in the worker),
    so a large vocabulary ships once per executor, not with every task.
    """

    _split = re.compile("[ \t\n\r]+")

    def __init__(self, vocab, max_len: int = MAX_SEQ_LENGTH):
        self._vocab = vocab
        self.max_len = max_len

    @property
    def vocab(self) -> dict:
        return self._vocab.value if hasattr(self._vocab, "value") else self._vocab

    def __call__(self, texts: list[str]) -> list[list[int]]:
        vocab, out = self.vocab, []
        for t in texts:
            words = [w for w in self._split.split(t or "") if w][: self.max_len - 2]
            out.append([BOS_ID] + [vocab.get(w, UNK_ID) for w in words] + [EOS_ID])
        return out


class TableTokenizer:
    """X2 with a vocabulary that stays a table: ``tokens.encode_with`` joins it to each row's
    distinct words and calls ``bound`` with the words and ids of one Arrow batch."""

    def __init__(self, table: DataFrame, max_len: int = MAX_SEQ_LENGTH):
        self.table, self.max_len = table.select("token", "id"), max_len
        self.bound = partial(WhitespaceTokenizer, max_len=max_len)


def whitespace_tokenizer(vocab_df: DataFrame, max_len: int = MAX_SEQ_LENGTH) -> WhitespaceTokenizer | TableTokenizer:
    """Build the X2 tokeniser from a vocabulary table: broadcast once to the executors while
    its measured size is at most ``tokens.LOOKUP_ROWS``, else joined by ``encode_with``."""
    from tessera.operators import tokens

    if vocab_df.count() > tokens.LOOKUP_ROWS:
        return TableTokenizer(vocab_df, max_len)
    vocab = {r["token"]: int(r["id"]) for r in vocab_df.select("token", "id").toLocalIterator()}
    return WhitespaceTokenizer(vocab_df.sparkSession.sparkContext.broadcast(vocab), max_len)
