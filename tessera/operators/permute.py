"""Invertible permutations of row numbers (O1, T5).

``position`` maps a row number 0..n-1 to its place in a seeded order, and ``row_of`` a place to its row, by
arithmetic in one expression: no sort, no table, no state. A Feistel network of ``ROUNDS`` rounds permutes the numbers of
2 * ``half`` bits that hold n; a result of n or more is permuted again until it is below n (cycle walking), which keeps the
map a bijection of 0..n-1. The expected number of walks is below four; ``WALKS`` steps are written out,
and the few numbers that need more are finished by ``_rest``, an exact loop over them.

The round function mixes a half with a key of the seed, the round and (as ``epoch``) a column, in 64-bit integers
that agree in Spark and SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 4
MULTIPLIER = 1_103_515_245   # below 2 ** 31, so products with a half of 31 bits fit in 62
ADDEND = 12_345
MASK = (1 << 31) - 1


def half_bits(n: int) -> int:
    """Bits of a half: 2 ** (2 * half) is the smallest even power of two that holds ``n``."""
    return max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)


def round_value(x, key):
    """31 mixed bits of a half and a key below 2 ** 31; numbers or columns alike."""
    y = ((x + key) % (MASK + 1) * MULTIPLIER + ADDEND) % (MASK + 1)
    y = (y % (1 << 16) * 32_749 + _shift(y, 15) * 31 + key) % (MASK + 1)
    return _shift(y * 48_271 % MASK, 7)


def _shift(x, k: int):
    return F.shiftright(x, k) if isinstance(x, Column) else x >> k


def keys(seed: int, epoch=0) -> list:
    """Round keys of a seed and an epoch (a number or a column)."""
    return [(epoch * 69_069 + (seed * 2_654_435 + r * 40_692_503) % MASK) % MASK for r in range(ROUNDS)]


def feistel(x, half: int, round_keys: list, back: bool = False):
    """One pass over 2 * half bits; numbers or columns alike."""
    size = 1 << half
    left, right = _shift(x, half), x % size
    for k in reversed(round_keys) if back else round_keys:
        if back:
            left, right = (right + size - round_value(left, k) % size) % size, left
        else:
            left, right = right, (left + round_value(right, k)) % size
    return left * size + right


def place(x: int, n: int, seed: int, epoch: int = 0, back: bool = False) -> int:
    """The permutation of one number."""
    half, ks = half_bits(n), keys(seed, epoch)
    while True:
        x = feistel(x, half, ks, back)
        if x < n:
            return x


WALKS = 24   # at most 3 of 4 numbers walk on each time: about one in a thousand needs more


def _walk(df: DataFrame, number: str, out: str, n: int, seed: int, epoch: Column, back: bool) -> DataFrame:
    half, ks = half_bits(n), keys(seed, epoch)
    step: Callable[[Column], Column] = lambda x: feistel(x, half, ks, back)
    walks = F.sequence(F.lit(1), F.lit(WALKS))
    done = F.aggregate(walks, step(F.col(number)), lambda x, _: F.when(x < n, x).otherwise(step(x)))
    return df.withColumn(out, done)


def _finished(df: DataFrame, out: str, n: int, seed: int, epoch: Column, back: bool) -> DataFrame:
    """Walk on where ``out`` is still n or more."""
    half, ks = half_bits(n), keys(seed, epoch)
    more = F.aggregate(F.sequence(F.lit(1), F.when(F.col(out) < n, F.lit(1)).otherwise(F.lit(40 * WALKS))), F.col(out),
                       lambda x, _: F.when(x < n, x).otherwise(feistel(x, half, ks, back)))
    return df.withColumn(out, more)


def position(df: DataFrame, row: str, n: int, seed: int, epoch: Column | None = None, out: str = "pos") -> DataFrame:
    """Adds each row number's place in the order of ``seed`` (and ``epoch``)."""
    e = F.lit(0).cast("long") if epoch is None else epoch.cast("long")
    return _finished(_walk(df, row, out, n, seed, e, False), out, n, seed, e, False)


def row_of(df: DataFrame, pos: str, n: int, seed: int, epoch: Column | None = None, out: str = "row") -> DataFrame:
    """Adds the row number that stands at each place: the inverse of ``position``."""
    e = F.lit(0).cast("long") if epoch is None else epoch.cast("long")
    return _finished(_walk(df, pos, out, n, seed, e, True), out, n, seed, e, True)


def row_at(step: int, slot: int, lane: int, n: int, b: int, a: int, g: int, seed: int, device: int = 0) -> tuple[int, int]:
    """(epoch, row number) of one place of the manifest, without reading it: step from 1, then slot, device, lane."""
    sample = (((step - 1) * a + slot) * g + device) * b + lane
    epoch, pos = divmod(sample, n)
    return epoch, place(pos, n, seed, epoch, back=True)


def manifest(n: int, b: int, a: int, g: int, first_step: int, last_step: int, seed: int, spark) -> DataFrame:
    """T5 by arithmetic: (step, slot, device, lane, batch_id, sample, epoch, row) of the steps first..last, with no shuffle.

    ``row`` is the number of the training row in one numbering for all epochs; only the asked steps are made.
    """
    per_step = b * a * g
    d = spark.range((first_step - 1) * per_step, last_step * per_step).withColumnRenamed("id", "sample")
    s = F.col("sample")
    micro = F.floor(s / b)
    d = d.select("sample", (F.floor(s / per_step) + 1).alias("step"), (F.floor(micro / g) % a).cast("int").alias("slot"), (micro % g).cast("int").alias("device"),
                 (s % b).cast("int").alias("lane"), micro.alias("batch_id"), F.floor(s / n).cast("int").alias("epoch"), (s % n).alias("_pos"))
    return row_of(d, "_pos", n, seed, F.col("epoch")).drop("_pos")
