"""Unions, reproducible shuffle and exact splits.

Spark rows have no order and ``rand(seed)`` depends on the partition layout,
so every random decision here comes from a content-free hash of a stable row
key: ``md5('<salt>|<source>|<row_id>')``. The hash is uniform, so hash
buckets are balanced whatever the sources look like.

* ``global_position`` - exact 0-based position in hash order with no global
  window: per-bucket counts (partial aggregate, <= 16**digits rows), their
  prefix sum (window over that bounded table), broadcast of the offsets
  (size bound 16**digits rows), then ``row_number`` inside each bucket.
* ``assign_split`` - exact ``ceil(share * n)`` validation rows without moving
  any row: the cutoff key is found from bucket counts and one bucket, then
  the split is a narrow filter expression.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.constants import SEED

KEY_COLS = ["source", "row_id"]


def row_hash(salt: str, key_cols: list[str] = KEY_COLS) -> Column:
    """``md5('<salt>|k1|k2...')`` as lowercase hex."""
    parts = [F.lit(salt)] + [F.col(c).cast("string") for c in key_cols]
    return F.md5(F.concat_ws("|", *parts))


def row_hash_sql(salt: str, key_cols: list[str] = KEY_COLS) -> str:
    inner = " || '|' || ".join(f"CAST({c} AS VARCHAR)" for c in key_cols)
    return f"md5('{salt}|' || {inner})"


def union_all(frames: list[DataFrame], allow_missing: bool = True) -> DataFrame:
    """Bag union aligned by column name; missing columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def position_digits(n_rows: int, max_bucket_rows: int = 1_000_000) -> int:
    """Hex digits of the hash bucket so a bucket holds about ``max_bucket_rows``."""
    return max(4, math.ceil(math.log(max(n_rows, 1) / max_bucket_rows, 16)))


def global_position(df: DataFrame, salt: str, key_cols: list[str] = KEY_COLS,
                    out: str = "pos", digits: int | str = 4, partition_cols: list[str] | None = None) -> DataFrame:
    """O1: exact 0-based position in ``(hash, key)`` order (a seeded permutation).

    ``partition_cols`` gives independent permutations per value (e.g. epoch).
    ``digits="auto"`` sizes the buckets from one count of the input.
    """
    pcols = list(partition_cols or [])
    if digits == "auto":
        digits = position_digits(df.count())
    d = df.withColumn("_h", row_hash(salt, key_cols)).withColumn("_b", F.substring("_h", 1, digits))
    counts = d.groupBy(*pcols, "_b").agg(F.count(F.lit(1)).alias("_n"))
    wb = Window.partitionBy(*pcols).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*pcols, "_b", F.coalesce(F.sum("_n").over(wb), F.lit(0)).alias("_off"))
    # the window below needs the same partitioning as this join; AQE broadcasts offsets measured small
    d = d.join(offsets, [*pcols, "_b"], "inner")
    wi = Window.partitionBy(*pcols, "_b").orderBy("_h", *key_cols)
    pos = (F.col("_off") + F.row_number().over(wi) - 1).cast("bigint")
    return d.withColumn(out, pos).drop("_h", "_b", "_off")


def global_rank(df: DataFrame, order_cols: list, out: str = "pos", partitions: int | None = None) -> DataFrame:
    """Exact 0-based position of every row in a total order, with no single task.

    A distributed sort (range partitioning + in-partition sort), written once
    to the shared checkpoint folder so partition contents are fixed; then
    per-partition row counts (one row per partition) give each partition's
    offset, and ``monotonically_increasing_id`` gives the index inside it.
    ``order_cols`` must define a total order (ties are broken arbitrarily).
    """
    from tessera.session import cut_lineage

    spark = df.sparkSession
    p = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    s = df.repartitionByRange(p, *order_cols).sortWithinPartitions(*order_cols)
    s = cut_lineage(s.withColumn("_pid", F.spark_partition_id()).withColumn("_mid", F.monotonically_increasing_id()))
    counts = sorted((int(r["_pid"]), int(r["n"])) for r in
                    s.groupBy("_pid").agg(F.count(F.lit(1)).alias("n")).toLocalIterator())
    offsets, acc = [], 0
    for pid, n in counts:
        offsets.append((pid, acc))
        acc += n
    off = spark.createDataFrame(offsets or [(0, 0)], "_pid int, _off long")
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    return s.join(F.broadcast(off), "_pid", "inner") \
        .withColumn(out, (F.col("_off") + local).cast("bigint")).drop("_pid", "_mid", "_off")


RANK_ROWS = 1_000_000  # largest hash bucket ranked in one window task


def split_cutoff(df: DataFrame, share: float, salt: str, key_cols: list[str] = KEY_COLS,
                 digits: int = 4) -> tuple[int, int, tuple | None]:
    """(n, n_val, cutoff) where cutoff = (hash, *key) of the last validation row.

    Small jobs only: per-bucket counts of the hash prefix (a partial
    aggregate; at most 16**digits rows reach the driver); while the bucket
    holding the cutoff is larger than ``RANK_ROWS``, the same is repeated
    inside it with ``digits`` more hex digits; then that one bucket is ranked
    by ``(hash, key)``.
    """
    keys = df.select(*key_cols).withColumn("_h", row_hash(salt, key_cols))
    prefix, n, k, size = "", None, None, None
    while True:
        width = len(prefix) + digits
        level = keys.where(F.col("_h").startswith(prefix)) if prefix else keys
        counts = sorted((r["_b"], int(r["_n"])) for r in level.groupBy(F.substring("_h", 1, width).alias("_b"))
                        .agg(F.count(F.lit(1)).alias("_n")).toLocalIterator())
        if n is None:
            n = sum(c for _, c in counts)
            k = math.ceil(share * n)
            if k <= 0:
                return n, 0, None
        before = 0
        for bucket, c in counts:
            if before + c >= k:
                break
            before += c
        prefix, k, size = bucket, k - before, c
        if size <= RANK_ROWS or width >= 32:
            break
    n_val = math.ceil(share * n)
    w = Window.orderBy("_h", *key_cols)  # one bucket of at most RANK_ROWS rows
    last = (keys.where(F.col("_h").startswith(prefix))
            .withColumn("_r", F.row_number().over(w))
            .where(F.col("_r") == k).select("_h", *key_cols).first())
    return n, n_val, tuple(last)


def _struct_le(cols: list[Column], values: tuple) -> Column:
    """Lexicographic ``(c1, c2, ...) <= (v1, v2, ...)``."""
    expr = None
    for c, v in reversed(list(zip(cols, values))):
        lit = F.lit(v)
        expr = (c <= lit) if expr is None else ((c < lit) | ((c == lit) & expr))
    return expr


def split_with_counts(df: DataFrame, share: float, seed: int = SEED, key_cols: list[str] = KEY_COLS,
                      out: str = "split", digits: int = 4) -> tuple[DataFrame, int, int]:
    """``assign_split`` plus the row count and the validation count."""
    salt = f"split|{seed}"
    n, n_val, cutoff = split_cutoff(df, share, salt, key_cols, digits)
    if cutoff is None:
        return df.withColumn(out, F.lit("train")), n, 0
    h = row_hash(salt, key_cols)
    is_val = _struct_le([h] + [F.col(c) for c in key_cols], cutoff)
    return df.withColumn(out, F.when(is_val, F.lit("val")).otherwise(F.lit("train"))), n, n_val


def assign_split(df: DataFrame, share: float, seed: int = SEED, key_cols: list[str] = KEY_COLS,
                 out: str = "split", digits: int = 4) -> DataFrame:
    """O2/O3: exactly ``ceil(share * n)`` rows get ``'val'``, the rest ``'train'``.

    The validation rows are the ones with the smallest ``md5('split|seed|key')``.
    """
    return split_with_counts(df, share, seed, key_cols, out, digits)[0]


def seeded_shuffle(df: DataFrame, seed: int = SEED, key_cols: list[str] = KEY_COLS,
                   out: str = "pos") -> DataFrame:
    """O1: position of each row in the seeded permutation."""
    return global_position(df, f"shuffle|{seed}", key_cols, out)


def n_train(n: int, share: float) -> int:
    """Training rows of an exact split of ``n`` rows."""
    return n - math.ceil(share * n)


def split_counts(df: DataFrame, split_col: str = "split") -> DataFrame:
    """A1: rows per split and source."""
    return df.groupBy(split_col, "source").agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"))


# ---- oracle SQL fragments ----

def shuffle_sql(src: str, seed: int = SEED, key_cols: list[str] = KEY_COLS, extra: str = "") -> str:
    h = row_hash_sql(f"shuffle|{seed}", key_cols)
    kc = ", ".join(key_cols)
    return (f"SELECT {kc}{extra}, CAST(row_number() OVER (ORDER BY {h}, {kc}) - 1 AS BIGINT) AS pos "
            f"FROM {src}")


def split_sql(src: str, share: float, seed: int = SEED, key_cols: list[str] = KEY_COLS,
              cols: str = "*") -> str:
    h = row_hash_sql(f"split|{seed}", key_cols)
    kc = ", ".join(key_cols)
    return (f"SELECT {cols}, CASE WHEN _rn <= ceil({share} * _n) THEN 'val' ELSE 'train' END AS split "
            f"FROM (SELECT *, row_number() OVER (ORDER BY {h}, {kc}) AS _rn, count(*) OVER () AS _n "
            f"FROM {src}) _s")
