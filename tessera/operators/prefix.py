"""Skew-safe running aggregates within a group.

A window ``PARTITION BY run ORDER BY seq`` puts a whole group in one task; one
run can hold a third of all events. Here every group is cut into chunks of a
monotone numeric key (``floor(key / width)``):

1. the running aggregate inside each chunk is a window over ``(group, chunk)``
   (bounded by the chunk width);
2. per-chunk totals are a partial aggregate; their exclusive running value
   takes two windows: over the ``FAN`` chunks of a super-chunk, and over the
   super-chunks of a group (4096 x 4096 rows give one super-chunk row);
3. the chunk offsets join back on ``(group, chunk)``. The window of step 1
   already hash-partitions the big side by these keys, so the join adds no
   second shuffle of it; AQE turns it into a broadcast when the offsets are
   measured small.

The result equals ``agg(value) OVER (PARTITION BY group ORDER BY order ROWS
BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)`` (or ``1 PRECEDING``) exactly.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FAN = 4096  # chunks per super-chunk

_AGG = {"sum": F.sum, "min": F.min, "max": F.max}


@dataclass(frozen=True)
class Running:
    """One running aggregate: ``fn(value)`` over the rows up to this one."""

    name: str
    value: Column
    fn: str = "sum"  # sum | min | max
    inclusive: bool = True


def _combine(fn: str, outer: Column, inner: Column) -> Column:
    if fn == "sum":
        both = F.coalesce(outer, F.lit(0)) + F.coalesce(inner, F.lit(0))
        return F.when(outer.isNull() & inner.isNull(), F.lit(None)).otherwise(both)
    pick = F.least if fn == "min" else F.greatest  # both skip nulls
    return pick(outer, inner)


def running_aggregates(df: DataFrame, group_cols: list[str], chunk_key: Column,
                       order_cols: list, specs: list[Running], width: float,
                       keep_chunk: bool = False) -> DataFrame:
    """Add one column per ``Running`` spec (see module docstring).

    With ``keep_chunk`` the ``_chunk`` column stays; a following call on the
    result reuses it (same width and key), so the rows, already partitioned by
    ``(group, _chunk)``, are not shuffled again.
    """
    ck = "_chunk"
    d = df if ck in df.columns else df.withColumn(ck, F.floor(chunk_key / F.lit(width)).cast("bigint"))
    vals = {s.name: f"_v_{s.name}" for s in specs}
    for s in specs:
        d = d.withColumn(vals[s.name], s.value)

    # chunk totals -> exclusive running value over chunks
    totals = d.groupBy(*group_cols, ck).agg(
        *[_AGG[s.fn](vals[s.name]).alias(f"_t_{s.name}") for s in specs])
    totals = totals.withColumn("_super", F.floor(F.col(ck) / F.lit(FAN)).cast("bigint"))
    inside = Window.partitionBy(*group_cols, "_super").orderBy(ck).rowsBetween(Window.unboundedPreceding, -1)
    above = Window.partitionBy(*group_cols).orderBy("_super").rowsBetween(Window.unboundedPreceding, -1)
    supers = totals.groupBy(*group_cols, "_super").agg(*[_AGG[s.fn](f"_t_{s.name}").alias(f"_t_{s.name}") for s in specs])
    supers = supers.select(*group_cols, "_super", *[_AGG[s.fn](f"_t_{s.name}").over(above).alias(f"_a_{s.name}") for s in specs])
    offsets = totals.select(*group_cols, "_super", ck, *[
        _AGG[s.fn](f"_t_{s.name}").over(inside).alias(f"_b_{s.name}") for s in specs])
    offsets = offsets.join(supers, [*group_cols, "_super"], "left").select(*group_cols, ck, *[
        _combine(s.fn, F.col(f"_a_{s.name}"), F.col(f"_b_{s.name}")).alias(f"_o_{s.name}") for s in specs])

    # running value inside the chunk
    win = Window.partitionBy(*group_cols, ck).orderBy(*order_cols)
    for s in specs:
        frame = win.rowsBetween(Window.unboundedPreceding, 0 if s.inclusive else -1)
        d = d.withColumn(f"_i_{s.name}", _AGG[s.fn](vals[s.name]).over(frame))

    d = d.join(offsets, [*group_cols, ck], "left")
    for s in specs:
        d = d.withColumn(s.name, _combine(s.fn, F.col(f"_o_{s.name}"), F.col(f"_i_{s.name}")))
    drop = ([] if keep_chunk else [ck]) + [c for s in specs
                                           for c in (vals[s.name], f"_t_{s.name}", f"_o_{s.name}", f"_i_{s.name}")]
    return d.drop(*[c for c in drop if c in d.columns])


def dense_rank_in_group(df: DataFrame, group_cols: list[str], order_cols: list[str], out: str = "seq") -> DataFrame:
    """Exact 1-based ``row_number()`` per group, ordered by ``order_cols``.

    One distributed sort by (group, order) gives every row its global position
    (``mix.global_rank``); a row's number is its distance from its group's first
    position. A hot group is cut into ranges by the sort like any other rows.
    """
    from tessera.operators.mix import global_rank

    ranked = global_rank(df, [F.col(c) for c in [*group_cols, *order_cols]], out="_pos")
    first = ranked.groupBy(*[F.col(c).alias(f"_g_{c}") for c in group_cols]).agg(F.min("_pos").alias("_first"))
    same = F.lit(True)
    for c in group_cols:
        same = same & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    return ranked.join(first, same).select(*df.columns, (F.col("_pos") - F.col("_first") + 1).cast("bigint").alias(out))
