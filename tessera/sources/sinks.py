"""Sinks: the token corpus table (S6) and the checkpoint leaderboards.

Reports are built as DataFrames of ``(run_id, line_no, line)`` so many runs
are formatted in parallel; ``write_report`` writes one text file per run
(``partitionBy(run_id)``; a report holds at most N + 2 lines).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.constants import (GAP_REPORT_HEADER, GAP_REPORT_LINE, LOSS_REPORT_HEADER,
                               LOSS_REPORT_LINE)
from tessera.functions.text import fill_template, with_fixed
from tessera.session import scratch_folder


def write_corpus(df: DataFrame, path: str | None = None, split_col: str = "split",
                 mode: str = "overwrite") -> str:
    """Write the split token table as parquet, one folder per split.

    Rows are range-partitioned and sorted by their shuffled position ``pos`` first, so
    files hold disjoint, balanced ranges in order. Default location: a fresh folder under
    the session's shared checkpoint folder.
    """
    spark = df.sparkSession
    if path is None:
        path = scratch_folder(spark, "corpus")
    order = [c for c in ("pos", "source", "row_id") if c in df.columns]
    out = df.repartitionByRange(*order).sortWithinPartitions(split_col, *order) if order else df
    out.write.mode(mode).partitionBy(split_col).parquet(path)
    return path


def loss_report(kept: DataFrame) -> DataFrame:
    """``kept(run_id, rank, step, eval_loss)`` -> report lines of each run."""
    k = with_fixed(kept, "eval_loss", "_l", 4)
    n = kept.groupBy("run_id").agg(F.count(F.lit(1)).cast("bigint").alias("_n"))
    head = n.select("run_id", F.lit(0).alias("line_no"), fill_template(LOSS_REPORT_HEADER, n=F.col("_n")).alias("line"))
    body = k.select("run_id", F.col("rank").alias("line_no"),
                    fill_template(LOSS_REPORT_LINE, i=F.col("rank"), step=F.col("step"), loss=F.col("_l")).alias("line"))
    tail = n.select("run_id", (F.col("_n") + 1).cast("int").alias("line_no"), F.lit("").alias("line"))
    return head.unionByName(body).unionByName(tail).withColumn("line_no", F.col("line_no").cast("int"))


def gap_report(kept: DataFrame, save_steps: int | None = None, eval_steps: int | None = None) -> DataFrame:
    """``kept(run_id, rank, step, gap, eval_loss)`` -> report lines of each run.

    The header's cadence is given as numbers, or taken per run from
    ``save_steps`` / ``eval_steps`` columns of ``kept`` (the run plan).
    """
    k = with_fixed(with_fixed(kept, "gap", "_g", 4), "eval_loss", "_l", 4)
    save = F.lit(save_steps) if save_steps is not None else F.col("save_steps")
    every = F.lit(eval_steps) if eval_steps is not None else F.col("eval_steps")
    runs = kept.groupBy("run_id").agg(F.first(save).alias("_sv"), F.first(every).alias("_ev"))
    head = runs.select("run_id", F.lit(0).alias("line_no"),
                       fill_template(GAP_REPORT_HEADER, save=F.col("_sv"), eval=F.col("_ev")).alias("line"))
    body = k.select("run_id", F.col("rank").alias("line_no"),
                    fill_template(GAP_REPORT_LINE, i=F.col("rank"), step=F.col("step"), gap=F.col("_g"),
                          loss=F.col("_l")).alias("line"))
    return head.unionByName(body).withColumn("line_no", F.col("line_no").cast("int"))


def write_report(lines: DataFrame, path: str) -> None:
    """Write one ordered text file per run."""
    (lines.repartition("run_id").sortWithinPartitions("run_id", "line_no")
     .select("run_id", "line").write.mode("overwrite").partitionBy("run_id").text(path))


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """``run_id, line`` of the files of ``write_report``. Where no run had a report there is no folder to name ``run_id``."""
    files = spark.read.text(path)
    run = F.col("run_id") if "run_id" in files.columns else F.lit(None)
    return files.select(run.cast("bigint").alias("run_id"), F.col("value").alias("line"))
