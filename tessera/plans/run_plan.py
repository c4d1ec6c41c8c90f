"""Run plan: hardware lookup, step arithmetic and run names.

The hardware table is a fixed 12-row dimension (broadcast is bounded by it).
Runs come from a run registry; the training-set size per phase is a count
aggregate joined on the phase key, so the plan is one lazy DataFrame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.constants import (EARLY_STOP_PATIENCE, EVAL_EVERY_SAVES, GAP_MULTIPLE, HARDWARE_TABLE,
                               LEARNING_RATES, MODEL_STEM, SPLIT_NUM)
from tessera.functions.text import checkpoint_path, format_lr, parent_label

HW_SCHEMA = "model string, phase string, gpu_class int, b int, a int, keep int, epochs double"
DEFAULT_STAMP = "240101"  # the yymmdd stamp is a parameter, for reproducible names


def hardware(spark: SparkSession) -> DataFrame:
    """The hardware table as a DataFrame."""
    return spark.createDataFrame(HARDWARE_TABLE, HW_SCHEMA)


def phase_params(spark: SparkSession) -> DataFrame:
    """Learning rate, evaluation cadence and patience per (model, phase)."""
    rows = [(m, p, float(lr), EVAL_EVERY_SAVES[p], EARLY_STOP_PATIENCE[(m, p)])
            for (m, p), lr in sorted(LEARNING_RATES.items())]
    return spark.createDataFrame(rows, "model string, phase string, lr double, eval_every int, patience int")


def hardware_lookup(runs: DataFrame, hw: DataFrame) -> DataFrame:
    """``gpus`` -> batch, accumulation, keep, epochs (classes 1, 2, 3+)."""
    r = runs.withColumn("gpu_class", F.least(F.col("gpus"), F.lit(3)).cast("int"))
    return r.join(F.broadcast(hw), ["model", "phase", "gpu_class"], "inner")


def _epochs_text(col: Column) -> Column:
    """``1`` for whole numbers, else ``1.5`` (Python's ``str`` of int or float)."""
    return F.when(col == F.floor(col), F.floor(col).cast("bigint").cast("string")).otherwise(col.cast("string"))


def run_plan(runs: DataFrame, n_train: DataFrame, hw: DataFrame, params: DataFrame,
             stamp: str = DEFAULT_STAMP, multiple: int = GAP_MULTIPLE) -> DataFrame:
    """A3 + P12: steps, cadence, effective batch and names of every run.

    ``runs(run_id, model, phase, gpus)``; ``n_train(phase, n_train)``.
    """
    d = hardware_lookup(runs, hw).join(F.broadcast(params), ["model", "phase"], "inner") \
        .join(F.broadcast(n_train), ["phase"], "inner")  # one row per phase
    denom = F.col("b") * F.col("a") * F.col("gpus") * F.lit(SPLIT_NUM * 10)
    save = F.ceil(F.col("n_train").cast("double") / denom.cast("double")).cast("bigint")
    d = d.withColumn("save_steps", save)
    d = d.withColumn("max_steps", (F.col("save_steps") * F.ceil(F.lit(float(SPLIT_NUM)) * F.col("epochs")) * 10)
                     .cast("bigint"))
    d = d.withColumn("eval_steps", (F.col("eval_every") * F.col("save_steps")).cast("bigint"))
    d = d.withColumn("eff_batch", (F.col("b") * F.col("a")).cast("int"))
    d = d.withColumn("epochs_run", F.col("max_steps").cast("double") * F.col("eff_batch") * F.col("gpus")
                     / F.col("n_train").cast("double"))
    stem = F.coalesce(*[F.when(F.col("model") == k, F.lit(v)) for k, v in MODEL_STEM.items()])
    base = F.concat(stem, F.lit("_"), F.col("phase"), F.lit("_"), F.lit(stamp), F.lit("_"), format_lr("lr"),
                    F.lit("_b"), F.col("eff_batch").cast("string"), F.lit("x"), F.col("gpus").cast("string"))
    name = F.when(F.col("phase") == "cpt", F.concat(base, F.lit("_"), _epochs_text(F.col("epochs")), F.lit("epo"))) \
        .otherwise(F.concat(base, F.lit("_cosine_"), _epochs_text(F.col("epochs")), F.lit("epo_gap_"),
                            F.lit(str(multiple)), F.lit("n")))
    d = d.withColumn("run_name", name).withColumn("output_dir", F.concat(F.lit("models/output_"), F.col("run_name")))
    return d


def checkpoint_paths(checkpoints: DataFrame, plan: DataFrame) -> DataFrame:
    """Checkpoint path and its parent-directory label."""
    j = checkpoints.join(plan.select("run_id", "phase", "output_dir"), ["run_id", "phase"], "inner")
    p = checkpoint_path(F.col("output_dir"), F.col("step"))
    return j.withColumn("path", p).withColumn("label", parent_label("path"))


def phase_handoff(cpt_best: DataFrame, plan: DataFrame) -> DataFrame:
    """Each SFT run starts from the rank-1 checkpoint of its CPT run.

    ``cpt_best(run_id, best_step)``; a run with no kept checkpoint has no row
    there and so gets no SFT run (inner join); ``orphans`` lists them.
    """
    cpt = plan.where(F.col("phase") == "cpt").select("run_id", F.col("output_dir").alias("cpt_dir"))
    sft = plan.where(F.col("phase") == "sft").select("run_id", F.col("run_name").alias("sft_run_name"))
    j = cpt_best.join(cpt, "run_id", "inner").join(sft, "run_id", "inner")
    return j.select("run_id", "sft_run_name", "best_step",
                    checkpoint_path(F.col("cpt_dir"), F.col("best_step")).alias("init_checkpoint"))


def orphans(runs: DataFrame, cpt_best: DataFrame) -> DataFrame:
    """Runs whose pre-training kept no checkpoint (``left_anti``)."""
    return runs.select("run_id").distinct().join(cpt_best.select("run_id"), "run_id", "left_anti")
