"""Evaluation report (A4): accuracy per model and stage, and lift per stage.

Gold answers join predictions on ``item_id`` (a key of the gold set, so no
hot key); a gold item without a prediction counts as wrong, and a stage
whose predictions match no gold item has accuracy 0. The result has per (model, stage); the lift is a ``lag`` over those few rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def stage_accuracy(gold: DataFrame, predictions: DataFrame) -> DataFrame:
    """``model, stage, stage_no, n_correct, n_gold, accuracy, lift``."""
    n_gold = gold.count()  # one scalar; keeps the gold set out of a cross join
    j = predictions.join(gold, "item_id", "left")
    c = j.groupBy("model", "stage", "stage_no").agg(
        F.sum(F.when(F.col("choice") == F.col("answer"), 1).otherwise(0)).cast("bigint").alias("n_correct"))
    c = c.withColumn("n_gold", F.lit(n_gold).cast("bigint")) \
        .withColumn("accuracy", F.col("n_correct").cast("double") / F.col("n_gold").cast("double"))
    w = Window.partitionBy("model").orderBy("stage_no")
    return c.withColumn("lift", F.col("accuracy") - F.lag("accuracy").over(w))
