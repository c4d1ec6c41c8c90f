"""The chunked running aggregates equal plain per-group windows exactly."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators.prefix import Running, dense_rank_in_group, running_aggregates


@pytest.fixture(scope="module")
def data(spark):
    rnd = random.Random(3)
    rows = []
    for g in range(3):
        k = 0
        for _ in range(400 if g == 0 else 40):  # group 0 is the hot one
            k += rnd.choice([1, 1, 2, 9])
            v = rnd.choice([None, rnd.randint(-50, 50)])
            rows.append((g, k, v))
    return spark.createDataFrame(rows, "g long, k long, v long")


@pytest.mark.parametrize("width", [1.0, 3.0, 17.0, 1e9])
def test_running_equals_window(spark, data, width):
    specs = [Running("s_in", F.col("v"), "sum", True), Running("s_ex", F.col("v"), "sum", False),
             Running("mn_ex", F.col("v"), "min", False), Running("mx_in", F.col("v"), "max", True)]
    got = {(r["g"], r["k"]): (r["s_in"], r["s_ex"], r["mn_ex"], r["mx_in"]) for r in
           running_aggregates(data, ["g"], F.col("k"), ["k"], specs, width).collect()}
    w = Window.partitionBy("g").orderBy("k")
    inc, exc = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    ref = data.select("g", "k", F.sum("v").over(inc).alias("a"), F.sum("v").over(exc).alias("b"),
                      F.min("v").over(exc).alias("c"), F.max("v").over(inc).alias("d"))
    assert got == {(r["g"], r["k"]): (r["a"], r["b"], r["c"], r["d"]) for r in ref.collect()}


def test_running_with_few_chunks_per_super_chunk(spark, data, monkeypatch):
    from tessera.operators import prefix
    monkeypatch.setattr(prefix, "FAN", 3)
    test_running_equals_window(spark, data, 3.0)


def test_dense_rank(spark, data):
    got = {(r["g"], r["k"]): r["seq"] for r in dense_rank_in_group(data, ["g"], ["k"]).collect()}
    ref = data.select("g", "k", F.row_number().over(Window.partitionBy("g").orderBy("k")).alias("n"))
    assert got == {(r["g"], r["k"]): r["n"] for r in ref.collect()}
