"""Keyed permutations: bijective at every size, equal in Python and Spark, invertible."""

import pytest
from pyspark.sql import functions as F

from tessera.operators.permute import half_bits, manifest, place, position, row_at, row_of
from tessera.operators.tokens import keyed_microbatch


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 15, 16, 17, 63, 257, 4097])
def test_bijective_and_invertible(n):
    for seed, epoch in ((42, 0), (42, 3), (7, 0)):
        p = [place(x, n, seed, epoch) for x in range(n)]
        assert sorted(p) == list(range(n))
        assert [place(x, n, seed, epoch, back=True) for x in p] == list(range(n))
    assert 4 ** half_bits(n) >= n and (half_bits(n) == 1 or 4 ** (half_bits(n) - 1) < n)


def test_orders_look_random():
    n = 6000
    p, q = ([place(x, n, 42, e) for x in range(n)] for e in (0, 1))
    assert sum(x == y for x, y in zip(p, q)) < 12 and sum(x == y for x, y in enumerate(p)) < 12
    assert abs(sum(abs(a - b) for a, b in zip(p, p[1:])) / n - n / 3) < n / 20
    halves = sum(x < n // 2 for x in p[:n // 2])
    assert abs(halves - n // 4) < 150


@pytest.mark.parametrize("n", [1, 5, 17, 1000])
def test_columns_equal_python(spark, n):
    rows = spark.range(n).withColumn("e", (F.col("id") % 3)).withColumnRenamed("id", "row")
    d = row_of(position(rows, "row", n, 42, F.col("e")), "pos", n, 42, F.col("e"), out="again")
    got = d.collect()
    assert all(r["pos"] == place(r["row"], n, 42, r["e"]) and r["again"] == r["row"] for r in got) and len(got) == n
    plan = d._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_any_place_of_the_manifest(spark):
    n, b, a, g, steps = 37, 2, 3, 2, 11
    rows = spark.range(n).select(F.lit("s").alias("source"), F.col("id").alias("row_id"), F.col("id").alias("row"))
    whole = keyed_microbatch(rows, n, b, a, g, steps, 42, ["source", "row_id"])
    assert "Exchange" not in whole._jdf.queryExecution().executedPlan().toString()
    every = {(r["step"], r["slot"], r["device"], r["lane"]): (r["epoch"], r["row_id"], r["batch_id"]) for r in whole.collect()}
    assert len(every) == steps * a * b * g
    for (step, slot, device, lane), (epoch, row, _) in every.items():
        assert row_at(step, slot, lane, n, b, a, g, 42, device) == (epoch, row)
    part = manifest(n, b, a, g, 4, 6, 42, spark).collect()
    assert {(r["step"], r["slot"], r["device"], r["lane"]): (r["epoch"], r["row"], r["batch_id"]) for r in part} == {k: v for k, v in every.items() if 4 <= k[0] <= 6}
    for e in range(max(v[0] for v in every.values())):   # an epoch has every row once
        assert sorted(v[1] for v in every.values() if v[0] == e) == list(range(n))


def test_no_rows(spark):
    rows = spark.range(0).select(F.lit("s").alias("source"), F.col("id").alias("row_id"), F.col("id").alias("row"))
    assert keyed_microbatch(rows, 0, 2, 3, 1, 5, 42, ["source", "row_id"]).collect() == []
