"""Batch = stream: the same events in 1, 3 and 7 micro-batches give the batch result."""

import math
import os
import uuid

import pytest
from pyspark.sql import functions as F

from tessera.operators import runs
from tessera.session import checkpoint_dir
from tessera.streaming.checkpoints import (LOG_SCHEMA, OUT_SCHEMA, best_n_processor, early_stop_processor, final_kept,
                                           gap_processor, run_available_now, stateful)
from tests.test_runs import SCHEMA, event, make_events


@pytest.fixture(scope="module")
def events(spark):
    return spark.createDataFrame(make_events(seed=11, n_runs=3, n_events=120), SCHEMA)


def per_batch(events, batches):
    return math.ceil(events.agg(F.max("seq")).first()[0] / batches)


@pytest.mark.parametrize("batches", [1, 3, 7])
def test_best_n_stream_equals_batch(spark, events, batches):
    out = run_available_now(spark, events, best_n_processor(3), per_batch(events, batches), 2)
    got = sorted((r["run_id"], r["rank"], r["seq"], r["step"]) for r in final_kept(out).collect())
    want = sorted((r["run_id"], r["rank"], r["seq"], r["step"]) for r in
                  runs.best_n(events.where("kind = 'eval' AND exists"), "loss", 3).collect())
    assert got == want
    trace = {(r["run_id"], r["seq"]): r["admitted"] for r in out.where("rec = 'trace' AND NOT late").collect()}
    batch = runs.admission_trace(events.where("kind = 'eval'"), "loss", F.col("exists"), 3)
    assert trace == {(r["run_id"], r["seq"]): r["admitted"] for r in batch.collect()}
    evicted = {(r["run_id"], r["evicted_step"], r["step"]) for r in out.where("evicted_step is not null").collect()}
    assert evicted == {(r["run_id"], r["evicted_step"], r["evicted_by"])
                       for r in runs.evicted(batch, F.col("exists"), 3).collect()}


def test_gap_stream_equals_batch(spark, events):
    out = run_available_now(spark, events, gap_processor(3, 9, 1), per_batch(events, 3), 2)
    got = sorted((r["run_id"], r["seq"], r["score"]) for r in final_kept(out).collect())
    g = runs.generalization_gap(events.drop("exists")).join(events.select("run_id", "seq", "exists"), ["run_id", "seq"])
    want = sorted((r["run_id"], r["seq"], r["gap"]) for r in runs.best_n(g.where("exists"), "gap", 3).collect())
    assert got == want


def test_early_stop_stream_equals_batch(spark, events):
    out = run_available_now(spark, events, early_stop_processor(3), per_batch(events, 7), 2)
    got = {(r["run_id"], r["seq"]): (r["counter"], r["stop"]) for r in out.where("rec = 'trace'").collect()}
    b = runs.early_stop(events.where("kind = 'eval'"), 3)
    assert got == {(r["run_id"], r["seq"]): (r["counter"], r["stop"]) for r in b.collect()}


def stream_batches(spark, fn, *batches):
    """Feed each list of rows as one micro-batch, in order."""
    base = os.path.join(checkpoint_dir(spark), "rows-" + uuid.uuid4().hex)
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(os.path.join(base, "input"))
    stream = spark.readStream.schema(LOG_SCHEMA).option("maxFilesPerTrigger", 1).parquet(os.path.join(base, "input"))
    q = (stateful(stream, fn).writeStream.format("parquet").option("checkpointLocation", os.path.join(base, "chk"))
         .trigger(availableNow=True).start(os.path.join(base, "out")))
    q.awaitTermination()
    return spark.read.schema(OUT_SCHEMA).parquet(os.path.join(base, "out"))


ROWS = [event(0, s, "eval", 60 * (s * 7 % 10)) for s in range(1, 21)]


def test_late_rows_are_side_output(spark):
    out = stream_batches(spark, best_n_processor(3), ROWS[10:], ROWS[:10])
    assert out.where("late").count() == 10
    assert out.where("rec = 'trace' AND NOT late").count() == 10
    # a micro-batch of late rows only does not repeat the kept list
    assert final_kept(out).count() == 3 and out.where("rec = 'kept'").count() == 3


@pytest.mark.parametrize("fn", [best_n_processor(3), gap_processor(3, 0), early_stop_processor(3)])
def test_repeated_rows_count_once(spark, fn):
    rows = [event(0, 1, "train", 50), event(0, 2, "eval", 60), event(0, 2, "eval", 60), event(0, 3, "train", 70), event(0, 4, "eval", 40)]
    out = stream_batches(spark, fn, rows, rows[3:])
    assert out.where("late").count() == 3
    assert out.where("rec = 'trace' AND NOT late").agg(F.max("eval_no")).first()[0] == 2


def test_gap_stream_equals_batch_with_save_steps(spark, events):
    out = run_available_now(spark, events, gap_processor(3, 4, save_steps=20), per_batch(events, 3), 2)
    got = sorted((r["run_id"], r["seq"], r["n_train"], r["score"]) for r in
                 out.where("rec = 'trace' AND NOT late").collect())
    g = runs.generalization_gap(events.drop("exists"), multiple=20, save_steps=20)  # warm-up 9*round(0.5)=0
    g4 = g.where("eval_no > 4")
    want = sorted((r["run_id"], r["seq"], r["n_train"], r["gap"]) for r in g4.collect())
    assert got == want and len(got) > 0


def test_hot_run_is_cut_into_micro_batches(spark):
    from tessera.streaming.checkpoints import write_log_files

    hot = [event(0, s, "eval", s) for s in range(1, 101)] + [event(1, 1, "eval", 5)]
    base = os.path.join(checkpoint_dir(spark), "hot-" + uuid.uuid4().hex)
    cols = [c.split(" ")[0] for c in LOG_SCHEMA.split(", ")]
    write_log_files(spark.createDataFrame(hot, SCHEMA).select(*cols), base, 10, 2)
    per_file = spark.read.parquet(base).groupBy(F.input_file_name(), "run_id").count()
    assert per_file.agg(F.max("count")).first()[0] == 10


def test_short_runs_share_a_group(spark):
    """A stream of many short runs calls a group for a shard of them, not for each."""
    rows = [event(r, s, "eval", 60 * ((s + r) * 7 % 10)) for r in range(40) for s in range(1, 7)]
    events = spark.createDataFrame(rows, SCHEMA)
    calls = spark.sparkContext.accumulator(0)
    fn = best_n_processor(3)

    def counted(key, pdfs, state):
        calls.add(1)
        yield from fn(key, pdfs, state)

    counted.state_schema = fn.state_schema
    out = run_available_now(spark, events, counted, 3, 2)
    assert 0 < calls.value <= 4   # 2 shards, 2 micro-batches; a call for each run would be 80
    got = sorted((r["run_id"], r["rank"], r["seq"]) for r in final_kept(out).collect())
    assert got == sorted((r["run_id"], r["rank"], r["seq"]) for r in
                         runs.best_n(events.where("kind = 'eval' AND exists"), "loss", 3).collect())


def test_leaderboard_has_no_file_for_each_run(spark):
    from tessera.session import scratch_folder
    from tessera.sources.sinks import loss_report
    from tessera.streaming.checkpoints import leaderboard_sink, read_leaderboard

    events = spark.createDataFrame([event(r, s, "eval", 60 * (s * 7 % 10)) for r in range(60) for s in range(1, 7 if r % 2 else 4)], SCHEMA)
    base = scratch_folder(spark, "board")
    run_available_now(spark, events, best_n_processor(3), 3, 2, sink=leaderboard_sink(base + "/report", loss_report), base=base)
    files = [f for _, _, names in os.walk(base.removeprefix("file:") + "/report") for f in names if f.endswith(".parquet")]
    assert 0 < len(files) < 60
    kept = runs.best_n(events.where("kind = 'eval' AND exists"), "loss", 3).select("run_id", "rank", "step", F.col("loss").alias("eval_loss"))
    assert sorted(map(tuple, read_leaderboard(spark, base + "/report").select("run_id", "line_no", "line").collect())) == \
        sorted(map(tuple, loss_report(kept).collect()))
