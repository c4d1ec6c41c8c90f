"""Save events as a second stream, and hooks over out-of-order events."""

import os
import random
import uuid

import pytest
from pyspark.sql import functions as F

from tessera.operators import runs
from tessera.session import checkpoint_dir
from tessera.streaming import reorder, saves
from tests.test_runs import SCHEMA, event, make_events


def folder(spark, name):
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


def stream_of(spark, schema, batches):
    """Each list of rows is one micro-batch."""
    base = folder(spark, "in")
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(base)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(base)


def decisions(spark, log, feed, n):
    """All decisions of micro-batches ``log`` and ``feed`` (lists of lists)."""
    base = folder(spark, "saves")
    out = saves.with_saves(stream_of(spark, saves.EVENTS, log), stream_of(spark, saves.EVENTS, feed), n)
    q = out.writeStream.format("parquet").option("checkpointLocation", base + "/chk").trigger(availableNow=True).start(base + "/out")
    q.awaitTermination()
    return spark.read.schema(saves.DECISIONS).parquet(base + "/out")


def ev(seq, loss, run=0):
    return (run, "eval", seq, 10 * seq, loss)


def told(kind, step, run=0):
    return (run, kind, None, step, None)


CASES = {
    "before": ([[ev(1, 3.0)], [ev(2, 2.0)], [ev(3, 2.5)]], [[told("saved", 10), told("saved", 20), told("saved", 30)], [told("upto", 30)], []]),
    "after": ([[ev(1, 3.0), ev(2, 2.0), ev(3, 2.5)], [], []], [[], [told("saved", 10)], [told("saved", 20), told("saved", 30), told("upto", 30)]]),
    "never": ([[ev(1, 3.0), ev(2, 2.0)], [ev(3, 2.5)], []], [[told("saved", 10)], [told("saved", 30)], [told("upto", 30)]]),
    "folder is gone": ([[ev(1, 3.0), ev(2, 2.0)], [ev(3, 2.5)], []], [[told("saved", 10), told("missing", 20)], [told("saved", 30)], [told("upto", 30)]]),
    "unanswered": ([[ev(1, 3.0), ev(2, 2.0)], [ev(3, 9.0)], []], [[told("saved", 10)], [], [told("upto", 10)]]),
}


@pytest.mark.parametrize("name", CASES)
def test_saves_before_after_and_never(spark, name):
    log, feed = CASES[name]
    blank = [(9, "upto", None, 0, None)]
    out = {r["step"]: (r["outcome"], r["evicted_step"]) for r in decisions(spark, [b or [(9, "eval", 1, 1, 1.0)] for b in log], [b or blank for b in feed], 2)
           .where("run_id = 0").collect()}
    kept = {10: ("kept", None), 20: ("kept", None), 30: ("kept", 10)}
    lost = {10: ("kept", None), 20: ("dropped", None), 30: ("kept", None)}
    assert out == {"before": kept, "after": kept, "never": lost, "folder is gone": lost, "unanswered": {10: ("kept", None)}}[name]


def test_repeated_log_events_are_late(spark):
    out = decisions(spark, [[ev(1, 3.0), ev(2, 2.0), ev(2, 2.0)], [ev(1, 3.0)]], [[told("saved", 10), told("saved", 20)], [told("upto", 20)]], 2)
    assert sorted((r["seq"], r["outcome"]) for r in out.collect()) == [(1, "kept"), (1, "late"), (2, "kept"), (2, "late")]


@pytest.mark.parametrize("ahead", [0, 1])
def test_two_streams_equal_batch(spark, ahead):
    """Random logs, saves far ahead of or behind their events: the batch admission trace."""
    rows = make_events(seed=21 + ahead, n_runs=3, n_events=60)
    events = spark.createDataFrame(rows, SCHEMA)
    log = [(r, k, q, t, x) for r, q, t, k, _, x, _ in sorted(rows, key=lambda r: r[1]) if k == "eval"]
    feed = sorted([(r, "saved", None, t, None) for r, _, t, k, _, _, ex in rows if k == "eval" and ex], key=lambda r: r[3])
    feed += [(r, "upto", None, 10**6, None) for r in range(3)]
    logs, feeds = [log[i:i + 40] for i in range(0, len(log), 40)], [feed[i:i + 25] for i in range(0, len(feed), 25)]
    pad_log, pad_feed = [[(9, "eval", k, 10 * k, 1.0)] for k in range(1, 4)], [[(9, "upto", None, k, None)] for k in range(3)]
    out = decisions(spark, pad_log + logs if ahead else logs, feeds if ahead else pad_feed + feeds, 3).where("run_id <> 9")
    got = {(r["run_id"], r["seq"]): (r["admitted"], r["outcome"], r["evicted_step"]) for r in out.collect()}
    trace = runs.admission_trace(events.where("kind = 'eval'"), "loss", F.col("exists"), 3)
    gone = {(r["run_id"], r["evicted_by"]): r["evicted_step"] for r in runs.evicted(trace, F.col("exists"), 3).collect()}
    want = {(r["run_id"], r["seq"]): (r["admitted"], "skipped" if not r["admitted"] else "kept" if r["exists"] else "dropped",
                                      gone.get((r["run_id"], r["step"]))) for r in trace.collect()}
    assert got == want


def dense(rows):
    """The events with their place in the run as ``seq``."""
    out = []
    for run in sorted({r[0] for r in rows}):
        mine = sorted((r for r in rows if r[0] == run), key=lambda r: r[1])
        out += [(run, k, r[2], r[3], r[5], r[6]) for k, r in enumerate(mine, 1)]
    return out


def test_out_of_order_equals_batch(spark):
    """Events in any order over many micro-batches: the batch's kept list; repeats in a table of their own."""
    rows = dense(make_events(seed=5, n_runs=3, n_events=40))
    mixed = rows + rows[3:9]
    random.Random(3).shuffle(mixed)
    stream = stream_of(spark, reorder.EVENTS, [mixed[i:i + 30] for i in range(0, len(mixed), 30)])
    out, late = reorder.run_ordered(spark, stream, reorder.KeepBest(3), folder(spark, "ordered"))
    got = sorted((r["run_id"], r["rank"], r["seq"], r["step"]) for r in reorder.present_list(out).collect())
    table = spark.createDataFrame(rows, reorder.EVENTS)
    want = sorted((r["run_id"], r["rank"], r["seq"], r["step"]) for r in runs.best_n(table.where("kind = 'eval' AND exists"), "loss", 3).collect())
    assert got == want and want
    assert sorted((r["run_id"], r["seq"]) for r in late.collect()) == sorted((r[0], r[1]) for r in rows[3:9])


def test_shards_of_runs_equal_runs(spark):
    """A group for a shard of runs: the rows and the late rows of a group for each run, over gaps, repeats and ends; state per shard."""
    rows = dense(make_events(seed=6, n_runs=12, n_events=25))
    rows = [(r, q, t, "end" if r in (3, 7) and q == 20 else k, x, ex) for r, q, t, k, x, ex in rows if (r, q) != (5, 11)]   # 5 waits for 11 without end
    mixed = rows + rows[3:60:7]
    random.Random(8).shuffle(mixed)
    batches = [mixed[i:i + 80] for i in range(0, len(mixed), 80)]
    seen = []
    for shards in (None, 2):
        base = folder(spark, "sharded")
        out, late = reorder.run_ordered(spark, stream_of(spark, reorder.EVENTS, batches), reorder.KeepBest(3), base, shards=shards)
        state = {name: spark.read.format("statestore").option("stateVarName", name).load(os.path.join(base, "chk-ordered")).collect() for name in ("position", "kept", "held")}
        seen.append((*(sorted(map(repr, t.collect())) for t in (out, late)), len({r["key"][0] for r in state["position"]}), len(state["position"])))
        assert {r["list_element"]["run_id"] for r in state["kept"]} == {r[0] for r in rows} - {3, 7}
        assert sum(len(r["value"]["seq"]) for r in state["held"]) == 14   # run 5 behind its gap
    assert seen[0][:2] == seen[1][:2] and seen[0][0] and seen[0][1]
    assert seen[0][2:] == (12, 12) and seen[1][2:] == (2, 12)
    with pytest.raises(ValueError):
        reorder.run_ordered(spark, stream_of(spark, reorder.EVENTS, batches[:1]), reorder.KeepBest(3, wait_ms=5), folder(spark, "no"), shards=2)


def test_timer_gives_up_a_gap_and_ended_runs_leave_no_state(spark):
    e = lambda run, seq, kind="eval", loss=None: (run, seq, 10 * seq, kind, loss or float(seq), True)
    stream = stream_of(spark, reorder.EVENTS, [[e(0, 1), e(0, 4), e(1, 1), e(1, 2, "end")], [e(1, 3), e(0, 5)]])
    base = folder(spark, "timers")
    out, late = reorder.run_ordered(spark, stream, reorder.KeepBest(5, wait_ms=500, ttl_ms=3_600_000), base,
                                    until=lambda rows: rows.where("run_id = 0 and seq = 5").count() > 0)
    decided = out.where("rank is null")
    assert [r["seq"] for r in decided.where("run_id = 0").orderBy("seq").collect()] == [1, 4, 5]   # 2 and 3 never came
    assert [(r["run_id"], r["seq"]) for r in late.collect()] == [(1, 3)]                            # after the end of run 1
    held = spark.read.format("statestore").option("stateVarName", "kept").load(os.path.join(base, "chk-ordered"))
    assert {r["key"]["run_id"] for r in held.collect()} == {0}


def test_gap_stream_with_missing_and_fractional_losses(spark):
    """ST2 = W2 where train losses are NaN, infinite or fractions of a unit, one or two in an interval, across micro-batches."""
    from decimal import Decimal

    from tests.test_streaming import per_batch
    from tessera.streaming.checkpoints import final_kept, gap_processor, run_available_now

    rng, rows = random.Random(4), []
    for run in range(2):
        for seq in range(1, 181):
            kind = "eval" if seq % 5 == 0 else "train"
            x = round(rng.uniform(0.5, 3), rng.choice([2, 7, 12]))
            odd = kind == "train" and seq // 5 % 4 == 1 and seq % 5 in ((1,) if run else (1, 2))
            x = rng.choice([float("nan"), float("inf")]) if odd else x
            rows.append((run, seq, 10 * seq, kind, None if odd else Decimal(repr(x)), x, True))
    log = spark.createDataFrame(rows, "run_id long, seq long, step long, kind string, loss_c decimal(38,18), loss double, exists boolean")
    want = runs.best_n(runs.generalization_gap(log.drop("exists"), scale=1), "gap", 25).collect()
    out = run_available_now(spark, log, gap_processor(25, 9, scale=1), per_batch(log, 11), 2)
    got = {(r["run_id"], r["rank"], r["seq"]): repr(r["score"]) for r in final_kept(out).collect()}
    assert got == {(r["run_id"], r["rank"], r["seq"]): repr(r["gap"]) for r in want}
    assert "nan" in got.values() and len(got) == 50
