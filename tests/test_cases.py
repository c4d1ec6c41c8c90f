"""Hand-made cases of FIXTURES.md (ties, empty interval, warm-up, short runs, NaN, report files)."""

import os
import tempfile

from pyspark.sql import functions as F

from tessera.operators import runs
from tessera.sources.sinks import loss_report, write_report
from tests.test_runs import SCHEMA, event


def _evals(spark, losses, exists=True):
    rows = [event(0, i + 1, "eval", l, exists) for i, l in enumerate(losses)]
    return spark.createDataFrame(rows, SCHEMA)


def test_tie_with_full_list_is_not_admitted(spark):
    # N = 2: losses 5 (seq 1), 3 (seq 2) fill the list; seq 3 ties the worst (5) -> not admitted
    t = runs.admission_trace(_evals(spark, [5, 3, 5, 4]), "loss", F.col("exists"), 2)
    got = [(r["seq"], r["admitted"], r["reason"]) for r in t.orderBy("seq").collect()]
    assert got == [(1, True, "Limit not reached"), (2, True, "Limit not reached"),
                   (3, False, "Not better than worst"), (4, True, "Better than worst")]
    ev = runs.evicted(t, F.col("exists"), 2).collect()
    assert [(r["evicted_step"], r["evicted_by"]) for r in ev] == [(10, 40)]


def test_fewer_events_than_n(spark):
    t = runs.admission_trace(_evals(spark, [7, 8, 9]), "loss", F.col("exists"), 10)
    assert [r["reason"] for r in t.collect()] == ["Limit not reached"] * 3
    kept = runs.best_n(_evals(spark, [7, 8, 9]), "loss", 10)
    assert kept.count() == 3


def test_empty_interval_and_warmup(spark):
    # 9 warm-up evaluations, each after one train event; then eval 10 with a sample,
    # eval 11 directly after it (empty interval: no decision), eval 12 with two samples
    rows, seq = [], 0
    for _ in range(9):
        rows += [event(0, seq + 1, "train", 100_000), event(0, seq + 2, "eval", 120_000)]
        seq += 2
    rows += [event(0, seq + 1, "train", 100_000), event(0, seq + 2, "eval", 150_000), event(0, seq + 3, "eval", 160_000),
             event(0, seq + 4, "train", 100_000), event(0, seq + 5, "train", 101_000), event(0, seq + 6, "eval", 99_000)]
    g = runs.generalization_gap(spark.createDataFrame(rows, SCHEMA)).orderBy("seq").collect()
    assert [r["eval_no"] for r in g] == [10, 12]
    assert abs(g[0]["gap"] - 0.5) < 1e-12 and g[0]["n_train"] == 1
    assert g[1]["n_train"] == 2 and g[1]["gap"] == abs(0.99 - 201 / 200)


def test_nan_ranks_last(spark):
    df = spark.createDataFrame([(0, 1, float("nan")), (0, 2, 0.5), (0, 3, 0.7)],
                               "run_id long, seq long, gap double")
    got = [r["seq"] for r in runs.best_n(df, "gap", 3).orderBy("rank").collect()]
    assert got == [2, 3, 1]


def test_report_files_are_ordered_per_run(spark):
    kept = spark.createDataFrame([(0, 1, 5, 0.25), (0, 2, 9, 0.5), (1, 1, 3, 1.03125)],
                                 "run_id long, rank int, step long, eval_loss double")
    lines = loss_report(kept)
    out = os.path.join(tempfile.mkdtemp(prefix="tessera-report-"), "reports")
    write_report(lines, out)
    with open([os.path.join(out, "run_id=0", f) for f in os.listdir(os.path.join(out, "run_id=0"))
               if f.endswith(".txt")][0]) as f:
        assert f.read() == ("Currently keeping 2 checkpoints:\n   1. checkpoint-5: eval_loss=0.2500\n"
                            "   2. checkpoint-9: eval_loss=0.5000\n\n")
    r1 = [r["line"] for r in lines.where("run_id = 1").orderBy("line_no").collect()]
    assert r1[1] == "   1. checkpoint-3: eval_loss=1.0312"  # half-even on the exact binary value


def test_gap_report_header_per_run(spark):
    from tessera.sources.sinks import gap_report
    kept = spark.createDataFrame([(0, 1, 7, 0.03125, 2.5, 3, 30), (1, 1, 4, 0.5, 1.0, 1, 10)],
                                 "run_id long, rank int, step long, gap double, eval_loss double, "
                                 "save_steps long, eval_steps long")
    lines = {(r["run_id"], r["line_no"]): r["line"] for r in gap_report(kept).collect()}
    assert lines[(0, 0)] == "Stability Priority Leaderboard (Samples every 3 steps, Settlement every 30 steps)"
    assert lines[(0, 1)] == "   1. checkpoint-7: Gap=0.0312 (Eval_Loss=2.5000)"
    fixed = {(r["run_id"], r["line_no"]): r["line"] for r in gap_report(kept.drop("save_steps", "eval_steps"), 1, 10)
             .collect()}
    assert fixed[(1, 0)].endswith("(Samples every 1 steps, Settlement every 10 steps)")


def test_position_digits_auto(spark):
    from tessera.operators.mix import global_position, position_digits
    assert position_digits(10) == 4 and position_digits(10**11) == 5 and position_digits(10**13) == 6
    df = spark.range(0, 300).select(F.lit("s").alias("source"), F.col("id").alias("row_id"))
    a = {r["row_id"]: r["pos"] for r in global_position(df, "x", digits="auto").collect()}
    b = {r["row_id"]: r["pos"] for r in global_position(df, "x", digits=2).collect()}
    assert a == b and sorted(a.values()) == list(range(300))


def test_no_report_reads_back_as_no_rows(spark):
    from tessera.sources.sinks import read_report, write_report
    kept = spark.createDataFrame([], "run_id long, rank int, step long, eval_loss double")
    out = os.path.join(tempfile.mkdtemp(prefix="tessera-report-"), "reports")
    write_report(loss_report(kept), out)
    back = read_report(spark, out)
    assert back.columns == ["run_id", "line"] and back.count() == 0
    write_report(loss_report(spark.createDataFrame([(7, 1, 5, 0.25)], kept.schema)), out)
    assert sorted(map(tuple, read_report(spark, out).collect())) == [
        (7, ""), (7, "   1. checkpoint-5: eval_loss=0.2500"), (7, "Currently keeping 1 checkpoints:")]
