"""Run analytics against their definitions, evaluated directly on small logs.

Random event logs with many ties, empty intervals and missing checkpoints;
chunk widths are made tiny so every chunk boundary path runs. A step is not an
event position (``step = 10 * seq``), and losses lie around the early-stop threshold.
"""

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import runs

SCHEMA = "run_id long, seq long, step long, kind string, loss_c long, loss double, exists boolean"
N = 3
UNIT = 100_000


def event(run, seq, kind, loss_c, exists=True):
    return (run, seq, 10 * seq, kind, loss_c, loss_c / UNIT, exists)


def make_events(seed=7, n_runs=4, n_events=160):
    rnd = random.Random(seed)
    rows = []
    for run in range(n_runs):
        seq = 0
        for _ in range(n_events):
            seq += rnd.choice([1, 1, 2, 5])  # gaps in seq are allowed
            kind = "eval" if rnd.random() < 0.35 else "train"
            rows.append(event(run, seq, kind, 60 * rnd.randint(0, 12), rnd.random() < 0.8))  # many ties
    return rows


def evals_of(rows, run):
    return sorted((seq, step, loss, ex) for r, seq, step, kind, _, loss, ex in rows if r == run and kind == "eval")


def kept_before(scored, seq, n):
    """The n best existing (score, seq, step) among the rows before ``seq``."""
    return sorted((s, q, t) for q, t, s, ex in scored if ex and q < seq)[:n]


def decisions(scored, n):
    """seq -> (admitted, step of the worst kept row when the list is full)."""
    out = {}
    for seq, _, score, _ in scored:
        kept = kept_before(scored, seq, n)
        full = len(kept) == n
        out[seq] = (not full or score < kept[-1][0], kept[-1][2] if full else None)
    return out


def evictions(scored, n):
    """(step pushed out, step that pushed it): the kept list before and after each row."""
    out = set()
    for seq, step, _, _ in scored:
        before, after = kept_before(scored, seq, n), kept_before(scored, seq + 1, n)
        out |= {(t, step) for _, _, t in set(before) - set(after)}
    return out


def gaps_of(rows, run, warmup):
    """(seq, step, gap, exists) of each evaluation that makes a decision."""
    events, out = sorted(r for r in rows if r[0] == run), []
    ends = [i for i, e in enumerate(events) if e[3] == "eval"]
    for number, (start, end) in enumerate(zip([-1, *ends], ends), 1):
        train = [e[4] for e in events[start + 1:end]]
        if number > warmup and train:
            _, seq, step, _, _, loss, ex = events[end]
            out.append((seq, step, abs(loss - sum(train) / (len(train) * UNIT)), ex))
    return out


def waits_of(rows, run, threshold=0.001):
    """seq -> evaluations since the last one that beat all before it by more than ``threshold``."""
    losses = [(seq, loss) for seq, _, loss, _ in evals_of(rows, run)]
    better = [i for i, (_, x) in enumerate(losses)
              if i == 0 or (x < min(y for _, y in losses[:i]) and min(y for _, y in losses[:i]) - x > threshold)]
    return {seq: i - max(b for b in better if b <= i) for i, (seq, _) in enumerate(losses)}


RUNS = range(4)


@pytest.fixture
def small_chunks(monkeypatch):
    from tessera.operators import prefix
    monkeypatch.setattr(runs, "SEQ_CHUNK", 7.0)
    monkeypatch.setattr(runs, "ADMIT_CHUNK", 5.0)
    monkeypatch.setattr(runs, "ADMIT_FAN", 3)
    monkeypatch.setattr(prefix, "FAN", 4)


@pytest.fixture(scope="module")
def rows():
    return make_events()


def check_list(trace, scored, n):
    """Decisions and evictions of one run's list."""
    got = {r["seq"]: (r["admitted"], r["worst_step"]) for r in trace.collect()}
    assert got == decisions(scored, n)
    out = runs.evicted(trace, F.col("exists"), n).collect()
    assert {(r["evicted_step"], r["evicted_by"]) for r in out} == evictions(scored, n)


def test_admission_and_eviction(spark, rows, small_chunks):
    df = spark.createDataFrame(rows, SCHEMA).where("kind = 'eval'")
    trace = runs.admission_trace(df, "loss", F.col("exists"), N)
    for run in RUNS:
        check_list(trace.where(f"run_id = {run}"), evals_of(rows, run), N)


def test_gap_admission_and_eviction(spark, rows, small_chunks):
    df = spark.createDataFrame(rows, SCHEMA)
    gaps = runs.generalization_gap(df.drop("exists")).join(df.select("run_id", "seq", "exists"), ["run_id", "seq"])
    trace = runs.admission_trace(gaps, "gap", F.col("exists"), N)
    for run in RUNS:
        check_list(trace.where(f"run_id = {run}"), gaps_of(rows, run, 9), N)


def test_best_n_equals_final_list(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).where("kind = 'eval' AND exists")
    got = {}
    for r in runs.best_n(df, "loss", N).orderBy("run_id", "rank").collect():
        got.setdefault(r["run_id"], []).append((r["loss"], r["seq"], r["step"]))
    assert got == {run: kept_before(evals_of(rows, run), 10**9, N) for run in RUNS}


def test_gap_and_gap_list(spark, rows, small_chunks):
    df = spark.createDataFrame(rows, SCHEMA)
    gaps = runs.generalization_gap(df.drop("exists"), multiple=10)
    got = {(r["run_id"], r["seq"]): r["gap"] for r in gaps.collect()}
    assert got == {(run, seq): gap for run in RUNS for seq, _, gap, _ in gaps_of(rows, run, 9)}


def test_gap_per_run_cadence(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    every = F.when(F.col("run_id") % 2 == 0, 20).otherwise(10)
    got = runs.generalization_gap(df.withColumn("every", every), save_steps="every").collect()
    sampled = [r for r in rows if r[3] == "eval" or r[0] % 2 or r[2] % 20 == 0]
    assert {(r["run_id"], r["seq"]): r["gap"] for r in got} == \
        {(run, seq): gap for run in RUNS for seq, _, gap, _ in gaps_of(sampled, run, 9)}


def test_early_stop(spark, rows, small_chunks):
    df = spark.createDataFrame(rows, SCHEMA).where("kind = 'eval'")
    got = {(r["run_id"], r["seq"]): (r["counter"], r["stop"]) for r in runs.early_stop(df, 3).collect()}
    assert got == {(run, seq): (n, n >= 3) for run in RUNS for seq, n in waits_of(rows, run).items()}


def test_early_stop_threshold_edges(spark):
    # 0.0005 better moves the best without resetting patience; 0.002 better resets it
    df = spark.createDataFrame([event(0, i + 1, "eval", x) for i, x in enumerate([100_000, 99_950, 99_900, 99_700])], SCHEMA)
    got = [(r["improved"], r["counter"]) for r in runs.early_stop(df, 3).orderBy("seq").collect()]
    assert got == [(True, 0), (False, 1), (False, 2), (True, 0)]


def test_nan_losses(spark):
    nan = float("nan")
    rows = [(0, i + 1, 10 * (i + 1), k, None if x != x else int(x * UNIT), x, True) for i, (k, x) in enumerate(
        [("eval", nan), ("train", nan), ("eval", 0.5), ("train", 0.25), ("eval", 0.5)])]
    df = spark.createDataFrame(rows, SCHEMA)
    ev = df.where("kind = 'eval'")
    assert [r["seq"] for r in runs.best_n(ev, "loss", 3).orderBy("rank").collect()] == [3, 5, 1]  # NaN ranks last
    means = {r["interval"]: r["mean_train_loss"] for r in runs.interval_train_loss(df).collect()}
    assert means[1] != means[1] and means[2] == 0.25
    assert [r["improved"] for r in runs.early_stop(ev, 3).orderBy("seq").collect()][1:] == [True, False]


def test_interval_and_warmup(spark, rows, small_chunks):
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r["run_id"], r["seq"]): r["interval"] for r in runs.with_interval(df).collect()}
    for run in RUNS:
        at = [seq for seq, *_ in evals_of(rows, run)]
        assert all(got[(run, r[1])] == sum(q < r[1] for q in at) for r in rows if r[0] == run)
    w = runs.warmup_counter(df, multiple=10).where("run_id = 0").orderBy("seq").collect()
    assert [r["warmup"] for r in w][:10] == [True] * 9 + [False]


def test_new_best_and_rank1(spark, rows, small_chunks):
    df = spark.createDataFrame(rows, SCHEMA).where("kind = 'eval'")
    got = {(r["run_id"], r["seq"]): r["new_best"] for r in runs.new_best_flag(df).collect()}
    for run in RUNS:
        ev = evals_of(rows, run)
        assert all(got[(run, q)] == all(x < y for p, _, y, _ in ev if p < q) for q, _, x, _ in ev)
    best = {r["run_id"]: r["best_step"] for r in runs.rank1(df.where("exists"), "loss").collect()}
    assert best == {run: kept_before(evals_of(rows, run), 10**9, 1)[0][2] for run in RUNS}


def test_existing_checkpoints_match_on_step(spark):
    df = spark.createDataFrame([event(0, 1, "train", 7), event(0, 2, "eval", 5), event(0, 4, "eval", 4)], SCHEMA).drop("exists")
    manifest = spark.createDataFrame([(0, 20), (0, 4)], "run_id long, step long")
    ev = df.where("kind = 'eval'")
    assert [r["step"] for r in runs.existing(ev, manifest).collect()] == [20]
    assert {r["step"]: r["exists"] for r in runs.mark_existing(ev, manifest).collect()} == {20: True, 40: False}


def test_events_until_stop(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    kept = runs.events_until_stop(df, runs.stop_points(runs.early_stop(df.where("kind = 'eval'"), 3)))
    stop = {run: min((q for q, n in waits_of(rows, run).items() if n >= 3), default=10**9) for run in RUNS}
    assert kept.count() == sum(r[1] <= stop[r[0]] for r in rows)
