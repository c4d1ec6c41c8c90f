"""Streaming checkpoint selection over a metric-event stream (ST1-ST4).

Each run is a small sequential state machine, so the stateful part runs as
``groupBy(run_id).applyInPandasWithState``: the state per run is bounded
(N kept checkpoints, a running sum and count, counters), and the rows a
group sees per micro-batch are bounded by the trigger size
(``maxFilesPerTrigger`` / ``maxBytesPerTrigger``; ``write_log_files`` bounds the events of
a run per trigger). Rows of a micro-batch are ordered by ``seq`` inside each run. A row at or
before the last processed ``seq`` of its run, and every repeat of a ``seq`` inside
a micro-batch but the first, is emitted with ``late = true`` and changes no state.

A call of a group costs some milliseconds however few rows it has, so a stream of many short runs takes a group for
a *shard* of runs (``stateful(shards=...)``): the hash of the run, with the states of its runs side by side. ``run_available_now``
takes as many shards as give one about ``SHARD_EVENTS`` events per trigger and ``SHARD_RUNS`` runs at most; without
``shards`` a run is a group of its own. The output is the same.

Output rows carry ``rec``: ``trace`` (one per event decision) or ``kept``
(the run's kept list after the micro-batch, tagged with ``version`` = last
processed seq; a micro-batch of late rows only emits none). Once the input is complete, the ``kept`` rows of the
highest version equal the batch ``best_n`` queries, and the trace equals
the batch admission / early-stop queries.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator
from decimal import Context, Decimal, localcontext
from itertools import groupby
from operator import itemgetter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tessera.constants import EARLY_STOP_THRESHOLD
from tessera.session import scratch_folder

# loss_c: an exact number of 1/scale units, null where the loss is NaN or infinite
LOG_SCHEMA = "run_id long, seq long, step long, kind string, loss_c decimal(38,18), loss double, exists boolean"

OUT_SCHEMA = ("run_id long, rec string, version long, seq long, step long, late boolean, eval_no long, n_train long, "
              "score double, eval_loss double, n_kept int, admitted boolean, evicted_step long, rank int, "
              "improved boolean, counter long, stop boolean")

STATE_SCHEMA = ("last_seq long, eval_no long, buf_sum decimal(38,18), buf_n long, buf_odd long, kept_score array<double>, "
                "kept_loss array<double>, kept_seq array<long>, kept_step array<long>, best double, last_improved long, stopped boolean")

SHARD_EVENTS = 8192   # events of a shard per trigger, about
SHARD_RUNS = 256      # runs of a shard, about


def of_shard(state_schema: str) -> str:
    """State of a shard: that of each of its runs."""
    return "runs array<struct<run_id: long, " + ", ".join(re.sub(r"^(\w+) ", r"\1: ", c) for c in re.split(r", (?=[a-z_]+ )", state_schema)) + ">>"


_COLS = [c.strip().split(" ")[0] for c in OUT_SCHEMA.split(",")]
_ARRAYS = {"long": (pd.arrays.IntegerArray, "int64", 0), "int": (pd.arrays.IntegerArray, "int32", 0),
           "double": (pd.arrays.FloatingArray, "float64", 0.0), "boolean": (pd.arrays.BooleanArray, "bool", False)}


def typed_frame(rows: list, schema: str) -> pd.DataFrame:
    """Rows (dicts or tuples in column order) with nullable types; NaN stays NaN and None null.

    Columns are built as arrays: a stream makes one small frame for each run and micro-batch.
    """
    fields = [c.strip().split(" ") for c in schema.split(",")]
    columns = list(zip(*(r.values() if isinstance(r, dict) else r for r in rows))) or [()] * len(fields)
    out = {}
    for (name, kind), values in zip(fields, columns):
        if kind == "string":
            out[name] = pd.Series(values, dtype=object)
            continue
        array, dtype, blank = _ARRAYS[kind]
        missing = np.fromiter((v is None for v in values), bool, len(values))
        out[name] = array(np.array([blank if v is None else v for v in values], dtype=dtype), missing)
    return pd.DataFrame(out)


def _frame(rows: list[dict]) -> pd.DataFrame:
    return typed_frame(rows, OUT_SCHEMA)


def _row(**kw) -> dict:
    r = dict.fromkeys(_COLS)
    r.update(kw)
    return r


def _less(a: float, b: float) -> bool:
    return a < b or (b != b and a == a)


class _Run:
    """Mutable per-run state, read from and written back to its shard's ``GroupState``."""

    def __init__(self, stored: tuple | None):
        if stored:
            (self.last_seq, self.eval_no, self.buf_sum, self.buf_n, self.buf_odd, ks, kl, kq, kt, self.best,
             self.last_improved, self.stopped) = stored
            self.kept = list(zip(ks or [], kl or [], kq or [], kt or []))
        else:
            self.last_seq, self.eval_no, self.buf_sum, self.buf_n, self.buf_odd = -1, 0, Decimal(0), 0, 0
            self.kept, self.best, self.last_improved, self.stopped = [], None, 0, False

    def stored(self) -> tuple:
        return (self.last_seq, self.eval_no, self.buf_sum, self.buf_n, self.buf_odd,
                *([k[i] for k in self.kept] for i in range(4)), self.best, self.last_improved, self.stopped)

    def admit(self, score: float, loss: float, seq: int, step: int, exists: bool, n: int):
        """Keep-N rule: admitted while the list is not full or strictly better
        than the worst; a saved admission that overfills evicts the worst. NaN
        ranks last, as Spark orders it."""
        full = len(self.kept) >= n
        admitted = (not full) or _less(score, self.kept[-1][0])
        evicted = None
        if admitted and exists:
            pos = len(self.kept)
            while pos > 0 and _less(score, self.kept[pos - 1][0]):  # stable: after equal scores
                pos -= 1
            self.kept.insert(pos, (score, loss, seq, step))
            if len(self.kept) > n:
                evicted = self.kept.pop()[3]
        return admitted, evicted


def events_by_run(pdfs: Iterator[pd.DataFrame], columns: list[str]) -> Iterator[tuple[int, list[tuple]]]:
    """A shard's rows of a micro-batch as (run, its rows in the order of ``seq``)."""
    frames = [p for p in pdfs if len(p)]
    if not frames:
        return
    events = pd.concat(frames, ignore_index=True)
    order = np.lexsort((events["seq"].to_numpy(), events["run_id"].to_numpy()))   # stable
    rows = zip(*(events[c].to_numpy()[order].tolist() for c in ["run_id", *columns]))
    for run_id, mine in groupby(rows, itemgetter(0)):
        yield int(run_id), [r[1:] for r in mine]


def _timely(rows: list[tuple], last_seq: int) -> tuple[list[tuple], list[int]]:
    """A run's rows without late rows and repeats; and the positions that were late or repeated."""
    timely, late = [], []
    for r in rows:
        if r[0] <= last_seq:
            late.append(int(r[0]))
        else:
            timely.append(r)
            last_seq = r[0]
    return timely, late


def _late_rows(run_id: int, late: list[int]) -> list[dict]:
    return [_row(run_id=run_id, rec="trace", seq=q, late=True) for q in late]


def _kept_rows(run_id: int, run: _Run, moved: bool) -> list[dict]:
    return [_row(run_id=run_id, rec="kept", version=run.last_seq, seq=q, step=t, score=s, eval_loss=l, rank=i)
            for i, (s, l, q, t) in enumerate(run.kept, 1)] if moved else []


def sharded(load, step, columns: list[str], frame, state_schema: str):
    """A processor for groups of one run or of a shard of them.

    ``load(stored or None)`` makes a run's state (``stored()`` gives it back), ``step(run_id, run, rows)`` the run's output rows.
    """
    def fn(key, pdfs, state: GroupState):
        runs = {r[0]: tuple(r[1:]) for r in state.get[0]} if state.exists else {}
        out: list = []
        for run_id, rows in events_by_run(pdfs, columns):
            run = load(runs.get(run_id))
            out += step(run_id, run, rows)
            runs[run_id] = run.stored()
        state.update(([(k, *v) for k, v in runs.items()],))
        yield frame(out)

    fn.state_schema = of_shard(state_schema)
    return fn


def _processor(step):
    return sharded(_Run, step, ["seq", "step", "kind", "loss_c", "loss", "exists"], _frame, STATE_SCHEMA)


def best_n_processor(n: int):
    """ST1: keep the N lowest evaluation losses of each run."""

    def step(run_id: int, run: _Run, rows: list[tuple]) -> Iterable[dict]:
        rows, late = _timely(rows, run.last_seq)
        out = _late_rows(run_id, late)
        for q, t, kind, _, loss, ex in rows:
            if kind != "eval":
                continue
            run.eval_no += 1
            n_before, loss = len(run.kept), float(loss)
            admitted, evicted = run.admit(loss, loss, int(q), int(t), bool(ex), n)
            out.append(_row(run_id=run_id, rec="trace", seq=int(q), step=int(t), late=False, eval_no=run.eval_no,
                            score=loss, eval_loss=loss, n_kept=min(n_before, n), admitted=admitted,
                            evicted_step=evicted))
        if rows:
            run.last_seq = int(rows[-1][0])
        return out + _kept_rows(run_id, run, len(rows) > 0)

    return _processor(step)


def gap_processor(n: int, warmup: int, save_steps: int = 1, scale: int = 100_000):
    """ST2: keep the N smallest generalisation gaps, after ``warmup`` evaluations.

    The buffer of train losses between evaluations is their exact sum, their number and the number of odd
    ones (NaN, infinity: no exact value). An odd loss makes the mean and so the gap NaN, which ranks last.
    """

    def step(run_id: int, run: _Run, rows: list[tuple]) -> Iterable[dict]:
        cur, late = _timely(rows, run.last_seq)
        out = _late_rows(run_id, late)
        if cur:
            run.last_seq = int(cur[-1][0])
        with localcontext(Context(prec=60)):   # sums of 38 digits stay exact
            for q, t, kind, units, loss, ex in cur:
                if kind == "train" and t % save_steps == 0:
                    run.buf_n += 1
                    if units is None or units != units:
                        run.buf_odd += 1
                    else:
                        run.buf_sum += units
                if kind != "eval":
                    continue
                run.eval_no += 1
                total, n_train, odd = run.buf_sum, run.buf_n, run.buf_odd
                run.buf_sum, run.buf_n, run.buf_odd = Decimal(0), 0, 0
                if run.eval_no <= warmup or n_train == 0:
                    continue
                loss = float(loss)
                gap = float("nan") if odd else abs(loss - float(total) / float(n_train * scale))
                n_before = len(run.kept)
                admitted, evicted = run.admit(gap, loss, int(q), int(t), bool(ex), n)
                out.append(_row(run_id=run_id, rec="trace", seq=int(q), step=int(t), late=False, eval_no=run.eval_no,
                                n_train=n_train, score=gap, eval_loss=loss, n_kept=min(n_before, n),
                                admitted=admitted, evicted_step=evicted))
        return out + _kept_rows(run_id, run, len(cur) > 0)

    return _processor(step)


def early_stop_processor(patience: int, threshold: float = EARLY_STOP_THRESHOLD):
    """ST3: patience counter; the best moves on any strict decrease."""

    def step(run_id: int, run: _Run, rows: list[tuple]) -> Iterable[dict]:
        rows, late = _timely(rows, run.last_seq)
        out = _late_rows(run_id, late)
        if rows:
            run.last_seq = int(rows[-1][0])
        for q, _, kind, _, loss, _ in rows:
            if kind != "eval":
                continue
            loss, prior = float(loss), float("inf") if run.best is None else run.best
            run.eval_no += 1
            improved = prior in (float("inf"), float("-inf")) or (loss < prior and abs(prior - loss) > threshold)
            if improved:
                run.last_improved = run.eval_no
            counter = run.eval_no - run.last_improved
            run.best = loss if loss < prior else prior   # NaN is never best
            run.stopped = run.stopped or counter >= patience
            out.append(_row(run_id=run_id, rec="trace", seq=int(q), late=False, eval_no=run.eval_no, improved=improved,
                            counter=counter, stop=counter >= patience))
        return out

    return _processor(step)


def by_shard(stream: DataFrame, shards: int | None):
    """Rows grouped by the hash of their run, or by run."""
    if shards is None:
        return stream.groupBy("run_id")
    return stream.withColumn("shard", F.pmod(F.xxhash64("run_id"), F.lit(shards))).groupBy("shard")


def shards_for(events: DataFrame, events_per_run: int, files: int) -> int:
    """How many shards a stream of these events, so many of a run per trigger, is grouped into."""
    runs = events.agg(F.approx_count_distinct("run_id")).first()[0]
    each = max(1, min(SHARD_RUNS, SHARD_EVENTS // events_per_run))
    return max(files, -(-runs // each))


def stateful(stream: DataFrame, fn, evals_only: bool = False, shards: int | None = None) -> DataFrame:
    """Run a per-run processor. ``evals_only`` drops train events on the JVM
    side first (the keep-N-by-loss and early-stop processors never read them),
    so fewer rows cross into Python. ``shards`` is for processors made by ``sharded``."""
    if evals_only:
        stream = stream.where(F.col("kind") == "eval")
    return by_shard(stream, shards).applyInPandasWithState(
        fn, OUT_SCHEMA, getattr(fn, "state_schema", STATE_SCHEMA), "append", GroupStateTimeout.NoTimeout)


# ---- running a stream to completion over files (availableNow) ----

def write_blocks(rows: DataFrame, folder: str, files: int) -> str:
    """Write rows for a file-stream source in one job: ``files`` files at most for each value of ``block`` (0, 1, ...), dealt by run.

    A file stream takes files by their time. Files are stamped with their block's number once all are written (a
    rename-free metadata call a file), so a stream of ``files`` files a trigger meets the blocks in order.
    """
    spark = rows.sparkSession
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("run_id"), F.lit(files)))
    dealt.repartition("block", "part").write.partitionBy("block", "part").parquet(folder)
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found, start = fs.listFiles(root, True), None
    while found.hasNext():
        f = found.next()
        start = f.getModificationTime() if start is None else start
        place = re.search(r"/block=(\d+)/", f.getPath().toString())
        if place:   # all in the past
            fs.setTimes(f.getPath(), start - 10_000_000_000 + 10 * int(place.group(1)), -1)
    return folder


def write_log_files(log: DataFrame, folder: str, events_per_run: int, files: int) -> str:
    """The log in blocks of ``events_per_run`` positions of the runs: a trigger of ``files``
    files gives a run at most about so many events, however long it is."""
    return write_blocks(log.withColumn("block", F.floor((F.col("seq") - 1) / F.lit(events_per_run))), folder, files)


def run_available_now(spark: SparkSession, log: DataFrame, fn, events_per_run: int = 100_000, files: int | None = None,
                      sink=None, base: str | None = None, evals_only: bool = False) -> DataFrame:
    """Stream ``log`` through the stateful ``fn`` and return all output rows.

    ``sink(batch_df, batch_id)`` (``foreachBatch``) gets each micro-batch's rows as
    written and read back, so the stateful plan runs once per micro-batch.
    """
    base = base or scratch_folder(spark, "stream")
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    src = write_log_files(log.withColumn("loss_c", F.col("loss_c").cast("decimal(38,18)")).select(*[c.split(" ")[0] for c in LOG_SCHEMA.split(", ")]),
                          os.path.join(base, "input"), events_per_run, files)
    stream = spark.readStream.schema(LOG_SCHEMA).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files).parquet(src)
    shards = shards_for(spark.read.schema(LOG_SCHEMA).option("recursiveFileLookup", "true").parquet(src), events_per_run, files) \
        if hasattr(fn, "state_schema") else None
    out = stateful(stream, fn, evals_only, shards)
    out_path = os.path.join(base, "out")
    writer = out.writeStream.option("checkpointLocation", os.path.join(base, "chk")).trigger(availableNow=True)
    if sink is None:
        q = writer.format("parquet").outputMode("append").start(out_path)
    else:
        def _both(batch_df, batch_id):
            # idempotent on retry: a re-run micro-batch rewrites its own folder
            folder = os.path.join(out_path, f"batch={batch_id}")
            batch_df.write.mode("overwrite").parquet(folder)
            sink(batch_df.sparkSession.read.schema(batch_df.schema).parquet(folder), batch_id)
        q = writer.foreachBatch(_both).start()
    q.awaitTermination()
    cols = [c.strip().split(" ")[0] for c in OUT_SCHEMA.split(",")]
    return spark.read.parquet(out_path).select(*cols)


def final_kept(out: DataFrame) -> DataFrame:
    """The kept list of each run after its last micro-batch."""
    kept = out.where(F.col("rec") == "kept")
    last = kept.groupBy("run_id").agg(F.max("version").alias("version"))
    return kept.join(last, ["run_id", "version"], "inner")


LINES = "run_id long, line_no int, line string"


def leaderboard_sink(report_path: str, build_lines):
    """ST4: ``foreachBatch`` keyed upsert - the new report of every run whose kept list changed in the micro-batch.

    A micro-batch writes one table, not a file for each run; ``read_leaderboard`` takes each run's last report.
    """

    def sink(batch_df: DataFrame, batch_id: int) -> None:
        kept = batch_df.where(F.col("rec") == "kept")
        last = kept.groupBy("run_id").agg(F.max("version").alias("version"))
        kept = kept.join(last, ["run_id", "version"], "inner")
        # idempotent on retry: a re-run micro-batch rewrites its own folder
        build_lines(kept).select(*[c.split(" ")[0] for c in LINES.split(", ")]) \
            .write.mode("overwrite").parquet(os.path.join(report_path, f"batch={batch_id}"))

    return sink


def read_leaderboard(spark: SparkSession, report_path: str) -> DataFrame:
    """The present report of every run."""
    lines = spark.read.schema(LINES + ", batch long").parquet(report_path)
    last = lines.groupBy("run_id").agg(F.max("batch").alias("batch"))
    return lines.join(last, ["run_id", "batch"]).drop("batch")
