"""Per-run event hooks over out-of-order input (X3, for ST1-ST3's late rule).

``OrderedRuns`` is a stateful processor (``transformWithStateInPandas``) that hands a run's events to hooks in ``seq``
order, whatever order they arrive in. ``seq`` counts a run's events without gaps from ``first``. Events ahead of a
gap are held in list state. A gap that is not filled within ``wait_ms`` of processing time is given up by
a timer: the held events go on behind it. Events at or before the last one handed on, and repeats, are *late*:
they come out with ``late`` true and reach no hook. An ``end`` event closes its run: the hooks' state and the list go, and only the
position stays, with a time to live of ``ttl_ms``, so that stragglers are still told apart. Without ``wait_ms`` a gap is waited for
without end, without ``ttl_ms`` the position of an ended run stays.

A processor of one's own sets ``columns`` (its output schema) and the hooks ``setup`` (its value states), ``on_event`` and
``clear``. ``KeepBest`` is ST1 in this form. ``run_ordered`` starts the stream and splits its output into the results and
a table of late rows.

State per run: the position, the held events (as many as the gap is long), and the hooks' own. The state store is
RocksDB, which this kind of state needs; it is set for the started stream only.

Each call of a state costs a round trip to the JVM, and a group some more. All states of a group are therefore read once and
written once a call, and a stream of many short runs takes a group for a *shard* of runs (``run_ordered(shards=...)``, as in
``checkpoints``); the hooks still see the value of the run they are called for. Timers and time to live belong
to a group, so with ``wait_ms`` or ``ttl_ms`` a run is a group of its own. The output is the same.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tessera.streaming.checkpoints import by_shard, typed_frame

EVENTS = "run_id long, seq long, step long, kind string, loss double, exists boolean"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


class RunValues:
    """A value of each run of a group; ``exists``, ``get``, ``update`` and ``clear`` are of the present ``run``.

    A group's values are read by ``load`` and written by ``store``.
    """

    def __init__(self, state):
        self.state, self.values, self.run, self.changed = state, {}, None, False

    def load(self) -> None:
        self.values = {r[0]: tuple(r[1:]) for r in self.state.get()} if self.state.exists() else {}
        self.changed = False

    def store(self) -> None:
        if self.changed and self.values:
            self.state.put([(run, *v) for run, v in self.values.items()])
        elif self.changed:
            self.state.clear()

    def exists(self) -> bool:
        return self.run in self.values

    def get(self) -> tuple | None:
        return self.values.get(self.run)

    def update(self, value: tuple) -> None:
        self.values[self.run], self.changed = tuple(value), True

    def clear(self) -> None:
        self.changed |= self.values.pop(self.run, None) is not None


class RunHandle:
    """The handle that ``setup`` gets: its value states belong to a run, whether or not the group is a run."""

    def __init__(self, handle: StatefulProcessorHandle, sharded: bool):
        self._handle, self._sharded, self.states = handle, sharded, []

    def getValueState(self, stateName: str, schema: str, ttlDurationMs: int | None = None) -> RunValues:
        self.states.append(RunValues(self._handle.getListState(stateName, "run_id long, " + schema, ttlDurationMs)))
        return self.states[-1]

    def __getattr__(self, name: str):
        if self._sharded:
            raise AttributeError(f"{name}: a shard of runs has value states only")
        return getattr(self._handle, name)


class OrderedRuns(StatefulProcessor):
    """Hands each run's events to the hooks in order."""

    columns = "run_id long, seq long"   # of the hooks' rows; ``late boolean`` is added in front
    sharded = False                     # a group is a shard of runs; set by ``run_ordered``

    def __init__(self, wait_ms: int | None = None, ttl_ms: int | None = None, first: int = 1):
        self.wait_ms, self.ttl_ms, self.first = wait_ms, ttl_ms, first

    @property
    def time_mode(self) -> str:
        """Timers and time to live need processing time."""
        return "None" if self.wait_ms is None and self.ttl_ms is None else "ProcessingTime"

    # hooks
    def setup(self, handle: StatefulProcessorHandle) -> None:
        """Declare state variables."""

    def on_event(self, run_id: int, event) -> Iterable[tuple]:
        """Rows for one event, which comes in order."""
        raise NotImplementedError

    def clear(self) -> None:
        """Drop the hooks' state of a run that has ended."""

    # the processor
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.runs = RunHandle(handle, self.sharded)
        self.position = self.runs.getValueState("position", "seq long, ended boolean", self.ttl_ms)
        self.held = handle.getValueState("held", ", ".join(f"{n} array<{kind}>" for n, kind in (c.split(" ") for c in EVENTS.split(", "))))
        self.setup(self.runs)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = self._loaded()
        out = []
        for run_id, events in _by_run(rows):
            position, ended = self._at(run_id)
            late, ahead = [], held.get(run_id, {})
            for e in map(_Event, events):
                if ended or e.seq <= position or e.seq in ahead:
                    late.append(e)
                else:
                    ahead[e.seq] = e
            out += self._moved(run_id, position, ended, ahead, late, held)
        self._stored(held)
        if not self.sharded and self.wait_ms is not None and held:
            self._wait(timerValues)
        yield from self._framed(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Give up the oldest gap: go on with what is held."""
        held = self._loaded()
        run_id = int(key[0])
        _, ended = self._at(run_id)
        if run_id not in held or not self.position.exists():
            return
        out = self._moved(run_id, min(held[run_id]) - 1, ended, held[run_id], [], held)
        self._stored(held)
        if held:
            self._wait(timerValues)
        yield from self._framed(out)

    def close(self) -> None:
        pass

    def _wait(self, timers) -> None:
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        self.handle.registerTimer(timers.getCurrentProcessingTimeInMs() + self.wait_ms)

    def _loaded(self) -> dict[int, dict]:
        """The group's states read; its held events by run and ``seq``."""
        for v in self.runs.states:
            v.load()
        held: dict[int, dict] = {}
        if self.held.exists():
            for run_id, *event in zip(*self.held.get()):
                held.setdefault(run_id, {})[event[0]] = _Event(event)
        self.had = bool(held)
        return held

    def _at(self, run_id: int) -> tuple[int, bool]:
        """Turn to a run: its position, and whether it has ended."""
        for v in self.runs.states:
            v.run = run_id
        return self.position.get() if self.position.exists() else (self.first - 1, False)

    def _moved(self, run_id: int, position: int, ended: bool, ahead: dict, late: list, held: dict) -> list[tuple]:
        """The rows of the present run, whose events ``ahead`` are handed on up to the next gap."""
        ready = []
        while position + 1 in ahead:
            position += 1
            ready.append(ahead.pop(position))
        rows = self._handed(run_id, ready, late)
        if ended:
            return rows
        ended = any(e.kind == "end" for e in ready)
        self.position.update((position, ended))
        if ended:
            self.clear()
        if ahead and not ended:
            held[run_id] = ahead
        else:
            held.pop(run_id, None)
        return rows

    def _stored(self, held: dict[int, dict]) -> None:
        for v in self.runs.states:
            v.store()
        if held:
            events = [(run_id, *e.values) for run_id, ahead in held.items() for _, e in sorted(ahead.items())]
            self.held.update(tuple(list(c) for c in zip(*events)))
        elif self.had:
            self.held.clear()

    def _handed(self, run_id: int, ready: list, late: list) -> list[tuple]:
        names = [c.split(" ")[0] for c in self.columns.split(", ")]
        rows = [(False, *row) for e in ready for row in self.on_event(run_id, e)]
        for e in late:
            row: list = [None] * len(names)
            row[names.index("run_id")], row[names.index("seq")] = run_id, e.seq
            rows.append((True, *row))
        return rows

    def _framed(self, rows: list[tuple]) -> Iterator[pd.DataFrame]:
        if rows:
            yield typed_frame(rows, "late boolean, " + self.columns)


def _by_run(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[int, Iterator[tuple]]]:
    """(run, its rows in the order of their arrival)."""
    frames = [f for f in frames if len(f)]
    if not frames:
        return
    events = pd.concat(frames, ignore_index=True)
    order = np.argsort(events["run_id"].to_numpy(), kind="stable")
    rows = zip(*(events[c].to_numpy()[order].tolist() for c in ("run_id", *_Event.names)))
    for run_id, mine in groupby(rows, itemgetter(0)):
        yield int(run_id), (r[1:] for r in mine)


class _Event:
    """One event of a run."""

    names = [c.split(" ")[0] for c in EVENTS.split(", ")][1:]
    __slots__ = ("values", *names)

    def __init__(self, row: Iterable):
        seq, step, kind, loss, exists = row
        self.values = (int(seq), None if pd.isna(step) else int(step), kind, None if loss is None else float(loss), None if exists is None else bool(exists))
        self.seq, self.step, self.kind, self.loss, self.exists = self.values


class KeepBest(OrderedRuns):
    """ST1: the N lowest evaluation losses of each run; a row per evaluation, and the kept list after each change.

    ``rank`` is null in decisions. The list of the largest ``seq`` is the present one.
    """

    columns = "run_id long, seq long, step long, eval_loss double, admitted boolean, evicted_step long, rank int, of_seq long"

    def __init__(self, n: int, **kw):
        super().__init__(**kw)
        self.n = n

    def setup(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getValueState("kept", "loss array<double>, seq array<long>, step array<long>")

    def on_event(self, run_id: int, e) -> Iterable[tuple]:
        if e.kind != "eval":
            return
        kept = list(zip(*self.kept.get())) if self.kept.exists() else []
        place = sum(not _below(e.loss, k[0]) for k in kept)   # behind equal losses
        admitted, evicted = place < self.n, None
        if admitted and e.exists:
            kept.insert(place, (e.loss, e.seq, e.step))
            evicted = kept.pop()[2] if len(kept) > self.n else None
            self.kept.update(tuple(list(x) for x in zip(*kept)))
        yield run_id, e.seq, e.step, e.loss, admitted, evicted, None, None
        if admitted and e.exists:
            for rank, (loss, seq, step) in enumerate(kept, 1):
                yield run_id, e.seq, step, loss, None, None, rank, seq

    def clear(self) -> None:
        self.kept.clear()


def _below(a: float, b: float) -> bool:
    """``a < b`` where NaN is the largest."""
    return a < b or (b != b and a == a)


def run_ordered(spark: SparkSession, stream: DataFrame, processor: OrderedRuns, base: str, until=None, shards: int | None = None):
    """Run a stream of ``EVENTS``; (the hooks' rows, the late rows as run_id, seq).

    ``shards`` as in ``checkpoints.stateful``, for processors without timers and time to live.

    Without timers and time to live it runs to the end of its input. With them a stream has no end (every trigger
    may have an expired timer): it runs until ``until(rows)`` is true, asked once a second with the hooks' rows so far.
    """
    if shards is not None and processor.time_mode != "None":
        raise ValueError("timers and time to live belong to a group: a run must be a group of its own")
    names = [c.split(" ")[0] for c in EVENTS.split(", ")]
    schema = "late boolean, " + processor.columns
    processor.sharded = shards is not None
    out = by_shard(stream.select(*names), shards).transformWithStateInPandas(processor, schema, "Append", processor.time_mode)
    rows, late = os.path.join(base, "rows"), os.path.join(base, "late")

    def split(batch: DataFrame, n: int) -> None:
        # idempotent on retry: a re-run micro-batch rewrites its own folders
        batch.write.mode("overwrite").parquet(os.path.join(base, "both", f"batch={n}"))
        both = batch.sparkSession.read.schema(schema).parquet(os.path.join(base, "both", f"batch={n}"))
        both.where("not late").drop("late").write.mode("overwrite").parquet(os.path.join(rows, f"batch={n}"))
        both.where("late").select("run_id", "seq").write.mode("overwrite").parquet(os.path.join(late, f"batch={n}"))

    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, ROCKSDB)
    try:   # a started stream keeps the settings it was started with
        writer = out.writeStream.option("checkpointLocation", os.path.join(base, "chk-ordered")).foreachBatch(split)
        q = (writer.trigger(availableNow=True) if processor.time_mode == "None" else writer).start()
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)

    def read(path: str, columns: str) -> DataFrame:
        return spark.read.schema(columns + ", batch int").parquet(path).drop("batch")

    if processor.time_mode == "None":
        q.awaitTermination()
    else:
        try:
            while not q.awaitTermination(1):
                if q.lastProgress and until(read(rows, processor.columns)):
                    break
        finally:
            q.stop()
    return read(rows, processor.columns), read(late, "run_id long, seq long")


def present_list(rows: DataFrame) -> DataFrame:
    """The kept list of each run after its last change, from ``KeepBest``'s rows."""
    kept = rows.where("rank is not null")
    last = kept.groupBy("run_id").agg(F.max("seq").alias("seq"))
    return kept.join(last, ["run_id", "seq"]).select("run_id", "rank", F.col("of_seq").alias("seq"), "step", "eval_loss")
