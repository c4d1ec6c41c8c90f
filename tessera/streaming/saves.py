"""Save events as a second stream (X3 ``on_save``, for ST1).

A trainer calls two hooks: a log event with an evaluation only *proposes* a checkpoint, and the later save event
admits it, if its folder is there, or drops it. Here both are streams of their own, tagged and united, and one
stateful processor per run holds what the other side has not answered yet:

* the log: ``kind`` ``eval`` with ``seq``, ``step`` and ``loss``;
* the save feed: ``saved`` (folder of ``step`` is there), ``missing`` (the save ran, its folder is not there) and
  ``upto`` (every save up to ``step`` has been told). A feed is what a listing of the run's folder gives:
  the steps found, then how far the listing goes.

Whether an evaluation is competitive depends on the list at that time, so on all earlier answers. Evaluations
therefore wait in ``seq`` order behind an unanswered proposal; a save that comes before its log event waits for it. A
proposal is dropped when its save is told as missing, or the feed has gone past its step (the save never came).
An evaluation that is not competitive needs no answer. State per run: the N kept checkpoints, the evaluations behind
the first unanswered proposal, and the answers ahead of the log. Answers up to the step of the last decided
evaluation go once the log has passed them.

Each stream must keep its own order within a run; between the two any order gives the same output. A repeated event, or an
evaluation at or before the last one seen, comes out with outcome ``late`` and changes nothing.

Output, one row per evaluation: ``outcome`` is ``kept``, ``dropped`` (proposed, not saved), ``skipped`` (not competitive)
or ``late``; ``evicted_step`` is what a kept one pushed out.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from tessera.streaming.checkpoints import by_shard, sharded, shards_for, typed_frame, write_blocks

EVENTS = "run_id long, kind string, seq long, step long, loss double"
DECISIONS = "run_id long, seq long, step long, eval_loss double, n_kept int, admitted boolean, outcome string, evicted_step long"
STATE = ("last_seq long, decided_step long, upto long, kept_loss array<double>, kept_step array<long>, "
         "wait_seq array<long>, wait_step array<long>, wait_loss array<double>, saved array<long>, missing array<long>")


class _Saves:
    """One run: proposals wait for their save."""

    def __init__(self, stored: tuple | None):
        if stored:
            self.last_seq, self.decided, self.upto, loss, step, *wait, saved, missing = stored
            self.kept, self.waiting = list(zip(loss, step)), list(zip(*wait))
            self.saved, self.missing = set(saved), set(missing)
        else:
            self.last_seq = self.decided = self.upto = -1
            self.kept, self.waiting, self.saved, self.missing = [], [], set(), set()

    def stored(self) -> tuple:
        # the log may hold further evaluations of the last decided step
        self.saved = {s for s in self.saved if s >= self.decided}
        self.missing = {s for s in self.missing if s >= self.decided}
        return (self.last_seq, self.decided, self.upto, [x for x, _ in self.kept], [s for _, s in self.kept],
                *([w[i] for w in self.waiting] for i in range(3)), sorted(self.saved), sorted(self.missing))

    def answer(self, step: int) -> bool | None:
        """Whether the proposal's folder is there; None while nobody has told."""
        if step in self.saved:
            return True
        return False if step in self.missing or step <= self.upto else None

    def decide(self, n: int) -> Iterator[tuple]:
        """Decisions of waiting evaluations, up to the first unanswered proposal."""
        while self.waiting:
            seq, step, loss = self.waiting[0]
            before = len(self.kept)
            worst = self.kept[-1][0] if self.kept else None
            # NaN ranks last, as Spark orders it
            admitted = before < n or loss < worst or (worst != worst and loss == loss)
            outcome, evicted = "skipped", None
            if admitted:
                there = self.answer(step)
                if there is None:
                    return
                outcome = "kept" if there else "dropped"
                if there:
                    at = before
                    while at and (loss < self.kept[at - 1][0] or (self.kept[at - 1][0] != self.kept[at - 1][0] and loss == loss)):
                        at -= 1   # behind equal losses
                    self.kept.insert(at, (loss, step))
                    if len(self.kept) > n:
                        evicted = self.kept.pop()[1]
            self.waiting.pop(0)
            self.decided = max(self.decided, step)
            yield seq, step, loss, before, admitted, outcome, evicted


def on_save_processor(n: int):
    """Keep the N lowest evaluation losses of each run among the checkpoints that were really saved."""
    def step(run_id: int, run: _Saves, rows: list[tuple]) -> list[tuple]:
        out = []
        for kind, _, at, _ in rows:
            if kind == "upto":
                run.upto = max(run.upto, int(at))
            elif kind != "eval":
                (run.saved if kind == "saved" else run.missing).add(int(at))
        for kind, seq, at, loss in rows:
            if kind != "eval":
                continue
            if seq <= run.last_seq:
                out.append((run_id, int(seq), int(at), float(loss), None, None, "late", None))
                continue
            run.last_seq = int(seq)
            run.waiting.append((int(seq), int(at), float(loss)))
        return out + [(run_id, *d) for d in run.decide(n)]

    return sharded(_Saves, step, ["kind", "seq", "step", "loss"], lambda out: typed_frame(out, DECISIONS), STATE)


def with_saves(log: DataFrame, saves: DataFrame, n: int, shards: int | None = None) -> DataFrame:
    """Decisions from a stream of log events and a stream of save events (each with the columns of ``EVENTS``).

    ``shards`` as in ``checkpoints.stateful``."""
    names = [c.split(" ")[0] for c in EVENTS.split(", ")]
    both = log.where(F.col("kind") == "eval").select(*names).unionByName(saves.select(*names))
    fn = on_save_processor(n)
    return by_shard(both, shards).applyInPandasWithState(fn, DECISIONS, fn.state_schema, "append", GroupStateTimeout.NoTimeout)


def saves_feed(manifest: DataFrame, log: DataFrame, every: int) -> DataFrame:
    """A save feed from the steps that a listing found: each ``saved`` step, and an ``upto`` every ``every`` steps and at the end.

    ``at`` orders the feed within a run.
    """
    saved = manifest.select("run_id", F.lit("saved").alias("kind"), "step")
    listed = log.groupBy("run_id").agg(F.max("step").alias("hi"))
    steps = F.sequence(F.lit(every).cast("bigint"), (F.ceil(F.col("hi") / every) * every).cast("bigint"), F.lit(every).cast("bigint"))
    upto = listed.where("hi >= 0").select("run_id", F.lit("upto").alias("kind"), F.explode(steps).alias("step"))
    none = F.lit(None)
    return saved.unionByName(upto).select("run_id", "kind", none.cast("bigint").alias("seq"), "step", none.cast("double").alias("loss"), F.col("step").alias("at"))


def run_with_saves(spark: SparkSession, log: DataFrame, saves: DataFrame, n: int, base: str, log_block: int, saves_block: int, files: int) -> DataFrame:
    """Both inputs written in blocks, streamed to their end (``availableNow``), all decisions read back."""
    sources = []
    for name, df, at, block in (("log", log, F.col("seq"), log_block), ("saves", saves, F.col("at"), saves_block)):
        path = write_blocks(df.select("run_id", "kind", "seq", "step", "loss", F.floor((at - 1) / F.lit(block)).alias("block")), os.path.join(base, name), files)
        sources.append(spark.readStream.schema(EVENTS).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files).parquet(path))
    out = os.path.join(base, "decisions")
    shards = shards_for(log, max(log_block, saves_block), files)
    q = with_saves(*sources, n, shards).writeStream.format("parquet").option("checkpointLocation", os.path.join(base, "chk-saves")) \
        .trigger(availableNow=True).start(out)
    q.awaitTermination()
    return spark.read.schema(DECISIONS).parquet(out)
