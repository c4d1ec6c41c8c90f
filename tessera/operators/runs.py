"""Training-run analytics over a metric-event log.

Input: ``log(run_id, seq, step, kind, loss, loss_c)``, ``kind`` in {train, eval},
``seq`` the total order inside a run, ``step`` the trainer's step, which names a
checkpoint. ``loss`` is the value as logged (a double; NaN ranks last), ``loss_c``
the same loss as an exact number of 1/``scale`` units (integer or decimal, null for NaN and
infinity), so that sums do not depend on their order.

Per-run running values (interval id, evaluation number, best so far, early
stop counter) use ``prefix.running_aggregates``: exact, and no run is ever
gathered into one task. Keeping the N best is a top-N per run
(``row_number() <= N``), which Spark evaluates with a partial group limit
before the shuffle. The admission trace needs the N-th smallest earlier
score at each evaluation; it is computed per chunk of the run from the
chunk's own earlier rows plus the N best of all earlier chunks (bounded
arrays, see ``prior_nth_smallest``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.constants import (EARLY_STOP_THRESHOLD, GAP_MULTIPLE, REASON_BETTER, REASON_LIMIT,
                               REASON_NOT_BETTER, WARMUP_PER_MULTIPLE)
from tessera.operators.prefix import Running, running_aggregates
from tessera.session import cut_lineage

SEQ_CHUNK = 4096.0      # rows of a run per running-aggregate chunk
LOSS_SCALE = 100_000    # loss_c units per 1.0 of loss
ADMIT_CHUNK = 256.0     # evaluations per admission chunk (arrays of <= this + N)
ADMIT_FAN = 256         # admission chunks per super-chunk


def is_eval() -> Column:
    return F.col("kind") == "eval"


def filter_loggable(log: DataFrame, save_steps: int = 1) -> DataFrame:
    """Evaluations, and train losses logged at a multiple of ``save_steps``."""
    keep = is_eval() | ((F.col("kind") == "train") & (F.col("step") % save_steps == 0))
    return log.where(keep)


def with_interval(log: DataFrame) -> DataFrame:
    """``interval`` = number of earlier evaluations in the run.

    A train event belongs to the interval the next evaluation closes; an
    evaluation closes the interval with its own number.
    """
    return running_aggregates(
        log, ["run_id"], F.col("seq"), ["seq"],
        [Running("interval", F.when(is_eval(), 1).otherwise(0).cast("bigint"), "sum", False)],
        SEQ_CHUNK).withColumn("interval", F.coalesce("interval", F.lit(0)).cast("bigint"))


def interval_train_loss(log: DataFrame, save_steps: int = 1, scale: int | None = None) -> DataFrame:
    """A2: count, sum and mean of the train losses inside each interval.

    ``loss_c`` sums exactly and the mean is one IEEE division, the same in every
    engine. A train loss without ``loss_c`` (NaN, infinity) makes the mean NaN.
    """
    return _interval_sums(with_interval(log), save_steps, scale)


def _train_aggregates(scale: int | None, train: Column) -> list[Column]:
    """Count, exact sum and number of train losses without an exact value."""
    return [F.count(F.when(train, 1)).cast("bigint").alias("n_train"),
            F.sum(F.when(train, F.col("loss_c"))).alias("sum_loss_c"),
            F.count(F.when(train & F.col("loss_c").isNull(), 1)).alias("_odd")]


def _mean_train(scale: int | None) -> Column:
    mean = F.col("sum_loss_c").cast("double") / (F.col("n_train") * (scale or LOSS_SCALE)).cast("double")
    return F.when(F.col("_odd") > 0, F.lit(float("nan"))).otherwise(mean)


def _interval_sums(iv: DataFrame, save_steps: int, scale: int | None) -> DataFrame:
    """A2 on a log that already carries ``interval`` (partial aggregation, so a
    long interval is combined map-side)."""
    t = filter_loggable(iv, save_steps).where(F.col("kind") == "train")
    return t.groupBy("run_id", "interval").agg(*_train_aggregates(scale, F.lit(True))) \
        .withColumn("mean_train_loss", _mean_train(scale)).drop("_odd")


def warmup_threshold(multiple: int = GAP_MULTIPLE) -> Column:
    """``9 * round(10 / multiple)`` with round-half-even."""
    return (F.lit(WARMUP_PER_MULTIPLE) * F.bround(F.lit(10.0) / F.lit(multiple), 0)).cast("bigint")


def evaluations(log: DataFrame) -> DataFrame:
    """W3 input: evaluation events with ``eval_no`` (1-based) per run."""
    return with_interval(log).where(is_eval()) \
        .withColumn("eval_no", (F.col("interval") + 1).cast("bigint"))


def warmup_counter(log: DataFrame, multiple: int = GAP_MULTIPLE) -> DataFrame:
    """N-th evaluation of a run and whether it falls in the warm-up."""
    e = evaluations(log)
    return e.select("run_id", "seq", "step", "eval_no",
                    (F.col("eval_no") <= warmup_threshold(multiple)).alias("warmup"))


def generalization_gap(log: DataFrame, multiple: int = GAP_MULTIPLE, save_steps: int | str = 1,
                       scale: int | None = None) -> DataFrame:
    """``|eval_loss - mean train loss since the previous evaluation|``.

    An evaluation has the interval id of the train events it closes, so one
    aggregate per (run, interval) holds both. Evaluations in the warm-up and
    evaluations with no train sample make no decision and are absent.
    ``save_steps`` is a number or the name of a per-run column of ``log``.
    """
    every = F.col(save_steps) if isinstance(save_steps, str) else F.lit(save_steps)
    train = (F.col("kind") == "train") & (F.col("step") % every == 0)
    evaluation = F.max(F.when(is_eval(), F.struct("seq", "step", "loss")))
    g = with_interval(log).groupBy("run_id", "interval").agg(*_train_aggregates(scale, train), evaluation.alias("_e"))
    g = g.withColumn("eval_no", (F.col("interval") + 1).cast("bigint")) \
        .where(F.col("_e").isNotNull() & (F.col("n_train") > 0) & (F.col("eval_no") > warmup_threshold(multiple)))
    g = g.select("run_id", F.col("_e.seq").alias("seq"), F.col("_e.step").alias("step"), "eval_no", "n_train",
                 F.col("_e.loss").alias("eval_loss"), _mean_train(scale).alias("avg_train_loss"))
    return g.withColumn("gap", F.abs(F.col("eval_loss") - F.col("avg_train_loss")))


def existing(evals: DataFrame, manifest: DataFrame) -> DataFrame:
    """Keep evaluations whose checkpoint, named by its step, exists (``left_semi``)."""
    return evals.join(manifest.select("run_id", "step"), ["run_id", "step"], "left_semi")


def mark_existing(evals: DataFrame, manifest: DataFrame) -> DataFrame:
    """J1 as a column ``exists``."""
    m = manifest.select("run_id", "step", F.lit(True).alias("exists")).distinct()
    return evals.join(m, ["run_id", "step"], "left").withColumn("exists", F.coalesce("exists", F.lit(False)))


def best_n(scored: DataFrame, score: str, n: int, rank_col: str = "rank", keep_col: str | None = None) -> DataFrame:
    """The N lowest scores per run, stable by ``seq``; 1-based rank.

    ``n`` is a literal bound, so Spark keeps a partial top-N per run before
    the shuffle. With ``keep_col`` each run keeps its own number (at most
    ``n``, e.g. the largest ``keep`` of the hardware table).
    """
    w = Window.partitionBy("run_id").orderBy(F.col(score).asc(), F.col("seq").asc())
    out = scored.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n)
    return out.where(F.col(rank_col) <= F.col(keep_col)) if keep_col else out


def rank1(scored: DataFrame, score: str) -> DataFrame:
    """Best checkpoint per run (ties: earliest), as a partial aggregate."""
    best = F.min(F.struct(F.col(score).alias("s"), F.col("seq").alias("q"), F.col("step").alias("t")))
    return scored.groupBy("run_id").agg(best.alias("_b")).select(
        "run_id", F.col("_b.t").alias("best_step"), F.col("_b.s").alias(f"best_{score}"))


def prior_nth_smallest(items: DataFrame, score: str, exists: Column, n: int,
                       chunk: float | None = None) -> DataFrame:
    """For each row: the kept list before it, i.e. the N smallest ``(score, seq)``
    among earlier rows with ``exists``; adds ``n_kept`` and ``worst`` (struct of
    score, seq, step ``s, q, t``, null until the list is full).
    """
    chunk = chunk or ADMIT_CHUNK
    # stored: three branches read the scored evaluations, which are a fraction of the log they come from
    d = cut_lineage(items).withColumn("_ex", exists).withColumn("_c", F.floor(F.col("seq") / F.lit(chunk)).cast("bigint"))
    sq = F.struct(F.col(score).alias("s"), F.col("seq").alias("q"), F.col("step").alias("t"))
    # N best existing rows of each chunk (partial top-N before the shuffle)
    wtop = Window.partitionBy("run_id", "_c").orderBy(F.col(score), F.col("seq"))
    tops = (d.where("_ex").withColumn("_r", F.row_number().over(wtop)).where(F.col("_r") <= n)
            .groupBy("run_id", "_c").agg(F.array_sort(F.collect_list(sq)).alias("_top")))
    # N best of all earlier chunks: one row per chunk (chunks without existing rows too),
    # two levels so no window holds more than ADMIT_FAN chunk rows or one row per
    # super-chunk (a run of 1e8 evaluations: 4e5 chunks, 1.5e3 super-chunks)
    empty = F.array().cast("array<struct<s:%s,q:bigint,t:bigint>>" % dict(d.dtypes)[score])
    fan = ADMIT_FAN

    def n_best(arrays_col):
        return F.slice(F.array_sort(F.flatten(arrays_col)), 1, n)

    tops = d.select("run_id", "_c").distinct().join(tops, ["run_id", "_c"], "left") \
        .withColumn("_s", F.floor(F.col("_c") / F.lit(fan)).cast("bigint"))
    w1 = Window.partitionBy("run_id", "_s").orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    tops = tops.withColumn("_in_s", n_best(F.collect_list("_top").over(w1)))
    sup = tops.groupBy("run_id", "_s").agg(n_best(F.collect_list("_top")).alias("_stop"))
    w2 = Window.partitionBy("run_id").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    sup = sup.select("run_id", "_s", n_best(F.collect_list("_stop").over(w2)).alias("_sprev"))
    before = tops.join(sup, ["run_id", "_s"], "left").select(
        "run_id", "_c", F.slice(F.array_sort(F.concat(F.coalesce("_sprev", empty), F.coalesce("_in_s", empty))),
                                1, n).alias("_prev"))
    # earlier existing rows of the same chunk
    win = Window.partitionBy("run_id", "_c").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("_in", F.collect_list(F.when(F.col("_ex"), sq)).over(win))
    d = d.join(before, ["run_id", "_c"], "left")
    cand = F.array_sort(F.concat(F.coalesce(F.col("_prev"), empty), F.col("_in")))
    d = d.withColumn("_cand", F.slice(cand, 1, n))
    d = d.withColumn("n_kept", F.size("_cand").cast("int")) \
        .withColumn("worst", F.when(F.col("n_kept") >= n, F.element_at("_cand", n)))
    return d.drop("_ex", "_c", "_in", "_prev", "_cand")


def admission_trace(items: DataFrame, score: str, exists: Column, n: int) -> DataFrame:
    """Per evaluation, admitted?, the reason and the worst kept score then."""
    d = prior_nth_smallest(items, score, exists, n)
    full = F.col("n_kept") >= n
    admitted = (~full) | (F.col(score) < F.col("worst.s"))
    reason = F.when(~full, F.lit(REASON_LIMIT)).when(admitted, F.lit(REASON_BETTER)) \
        .otherwise(F.lit(REASON_NOT_BETTER))
    return d.withColumn("admitted", admitted).withColumn("reason", reason) \
        .withColumn("worst_score", F.col("worst.s")).withColumn("worst_step", F.col("worst.t")).drop("worst")


def evicted(trace: DataFrame, exists: Column, n: int) -> DataFrame:
    """A saved admission into a full list evicts the worst kept row."""
    return trace.where(F.col("admitted") & exists & (F.col("n_kept") >= n)).select(
        "run_id", F.col("worst_step").alias("evicted_step"), F.col("worst_score").alias("evicted_score"),
        F.col("step").alias("evicted_by"))


def new_best_flag(evals: DataFrame, score: str = "loss") -> DataFrame:
    """Strict new minimum of the run so far."""
    d = running_aggregates(evals, ["run_id"], F.col("seq"), ["seq"],
                           [Running("_prior_min", F.col(score), "min", False)], SEQ_CHUNK)
    return d.withColumn("new_best", F.col("_prior_min").isNull() | (F.col(score) < F.col("_prior_min"))) \
        .drop("_prior_min")


def early_stop(evals: DataFrame, patience, threshold: float = EARLY_STOP_THRESHOLD,
               score: str = "loss") -> DataFrame:
    """Patience counter of early stopping per evaluation.

    ``improved`` when there is no best yet, or the loss is below the best and
    by more than ``threshold``; the best itself moves on any strict decrease.
    ``patience`` is a number or the name of a per-run column.
    ``counter`` = evaluations since the last improvement; ``stop`` when it
    reaches ``patience``.
    """
    d = running_aggregates(evals, ["run_id"], F.col("seq"), ["seq"], [
        Running("eval_idx", F.lit(1).cast("bigint"), "sum", True),
        Running("_prior_min", F.col(score), "min", False)], SEQ_CHUNK, keep_chunk=True)
    delta = F.col("_prior_min") - F.col(score)
    improved = F.col("_prior_min").isNull() | ((F.col(score) < F.col("_prior_min")) & (F.abs(delta) > threshold))
    d = d.withColumn("improved", improved)
    d = running_aggregates(d, ["run_id"], F.col("seq"), ["seq"], [
        Running("_last", F.when(F.col("improved"), F.col("eval_idx")), "max", True)], SEQ_CHUNK)
    d = d.withColumn("counter", (F.col("eval_idx") - F.col("_last")).cast("bigint"))
    limit = F.col(patience) if isinstance(patience, str) else F.lit(patience)  # per-run column or number
    return d.withColumn("stop", F.col("counter") >= limit).drop("_prior_min", "_last")


def stop_points(trace: DataFrame) -> DataFrame:
    """First stopping evaluation per run (partial aggregate)."""
    return trace.where("stop").groupBy("run_id").agg(F.min("seq").alias("stop_seq"))


def events_until_stop(log: DataFrame, stops: DataFrame) -> DataFrame:
    """Drop the events after a run's stop point (runs that never stop stay whole).

    The stop table has one row per run; the join is left to AQE, which broadcasts
    a table measured small and splits the partitions of a hot run otherwise.
    """
    j = log.join(stops, ["run_id"], "left")
    return j.where(F.col("stop_seq").isNull() | (F.col("seq") <= F.col("stop_seq"))).drop("stop_seq")
