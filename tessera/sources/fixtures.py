"""Stand-ins F1-F6 for the workload's inputs, derived from the driver tables.

Each builder reads whole tables and only the columns it needs (column pruning
reaches the parquet scan), and avoids windows keyed by a possibly hot group:
neighbouring turns are found by an equi-join on ``(conv_id, turn)`` and the
per-run event order comes from one distributed sort (``operators.prefix``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import table_path

STEP_PER_EVENT = 5     # a step is not an event position
LOSS_SCALE = 100_000   # loss_c units per 1.0 of loss


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def literature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``source, row_id, title, text``."""
    d = _read(spark, sf_dir, "documents").select("source", "doc_id", "text")
    return d.select("source", F.col("doc_id").alias("row_id"),
                    F.concat(F.col("source"), F.lit("/"), F.col("doc_id").cast("string")).alias("title"), "text")


def dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the dictionary stand-in."""
    b = _read(spark, sf_dir, "benchmark").select("item_id", "text")
    return b.select(F.lit("dict").alias("source"), F.col("item_id").alias("row_id"),
                    F.concat(F.lit("item/"), F.col("item_id").cast("string")).alias("title"),
                    "text")


def _turn_pairs(spark: SparkSession, sf_dir: str, previous: bool) -> DataFrame:
    """Each user turn with the assistant turn that follows it (null without a
    reply) and, if asked for, the system turn before it."""
    c = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    nxt = c.where(F.col("role") == "assistant").select("conv_id", (F.col("turn") - 1).alias("turn"),
                                                       F.col("text").alias("next_text"))
    users = c.where(F.col("role") == "user").join(nxt, ["conv_id", "turn"], "left")
    if not previous:
        return users
    prev = c.where(F.col("role") == "system").select("conv_id", (F.col("turn") + 1).alias("turn"),
                                                     F.col("role").alias("prev_role"), F.col("text").alias("prev_text"))
    return users.join(prev, ["conv_id", "turn"], "left")


def dialogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``instruction / input / output`` rows (even conversations)."""
    p = _turn_pairs(spark, sf_dir, True).where(F.col("conv_id") % 2 == 0)
    sys_prev = F.col("prev_role") == "system"
    instruction = (F.when(sys_prev, F.col("prev_text"))
                   .when(F.col("conv_id") % 10 == 0, F.concat(F.lit("　"), F.col("text"), F.lit(" 　")))
                   .otherwise(F.col("text")))
    inp = (F.when(sys_prev, F.col("text"))
           .when(F.col("conv_id") % 4 == 0, F.lit(""))
           .otherwise(F.lit(None).cast("string")))
    return p.select(F.col("conv_id").alias("row_id"), "turn", instruction.alias("instruction"),
                    inp.alias("input"), F.col("next_text").alias("output"))


def technical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``Input / Output`` rows (odd conversations)."""
    p = _turn_pairs(spark, sf_dir, False).where(F.col("conv_id") % 2 == 1)
    return p.select(F.col("conv_id").alias("row_id"), "turn", F.col("text").alias("Input"),
                    F.col("next_text").alias("Output"))


def metric_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``run_id, seq, step, kind, loss_c, loss``; one run per user, ``loss_c``
    an exact integer of ``LOSS_SCALE`` units."""
    from tessera.operators.prefix import dense_rank_in_group

    e = _read(spark, sf_dir, "events").select("event_id", "ts", F.col("user_id").alias("run_id"), "event_type", "value")
    e = dense_rank_in_group(e, ["run_id"], ["ts", "event_id"], out="seq")
    loss_c = F.round(F.col("value") * 100).cast("bigint")
    return e.select(
        "run_id", "seq", (F.col("seq") * STEP_PER_EVENT).cast("bigint").alias("step"),
        F.when(F.col("event_type") == "purchase", "eval").otherwise("train").alias("kind"),
        loss_c.alias("loss_c"), (loss_c.cast("double") / F.lit(float(LOSS_SCALE))).alias("loss"))


def checkpoint_manifest(spark: SparkSession, sf_dir: str, log: DataFrame | None = None) -> DataFrame:
    """Checkpoints that exist, as ``(run_id, step)``.

    Derived from the metric log (evaluation events whose position is not a
    multiple of 7), so both share one scan and one ordering pass.
    """
    log = log if log is not None else metric_log(spark, sf_dir)
    return (log.where((F.col("kind") == "eval") & (F.col("seq") % 7 != 0))
            .select("run_id", "step"))


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """gold answers."""
    return _read(spark, sf_dir, "labels").select(F.col("doc_id").alias("item_id"),
                                                  F.col("quality").alias("answer"))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """model choices per stage.

    One scan of the documents; each row fans out to the fixed 2 x 3
    (model, stage) pairs through an exploded literal array (no join).
    """
    d = _read(spark, sf_dir, "documents").select("doc_id", "n_chars")
    stages = [("original", 1), ("after_cpt", 2), ("after_sft", 3)]
    models = [("small", 50), ("large", 90)]
    pairs = F.array(*[F.struct(F.lit(m).alias("model"), F.lit(k).cast("bigint").alias("skip"),
                               F.lit(st).alias("stage"), F.lit(no).cast("int").alias("stage_no"))
                      for m, k in models for st, no in stages])
    x = d.select("doc_id", "n_chars", F.explode(pairs).alias("p")).where(F.col("doc_id") % F.col("p.skip") != 0)
    choice = (F.when(F.col("p.stage_no") == 1, (F.col("n_chars") % 2).cast("int"))
              .when(F.col("p.stage_no") == 2, F.when(F.col("n_chars") > 200, 1).otherwise(0))
              .otherwise(F.lit(1))).cast("int")
    return x.select(F.col("p.model").alias("model"), F.col("p.stage").alias("stage"),
                    F.col("p.stage_no").alias("stage_no"), F.col("doc_id").alias("item_id"), choice.alias("choice"))


# ---- oracle SQL for the fixtures (DuckDB and Spark SQL) ----

SQL_LITERATURE = """
SELECT source, doc_id AS row_id, concat(source, '/', CAST(doc_id AS VARCHAR)) AS title, text
FROM documents"""

SQL_DICTIONARY = """
SELECT 'dict' AS source, item_id AS row_id, concat('item/', CAST(item_id AS VARCHAR)) AS title, text
FROM benchmark"""

SQL_DIALOGUE = """
SELECT conv_id AS row_id, turn,
       CASE WHEN prev_role = 'system' THEN prev_text
            WHEN conv_id % 10 = 0 THEN concat('　', text, ' 　')
            ELSE text END AS instruction,
       CASE WHEN prev_role = 'system' THEN text
            WHEN conv_id % 4 = 0 THEN ''
            ELSE NULL END AS input,
       CASE WHEN next_role = 'assistant' THEN next_text END AS output
FROM (SELECT conv_id, turn, role, text,
             lag(role)  OVER (PARTITION BY conv_id ORDER BY turn) AS prev_role,
             lag(text)  OVER (PARTITION BY conv_id ORDER BY turn) AS prev_text,
             lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role,
             lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS next_text
      FROM conversations) c
WHERE role = 'user' AND conv_id % 2 = 0"""

SQL_TECHNICAL = """
SELECT conv_id AS row_id, turn, text AS Input, CASE WHEN next_role = 'assistant' THEN next_text END AS Output
FROM (SELECT conv_id, turn, role, text,
             lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role,
             lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS next_text
      FROM conversations) c
WHERE role = 'user' AND conv_id % 2 = 1"""

SQL_METRIC_LOG = """
SELECT run_id, CAST(seq AS bigint) AS seq, CAST(seq * 5 AS bigint) AS step,
       CASE WHEN event_type = 'purchase' THEN 'eval' ELSE 'train' END AS kind,
       CAST(round(value * 100) AS bigint) AS loss_c, CAST(round(value * 100) AS DOUBLE) / 100000.0 AS loss
FROM (SELECT user_id AS run_id, event_type, value,
             row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq
      FROM events) e"""

SQL_CHECKPOINT_MANIFEST = """
SELECT run_id, CAST(seq * 5 AS bigint) AS step
FROM (SELECT user_id AS run_id, event_type,
             row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq
      FROM events) e
WHERE event_type = 'purchase' AND seq % 7 <> 0"""

SQL_GOLD = "SELECT doc_id AS item_id, quality AS answer FROM labels"

SQL_PREDICTIONS = """
SELECT m.model, s.stage, CAST(s.stage_no AS int) AS stage_no, d.doc_id AS item_id,
       CASE WHEN s.stage_no = 1 THEN CAST(d.n_chars % 2 AS int)
            WHEN s.stage_no = 2 THEN CASE WHEN d.n_chars > 200 THEN 1 ELSE 0 END
            ELSE 1 END AS choice
FROM documents d
CROSS JOIN (SELECT 'small' AS model, 50 AS skip UNION ALL SELECT 'large', 90) m
CROSS JOIN (SELECT 'original' AS stage, 1 AS stage_no
            UNION ALL SELECT 'after_cpt', 2 UNION ALL SELECT 'after_sft', 3) s
WHERE d.doc_id % m.skip <> 0"""

FIXTURE_SQL = {
    "literature": SQL_LITERATURE,
    "dictionary": SQL_DICTIONARY,
    "dialogue": SQL_DIALOGUE,
    "technical": SQL_TECHNICAL,
    "metric_log": SQL_METRIC_LOG,
    "checkpoint_manifest": SQL_CHECKPOINT_MANIFEST,
    "gold": SQL_GOLD,
    "predictions": SQL_PREDICTIONS,
}


def with_fixtures(sql: str, *names: str) -> str:
    """Prefix ``sql`` with CTEs for the named fixtures."""
    ctes = ",\n".join(f"{n} AS ({FIXTURE_SQL[n]}\n)" for n in names)
    return f"WITH {ctes}\n{sql}" if names else sql
