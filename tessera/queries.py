"""Registry of queries and their independent SQL oracles.

``QUERIES[name](spark, sf_dir) -> DataFrame`` is the Spark implementation.
``ORACLES[name]`` is SQL over the raw driver tables (DuckDB dialect, also
valid for most of Spark SQL) that computes the same result with plain
global windows and joins; a name without an oracle is checked rows-only.
Every computed column is aliased and cast the same way on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.constants import CPT_VAL_SHARE, SEED, SFT_VAL_SHARE
from tessera.functions.templates import dictionary_text_sql, literature_text_sql
from tessera.operators import mix
from tessera.plans import corpus
from tessera.session import cut_lineage, scratch_folder
from tessera.sources import fixtures
from tessera.sources.fixtures import FIXTURE_SQL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def ctes(*pairs: tuple[str, str], body: str) -> str:
    """``WITH a AS (...), b AS (...) body``."""
    if not pairs:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({q}\n)" for n, q in pairs) + "\n" + body


def fx(*names: str) -> list[tuple[str, str]]:
    return [(n, FIXTURE_SQL[n]) for n in names]


# --------------------------------------------------------------------------
# 2.1 scans
# --------------------------------------------------------------------------

@register("scan_literature", ctes(*fx("literature"), body="SELECT source, row_id, title, text FROM literature"))
def q_scan_literature(spark, sf):
    return fixtures.literature(spark, sf)


@register("scan_dictionary", ctes(*fx("dictionary"), body="SELECT source, row_id, title, text FROM dictionary"))
def q_scan_dictionary(spark, sf):
    return fixtures.dictionary(spark, sf)


@register("scan_dialogue", ctes(*fx("dialogue"), body="SELECT row_id, turn, instruction, input, output FROM dialogue"))
def q_scan_dialogue(spark, sf):
    return fixtures.dialogue(spark, sf)


@register("scan_technical", ctes(*fx("technical"), body="SELECT row_id, turn, Input, Output FROM technical"))
def q_scan_technical(spark, sf):
    return fixtures.technical(spark, sf)


@register("scan_metric_log", ctes(*fx("metric_log"), body="SELECT run_id, seq, step, kind, loss_c, loss FROM metric_log"))
def q_scan_metric_log(spark, sf):
    return fixtures.metric_log(spark, sf)


# --------------------------------------------------------------------------
# 2.2 / 2.3 / 2.4 pre-training corpus
# --------------------------------------------------------------------------

_CPT_SQL = [
    *fx("literature", "dictionary"),
    ("cpt", "SELECT source, row_id, title, " + literature_text_sql() + " AS text FROM literature "
            "UNION ALL SELECT source, row_id, title, " + dictionary_text_sql() + " AS text FROM dictionary"),
]


@register("format_literature", ctes(*fx("literature"),
                                    body=f"SELECT source, row_id, title, {literature_text_sql()} AS text FROM literature"))
def q_format_literature(spark, sf):
    return corpus.formatted_literature(spark, sf).drop("source_ord")


@register("format_dictionary", ctes(*fx("dictionary"),
                                    body=f"SELECT source, row_id, title, {dictionary_text_sql()} AS text FROM dictionary"))
def q_format_dictionary(spark, sf):
    return corpus.formatted_dictionary(spark, sf).drop("source_ord")


@register("map_overwrite", ctes(*fx("dictionary"), body=(
    f"SELECT source, row_id, title, {dictionary_text_sql()} AS text FROM dictionary")))
def q_map_overwrite(spark, sf):
    """The mapped value takes the place of ``text``, all other columns stay."""
    from tessera.functions.templates import dictionary_text, map_overwrite
    return map_overwrite(fixtures.dictionary(spark, sf).select("source", "row_id", "title", "text"), dictionary_text())


@register("union_cpt", ctes(*_CPT_SQL, body="SELECT source, row_id, title, text FROM cpt"))
def q_union_cpt(spark, sf):
    return corpus.cpt_corpus(spark, sf).drop("source_ord")


@register("seeded_shuffle", ctes(*_CPT_SQL, body=mix.shuffle_sql("cpt")))
def q_seeded_shuffle(spark, sf):
    return mix.seeded_shuffle(corpus.cpt_corpus(spark, sf).select("source", "row_id"))


@register("split_cpt", ctes(*_CPT_SQL, body=mix.split_sql("cpt", CPT_VAL_SHARE, cols="source, row_id")))
def q_split_cpt(spark, sf):
    return corpus.cpt_split(spark, sf).select("source", "row_id", "split")


@register("split_counts", ctes(*_CPT_SQL, ("s", mix.split_sql("cpt", CPT_VAL_SHARE, cols="source, row_id")),
                               body="SELECT split, source, CAST(count(*) AS BIGINT) AS n_rows FROM s GROUP BY split, source"))
def q_split_counts(spark, sf):
    return mix.split_counts(corpus.cpt_split(spark, sf))


# --------------------------------------------------------------------------
# chat fine-tuning corpus
# --------------------------------------------------------------------------

def _ws_sql() -> str:
    from tessera.constants import WS29
    return " || ".join(f"chr({ord(c)})" for c in WS29)


WS = _ws_sql()


def _strip(expr: str) -> str:
    return f"trim({expr}, {WS})"


def _clean(col: str) -> str:
    return _strip(f"coalesce({col}, '')")


def _render2_sql(user: str, assistant: str) -> str:
    return ("'<bos>' || '<start_of_turn>user' || chr(10) || " + _strip(user) +
            " || '<end_of_turn>' || chr(10) || '<start_of_turn>model' || chr(10) || " + _strip(assistant) +
            " || '<end_of_turn>' || chr(10)")


_USER_DIALOGUE = _strip(f"{_clean('instruction')} || chr(10) || {_clean('input')}")

_SFT_SQL = [
    *fx("dialogue", "technical"),
    ("sft", f"SELECT 'dialogue' AS source, row_id, turn, {_render2_sql(_USER_DIALOGUE, _clean('output'))} AS text "
            f"FROM dialogue UNION ALL "
            f"SELECT 'technical' AS source, row_id, turn, {_render2_sql(_clean('Input'), _clean('Output'))} AS text "
            f"FROM technical"),
]


@register("strip_unicode", ctes(*fx("dialogue"), body=f"SELECT row_id, turn, {_strip('instruction')} AS instruction FROM dialogue"))
def q_strip_unicode(spark, sf):
    from tessera.functions.text import strip_unicode
    return fixtures.dialogue(spark, sf).select("row_id", "turn", strip_unicode("instruction").alias("instruction"))


@register("default_missing", ctes(*fx("dialogue"), body="SELECT row_id, turn, coalesce(input, '') AS input FROM dialogue"))
def q_default_missing(spark, sf):
    from tessera.functions.text import default_missing
    return fixtures.dialogue(spark, sf).select("row_id", "turn", default_missing("input").alias("input"))


@register("build_user_content", ctes(*fx("dialogue"), body=f"SELECT row_id, turn, {_USER_DIALOGUE} AS user_content FROM dialogue"))
def q_build_user_content(spark, sf):
    from tessera.functions.text import build_user_content
    return fixtures.dialogue(spark, sf).select("row_id", "turn", build_user_content("instruction", "input").alias("user_content"))


@register("build_conversation", ctes(*fx("dialogue"), body=(
    f"SELECT row_id, turn, 'user' AS role_0, {_USER_DIALOGUE} AS content_0, "
    f"'assistant' AS role_1, {_clean('output')} AS content_1 FROM dialogue")))
def q_build_conversation(spark, sf):
    from tessera.functions.chat import build_conversation
    from tessera.functions.text import build_user_content, clean_field
    d = fixtures.dialogue(spark, sf).select(
        "row_id", "turn", build_conversation(build_user_content("instruction", "input"), clean_field("output")).alias("conv"))
    return d.select("row_id", "turn",
                    F.col("conv")[0]["role"].alias("role_0"), F.col("conv")[0]["content"].alias("content_0"),
                    F.col("conv")[1]["role"].alias("role_1"), F.col("conv")[1]["content"].alias("content_1"))


@register("render_chat", ctes(*_SFT_SQL, body="SELECT source, row_id, turn, text FROM sft WHERE source = 'dialogue'"))
def q_render_chat(spark, sf):
    return corpus.dialogue_rows(spark, sf)


_MULTI_SQL = f"""
SELECT conv_id, '<bos>' || string_agg(seg, '' ORDER BY turn) AS text
FROM (SELECT c.conv_id, c.turn,
             '<start_of_turn>' || CASE WHEN c.role = 'user' THEN 'user' WHEN c.role = 'assistant' THEN 'model'
                                       ELSE c.role END || chr(10)
             || CASE WHEN p.role = 'system' THEN p.text || chr(10) || chr(10) ELSE '' END
             || {_strip('c.text')} || '<end_of_turn>' || chr(10) AS seg
      FROM conversations c
      LEFT JOIN conversations p ON p.conv_id = c.conv_id AND p.turn = 0 AND c.turn = 1
      WHERE c.role <> 'system') s
GROUP BY conv_id"""


@register("render_chat_multiturn", _MULTI_SQL)
def q_render_chat_multiturn(spark, sf):
    from tessera.functions.chat import render_conversations
    conv = spark.read.parquet(f"{sf}/conversations.parquet")
    return render_conversations(conv)


@register("union_sft", ctes(*_SFT_SQL, body="SELECT source, row_id, turn, text FROM sft"))
def q_union_sft(spark, sf):
    return corpus.sft_corpus(spark, sf).drop("source_ord")


@register("corpus_from_rows", ctes(*_SFT_SQL, body=(
    "SELECT source, row_id, turn, text, CAST(CASE WHEN source = 'technical' THEN 0 ELSE 1 END AS INTEGER) "
    "AS source_ord FROM sft")))
def q_corpus_from_rows(spark, sf):
    return corpus.sft_corpus(spark, sf, model="27b")


@register("split_sft", ctes(*_SFT_SQL, body=mix.split_sql("sft", SFT_VAL_SHARE, key_cols=corpus.SFT_KEY,
                                                           cols="source, row_id, turn")))
def q_split_sft(spark, sf):
    return corpus.sft_split(spark, sf).select("source", "row_id", "turn", "split")


# --------------------------------------------------------------------------
# training-run analytics
# --------------------------------------------------------------------------

N_KEEP = 10
GAP_KEEP = 2  # the smallest list of the hardware table: fills after the warm-up of short runs
PATIENCE = 3
LOGGABLE_SAVE_STEPS = 3


def _log(spark, sf):
    """The ordered metric log, written once to the shared checkpoint folder:
    every analytics query reads it in two to four branches, and the ordering
    pass (chunked prefix count) should run once, not per branch."""
    return cut_lineage(fixtures.metric_log(spark, sf))


def _evals(log):
    return log.where(F.col("kind") == "eval").select("run_id", "seq", "step", "loss", "loss_c")


def _evals_exists(spark, sf, log=None):
    from tessera.operators.runs import mark_existing
    log = log if log is not None else _log(spark, sf)
    return mark_existing(_evals(log), fixtures.checkpoint_manifest(spark, sf, log))


_RUN_SQL = fx("metric_log", "checkpoint_manifest") + [
    ("ev", "SELECT m.run_id, m.seq, m.step, m.loss_c, (c.step IS NOT NULL) AS ex FROM metric_log m "
           "LEFT JOIN checkpoint_manifest c ON c.run_id = m.run_id AND c.step = m.step WHERE m.kind = 'eval'"),
    ("iv", "SELECT run_id, seq, step, kind, loss_c, CAST(coalesce(sum(CASE WHEN kind = 'eval' THEN 1 ELSE 0 END) "
           "OVER (PARTITION BY run_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) "
           "AS interval FROM metric_log"),
    ("itl", "SELECT run_id, interval, CAST(count(*) AS BIGINT) AS n_train, CAST(sum(loss_c) AS BIGINT) AS sum_loss_c, "
            "CAST(sum(loss_c) AS DOUBLE) / CAST(count(*) * 100000 AS DOUBLE) AS mean_train_loss "
            "FROM iv WHERE kind = 'train' GROUP BY run_id, interval"),
    ("evn", "SELECT run_id, seq, step, loss_c, interval, CAST(interval + 1 AS BIGINT) AS eval_no FROM iv "
            "WHERE kind = 'eval'"),
    ("gap", "SELECT e.run_id, e.seq, e.step, e.eval_no, a.n_train, CAST(e.loss_c AS DOUBLE) / 100000.0 AS eval_loss, "
            "a.mean_train_loss AS avg_train_loss, "
            "abs(CAST(e.loss_c AS DOUBLE) / 100000.0 - a.mean_train_loss) AS gap "
            "FROM evn e JOIN itl a ON a.run_id = e.run_id AND a.interval = e.interval WHERE e.eval_no > 9"),
]


@register("filter_loggable", ctes(*fx("metric_log"), body=(
    f"SELECT run_id, seq, step, kind, loss_c, loss FROM metric_log "
    f"WHERE kind = 'eval' OR (kind = 'train' AND step % {LOGGABLE_SAVE_STEPS} = 0)")))
def q_filter_loggable(spark, sf):
    from tessera.operators.runs import filter_loggable
    return filter_loggable(_log(spark, sf), LOGGABLE_SAVE_STEPS)


@register("eval_interval_id", ctes(*_RUN_SQL, body="SELECT run_id, seq, kind, interval FROM iv"))
def q_eval_interval_id(spark, sf):
    from tessera.operators.runs import with_interval
    return with_interval(_log(spark, sf)).select("run_id", "seq", "kind", "interval")


@register("interval_train_loss", ctes(*_RUN_SQL, body="SELECT run_id, interval, n_train, sum_loss_c, mean_train_loss FROM itl"))
def q_interval_train_loss(spark, sf):
    from tessera.operators.runs import interval_train_loss
    return interval_train_loss(_log(spark, sf))


@register("warmup_counter", ctes(*_RUN_SQL, body="SELECT run_id, seq, step, eval_no, eval_no <= 9 AS warmup FROM evn"))
def q_warmup_counter(spark, sf):
    from tessera.operators.runs import warmup_counter
    return warmup_counter(_log(spark, sf))


@register("generalization_gap", ctes(*_RUN_SQL, body="SELECT * FROM gap"))
def q_generalization_gap(spark, sf):
    from tessera.operators.runs import generalization_gap
    return generalization_gap(_log(spark, sf))


@register("existing_checkpoints", ctes(*_RUN_SQL, body="SELECT run_id, seq, step, loss_c FROM ev WHERE ex"))
def q_existing_checkpoints(spark, sf):
    from tessera.operators.runs import existing
    log = _log(spark, sf)
    return existing(_evals(log).drop("loss"), fixtures.checkpoint_manifest(spark, sf, log))


@register("best_n_by_loss", ctes(*_RUN_SQL, body=(
    f"SELECT run_id, rank, seq, step, eval_loss FROM (SELECT run_id, seq, step, CAST(loss_c AS DOUBLE) / 100000.0 AS eval_loss, "
    f"CAST(row_number() OVER (PARTITION BY run_id ORDER BY loss_c, seq) AS INTEGER) AS rank FROM ev WHERE ex) t "
    f"WHERE rank <= {N_KEEP}")))
def q_best_n_by_loss(spark, sf):
    return _kept_by_loss(spark, sf).select("run_id", "rank", "seq", "step", "eval_loss")


def _kept_by_loss(spark, sf, log=None):
    from tessera.operators.runs import best_n
    return best_n(_evals_exists(spark, sf, log).where("exists"), "loss", N_KEEP).withColumnRenamed("loss", "eval_loss")


def _gap_exists(spark, sf, log=None):
    from tessera.operators.runs import generalization_gap, mark_existing
    log = log if log is not None else _log(spark, sf)
    return mark_existing(generalization_gap(log), fixtures.checkpoint_manifest(spark, sf, log))


_GAP_EX = ("gx", "SELECT g.*, (c.step IS NOT NULL) AS ex FROM gap g LEFT JOIN checkpoint_manifest c "
                 "ON c.run_id = g.run_id AND c.step = g.step")


@register("best_n_by_gap", ctes(*_RUN_SQL, _GAP_EX, body=(
    f"SELECT run_id, rank, seq, step, gap, eval_loss FROM (SELECT run_id, seq, step, gap, eval_loss, "
    f"CAST(row_number() OVER (PARTITION BY run_id ORDER BY gap, seq) AS INTEGER) AS rank FROM gx WHERE ex) t "
    f"WHERE rank <= {N_KEEP}")))
def q_best_n_by_gap(spark, sf):
    from tessera.operators.runs import best_n
    g = _gap_exists(spark, sf).where("exists")
    return best_n(g, "gap", N_KEEP).select("run_id", "rank", "seq", "step", "gap", "eval_loss")


@register("stable_ranking", ctes(*_RUN_SQL, _GAP_EX, body=(
    f"SELECT * FROM (SELECT 'loss' AS list, run_id, CAST(row_number() OVER (PARTITION BY run_id ORDER BY loss_c, seq) "
    f"AS INTEGER) AS rank, seq, CAST(loss_c AS DOUBLE) / 100000.0 AS score FROM ev WHERE ex "
    f"UNION ALL SELECT 'gap' AS list, run_id, CAST(row_number() OVER (PARTITION BY run_id ORDER BY gap, seq) AS INTEGER) "
    f"AS rank, seq, gap AS score FROM gx WHERE ex) t WHERE rank <= {N_KEEP}")))
def q_stable_ranking(spark, sf):
    from tessera.operators.runs import best_n
    log = _log(spark, sf)
    a = _kept_by_loss(spark, sf, log).select(F.lit("loss").alias("list"), "run_id", "rank", "seq", F.col("eval_loss").alias("score"))
    b = best_n(_gap_exists(spark, sf, log).where("exists"), "gap", N_KEEP) \
        .select(F.lit("gap").alias("list"), "run_id", "rank", "seq", F.col("gap").alias("score"))
    return a.unionByName(b)


@register("rank1_checkpoint", ctes(*_RUN_SQL, body=(
    "SELECT run_id, arg_min(step, loss_c * 1000000000 + seq) AS best_step, CAST(min(loss_c) AS DOUBLE) / 100000.0 AS best_loss "
    "FROM ev WHERE ex GROUP BY run_id")))
def q_rank1_checkpoint(spark, sf):
    from tessera.operators.runs import rank1
    return rank1(_evals_exists(spark, sf).where("exists"), "loss")


def _adm_sql(n: int, src: str = "ev", score: str = "loss_c") -> list[tuple[str, str]]:
    """The decisions of one list, evaluation by evaluation, from ``src``."""
    return [
        ("pr", f"SELECT e.run_id, e.seq, p.{score} AS ps, p.step AS pt, row_number() OVER "
               f"(PARTITION BY e.run_id, e.seq ORDER BY p.{score}, p.seq) AS r "
               f"FROM {src} e JOIN {src} p ON p.run_id = e.run_id AND p.seq < e.seq AND p.ex"),
        ("pa", f"SELECT run_id, seq, count(*) AS k, max(CASE WHEN r = {n} THEN ps END) AS wl, "
               f"max(CASE WHEN r = {n} THEN pt END) AS wt FROM pr WHERE r <= {n} GROUP BY run_id, seq"),
        ("adm", f"SELECT e.run_id, e.seq, e.step, e.{score}, e.ex, CAST(coalesce(a.k, 0) AS INTEGER) AS n_kept, a.wl, a.wt, "
                f"(coalesce(a.k, 0) < {n} OR e.{score} < a.wl) AS admitted FROM {src} e LEFT JOIN pa a "
                f"ON a.run_id = e.run_id AND a.seq = e.seq"),
    ]


def _evicted_sql(n: int, src: str = "ev", score: str = "loss_c") -> list[tuple[str, str]]:
    """Kept rows pushed out later: by the row that leaves ``n`` better ones."""
    return _adm_sql(n, src, score) + [
        ("px", f"SELECT x.run_id, x.seq, x.step, x.{score}, (SELECT count(*) FROM {src} p WHERE p.run_id = x.run_id "
               f"AND p.seq < x.seq AND p.ex AND p.{score} <= x.{score}) AS p FROM adm x WHERE x.admitted AND x.ex"),
        ("lt", f"SELECT x.run_id, x.step AS xs, x.p, y.step AS ys, row_number() OVER (PARTITION BY x.run_id, x.seq "
               f"ORDER BY y.seq) AS r FROM px x JOIN {src} y ON y.run_id = x.run_id AND y.seq > x.seq AND y.ex "
               f"AND y.{score} < x.{score}"),
    ]


def _reason_sql(n: int) -> str:
    return (f"CASE WHEN n_kept < {n} THEN 'Limit not reached' WHEN admitted THEN 'Better than worst' "
            f"ELSE 'Not better than worst' END AS reason")


@register("admission_trace", ctes(*_RUN_SQL, *_adm_sql(N_KEEP), body=(
    f"SELECT run_id, seq, step, CAST(loss_c AS DOUBLE) / 100000.0 AS eval_loss, n_kept, "
    f"CAST(wl AS DOUBLE) / 100000.0 AS worst_loss, wt AS worst_step, admitted, {_reason_sql(N_KEEP)} FROM adm")))
def q_admission_trace(spark, sf):
    from tessera.operators.runs import admission_trace
    t = admission_trace(_evals_exists(spark, sf), "loss", F.col("exists"), N_KEEP)
    return t.select("run_id", "seq", "step", F.col("loss").alias("eval_loss"), "n_kept",
                    F.col("worst_score").alias("worst_loss"), "worst_step", "admitted", "reason")


@register("gap_admission_trace", ctes(*_RUN_SQL, _GAP_EX, *_adm_sql(GAP_KEEP, "gx", "gap"), body=(
    f"SELECT run_id, seq, step, gap, n_kept, wl AS worst_gap, wt AS worst_step, admitted, {_reason_sql(GAP_KEEP)} FROM adm")))
def q_gap_admission_trace(spark, sf):
    """W4 for the list kept by generalisation gap."""
    from tessera.operators.runs import admission_trace
    t = admission_trace(_gap_exists(spark, sf), "gap", F.col("exists"), GAP_KEEP)
    return t.select("run_id", "seq", "step", "gap", "n_kept", F.col("worst_score").alias("worst_gap"),
                    "worst_step", "admitted", "reason")


@register("evicted_checkpoints", ctes(*_RUN_SQL, *_evicted_sql(N_KEEP),
    body=f"SELECT run_id, xs AS evicted_step, ys AS evicted_by FROM lt WHERE r = {N_KEEP} - p"))
def q_evicted_checkpoints(spark, sf):
    from tessera.operators.runs import admission_trace, evicted
    t = admission_trace(_evals_exists(spark, sf), "loss", F.col("exists"), N_KEEP)
    return evicted(t, F.col("exists"), N_KEEP).select("run_id", "evicted_step", "evicted_by")


@register("gap_evicted", ctes(*_RUN_SQL, _GAP_EX, *_evicted_sql(GAP_KEEP, "gx", "gap"),
    body=f"SELECT run_id, xs AS evicted_step, ys AS evicted_by FROM lt WHERE r = {GAP_KEEP} - p"))
def q_gap_evicted(spark, sf):
    """O7 for the list kept by generalisation gap."""
    from tessera.operators.runs import admission_trace, evicted
    t = admission_trace(_gap_exists(spark, sf), "gap", F.col("exists"), GAP_KEEP)
    return evicted(t, F.col("exists"), GAP_KEEP).select("run_id", "evicted_step", "evicted_by")


@register("new_best_flag", ctes(*_RUN_SQL, body=(
    "SELECT run_id, seq, (pm IS NULL OR loss_c < pm) AS new_best FROM (SELECT run_id, seq, loss_c, "
    "min(loss_c) OVER (PARTITION BY run_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm "
    "FROM ev) t")))
def q_new_best_flag(spark, sf):
    from tessera.operators.runs import new_best_flag
    ev = _log(spark, sf).where(F.col("kind") == "eval")
    return new_best_flag(ev).select("run_id", "seq", "new_best")


_ES_SQL = [
    ("es_a", "SELECT run_id, seq, loss_c, row_number() OVER (PARTITION BY run_id ORDER BY seq) AS eval_idx, "
             "min(loss_c) OVER (PARTITION BY run_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm "
             "FROM ev"),
    ("es_b", "SELECT *, (pm IS NULL OR (loss_c < pm AND abs(CAST(pm AS DOUBLE) / 100000.0 - CAST(loss_c AS DOUBLE) / 100000.0) > 0.001)) AS improved "
             "FROM es_a"),
    ("es_c", "SELECT *, sum(CASE WHEN improved THEN 1 ELSE 0 END) OVER (PARTITION BY run_id ORDER BY seq "
             "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS g FROM es_b"),
    ("es", f"SELECT run_id, seq, CAST(eval_idx AS BIGINT) AS eval_idx, improved, "
           f"CAST(row_number() OVER (PARTITION BY run_id, g ORDER BY seq) - 1 AS BIGINT) AS counter FROM es_c"),
]


@register("early_stop", ctes(*_RUN_SQL, *_ES_SQL, body=(
    f"SELECT run_id, seq, eval_idx, improved, counter, counter >= {PATIENCE} AS stop FROM es")))
def q_early_stop(spark, sf):
    from tessera.operators.runs import early_stop
    ev = _log(spark, sf).where(F.col("kind") == "eval")
    return early_stop(ev, PATIENCE).select("run_id", "seq", "eval_idx", "improved", "counter", "stop")


@register("events_until_stop", ctes(*_RUN_SQL, *_ES_SQL, (
    "st", f"SELECT run_id, min(seq) AS stop_seq FROM es WHERE counter >= {PATIENCE} GROUP BY run_id"),
    body=("SELECT m.run_id, m.seq, m.kind, m.loss_c FROM metric_log m LEFT JOIN st ON st.run_id = m.run_id "
          "WHERE st.stop_seq IS NULL OR m.seq <= st.stop_seq")))
def q_events_until_stop(spark, sf):
    from tessera.operators.runs import early_stop, events_until_stop, stop_points
    log = _log(spark, sf)
    stops = stop_points(early_stop(log.where(F.col("kind") == "eval"), PATIENCE))
    return events_until_stop(log, stops).select("run_id", "seq", "kind", "loss_c")


# --------------------------------------------------------------------------
# tokens and batches
# --------------------------------------------------------------------------

MAX_LEN = 2880
CPT_HW = dict(b=2, a=12, g=1, epochs=1.0)  # 12B, pre-training, one GPU

_TOK_SQL = _CPT_SQL + [
    ("wd", "SELECT source, row_id, text, list_filter(string_split_regex(text, '[ \\t\\n\\r]+'), lambda x: x <> '') AS w "
           "FROM cpt"),
    ("sp", mix.split_sql("cpt", CPT_VAL_SHARE, cols="source, row_id")),
    ("tk", "SELECT unnest(wd.w) AS token FROM wd JOIN sp ON sp.source = wd.source AND sp.row_id = wd.row_id "
           "WHERE sp.split = 'train'"),
    ("vc", "SELECT token, count(*) AS cnt FROM tk GROUP BY token"),
    ("vocab", "SELECT token, CAST(row_number() OVER (ORDER BY cnt DESC, token) + 3 AS INTEGER) AS id, "
              "CAST(cnt AS BIGINT) AS cnt FROM vc"),
    ("ex", f"SELECT source, row_id, unnest(w[1:{MAX_LEN - 2}]) AS token, "
           f"generate_subscripts(w[1:{MAX_LEN - 2}], 1) AS p FROM wd"),
    ("encs", "SELECT ex.source, ex.row_id, sum(coalesce(v.id, 3)) AS s, "
             "sum(CAST(ex.p AS BIGINT) * coalesce(v.id, 3)) AS ws FROM ex LEFT JOIN vocab v ON v.token = ex.token "
             "GROUP BY ex.source, ex.row_id"),
    ("enc", f"SELECT wd.source, wd.row_id, CAST(least(len(w), {MAX_LEN - 2}) + 2 AS INTEGER) AS n_tokens, "
            f"CAST(greatest(len(w) - {MAX_LEN - 2}, 0) AS INTEGER) AS n_dropped, "
            f"CAST(len(w) AS INTEGER) AS n_words, "
            f"CAST(2 + 1 + coalesce(e.s, 0) AS BIGINT) AS id_sum, "
            f"CAST(coalesce(e.ws, 0) + (least(len(w), {MAX_LEN - 2}) + 1) AS BIGINT) AS id_wsum, "
            f"starts_with(text, '<bos>') AS dbos, ends_with(text, '<eos>') AS deos "
            f"FROM wd LEFT JOIN encs e ON e.source = wd.source AND e.row_id = wd.row_id"),
]


def _vocab(spark, sf):
    """All words of the training rows."""
    from tessera.operators.tokens import build_vocabulary
    return build_vocabulary(corpus.cpt_split(spark, sf).where(F.col("split") == "train"))


def _encoded(spark, sf):
    from tessera.operators.tokens import encode
    return encode(corpus.cpt_corpus(spark, sf), _vocab(spark, sf), mix.KEY_COLS, max_len=MAX_LEN)


def _lengths(spark, sf):
    from tessera.operators.tokens import token_lengths
    return corpus.cpt_corpus(spark, sf).select(*mix.KEY_COLS, token_lengths(F.col("text"), MAX_LEN)["n_tokens"].alias("n_tokens"))


@register("build_vocabulary", ctes(*_TOK_SQL, body="SELECT token, id, cnt FROM vocab"))
def q_build_vocabulary(spark, sf):
    return _vocab(spark, sf)


@register("encode_truncate", ctes(*_TOK_SQL, body="SELECT source, row_id, n_tokens, n_dropped, id_sum, id_wsum FROM enc"))
def q_encode_truncate(spark, sf):
    from tessera.operators.tokens import id_checksums
    return _encoded(spark, sf).select("source", "row_id", "n_tokens", "n_dropped", *id_checksums())


@register("add_special_tokens", ctes(*_TOK_SQL, body=(
    f"SELECT source, row_id, CAST(2 AS INTEGER) AS first_id, CAST(1 AS INTEGER) AS last_id, "
    f"CAST(n_tokens - 2 AS INTEGER) AS n_content FROM enc")))
def q_add_special_tokens(spark, sf):
    return _encoded(spark, sf).select("source", "row_id", F.element_at("input_ids", 1).alias("first_id"),
                                      F.element_at("input_ids", -1).alias("last_id"),
                                      (F.col("n_tokens") - 2).cast("int").alias("n_content"))


@register("truncation_report", ctes(*_TOK_SQL, body=(
    "SELECT source, CAST(count(*) AS BIGINT) AS n_rows, "
    "CAST(sum(CASE WHEN n_dropped > 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_truncated, "
    "CAST(sum(n_dropped) AS BIGINT) AS n_dropped, CAST(sum(n_words - n_dropped) AS BIGINT) AS n_kept, "
    "CAST(sum(CASE WHEN dbos THEN 1 ELSE 0 END) AS BIGINT) AS n_double_bos, "
    "CAST(sum(CASE WHEN deos THEN 1 ELSE 0 END) AS BIGINT) AS n_double_eos, "
    "CASE WHEN sum(n_words) > 0 THEN CAST(sum(n_words - n_dropped) AS DOUBLE) / CAST(sum(n_words) AS DOUBLE) END "
    "AS kept_ratio FROM enc GROUP BY source")))
def q_truncation_report(spark, sf):
    from tessera.operators.tokens import truncation_report
    return truncation_report(corpus.cpt_corpus(spark, sf), max_len=MAX_LEN)


def _train_samples(spark, sf):
    from tessera.operators.tokens import assign_microbatch
    from tessera.plans.prepare import plan_steps
    split, n, n_val = mix.split_with_counts(corpus.cpt_corpus(spark, sf), CPT_VAL_SHARE)
    n_train = n - n_val
    b, a, g = CPT_HW["b"], CPT_HW["a"], CPT_HW["g"]
    max_steps = plan_steps(n_train, b, a, g, CPT_HW["epochs"], 5)["max_steps"]
    train = split.where(F.col("split") == "train")
    return assign_microbatch(train, n_train, b, a, g, max_steps, SEED, mix.KEY_COLS)


_MB_SQL = _TOK_SQL + [
    ("tr", "SELECT source, row_id FROM sp WHERE split = 'train'"),
    ("prm", "SELECT n, total, CAST(ceil(total / n) AS BIGINT) AS e FROM (SELECT n, "
            "CAST(ceil(n / 6000.0) AS BIGINT) * 250 * 24 AS total FROM (SELECT count(*) AS n FROM tr) c) x"),
    ("ep", "SELECT source, row_id, unnest(range(0, e)) AS epoch FROM tr, prm"),
    ("ps", "SELECT source, row_id, epoch, row_number() OVER (PARTITION BY epoch ORDER BY "
           "md5('shuffle|42|' || CAST(epoch AS VARCHAR) || '|' || source || '|' || CAST(row_id AS VARCHAR)), "
           "source, row_id) - 1 AS pos FROM ep"),
    ("mb", "SELECT source, row_id, CAST(epoch AS INTEGER) AS epoch, CAST(epoch * n + pos AS BIGINT) AS sample "
           "FROM ps, prm WHERE epoch * n + pos < total"),
    ("mbx", "SELECT source, row_id, epoch, sample, CAST(sample // 24 + 1 AS BIGINT) AS step, "
            "CAST((sample // 2) % 12 AS INTEGER) AS slot, CAST(0 AS INTEGER) AS device, "
            "CAST(sample % 2 AS INTEGER) AS lane, CAST(sample // 2 AS BIGINT) AS batch_id FROM mb"),
    ("pb", "SELECT m.batch_id, m.lane, e.n_tokens, e.id_sum, "
           "CAST(ceil(max(e.n_tokens) OVER (PARTITION BY m.batch_id) / 8.0) * 8 AS INTEGER) AS padded_len "
           "FROM mbx m JOIN enc e ON e.source = m.source AND e.row_id = m.row_id"),
]


@register("assign_microbatch", ctes(*_MB_SQL, body="SELECT * FROM mbx"))
def q_assign_microbatch(spark, sf):
    return _train_samples(spark, sf)


# T5 by arithmetic (operators/permute): rows numbered once, each epoch's order a keyed bijection of the numbers.
# One recursion step is one round; a walk of four rounds is repeated while its result is n or more.
_KEYED_SQL = _TOK_SQL + [
    ("num", "SELECT source, row_id, row_number() OVER (ORDER BY source, row_id) - 1 AS x, count(*) OVER () AS n FROM sp WHERE split = 'train'"),
    ("size", "SELECT n, total, CAST(ceil(total / n) AS BIGINT) AS e, (SELECT CAST(min(h) AS BIGINT) FROM range(1, 31) t(h) WHERE (CAST(1 AS BIGINT) << CAST(2 * h AS INTEGER)) >= greatest(n, 2)) AS h "
             "FROM (SELECT n, CAST(ceil(n / 6000.0) AS BIGINT) * 250 * 24 AS total FROM (SELECT DISTINCT n FROM num) a) b"),
    ("feistel", "SELECT x, epoch, (x >> h) AS l, x % (CAST(1 AS BIGINT) << h) AS r, 0 AS i, n, h, (CAST(1 AS BIGINT) << h) AS s "
                "FROM (SELECT num.x, num.n, CAST(unnest(range(0, e)) AS BIGINT) AS epoch, CAST(h AS INTEGER) AS h FROM num, size) start "
                "UNION ALL SELECT x, epoch, r, (l + (((y % 65536 * 32749 + (y >> 15) * 31 + k) % 2147483648 * 48271 % 2147483647) >> 7)) % s, i + 1, n, h, s "
                "FROM (SELECT *, ((r + k) % 2147483648 * 1103515245 + 12345) % 2147483648 AS y FROM "
                f"(SELECT *, (epoch * 69069 + ({SEED} * 2654435 + (i % 4) * 40692503) % 2147483647) % 2147483647 AS k FROM feistel "
                "WHERE i % 4 <> 0 OR i = 0 OR l * s + r >= n) a) b"),
    ("placed", "SELECT x, epoch, l * s + r AS pos, n FROM feistel WHERE i > 0 AND i % 4 = 0 AND l * s + r < n"),
    ("keyed", "SELECT num.source, num.row_id, p.epoch, CAST(p.epoch * p.n + p.pos AS BIGINT) AS sample FROM placed p JOIN num USING (x), size "
              "WHERE p.epoch * p.n + p.pos < size.total"),
]


def _recursive(sql: str) -> str:
    return "WITH RECURSIVE" + sql.removeprefix("WITH")


@register("keyed_microbatch", _recursive(ctes(*_KEYED_SQL, body=(
    "SELECT source, row_id, CAST(epoch AS INTEGER) AS epoch, sample, CAST(sample // 24 + 1 AS BIGINT) AS step, "
    "CAST((sample // 2) % 12 AS INTEGER) AS slot, CAST(0 AS INTEGER) AS device, CAST(sample % 2 AS INTEGER) AS lane, "
    "CAST(sample // 2 AS BIGINT) AS batch_id FROM keyed"))))
def q_keyed_microbatch(spark, sf):
    """T5 with a keyed permutation: one numbering, no sort and no shuffle for an epoch."""
    from tessera.operators.tokens import keyed_microbatch
    from tessera.plans.prepare import plan_steps
    split, n, n_val = mix.split_with_counts(corpus.cpt_corpus(spark, sf), CPT_VAL_SHARE)
    b, a, g = CPT_HW["b"], CPT_HW["a"], CPT_HW["g"]
    max_steps = plan_steps(n - n_val, b, a, g, CPT_HW["epochs"], 5)["max_steps"]
    rows = mix.global_rank(split.where(F.col("split") == "train").select(*mix.KEY_COLS), mix.KEY_COLS, out="row")
    return keyed_microbatch(rows, n - n_val, b, a, g, max_steps, SEED, mix.KEY_COLS)


def _sized(spark, sf):
    from tessera.operators.tokens import size_batches
    s = _train_samples(spark, sf).select("source", "row_id", "batch_id", "lane")
    return size_batches(s, _lengths(spark, sf), mix.KEY_COLS)


def _padded(spark, sf):
    from tessera.operators.tokens import pad_batch
    return pad_batch(_sized(spark, sf), _encoded(spark, sf), mix.KEY_COLS)


@register("pad_batch", ctes(*_MB_SQL, body=(
    "SELECT batch_id, lane, n_tokens, padded_len, CAST(padded_len - n_tokens AS INTEGER) AS n_pad FROM pb")))
def q_pad_batch(spark, sf):
    return _sized(spark, sf).select("batch_id", "lane", "n_tokens", "padded_len", "n_pad")


@register("attention_mask", ctes(*_MB_SQL, body=(
    "SELECT batch_id, lane, CAST(padded_len AS INTEGER) AS mask_len, CAST(n_tokens AS BIGINT) AS mask_sum FROM pb")))
def q_attention_mask(spark, sf):
    m = F.aggregate("attention_mask", F.lit(0).cast("bigint"), lambda acc, x: acc + x.cast("bigint"))
    return _padded(spark, sf).select("batch_id", "lane", F.size("attention_mask").cast("int").alias("mask_len"),
                                     m.alias("mask_sum"))


@register("causal_labels", ctes(*_MB_SQL, body=(
    "SELECT batch_id, lane, CAST(padded_len - n_tokens AS BIGINT) AS n_ignored, CAST(id_sum AS BIGINT) AS label_sum "
    "FROM pb")))
def q_causal_labels(spark, sf):
    from tessera.constants import LABEL_IGNORE
    lab = F.col("labels")
    n_ign = F.size(F.filter(lab, lambda x: x == LABEL_IGNORE)).cast("bigint")
    s = F.aggregate(F.filter(lab, lambda x: x != LABEL_IGNORE), F.lit(0).cast("bigint"),
                    lambda acc, x: acc + x.cast("bigint"))
    return _padded(spark, sf).select("batch_id", "lane", n_ign.alias("n_ignored"), s.alias("label_sum"))


@register("padding_efficiency", ctes(*_MB_SQL, body=(
    "SELECT batch_id, CAST(sum(n_tokens) AS BIGINT) AS real_tokens, CAST(sum(padded_len) AS BIGINT) AS padded_tokens, "
    "CAST(sum(n_tokens) AS DOUBLE) / CAST(sum(padded_len) AS DOUBLE) AS efficiency FROM pb GROUP BY batch_id")))
def q_padding_efficiency(spark, sf):
    from tessera.operators.tokens import padding_efficiency
    return padding_efficiency(_sized(spark, sf))


# --------------------------------------------------------------------------
# run plan, names and hand-off (J2, A3, P11-P13, J3), evaluation (A4), sinks
# --------------------------------------------------------------------------

def _runs(spark, sf):
    """Run registry: one run per metric-log run id, in both phases."""
    r = spark.read.parquet(f"{sf}/events.parquet").select(F.col("user_id").alias("run_id")).distinct()
    model = F.when(F.col("run_id") % 2 == 0, "12b").otherwise("27b")
    gpus = (F.col("run_id") % 4 + 1).cast("int")
    return mix.union_all([r.select("run_id", model.alias("model"), F.lit(ph).alias("phase"), gpus.alias("gpus"))
                          for ph in ("cpt", "sft")])


def _n_train(spark, sf):
    """Training rows per phase: a count per corpus is enough, the split is exact."""
    n_c = fixtures.literature(spark, sf).count() + fixtures.dictionary(spark, sf).count()
    n_s = spark.read.parquet(f"{sf}/conversations.parquet").where(F.col("role") == "user").count()
    rows = [("cpt", mix.n_train(n_c, CPT_VAL_SHARE)), ("sft", mix.n_train(n_s, SFT_VAL_SHARE))]
    return spark.createDataFrame(rows, "phase string, n_train long")


def _plan(spark, sf):
    from tessera.plans.run_plan import hardware, phase_params, run_plan
    return run_plan(_runs(spark, sf), _n_train(spark, sf), hardware(spark), phase_params(spark))


def _hw_values() -> str:
    from tessera.constants import HARDWARE_TABLE
    rows = ", ".join(f"('{m}', '{p}', {g}, {b}, {a}, {k}, {e!r})" for m, p, g, b, a, k, e in HARDWARE_TABLE)
    return (f"SELECT model, phase, CAST(gpu_class AS INTEGER) AS gpu_class, CAST(b AS INTEGER) AS b, "
            f"CAST(a AS INTEGER) AS a, CAST(keep AS INTEGER) AS keep, CAST(epochs AS DOUBLE) AS epochs "
            f"FROM (VALUES {rows}) t(model, phase, gpu_class, b, a, keep, epochs)")


def _param_values() -> str:
    from tessera.constants import EARLY_STOP_PATIENCE, EVAL_EVERY_SAVES, LEARNING_RATES
    rows = ", ".join(f"('{m}', '{p}', {lr!r}, {EVAL_EVERY_SAVES[p]}, {EARLY_STOP_PATIENCE[(m, p)]})"
                     for (m, p), lr in sorted(LEARNING_RATES.items()))
    return (f"SELECT model, phase, CAST(lr AS DOUBLE) AS lr, CAST(eval_every AS INTEGER) AS eval_every, "
            f"CAST(patience AS INTEGER) AS patience FROM (VALUES {rows}) t(model, phase, lr, eval_every, patience)")


def _lr_sql(x: str) -> str:
    s = f"printf('%e', {x})"
    return (f"regexp_replace(regexp_replace(split_part({s}, 'e', 1), '0+$', ''), '\\.$', '') || 'e' || "
            f"CAST(CAST(split_part({s}, 'e', 2) AS INTEGER) AS VARCHAR)")


def _epo_sql(x: str) -> str:
    return f"CASE WHEN {x} = floor({x}) THEN CAST(CAST(floor({x}) AS BIGINT) AS VARCHAR) ELSE CAST({x} AS VARCHAR) END"


_PLAN_SQL = _CPT_SQL + _SFT_SQL + [
    ("cs", mix.split_sql("cpt", CPT_VAL_SHARE, cols="source, row_id")),
    ("ss", mix.split_sql("sft", SFT_VAL_SHARE, key_cols=corpus.SFT_KEY, cols="source, row_id, turn")),
    ("ntr", "SELECT 'cpt' AS phase, CAST(count(*) AS BIGINT) AS n_train FROM cs WHERE split = 'train' "
            "UNION ALL SELECT 'sft', CAST(count(*) AS BIGINT) FROM ss WHERE split = 'train'"),
    ("runs", "SELECT run_id, CASE WHEN run_id % 2 = 0 THEN '12b' ELSE '27b' END AS model, p.phase, "
             "CAST(run_id % 4 + 1 AS INTEGER) AS gpus FROM (SELECT DISTINCT user_id AS run_id FROM events) r, "
             "(SELECT 'cpt' AS phase UNION ALL SELECT 'sft') p"),
    ("hw", _hw_values()),
    ("prm", _param_values()),
    ("hl", "SELECT r.run_id, r.phase, r.model, r.gpus, CAST(least(r.gpus, 3) AS INTEGER) AS gpu_class, "
           "h.b, h.a, h.keep, h.epochs FROM runs r JOIN hw h ON h.model = r.model AND h.phase = r.phase "
           "AND h.gpu_class = least(r.gpus, 3)"),
    ("pl0", "SELECT hl.*, p.lr, p.eval_every, n.n_train, "
            "CAST(ceil(CAST(n.n_train AS DOUBLE) / CAST(hl.b * hl.a * hl.gpus * 250 AS DOUBLE)) AS BIGINT) AS save_steps "
            "FROM hl JOIN prm p ON p.model = hl.model AND p.phase = hl.phase JOIN ntr n ON n.phase = hl.phase"),
    ("pl1", "SELECT *, CAST(save_steps * ceil(25.0 * epochs) * 10 AS BIGINT) AS max_steps, "
            "CAST(eval_every * save_steps AS BIGINT) AS eval_steps, CAST(b * a AS INTEGER) AS eff_batch FROM pl0"),
    ("plan", "SELECT *, CAST(max_steps AS DOUBLE) * eff_batch * gpus / CAST(n_train AS DOUBLE) AS epochs_run, "
             "CASE WHEN model = '12b' THEN 'gemma3_12b' ELSE 'gemma3_27b' END || '_' || phase || '_240101_' || "
             + _lr_sql("lr") + " || '_b' || CAST(eff_batch AS VARCHAR) || 'x' || CAST(gpus AS VARCHAR) || "
             "CASE WHEN phase = 'cpt' THEN '_' || " + _epo_sql("epochs") + " || 'epo' "
             "ELSE '_cosine_' || " + _epo_sql("epochs") + " || 'epo_gap_10n' END AS run_name FROM pl1"),
]


@register("hardware_lookup", ctes(*_PLAN_SQL, body="SELECT run_id, phase, model, gpus, gpu_class, b, a, keep, epochs FROM hl"))
def q_hardware_lookup(spark, sf):
    from tessera.plans.run_plan import hardware, hardware_lookup
    return hardware_lookup(_runs(spark, sf), hardware(spark)).select(
        "run_id", "phase", "model", "gpus", "gpu_class", "b", "a", "keep", "epochs")


@register("run_plan", ctes(*_PLAN_SQL, body=(
    "SELECT run_id, phase, n_train, save_steps, max_steps, eval_steps, eff_batch, epochs_run FROM plan")))
def q_run_plan(spark, sf):
    return _plan(spark, sf).select("run_id", "phase", "n_train", "save_steps", "max_steps", "eval_steps",
                                   "eff_batch", "epochs_run")


@register("run_name", ctes(*_PLAN_SQL, body="SELECT run_id, phase, run_name FROM plan"))
def q_run_name(spark, sf):
    return _plan(spark, sf).select("run_id", "phase", "run_name")


@register("format_lr", f"SELECT event_id, value * 1e-5 AS lr, {_lr_sql('value * 1e-5')} AS lr_text FROM events")
def q_format_lr(spark, sf):
    from tessera.functions.text import format_lr
    e = spark.read.parquet(f"{sf}/events.parquet").select("event_id", (F.col("value") * 1e-5).alias("lr"))
    return e.select("event_id", "lr", format_lr("lr").alias("lr_text"))


_KEPT_SQL = _RUN_SQL + [
    ("kept", f"SELECT run_id, seq, step, loss_c, rank FROM (SELECT run_id, seq, step, loss_c, "
             f"CAST(row_number() OVER (PARTITION BY run_id ORDER BY loss_c, seq) AS INTEGER) AS rank FROM ev WHERE ex) t "
             f"WHERE rank <= {N_KEEP}"),
]


@register("checkpoint_path", ctes(*_PLAN_SQL, *_KEPT_SQL, body=(
    "SELECT k.run_id, k.step, 'models/output_' || p.run_name || '/checkpoint-' || CAST(k.step AS VARCHAR) AS path, "
    "'output_' || p.run_name AS label FROM kept k JOIN plan p ON p.run_id = k.run_id AND p.phase = 'cpt'")))
def q_checkpoint_path(spark, sf):
    from tessera.plans.run_plan import checkpoint_paths
    kept = _kept_by_loss(spark, sf).select("run_id", "step", F.lit("cpt").alias("phase"))
    return checkpoint_paths(kept, _plan(spark, sf)).select("run_id", "step", "path", "label")


@register("phase_handoff", ctes(*_PLAN_SQL, *_RUN_SQL, (
    "b1", "SELECT run_id, arg_min(step, loss_c * 1000000000 + seq) AS best_step FROM ev WHERE ex GROUP BY run_id"),
    body=("SELECT b.run_id, s.run_name AS sft_run_name, b.best_step, "
          "'models/output_' || c.run_name || '/checkpoint-' || CAST(b.best_step AS VARCHAR) AS init_checkpoint "
          "FROM b1 b JOIN plan c ON c.run_id = b.run_id AND c.phase = 'cpt' "
          "JOIN plan s ON s.run_id = b.run_id AND s.phase = 'sft'")))
def q_phase_handoff(spark, sf):
    from tessera.operators.runs import rank1
    from tessera.plans.run_plan import phase_handoff
    best = rank1(_evals_exists(spark, sf).where("exists"), "loss")
    return phase_handoff(best, _plan(spark, sf))


@register("phase_orphans", ctes(*_RUN_SQL, body=(
    "SELECT DISTINCT c_custkey AS run_id FROM customer WHERE c_custkey NOT IN (SELECT run_id FROM ev WHERE ex)")))
def q_phase_orphans(spark, sf):
    from tessera.operators.runs import rank1
    from tessera.plans.run_plan import orphans
    best = rank1(_evals_exists(spark, sf).where("exists"), "loss")
    # the registry names every customer's run; most have no checkpoint
    runs = spark.read.parquet(f"{sf}/customer.parquet").select(F.col("c_custkey").cast("bigint").alias("run_id"))
    return orphans(runs, best)


@register("stage_accuracy", ctes(*fx("gold", "predictions"), (
    "c", "SELECT p.model, p.stage, p.stage_no, CAST(sum(CASE WHEN p.choice = g.answer THEN 1 ELSE 0 END) AS BIGINT) "
         "AS n_correct FROM predictions p JOIN gold g ON g.item_id = p.item_id GROUP BY p.model, p.stage, p.stage_no"), (
    "a", "SELECT c.*, CAST((SELECT count(*) FROM gold) AS BIGINT) AS n_gold, "
         "CAST(n_correct AS DOUBLE) / CAST((SELECT count(*) FROM gold) AS DOUBLE) AS accuracy FROM c"),
    body="SELECT *, accuracy - lag(accuracy) OVER (PARTITION BY model ORDER BY stage_no) AS lift FROM a"))
def q_stage_accuracy(spark, sf):
    from tessera.operators.evals import stage_accuracy
    return stage_accuracy(fixtures.gold(spark, sf), fixtures.predictions(spark, sf))


def _written(spark, text, share, key):
    """The token table written in shuffled order, read back with the order of its files."""
    from tessera.plans.prepare import token_table
    from tessera.sources.sinks import write_corpus
    table, _, _ = token_table(text, share, SEED, key, max_len=MAX_LEN)
    return spark.read.parquet(write_corpus(table))


@register("write_corpus", ctes(*_TOK_SQL, ("po", mix.shuffle_sql("cpt")), body=(
    "SELECT s.split, s.source, s.row_id, p.pos, e.n_tokens, e.id_sum FROM sp s JOIN enc e ON e.source = s.source "
    "AND e.row_id = s.row_id JOIN po p ON p.source = s.source AND p.row_id = s.row_id")))
def q_write_corpus(spark, sf):
    from tessera.operators.tokens import id_checksums
    t = _written(spark, corpus.cpt_corpus(spark, sf), CPT_VAL_SHARE, mix.KEY_COLS)
    return t.select("split", "source", "row_id", "pos", "n_tokens", id_checksums()[0])


_SFT_TOK_SQL = _SFT_SQL + [
    ("sp", mix.split_sql("sft", SFT_VAL_SHARE, key_cols=corpus.SFT_KEY, cols="source, row_id, turn")),
    ("wd", "SELECT source, row_id, turn, list_filter(string_split_regex(text, '[ \\t\\n\\r]+'), lambda x: x <> '') AS w FROM sft"),
    ("vc", "SELECT token, count(*) AS cnt FROM (SELECT unnest(wd.w) AS token FROM wd JOIN sp USING (source, row_id, turn) "
           "WHERE sp.split = 'train') GROUP BY token"),
    ("vocab", "SELECT token, row_number() OVER (ORDER BY cnt DESC, token) + 3 AS id FROM vc"),
    ("ex", f"SELECT source, row_id, turn, unnest(w[1:{MAX_LEN - 2}]) AS token FROM wd"),
    ("encs", "SELECT ex.source, ex.row_id, ex.turn, sum(coalesce(v.id, 3)) AS s FROM ex LEFT JOIN vocab v "
             "ON v.token = ex.token GROUP BY ALL"),
    ("po", mix.shuffle_sql("sft", key_cols=corpus.SFT_KEY)),
]


@register("write_corpus_sft", ctes(*_SFT_TOK_SQL, body=(
    f"SELECT sp.split, wd.source, wd.row_id, wd.turn, po.pos, CAST(least(len(w), {MAX_LEN - 2}) + 2 AS INTEGER) AS n_tokens, "
    f"CAST(3 + coalesce(e.s, 0) AS BIGINT) AS id_sum FROM wd JOIN sp USING (source, row_id, turn) "
    f"JOIN po USING (source, row_id, turn) LEFT JOIN encs e USING (source, row_id, turn)")))
def q_write_corpus_sft(spark, sf):
    from tessera.operators.tokens import id_checksums
    t = _written(spark, corpus.sft_corpus(spark, sf).drop("source_ord"), SFT_VAL_SHARE, corpus.SFT_KEY)
    return t.select("split", "source", "row_id", "turn", "pos", "n_tokens", id_checksums()[0])


@register("drop_source_columns", ctes(*_TOK_SQL, body="SELECT n_tokens, id_sum FROM enc"))
def q_drop_source_columns(spark, sf):
    """Only the token columns stay."""
    from tessera.functions.templates import drop_source_columns
    from tessera.operators.tokens import id_checksums
    return drop_source_columns(_encoded(spark, sf), ["input_ids", "n_tokens"]).select("n_tokens", id_checksums()[0])


@register("union_literature", ctes(*fx("literature"), body="SELECT source, row_id, title, text FROM literature"))
def q_union_literature(spark, sf):
    """Every source as a table of its own, appended."""
    lit_df = fixtures.literature(spark, sf)
    names = [r["source"] for r in lit_df.select("source").distinct().orderBy("source").collect()]
    parts = [lit_df.where(F.col("source") == n) for n in names] + [lit_df.where(F.col("source").isNull())]
    return mix.union_all(parts)


@register("leaderboard_text", ctes(*_KEPT_SQL, (
    "n", "SELECT run_id, count(*) AS n FROM kept GROUP BY run_id"),
    body=("SELECT run_id, CAST(0 AS INTEGER) AS line_no, 'Currently keeping ' || CAST(n AS VARCHAR) || "
          "' checkpoints:' AS line FROM n UNION ALL "
          "SELECT run_id, rank AS line_no, '   ' || CAST(rank AS VARCHAR) || '. checkpoint-' || CAST(step AS VARCHAR) "
          "|| ': eval_loss=' || printf('%.4f', CAST(loss_c AS DOUBLE) / 100000.0) AS line FROM kept UNION ALL "
          "SELECT run_id, CAST(n + 1 AS INTEGER) AS line_no, '' AS line FROM n")))
def q_leaderboard_text(spark, sf):
    from tessera.sources.sinks import loss_report
    return loss_report(_kept_by_loss(spark, sf).select("run_id", "rank", "step", "eval_loss"))


@register("leaderboard_gap_text", ctes(*_RUN_SQL, _GAP_EX, (
    "kg", f"SELECT * FROM (SELECT run_id, seq, step, gap, eval_loss, CAST(row_number() OVER (PARTITION BY run_id "
          f"ORDER BY gap, seq) AS INTEGER) AS rank FROM gx WHERE ex) t WHERE rank <= {N_KEEP}"),
    body=("SELECT DISTINCT run_id, CAST(0 AS INTEGER) AS line_no, 'Stability Priority Leaderboard (Samples every 1 "
          "steps, Settlement every 10 steps)' AS line FROM kg UNION ALL "
          "SELECT run_id, rank AS line_no, '   ' || CAST(rank AS VARCHAR) || '. checkpoint-' || CAST(step AS VARCHAR) "
          "|| ': Gap=' || printf('%.4f', gap) || ' (Eval_Loss=' || printf('%.4f', eval_loss) || ')' AS line "
          "FROM kg")))
def q_leaderboard_gap_text(spark, sf):
    from tessera.operators.runs import best_n
    from tessera.sources.sinks import gap_report
    kept = best_n(_gap_exists(spark, sf).where("exists"), "gap", N_KEEP) \
        .select("run_id", "rank", "step", "gap", "eval_loss")
    return gap_report(kept, 1, 10)


_PLANNED_SQL = _PLAN_SQL + _RUN_SQL + [
    ("cad", "SELECT run_id, save_steps, CAST(eval_every * save_steps AS BIGINT) AS eval_steps FROM (SELECT hl.run_id, p.eval_every, "
            "CAST(ceil(CAST(n AS DOUBLE) / CAST(hl.b * hl.a * hl.gpus * 250 AS DOUBLE)) AS BIGINT) AS save_steps FROM hl "
            "JOIN prm p ON p.model = hl.model AND p.phase = hl.phase, (SELECT count(*) AS n FROM lineitem) l WHERE hl.phase = 'sft') x"),
    ("pit", "SELECT i.run_id, i.interval, count(*) AS n, sum(i.loss_c) AS s FROM iv i JOIN cad c ON c.run_id = i.run_id "
            "WHERE i.kind = 'train' AND i.step % c.save_steps = 0 GROUP BY ALL"),
    ("pgap", "SELECT e.run_id, e.seq, e.step, CAST(e.loss_c AS DOUBLE) / 100000.0 AS eval_loss, CAST(n AS BIGINT) AS n_train, "
             "abs(CAST(e.loss_c AS DOUBLE) / 100000.0 - CAST(s AS DOUBLE) / CAST(n * 100000 AS DOUBLE)) AS gap "
             "FROM evn e JOIN pit p ON p.run_id = e.run_id AND p.interval = e.interval WHERE e.eval_no > 9"),
    ("pk", f"SELECT * FROM (SELECT g.*, row_number() OVER (PARTITION BY g.run_id ORDER BY gap, seq) AS rank FROM pgap g "
           f"JOIN checkpoint_manifest c ON c.run_id = g.run_id AND c.step = g.step) t WHERE rank <= {N_KEEP}"),
]


def _gap_planned(spark, sf):
    """Train losses sampled at each run's own ``save_steps``, from a plan over as many
    training rows as ``lineitem`` has (so that cadences differ)."""
    from tessera.operators.runs import existing, generalization_gap
    from tessera.plans.run_plan import hardware, phase_params, run_plan
    rows = spark.createDataFrame([("sft", spark.read.parquet(f"{sf}/lineitem.parquet").count())], "phase string, n_train long")
    plan = run_plan(_runs(spark, sf), rows, hardware(spark), phase_params(spark)).select("run_id", "save_steps", "eval_steps")
    log = _log(spark, sf)
    g = generalization_gap(log.join(plan.select("run_id", "save_steps"), "run_id"), save_steps="save_steps")
    return existing(g, fixtures.checkpoint_manifest(spark, sf, log)).join(plan, "run_id")


@register("generalization_gap_planned", ctes(*_PLANNED_SQL, body=(
    "SELECT g.run_id, g.seq, g.step, g.n_train, g.gap FROM pgap g JOIN checkpoint_manifest c ON c.run_id = g.run_id AND c.step = g.step")))
def q_generalization_gap_planned(spark, sf):
    return _gap_planned(spark, sf).select("run_id", "seq", "step", "n_train", "gap")


@register("report_files", ctes(*_PLANNED_SQL, body=(
    "SELECT DISTINCT k.run_id, 'Stability Priority Leaderboard (Samples every ' || CAST(p.save_steps AS VARCHAR) || ' steps, "
    "Settlement every ' || CAST(p.eval_steps AS VARCHAR) || ' steps)' AS line FROM pk k JOIN cad p ON p.run_id = k.run_id UNION ALL "
    "SELECT run_id, '   ' || CAST(rank AS VARCHAR) || '. checkpoint-' || CAST(step AS VARCHAR) || ': Gap=' || "
    "printf('%.4f', gap) || ' (Eval_Loss=' || printf('%.4f', eval_loss) || ')' AS line FROM pk")))
def q_report_files(spark, sf):
    """S7 as files: each run's report with its own cadence, written and read back."""
    from tessera.operators.runs import best_n
    from tessera.sources.sinks import gap_report, read_report, write_report
    kept = best_n(_gap_planned(spark, sf), "gap", N_KEEP)
    path = scratch_folder(spark, "reports")
    write_report(gap_report(kept), path)
    return read_report(spark, path)


# --------------------------------------------------------------------------
# streaming (ST1-ST4): run to completion, final state equals the batch query
# --------------------------------------------------------------------------

STREAM_EVENTS = 32  # events of a run per micro-batch


def _log_exists(spark, sf):
    from tessera.operators.runs import mark_existing
    log = _log(spark, sf)
    return mark_existing(log, fixtures.checkpoint_manifest(spark, sf, log))


@register("stream_best_n", ORACLES["best_n_by_loss"])
def q_stream_best_n(spark, sf):
    from tessera.streaming.checkpoints import best_n_processor, final_kept, run_available_now
    out = run_available_now(spark, _log_exists(spark, sf), best_n_processor(N_KEEP), STREAM_EVENTS,
                            evals_only=True)
    return final_kept(out).select("run_id", "rank", "seq", "step", "eval_loss")


@register("stream_gap", ORACLES["best_n_by_gap"])
def q_stream_gap(spark, sf):
    from tessera.streaming.checkpoints import final_kept, gap_processor, run_available_now
    out = run_available_now(spark, _log_exists(spark, sf), gap_processor(N_KEEP, 9, 1), STREAM_EVENTS)
    return final_kept(out).select("run_id", "rank", "seq", "step", F.col("score").alias("gap"), "eval_loss")


@register("stream_early_stop", ORACLES["early_stop"])
def q_stream_early_stop(spark, sf):
    from tessera.streaming.checkpoints import early_stop_processor, run_available_now
    out = run_available_now(spark, _log_exists(spark, sf), early_stop_processor(PATIENCE), STREAM_EVENTS,
                            evals_only=True)
    t = out.where((F.col("rec") == "trace") & ~F.col("late"))
    return t.select("run_id", "seq", F.col("eval_no").alias("eval_idx"), "improved", "counter", "stop")


@register("stream_admission_trace", ctes(*_RUN_SQL, *_evicted_sql(N_KEEP), body=(
    f"SELECT a.run_id, a.seq, a.step, CAST(a.loss_c AS DOUBLE) / 100000.0 AS eval_loss, a.n_kept, a.admitted, "
    f"l.xs AS evicted_step FROM adm a LEFT JOIN lt l ON l.run_id = a.run_id AND l.ys = a.step AND l.r = {N_KEEP} - l.p")))
def q_stream_admission_trace(spark, sf):
    """ST1's decision at every evaluation: admitted, and what it pushed out."""
    from tessera.streaming.checkpoints import best_n_processor, run_available_now
    out = run_available_now(spark, _log_exists(spark, sf), best_n_processor(N_KEEP), STREAM_EVENTS, evals_only=True)
    t = out.where((F.col("rec") == "trace") & ~F.col("late"))
    return t.select("run_id", "seq", "step", "eval_loss", "n_kept", "admitted", "evicted_step")


@register("stream_leaderboard_sink", ORACLES["leaderboard_text"])
def q_stream_leaderboard_sink(spark, sf):
    import os

    from tessera.sources.sinks import loss_report
    from tessera.streaming.checkpoints import best_n_processor, leaderboard_sink, read_leaderboard, run_available_now
    base = scratch_folder(spark, "stream")
    report = os.path.join(base, "report")
    run_available_now(spark, _log_exists(spark, sf), best_n_processor(N_KEEP), STREAM_EVENTS,
                      sink=leaderboard_sink(report, loss_report), base=base, evals_only=True)
    return read_leaderboard(spark, report).select("run_id", "line_no", "line")


@register("stream_on_save", ctes(*_RUN_SQL, *_evicted_sql(N_KEEP), body=(
    "SELECT a.run_id, a.seq, a.step, CAST(a.loss_c AS DOUBLE) / 100000.0 AS eval_loss, a.n_kept, a.admitted, "
    "CASE WHEN NOT a.admitted THEN 'skipped' WHEN a.ex THEN 'kept' ELSE 'dropped' END AS outcome, "
    f"l.xs AS evicted_step FROM adm a LEFT JOIN lt l ON l.run_id = a.run_id AND l.ys = a.step AND l.r = {N_KEEP} - l.p")))
def q_stream_on_save(spark, sf):
    """Log events propose, save events of a second stream admit or drop; saves come before, after and never."""
    from tessera.streaming.saves import run_with_saves, saves_feed
    log = _log(spark, sf)
    feed = saves_feed(fixtures.checkpoint_manifest(spark, sf, log), log, every=8)
    # blocks of another length: the feed is now ahead of the log and now behind it
    return run_with_saves(spark, log, feed, N_KEEP, scratch_folder(spark, "on-save"), STREAM_EVENTS, STREAM_EVENTS * 2 // 3,
                          int(spark.conf.get("spark.sql.shuffle.partitions")))


@register("stream_out_of_order", ORACLES["best_n_by_loss"])
def q_stream_out_of_order(spark, sf):
    """ST1 over a log whose blocks arrive in another order than its events."""
    import os

    from tessera.streaming.checkpoints import shards_for, write_blocks
    from tessera.streaming.reorder import EVENTS, KeepBest, present_list, run_ordered
    base, files = scratch_folder(spark, "out-of-order"), int(spark.conf.get("spark.sql.shuffle.partitions"))
    block = F.floor((F.col("seq") - 1) / STREAM_EVENTS)
    swapped = F.when(block % 2 == 0, block + 1).otherwise(block - 1)   # neighbouring blocks change places
    path = write_blocks(_log_exists(spark, sf).select(*[c.split(" ")[0] for c in EVENTS.split(", ")], swapped.alias("block")), os.path.join(base, "log"), files)
    stream = spark.readStream.schema(EVENTS).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files).parquet(path)
    shards = shards_for(spark.read.schema(EVENTS).option("recursiveFileLookup", "true").parquet(path), STREAM_EVENTS, files)
    rows, _ = run_ordered(spark, stream, KeepBest(N_KEEP), base, shards=shards)
    return present_list(rows).select("run_id", F.col("rank").cast("int").alias("rank"), "seq", "step", "eval_loss")


# --------------------------------------------------------------------------
# user-function hooks (X1, X2) on the workload's own functions
# --------------------------------------------------------------------------

@register("map_batches_format", ORACLES["format_literature"])
def q_map_batches_format(spark, sf):
    from tessera.constants import EOS_TEXT, LITERATURE_TEMPLATE
    from tessera.functions.hooks import map_batches

    def fmt(pdf):
        pdf = pdf.copy()
        pdf["text"] = [LITERATURE_TEMPLATE.format(title=a, text=b) + EOS_TEXT
                       for a, b in zip(pdf["title"].fillna(""), pdf["text"].fillna(""))]
        return pdf

    lit_df = fixtures.literature(spark, sf)
    return map_batches(lit_df, fmt, lit_df.schema)


@register("encode_with_hook", ORACLES["encode_truncate"])
def q_encode_with_hook(spark, sf):
    from tessera.functions.hooks import whitespace_tokenizer
    from tessera.operators.tokens import encode_with, id_checksums, token_lengths
    tok = whitespace_tokenizer(_vocab(spark, sf), MAX_LEN)
    enc = encode_with(corpus.cpt_corpus(spark, sf), tok, mix.KEY_COLS, max_len=MAX_LEN,
                      keep=[token_lengths(F.col("text"), MAX_LEN)["n_dropped"].alias("n_dropped")])
    return enc.select("source", "row_id", "n_tokens", "n_dropped", *id_checksums())


# --------------------------------------------------------------------------
# keep-N from the run plan (J2 -> O6): each run keeps its hardware class's N
# --------------------------------------------------------------------------

@register("best_n_by_gap_planned", ctes(*_PLAN_SQL, *_RUN_SQL, _GAP_EX, body=(
    "SELECT run_id, rank, seq, gap, keep FROM (SELECT g.run_id, g.seq, g.gap, p.keep, "
    "CAST(row_number() OVER (PARTITION BY g.run_id ORDER BY g.gap, g.seq) AS INTEGER) AS rank "
    "FROM gx g JOIN hl p ON p.run_id = g.run_id AND p.phase = 'sft' WHERE g.ex) t WHERE rank <= keep")))
def q_best_n_by_gap_planned(spark, sf):
    from tessera.constants import HARDWARE_TABLE
    from tessera.operators.runs import best_n
    from tessera.plans.run_plan import hardware, hardware_lookup
    keep = hardware_lookup(_runs(spark, sf), hardware(spark)).where(F.col("phase") == "sft") \
        .select("run_id", "keep")
    g = _gap_exists(spark, sf).where("exists").join(keep, "run_id", "inner")
    max_keep = max(k for *_, k, _e in HARDWARE_TABLE)
    return best_n(g, "gap", max_keep, keep_col="keep").select("run_id", "rank", "seq", "gap", "keep")


# --------------------------------------------------------------------------
# file readers (S1-S4) end to end: the inputs written as files, read back
# --------------------------------------------------------------------------

@register("scan_sources_files", ctes(*_CPT_SQL, body="SELECT source, title, text FROM cpt"))
def q_scan_sources_files(spark, sf):
    import os

    from tessera.plans.prepare import pretraining_text
    from tessera.sources.readers import read_text_sources
    root = scratch_folder(spark, "sources")
    fixtures.literature(spark, sf).select("source", "title", "text") \
        .write.partitionBy("source").parquet(os.path.join(root, "literature"))
    fixtures.dictionary(spark, sf).select("source", "title", "text") \
        .write.partitionBy("source").json(os.path.join(root, "dictionary"))
    lit_df = read_text_sources(spark, os.path.join(root, "literature"))
    dic = read_text_sources(spark, os.path.join(root, "dictionary"), fmt="json")
    return pretraining_text(lit_df, dic).select("source", "title", "text")


@register("scan_instruction_files", ctes(*_SFT_SQL, body="SELECT source, text FROM sft"))
def q_scan_instruction_files(spark, sf):
    import os

    from tessera.plans.prepare import chat_text
    from tessera.sources.readers import DIALOGUE_SCHEMA, TECHNICAL_SCHEMA, read_instructions
    root = scratch_folder(spark, "instructions")
    fixtures.dialogue(spark, sf).drop("row_id", "turn").write.json(os.path.join(root, "dialogue"))
    fixtures.technical(spark, sf).drop("row_id", "turn").write.json(os.path.join(root, "technical"))
    dlg = read_instructions(spark, os.path.join(root, "dialogue"), "dialogue", DIALOGUE_SCHEMA)
    tech = read_instructions(spark, os.path.join(root, "technical"), "technical", TECHNICAL_SCHEMA)
    return chat_text(dlg, tech).select("source", "text")


@register("early_stop_planned", ctes(*_PLAN_SQL, *_RUN_SQL, *_ES_SQL, body=(
    "SELECT e.run_id, e.seq, e.counter, p.patience, e.counter >= p.patience AS stop FROM es e "
    "JOIN runs r ON r.run_id = e.run_id AND r.phase = 'sft' "
    "JOIN prm p ON p.model = r.model AND p.phase = 'sft'")))
def q_early_stop_planned(spark, sf):
    """W6 with the fine-tuning patience of each run's model (5 for 12B, 3 for 27B)."""
    from tessera.operators.runs import early_stop
    from tessera.plans.run_plan import phase_params
    pat = _runs(spark, sf).where(F.col("phase") == "sft").join(
        F.broadcast(phase_params(spark)), ["model", "phase"]).select("run_id", "patience")  # 4-row table
    ev = _log(spark, sf).where(F.col("kind") == "eval").join(pat, "run_id")
    return early_stop(ev, "patience").select("run_id", "seq", "counter", "patience", "stop")
