"""File readers and the two end-to-end preparations (S1-S4, S6, entries 1-2)."""

import math
import os
import tempfile
from collections import Counter

from pyspark.sql import functions as F

from tessera.plans import corpus
from tessera.plans.prepare import chat_text, prepare_chat, prepare_pretraining, pretraining_text
from tessera.sources import fixtures
from tessera.sources.readers import (DIALOGUE_SCHEMA, TECHNICAL_SCHEMA, read_instructions, read_metric_log,
                                     read_trainer_state,
                                     read_text_sources)
from tests.conftest import SF_SMALL


def _files(spark):
    root = tempfile.mkdtemp(prefix="tessera-readers-")
    lit_df = fixtures.literature(spark, SF_SMALL).select("source", "title", "text")
    lit_df.write.partitionBy("source").parquet(os.path.join(root, "lit"))
    fixtures.dictionary(spark, SF_SMALL).select("source", "title", "text") \
        .write.partitionBy("source").json(os.path.join(root, "dict"))
    fixtures.dialogue(spark, SF_SMALL).drop("row_id", "turn").coalesce(1).write.json(os.path.join(root, "dlg"))
    fixtures.technical(spark, SF_SMALL).drop("row_id", "turn").coalesce(1).write.json(os.path.join(root, "tech"))
    return root


def test_readers_reproduce_fixture_texts(spark):
    root = _files(spark)
    lit_df = read_text_sources(spark, os.path.join(root, "lit"))
    dic = read_text_sources(spark, os.path.join(root, "dict"), fmt="json")
    assert lit_df.columns[:4] == ["source", "source_ord", "file", "row_id"]
    assert lit_df.select("source", "file", "row_id").distinct().count() == lit_df.count()
    got = Counter(r["text"] for r in pretraining_text(lit_df, dic).collect())
    want = Counter(r["text"] for r in corpus.cpt_corpus(spark, SF_SMALL).collect())
    assert got == want
    # partition pruning on the source column
    plan = lit_df.where("source = 'src3'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan

    dlg = read_instructions(spark, os.path.join(root, "dlg"), "dialogue", DIALOGUE_SCHEMA)
    tech = read_instructions(spark, os.path.join(root, "tech"), "technical", TECHNICAL_SCHEMA)
    assert dlg.where(F.col("input").isNull()).count() > 0  # absent key reads as null
    got = Counter(r["text"] for r in chat_text(dlg, tech).collect())
    want = Counter(r["text"] for r in corpus.sft_corpus(spark, SF_SMALL).collect())
    assert got == want


def test_prepare_end_to_end(spark):
    root = _files(spark)
    lit_df = read_text_sources(spark, os.path.join(root, "lit"))
    dic = read_text_sources(spark, os.path.join(root, "dict"), fmt="json")
    path, counts, vocab = prepare_pretraining(spark, lit_df, dic, vocab_size=500, max_len=64)
    n = lit_df.count() + dic.count()
    assert counts["val"] == math.ceil(0.05 * n) and counts["train"] + counts["val"] == n
    out = spark.read.parquet(path)
    assert {r["split"]: r["count"] for r in out.groupBy("split").count().collect()} == counts
    assert out.agg(F.max("n_tokens")).first()[0] <= 64
    dlg = read_instructions(spark, os.path.join(root, "dlg"), "dialogue", DIALOGUE_SCHEMA)
    tech = read_instructions(spark, os.path.join(root, "tech"), "technical", TECHNICAL_SCHEMA)
    path2, counts2, _ = prepare_chat(spark, dlg, tech, vocab=vocab, max_len=64)
    assert counts2["val"] == math.ceil(0.1 * (dlg.count() + tech.count()))


def test_metric_log_reader(spark):
    root = tempfile.mkdtemp(prefix="tessera-log-")
    fixtures.metric_log(spark, SF_SMALL).write.parquet(os.path.join(root, "log"))
    assert read_metric_log(spark, os.path.join(root, "log")).count() == 1000
    s = read_metric_log(spark, os.path.join(root, "log"), stream=True, max_files_per_trigger=1)
    assert s.isStreaming


def test_trainer_state_reader(spark):
    import json

    from tessera.operators import runs
    rows = fixtures.metric_log(spark, SF_SMALL).orderBy("run_id", "seq").collect()
    root = tempfile.mkdtemp(prefix="tessera-state-")
    by_run = {}
    for r in rows:
        e = {"step": r["step"], "epoch": 0.1}
        if r["kind"] == "eval":
            e.update({"eval_loss": r["loss"], "eval_runtime": 1.5})
        else:
            e.update({"loss": r["loss"], "learning_rate": 2.5e-4, "grad_norm": 0.7})
        by_run.setdefault(r["run_id"], []).append(e)
    for run, hist in by_run.items():
        d = os.path.join(root, f"run{run}")
        os.makedirs(d)
        with open(os.path.join(d, "trainer_state.json"), "w") as f:
            json.dump({"global_step": 9, "log_history": hist + [{"train_runtime": 3.0, "step": 9}]}, f, indent=1)
    log = read_trainer_state(spark, os.path.join(root, "*", "trainer_state.json"))
    got = sorted((r["run_id"], r["seq"], r["step"], r["kind"], r["loss"], float(r["loss_c"])) for r in log.collect())
    want = sorted((f"run{r['run_id']}", r["seq"], r["step"], r["kind"], r["loss"], r["loss"]) for r in rows)
    assert got == want
    g1 = {(r["run_id"], r["seq"]): r["gap"] for r in runs.generalization_gap(log, scale=1).collect()}
    g2 = {(f"run{r['run_id']}", r["seq"]): r["gap"] for r in
          runs.generalization_gap(fixtures.metric_log(spark, SF_SMALL)).collect()}
    assert set(g1) == set(g2) and len(g1) > 0 and all(abs(g1[k] - g2[k]) < 1e-15 for k in g1)


def test_trainer_state_steps_and_odd_losses(spark):
    """Checkpoints carry the trainer's step; close and NaN losses stay what they are."""
    from tessera.operators import runs

    d = os.path.join(tempfile.mkdtemp(prefix="tessera-state-"), "runA")
    os.makedirs(d)
    with open(os.path.join(d, "trainer_state.json"), "w") as f:
        f.write('{"log_history": [{"step": 5, "loss": 0.5}, {"step": 5, "eval_loss": 1.23456749}, {"step": 10, "loss": NaN}, '
                '{"step": 10, "eval_loss": 1.23456741}, {"step": 15, "eval_loss": NaN}]}')
    log = read_trainer_state(spark, os.path.join(d, "trainer_state.json"))
    ev = log.where("kind = 'eval'")
    manifest = spark.createDataFrame([("runA", 5), ("runA", 10)], "run_id string, step long")
    assert [r["step"] for r in runs.best_n(runs.existing(ev, manifest), "loss", 2).orderBy("rank").collect()] == [10, 5]
    assert runs.rank1(ev, "loss").first()["best_step"] == 10
    assert [r["new_best"] for r in runs.new_best_flag(ev).orderBy("seq").collect()] == [True, True, False]
    assert log.where("loss_c is null").count() == 2


def test_batch_manifest(spark):
    from tessera.plans.prepare import write_batch_manifest
    root = _files(spark)
    lit_df = read_text_sources(spark, os.path.join(root, "lit"))
    dic = read_text_sources(spark, os.path.join(root, "dict"), fmt="json")
    path, counts, _ = prepare_pretraining(spark, lit_df, dic, vocab_size=500, max_len=64)
    mpath, plan = write_batch_manifest(spark, path, b=2, a=12, g=1, epochs=1.0, eval_every=5)
    m = spark.read.parquet(mpath)
    assert plan["n_train"] == counts["train"] and plan["max_steps"] == 250
    assert m.count() == plan["max_steps"] * 2 * 12
    per_step = m.groupBy("step").count().agg(F.min("count"), F.max("count")).first()
    assert tuple(per_step) == (24, 24)
    bad = m.where((F.col("padded_len") % 8 != 0) | (F.col("padded_len") < F.col("n_tokens"))).count()
    assert bad == 0
    # every sample once per epoch pass: an epoch is a permutation of the training rows
    first = m.where("epoch = 0").select("source", "file", "row_id").distinct().count()
    assert first == min(counts["train"], plan["max_steps"] * 24)


def test_instruction_json_array_file(spark):
    import json
    rows = [r.asDict() for r in fixtures.dialogue(spark, SF_SMALL).drop("row_id", "turn").collect()]
    for r in rows:
        if r["input"] is None:
            del r["input"]  # a missing key, as in hand-written files
    root = tempfile.mkdtemp(prefix="tessera-array-")
    path = os.path.join(root, "dialogue.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump(rows, f, ensure_ascii=False, indent=1)
    dlg = read_instructions(spark, path, "dialogue", DIALOGUE_SCHEMA, multi_line=True)
    assert dlg.count() == len(rows)
    assert dlg.select("source", "file", "row_id").distinct().count() == len(rows)  # keys stay unique
    tech = read_instructions(spark, path, "technical", TECHNICAL_SCHEMA, multi_line=True).limit(0)
    got = Counter(r["text"] for r in chat_text(dlg, tech).collect())
    want = Counter(r["text"] for r in corpus.dialogue_rows(spark, SF_SMALL).collect())
    assert got == want
