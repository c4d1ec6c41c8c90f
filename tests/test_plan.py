"""Run plan arithmetic and names."""

from tessera.plans.run_plan import hardware, phase_params, run_plan


def _plan(spark, cases):
    runs = spark.createDataFrame([(i, m, p, g) for i, (m, p, g, _) in enumerate(cases)],
                                 "run_id long, model string, phase string, gpus int")
    out = []
    for i, (m, p, g, n) in enumerate(cases):
        ntr = spark.createDataFrame([(p, n)], "phase string, n_train long")
        r = run_plan(runs.where(f"run_id = {i}"), ntr, hardware(spark), phase_params(spark)).first()
        out.append(r)
    return out


def test_step_arithmetic(spark):
    cases = [("12b", "cpt", 1, 950), ("12b", "cpt", 1, 100000), ("12b", "sft", 1, 900), ("12b", "sft", 1, 100000)]
    got = [(r["save_steps"], r["max_steps"], r["eval_steps"]) for r in _plan(spark, cases)]
    assert got == [(1, 250, 5), (17, 4250, 85), (1, 380, 10), (3, 1140, 30)]


def test_run_names_and_hardware_classes(spark):
    cases = [("12b", "cpt", 1, 950), ("27b", "sft", 2, 900), ("12b", "sft", 3, 900), ("27b", "cpt", 8, 950)]
    r = _plan(spark, cases)
    assert r[0]["run_name"] == "gemma3_12b_cpt_240101_2.5e-4_b24x1_1epo"
    assert r[1]["run_name"] == "gemma3_27b_sft_240101_4e-4_b128x2_cosine_1.5epo_gap_10n"
    assert (r[2]["b"], r[2]["a"], r[2]["keep"]) == (2, 12, 2)
    assert (r[3]["gpu_class"], r[3]["b"], r[3]["a"]) == (3, 1, 4)
    assert r[3]["output_dir"].startswith("models/output_gemma3_27b_cpt_240101_1e-4_b4x8")
