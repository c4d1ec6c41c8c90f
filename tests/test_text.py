"""Value semantics of the text functions."""

from pyspark.sql import functions as F

from tessera.constants import WS29
from tessera.functions.chat import build_conversation, render_chat
from tessera.functions.templates import dictionary_text, literature_text
from tessera.functions.text import (build_user_content, checkpoint_path, clean_field, format_lr,
                                    parent_label, strip_unicode, with_fixed)


def _one(spark, expr, schema, row):
    return spark.createDataFrame([row], schema).select(expr.alias("v")).first()["v"]


def test_ws29_matches_python_strip():
    every = [chr(c) for c in range(0x110000) if chr(c).strip() == ""]
    assert sorted(WS29) == sorted(every) and len(WS29) == 29


def test_strip_each_whitespace(spark):
    rows = [(ch + "台 語" + ch + ch,) for ch in WS29] + [("​台 語​",)]
    got = [r["v"] for r in spark.createDataFrame(rows, "s string").select(strip_unicode("s").alias("v")).collect()]
    assert got == [r[0].strip() for r in rows]
    assert got[-1] == "​台 語​"  # zero-width space is not whitespace


def test_user_content_cases(spark):
    schema = "i string, x string"
    cases = [("a", ""), ("", "b"), (None, "b"), ("a", None), ("", ""), ("　a　", " b\n"), (None, None)]
    got = [r["v"] for r in spark.createDataFrame(cases, schema)
           .select(build_user_content("i", "x").alias("v")).collect()]
    assert got == ["a", "b", "b", "a", "", "a\nb", ""]


def test_clean_field_default(spark):
    assert _one(spark, clean_field("s"), "s string", (None,)) == ""


def test_template_braces_are_inert(spark):
    v = _one(spark, literature_text(), "title string, text string", ("{x}", "100% {0}"))
    assert v == "台語文學\n    ### 標題：{x}\n\n    ### 文章：\n    100% {0}<eos>"
    v = _one(spark, dictionary_text(), "title string, text string", ("t", "%s {}"))
    assert v == "台語文本：\n    %s {}<eos>"


def test_render_chat_blank_row_kept(spark):
    conv = build_conversation(build_user_content("i", "x"), clean_field("o"))
    v = _one(spark, render_chat(conv), "i string, x string, o string", ("", "", ""))
    assert v == "<bos><start_of_turn>user\n<end_of_turn>\n<start_of_turn>model\n<end_of_turn>\n"


def test_format_lr(spark):
    # the last three lie next to a tie in the sixth decimal of the mantissa
    vals = [2.5e-4, 1e-4, 4e-4, 10.0, 0.0, -3e-7, 1.25e-5, 123456.0, 1.0000005e-3, 1.2345675e-5, 2.0000015e-2]
    got = [r["v"] for r in spark.createDataFrame([(v,) for v in vals], "x double")
           .select(format_lr("x").alias("v")).collect()]
    assert got == ["2.5e-4", "1e-4", "4e-4", "1e1", "0e0", "-3e-7", "1.25e-5", "1.23456e5", "1e-3", "1.234567e-5", "2.000001e-2"]
    nan = spark.createDataFrame([(float("nan"),), (float("inf"),)], "x double").select(format_lr("x").alias("v"))
    assert [r["v"] for r in nan.collect()] == [None, None]


def test_checkpoint_path_and_label(spark):
    df = spark.createDataFrame([("models/output_run", 35)], "d string, s long")
    r = df.select(checkpoint_path("d", "s").alias("p")).select("p", parent_label("p").alias("l")).first()
    assert r["p"] == "models/output_run/checkpoint-35" and r["l"] == "output_run"


def test_fixed_formatting_matches_python(spark):
    vals = [0.03125, 2.67495, 0.00005, 1.00005, 6.55, -0.03125, 0.0, 490.02, 1 / 3, 1e-7]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, x double")
    got = {r["i"]: r["t"] for r in with_fixed(df, "x", "t", 4).collect()}
    assert [got[i] for i in range(len(vals))] == [f"{v:.4f}" for v in vals]
    odd = spark.createDataFrame([(1, float("nan")), (2, float("inf")), (3, None)], "i int, x double")
    assert {r["i"]: r["t"] for r in with_fixed(odd, "x", "t", 4).collect()} == {1: "nan", 2: "infinity", 3: None}


def test_conversations_keep_every_turn(spark):
    from tessera.functions.chat import render_conversations

    rows = [(1, 0, "system", "S"), (1, 1, "user", "u"), (1, 2, "assistant", "a"), (1, 3, "system", "late"),
            (2, 0, "system", "alone"), (3, 0, "system", "S"), (3, 2, "user", "u"), (4, 0, None, "x"), (5, 0, "user", None)]
    got = {r["conv_id"]: r["text"] for r in render_conversations(
        spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    turn = lambda role, text: f"<start_of_turn>{role}\n{text}<end_of_turn>\n"
    assert got == {1: "<bos>" + turn("user", "S\n\nu") + turn("model", "a") + turn("system", "late"),
                   2: "<bos>" + turn("system", "alone"), 3: "<bos>" + turn("system", "S") + turn("user", "u"),
                   4: "<bos>" + turn("", "x"), 5: "<bos>" + turn("user", "")}


def test_stage_without_matches_has_accuracy_zero(spark):
    from tessera.operators.evals import stage_accuracy

    gold = spark.createDataFrame([(1, 1), (2, 0)], "item_id long, answer int")
    pred = spark.createDataFrame([("m", "a", 1, 1, 1), ("m", "b", 2, 99, 1)], "model string, stage string, stage_no int, item_id long, choice int")
    got = {r["stage"]: (r["n_correct"], r["accuracy"], r["lift"]) for r in stage_accuracy(gold, pred).collect()}
    assert got == {"a": (1, 0.5, None), "b": (0, 0.0, -0.5)}
