"""Fixed values that must equal the workload being reproduced.

Everything in this module is a constant of the training-data workload, stated
plainly and in natural order. Logic lives elsewhere.
"""

from __future__ import annotations

# --- fixed values: whitespace removed by Python's str.strip() (29 code points) ---
# U+0009-000D, U+001C-0020, U+0085, U+00A0, U+1680, U+2000-200A, U+2028,
# U+2029, U+202F, U+205F, U+3000
WS29 = (
    "\u0009\u000a\u000b\u000c\u000d"
    "\u001c\u001d\u001e\u001f\u0020"
    "\u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# --- fixed values: pre-training text templates (continuation lines keep 4 spaces) ---
LITERATURE_TEMPLATE = "台語文學\n    ### 標題：{title}\n\n    ### 文章：\n    {text}"
DICTIONARY_TEMPLATE = "台語文本：\n    {text}"

# --- fixed values: special tokens of the default chat format ---
BOS_TEXT = "<bos>"
EOS_TEXT = "<eos>"
TURN_START = "<start_of_turn>"
TURN_END = "<end_of_turn>"
# role name in the conversation -> role name written in the rendered text
CHAT_ROLE_NAMES = {"user": "user", "assistant": "model"}

# --- fixed values: literary sources in union order, then the dictionary ---
LITERATURE_SOURCES = [
    "ots", "tks", "sslts", "ljk", "kkh", "tsk", "olbt", "abt", "manlajo",
    "asts", "achiak", "ngkh", "ttshs", "pikh", "khg", "lgs", "llb",
]
DICTIONARY_SOURCE = "dict"

# --- fixed values: corpus preparation ---
MAX_SEQ_LENGTH = 2880
SEED = 42
CPT_VAL_SHARE = 0.05
SFT_VAL_SHARE = 0.10
PAD_MULTIPLE = 8
SPLIT_NUM = 25  # save points per epoch / 10

# --- fixed values: special token ids of the built-in vocabulary ---
PAD_ID = 0
EOS_ID = 1
BOS_ID = 2
UNK_ID = 3
FIRST_WORD_ID = 4
LABEL_IGNORE = -100

# --- fixed values: hardware table (model, phase, gpu class, batch, accumulation, keep, epochs) ---
# gpu class 1 = one GPU, 2 = two GPUs, 3 = three or more
HARDWARE_TABLE = [
    ("12b", "cpt", 1, 2, 12, 10, 1.0),
    ("12b", "cpt", 2, 2, 6, 10, 1.0),
    ("12b", "cpt", 3, 1, 4, 10, 1.0),
    ("27b", "cpt", 1, 2, 12, 10, 1.0),
    ("27b", "cpt", 2, 2, 6, 10, 1.0),
    ("27b", "cpt", 3, 1, 4, 10, 1.0),
    ("12b", "sft", 1, 2, 96, 10, 1.5),
    ("12b", "sft", 2, 4, 24, 10, 1.5),
    ("12b", "sft", 3, 2, 12, 2, 1.5),
    ("27b", "sft", 1, 2, 128, 10, 1.5),
    ("27b", "sft", 2, 4, 32, 10, 1.5),
    ("27b", "sft", 3, 2, 16, 10, 1.5),
]

# --- fixed values: learning rates and early stopping per (model, phase) ---
LEARNING_RATES = {
    ("12b", "cpt"): 2.5e-4, ("27b", "cpt"): 1e-4,
    ("12b", "sft"): 2.5e-4, ("27b", "sft"): 4e-4,
}
EARLY_STOP_PATIENCE = {
    ("12b", "cpt"): 3, ("27b", "cpt"): 3,
    ("12b", "sft"): 5, ("27b", "sft"): 3,
}
EARLY_STOP_THRESHOLD = 0.001
EVAL_EVERY_SAVES = {"cpt": 5, "sft": 10}
GAP_MULTIPLE = 10
WARMUP_PER_MULTIPLE = 9
MODEL_STEM = {"12b": "gemma3_12b", "27b": "gemma3_27b"}

# --- fixed values: report lines ---
LOSS_REPORT_HEADER = "Currently keeping {n} checkpoints:"
LOSS_REPORT_LINE = "   {i}. checkpoint-{step}: eval_loss={loss}"
GAP_REPORT_HEADER = (
    "Stability Priority Leaderboard (Samples every {save} steps, "
    "Settlement every {eval} steps)"
)
GAP_REPORT_LINE = "   {i}. checkpoint-{step}: Gap={gap} (Eval_Loss={loss})"
REASON_LIMIT = "Limit not reached"
REASON_BETTER = "Better than worst"
REASON_NOT_BETTER = "Not better than worst"
