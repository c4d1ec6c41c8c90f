"""Conversations and chat rendering.

The chat format is data: a role map, turn start and end markers and the
beginning-of-sequence text. The default is the public Gemma form
``<bos><start_of_turn>{user|model}\\n{content}<end_of_turn>\\n``; a leading
system turn is folded into the first following turn as ``system + '\\n\\n'``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.constants import BOS_TEXT, CHAT_ROLE_NAMES, TURN_END, TURN_START
from tessera.functions.text import strip_unicode


@dataclass(frozen=True)
class ChatFormat:
    bos: str = BOS_TEXT
    turn_start: str = TURN_START
    turn_end: str = TURN_END
    roles: dict = field(default_factory=lambda: dict(CHAT_ROLE_NAMES))

    def role_expr(self, role: Column) -> Column:
        expr = role
        for src, dst in self.roles.items():
            expr = F.when(role == src, F.lit(dst)).otherwise(expr)
        return expr


DEFAULT_CHAT = ChatFormat()
TURN_CHUNK = 1024


def build_conversation(user_content: Column, assistant_content: Column) -> Column:
    """``[{role: user, content}, {role: assistant, content}]``."""
    return F.array(
        F.struct(F.lit("user").alias("role"), user_content.alias("content")),
        F.struct(F.lit("assistant").alias("role"), assistant_content.alias("content")))


def turn_segment(role: Column, content: Column, prefix: Column | None = None,
                 fmt: ChatFormat = DEFAULT_CHAT) -> Column:
    """One rendered turn: start marker, role, newline, content, end marker, newline."""
    body = strip_unicode(F.coalesce(content, F.lit("")))
    if prefix is not None:
        body = F.concat(F.coalesce(prefix, F.lit("")), body)
    return F.concat(F.lit(fmt.turn_start), fmt.role_expr(role), F.lit("\n"), body,
                    F.lit(fmt.turn_end), F.lit("\n"))


def render_chat(conversation: Column, fmt: ChatFormat = DEFAULT_CHAT) -> Column:
    """Conversation array -> single text, no generation prompt."""
    segs = F.transform(conversation, lambda m: turn_segment(m["role"], m["content"], fmt=fmt))
    return F.concat(F.lit(fmt.bos), F.array_join(segs, ""))


def render_conversations(turns: DataFrame, fmt: ChatFormat = DEFAULT_CHAT,
                         key: str = "conv_id") -> DataFrame:
    """P10: every conversation of ``(conv_id, turn, role, text)`` rendered to one text.

    Segments are rendered per turn as a projection. A system turn 0 is folded
    into turn 1 (an equi-join on ``(conv_id, turn)``) if turn 1 is there and is
    not a system turn itself; every other system turn is a turn of its own, so each
    conversation has a row and no text is lost. A null role renders as an empty role.
    Only the ordered concatenation groups by conversation (partial aggregation first).
    """
    t = turns.select(key, "turn", F.coalesce("role", F.lit("")).alias("role"), "text")
    head = t.where((F.col("turn") == 0) & (F.col("role") == "system")) \
        .select(key, F.lit(1).cast(dict(turns.dtypes)["turn"]).alias("turn"), F.concat(F.coalesce("text", F.lit("")), F.lit("\n\n")).alias("_prefix"))
    taker = t.where((F.col("turn") == 1) & (F.col("role") != "system")).select(key, F.lit(0).cast(dict(turns.dtypes)["turn"]).alias("turn"), F.lit(True).alias("_folds"))
    body = t.join(taker.distinct(), [key, "turn"], "left").join(head, [key, "turn"], "left")
    body = body.where(~((F.col("role") == "system") & (F.col("turn") == 0) & F.coalesce("_folds", F.lit(False))))
    body = body.withColumn("_prefix", F.when(F.col("role") != "system", F.col("_prefix")))
    seg = body.select(key, "turn", turn_segment(F.col("role"), F.col("text"), F.col("_prefix"), fmt).alias("seg"))
    # ordered concatenation in two levels: turns within a chunk, then the chunks,
    # so no task sorts more than TURN_CHUNK segments of one conversation at once
    part = seg.groupBy(key, F.floor(F.col("turn") / F.lit(TURN_CHUNK)).alias("_tc")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "seg"))), lambda x: x["seg"]), "")
        .alias("_part"))
    agg = part.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_tc", "_part"))).alias("_parts"))
    return agg.select(key, F.concat(F.lit(fmt.bos), F.array_join(F.transform("_parts", lambda x: x["_part"]), ""))
                      .alias("text"))


def role_sql(col: str, fmt: ChatFormat = DEFAULT_CHAT) -> str:
    cases = " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in fmt.roles.items())
    return f"CASE {cases} ELSE {col} END"
