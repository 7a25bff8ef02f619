"""Operators on chat turns: ``(conv_id, turn, role, content)``, ``turn`` unique in a conversation."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.functions import text
from colloquy.functions.fixed import ADDED_TOKENS
from colloquy.functions.template import is_query
from colloquy.plans.ordered_groups import (
    OrderedGroups,
    following,
    position,
    running_last,
    total,
    total_count,
)

ROLES = ["system", "user", "assistant", "tool"]


def conversations(turns: DataFrame, ordered: bool = True) -> OrderedGroups:
    return OrderedGroups.of(turns, ["conv_id"], "turn", ordered)


def drop_empty_turns(turns: DataFrame) -> DataFrame:
    """Drop user turns with nothing but white space."""
    content = F.coalesce("content", F.lit(""))
    return turns.where(~((F.col("role") == "user") & text.is_empty_turn(content)))


def take_until_exit(turns: DataFrame) -> DataFrame:
    """Drop the first user turn that is an exit word, and everything after it."""
    leaves = (F.col("role") == "user") & text.is_exit(F.col("content"))
    closed = conversations(turns, ordered=False).with_columns(
        _closed=total(F.min, F.when(leaves, F.col("turn")))
    )
    return closed.df.where(F.col("_closed").isNull() | (F.col("turn") < F.col("_closed"))).drop(
        "_closed"
    )


def validate_turns(turns: DataFrame) -> DataFrame:
    """One row that counts the turns, and those that break the input rules."""
    per_place = turns.groupBy("conv_id", "turn").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("conv_id").isNull() | F.col("turn").isNull()).alias("no_place"),
        F.count_if(F.col("role").isNull()).alias("no_role"),
        F.count_if(~F.col("role").isin(ROLES)).alias("unknown_role"),
        F.count_if(F.col("content").isNull()).alias("no_content"),
    )
    return per_place.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("turns"),
        F.coalesce(F.sum("no_place"), F.lit(0)).alias("no_place"),
        F.coalesce(F.sum("no_role"), F.lit(0)).alias("no_role"),
        F.coalesce(F.sum("unknown_role"), F.lit(0)).alias("unknown_role"),
        F.coalesce(F.sum("no_content"), F.lit(0)).alias("no_content"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("repeated_place"),
    )


def require_valid_turns(turns: DataFrame) -> DataFrame:
    """The same rows; the job fails on a turn without conversation, place or role."""
    bad = F.col("conv_id").isNull() | F.col("turn").isNull() | F.col("role").isNull()
    return turns.withColumn(
        "role",
        F.when(bad, F.raise_error(F.lit("a turn lacks conv_id, turn or role"))).otherwise(
            F.col("role")
        ),
    )


def number_turns(turns: DataFrame) -> DataFrame:
    """Add ``number`` from 1 and ``of``, the turns of the conversation."""
    numbered = conversations(turns).with_columns(number=position(), of=total_count())
    return numbered.df.withColumn("number", F.col("number") + 1)


def last_query_index(turns: DataFrame) -> DataFrame:
    """Per conversation, the 0-based index of the last real user query; the last index if none."""
    query = is_query(F.col("role"), F.col("content"))
    return (
        conversations(turns.select("conv_id", "turn", query.alias("_query")))
        .with_columns(_i=position())
        .df.groupBy("conv_id")
        .agg(
            F.coalesce(F.max(F.when(F.col("_query"), F.col("_i"))), F.max("_i")).alias(
                "last_query_index"
            )
        )
    )


def thinking_mode(turns: DataFrame, enable_thinking: bool = True) -> DataFrame:
    """Add ``mode``: the latest soft switch of a user or system turn decides, thinking if none.

    Thinking that is not enabled overrides all switches. A column
    ``enable_thinking`` says so for each conversation, at its last turn; where it
    is null or not given, the argument does.
    """
    switch = F.when(F.col("role").isin("user", "system"), text.soft_switch(F.col("content")))
    steps = {"_latest": running_last(F.col("_switch"))}
    enabled = F.lit(enable_thinking)
    if "enable_thinking" in turns.columns:
        steps["_flag"] = total(F.max, F.struct("turn", "enable_thinking"))
        enabled = F.coalesce(F.col("_flag.enable_thinking"), enabled)
    elif not enable_thinking:
        return turns.withColumn("mode", F.lit("non_thinking"))
    return (
        conversations(turns.withColumn("_switch", switch))
        .with_columns(**steps)
        .df.withColumn(
            "mode",
            F.when(~enabled | (F.col("_latest") == "no_think"), "non_thinking").otherwise("thinking"),
        )
        .drop("_switch", *steps)
    )


def qa_pairs(turns: DataFrame) -> DataFrame:
    """Each user turn with the assistant turn right after it: ``(conv_id, turn, prompt, answer)``."""
    # Two values, so that a user of the places alone does not pull the texts along.
    return (
        conversations(turns.select("conv_id", "turn", "role", "content"))
        .with_columns(
            _next=following(F.struct("role")), _reply=following(F.struct("content"), wide=True)
        )
        .df.where((F.col("role") == "user") & (F.col("_next.role") == "assistant"))
        .select(
            "conv_id",
            "turn",
            F.col("content").alias("prompt"),
            F.col("_reply.content").alias("answer"),
        )
    )


def loss_bearing_totals(turns: DataFrame) -> DataFrame:
    """Characters per conversation, and those of assistant turns."""
    n = F.length("content")
    return turns.groupBy("conv_id").agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("chars"),
        F.coalesce(F.sum(F.when(F.col("role") == "assistant", n)), F.lit(0)).alias("loss_chars"),
    )


def preset_lookup(turns: DataFrame, presets: DataFrame, enable_thinking: bool = True) -> DataFrame:
    """Sampling settings of every turn by its mode; ``presets`` has one row per mode.

    No turn is dropped: the job fails on a mode that has no preset.
    """
    named = presets.withColumn("_known", F.lit(True))
    found = thinking_mode(turns, enable_thinking).join(named, "mode", "left")
    missing = F.raise_error(F.concat(F.lit("no preset for mode "), F.col("mode")))
    return found.withColumn(
        "mode", F.when(F.col("_known").isNull(), missing.cast("string")).otherwise(F.col("mode"))
    ).drop("_known")


def control_token_scan(turns: DataFrame, column: str = "content", tokens: Iterable[str] = ADDED_TOKENS) -> DataFrame:
    """Uses of the added tokens in texts: ``(token, uses, turns)`` for those that occur."""
    found = turns.select(text.control_tokens(F.col(column), tokens).alias("_found"))
    return (
        found.select(
            F.explode(
                F.transform(
                    F.array_distinct("_found"),
                    lambda t: F.struct(
                        t.alias("token"),
                        (F.size("_found") - F.size(F.array_remove("_found", t))).alias("uses"),
                    ),
                )
            ).alias("_t")
        )
        .groupBy(F.col("_t.token").alias("token"))
        .agg(F.sum("_t.uses").alias("uses"), F.count(F.lit(1)).alias("turns"))
    )


def extract_tool_calls(turns: DataFrame) -> DataFrame:
    """Tool calls written in assistant texts, one row each: ``(conv_id, turn, call, name, arguments)``."""
    calls = turns.where(F.col("role") == "assistant").select(
        "conv_id", "turn", F.posexplode(text.tool_call_bodies(F.col("content"))).alias("call", "_body")
    )
    return calls.select(
        "conv_id",
        "turn",
        "call",
        F.get_json_object("_body", "$.name").alias("name"),
        F.get_json_object("_body", "$.arguments").alias("arguments"),
    )
