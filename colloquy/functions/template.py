"""The pieces of a rendered prompt, one message at a time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from colloquy.functions.fixed import EMPTY_THINKING, TOOLS_INTRO, TOOLS_OUTRO
from colloquy.functions.text import strip_newlines

GENERATION_PROMPT = "<|im_start|>assistant\n"


def block(role: Column, text: Column) -> Column:
    """One message: opening mark and role, text, closing mark."""
    return F.concat(F.lit("<|im_start|>"), role, F.lit("\n"), text, F.lit("<|im_end|>\n"))


def tools_head(system_text: Column, tools: Column) -> Column:
    """The system block that lists the tools; ``system_text`` is null if there is none."""
    listing = F.array_join(F.transform(tools, lambda t: F.concat(F.lit("\n"), t)), "")
    return block(
        F.lit("system"),
        F.concat(
            F.coalesce(F.concat(system_text, F.lit("\n\n")), F.lit("")),
            F.lit(TOOLS_INTRO),
            listing,
            F.lit(TOOLS_OUTRO),
        ),
    )


def has_tools(tools: Column) -> Column:
    return F.coalesce(F.size(tools) > 0, F.lit(False))


def tool_call_text(calls: Column, answer: Column) -> Column:
    """The calls of an assistant turn, each on its own lines after the answer."""

    def one(call: Column, k: Column) -> Column:
        return F.concat(
            F.when((k > 0) | (answer != ""), F.lit("\n")).otherwise(F.lit("")),
            F.lit('<tool_call>\n{"name": "'),
            F.coalesce(call["name"], F.lit("")),
            F.lit('", "arguments": '),
            F.coalesce(call["arguments"], F.lit("null")),
            F.lit("}\n</tool_call>"),
        )

    return F.coalesce(F.array_join(F.transform(calls, one), ""), F.lit(""))


def assistant_plain(answer: Column, calls: Column) -> Column:
    """An assistant turn without its reasoning."""
    return block(F.lit("assistant"), F.concat(answer, calls))


def assistant_with_reasoning(reasoning: Column, answer: Column, calls: Column) -> Column:
    return block(
        F.lit("assistant"),
        F.concat(
            F.lit("<think>\n"),
            strip_newlines(reasoning),
            F.lit("\n</think>\n\n"),
            F.ltrim(answer, F.lit("\n")),
            calls,
        ),
    )


def tool_result(text: Column, opens: Column, closes: Column) -> Column:
    """A tool turn; a run of them shares one user block."""
    return F.concat(
        F.when(opens, F.lit("<|im_start|>user")).otherwise(F.lit("")),
        F.lit("\n<tool_response>\n"),
        text,
        F.lit("\n</tool_response>"),
        F.when(closes, F.lit("<|im_end|>\n")).otherwise(F.lit("")),
    )


def is_query(role: Column, content: Column) -> Column:
    """A user message that is text and not a wrapped tool result."""
    wrapped = F.startswith(content, F.lit("<tool_response>")) & F.endswith(
        content, F.lit("</tool_response>")
    )
    return F.coalesce((role == "user") & ~wrapped, F.lit(False))


def generation_prompt(enable_thinking: Column | bool = True) -> Column:
    """The open assistant turn; without thinking it starts with an empty block."""
    if isinstance(enable_thinking, bool):
        return F.lit(GENERATION_PROMPT + ("" if enable_thinking else EMPTY_THINKING))
    return F.when(enable_thinking.eqNullSafe(False), F.lit(GENERATION_PROMPT + EMPTY_THINKING)).otherwise(
        F.lit(GENERATION_PROMPT)
    )
