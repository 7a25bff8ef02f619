"""String rules on prompts and answers."""

from __future__ import annotations

import string
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from colloquy.functions.fixed import (
    ADDED_TOKENS,
    DEFAULT_SYSTEM_PROMPT,
    END_OF_THINKING_ID,
    EXIT_WORDS,
    SPECIAL_TOKENS,
    TASK_INSTRUCTIONS,
    WHITESPACE,
)
from colloquy.functions.tokens import longest_of


def strip(text: Column) -> Column:
    """Trim all Unicode white space, not only blanks."""
    return F.btrim(text, F.lit(WHITESPACE))


def strip_newlines(text: Column) -> Column:
    return F.btrim(text, F.lit("\n"))


def is_empty_turn(text: Column) -> Column:
    return F.length(strip(text)) == 0


def is_exit(text: Column) -> Column:
    """The whole turn is an exit word, in any case.

    No letter outside ASCII has one of the words' letters as its lower case.
    """
    word = strip(text)
    lower = F.translate(word, string.ascii_uppercase, string.ascii_lowercase)
    return F.coalesce(
        (F.length(word) <= max(map(len, EXIT_WORDS))) & lower.isin(EXIT_WORDS), F.lit(False)
    )


def chat_prompt(user: Column, system: Column | str = DEFAULT_SYSTEM_PROMPT) -> Column:
    """System turn, user turn and an open assistant turn."""
    system = F.lit(system) if isinstance(system, str) else system
    return F.concat(
        F.lit("<|im_start|>system\n"),
        system,
        F.lit("<|im_end|>\n<|im_start|>user\n"),
        user,
        F.lit("<|im_end|>\n<|im_start|>assistant\n"),
    )


def dispatch_prompt(kind: Column, text: Column, system: Column | str = DEFAULT_SYSTEM_PROMPT) -> Column:
    """Chat cases get the chat format, all others go in as they are."""
    return F.when(kind == "chat", chat_prompt(text, system)).otherwise(text)


def strip_special_tokens(text: Column, tokens: Iterable[str] = SPECIAL_TOKENS) -> Column:
    """Remove the special tokens; thinking, tool and fill-in markers stay. ``tokens`` may be a table of thousands."""
    return F.regexp_replace(text, F.lit(longest_of(tokens)), F.lit(""))


def control_tokens(text: Column, tokens: Iterable[str] = ADDED_TOKENS) -> Column:
    """All added tokens in a text, in order: at each place the longest."""
    return F.regexp_extract_all(text, F.lit(f"({longest_of(tokens)})"), 1)


def strip_echo(output: Column, prompt: Column) -> Column:
    """Cut the prompt off an output that repeats it, and trim."""
    rest = F.substring(output, F.length(prompt) + 1, F.length(output))
    return strip(F.when(F.startswith(output, prompt), rest).otherwise(output))


def reasoning_of(text: Column) -> Column:
    """Text up to the first ``</think>`` and after the last ``<think>`` in it; '' if none."""
    before = F.rtrim(F.substring_index(text, "</think>", 1), F.lit("\n"))
    return F.when(
        F.contains(text, F.lit("</think>")),
        F.ltrim(F.substring_index(before, "<think>", -1), F.lit("\n")),
    ).otherwise(F.lit(""))


def answer_of(text: Column) -> Column:
    """Text after the last ``</think>``; the whole text if there is none."""
    return F.when(
        F.contains(text, F.lit("</think>")),
        F.ltrim(F.substring_index(text, "</think>", -1), F.lit("\n")),
    ).otherwise(text)


def split_ids(ids: Column, marker: int = END_OF_THINKING_ID) -> tuple[Column, Column]:
    """Token ids up to and including the last marker, and those after it."""
    from_end = F.array_position(F.reverse(ids), F.lit(marker))
    cut = F.when(from_end == 0, F.lit(0)).otherwise(F.size(ids) - from_end + 1).cast("int")
    return F.slice(ids, F.lit(1), cut), F.slice(ids, cut + 1, F.size(ids))


def with_instruction(text: Column, task: Column) -> Column:
    """Append the answer-format instruction of the task; other tasks stay as they are."""
    instruction = F.when(task == "math", F.lit("\n" + TASK_INSTRUCTIONS["math"])).when(
        task == "choice", F.lit("\n" + TASK_INSTRUCTIONS["choice"])
    )
    return F.concat(text, F.coalesce(instruction, F.lit("")))


def boxed_answer(text: Column) -> Column:
    """Content of the last ``\\boxed{...}`` that is closed, with braces inside to any depth; null if none.

    A fold over the braces keeps where each open one stands. A brace after a
    backslash is text.
    """
    chunks = F.regexp_extract_all(text, F.lit(r"(?s)[^\\{}]*+(?:\\boxed\{|\\.|[{}])"), 0)  # each ends with a brace or an escape

    def step(state: Column, chunk: Column) -> Column:
        at, open_ = state["at"] + F.length(chunk), state["open"]
        opens = chunk.endswith("{") & ~chunk.endswith("\\{")
        closes = chunk.endswith("}") & ~chunk.endswith("\\}") & (F.size(open_) > 0)
        last = F.try_element_at(open_, F.lit(-1))
        boxed = closes & (last > 0)
        return F.struct(
            at.alias("at"),
            F.when(opens, F.concat(open_, F.array(F.when(chunk.endswith("\\boxed{"), at).otherwise(0))))
            .when(closes, F.slice(open_, F.lit(1), F.size(open_) - 1))
            .otherwise(open_)
            .alias("open"),
            F.when(boxed, last).otherwise(state["begins"]).alias("begins"),
            F.when(boxed, at - 1 - last).otherwise(state["size"]).alias("size"),
        )

    number = lambda n, name: F.lit(n).cast("int").alias(name)
    start = F.struct(number(0, "at"), F.array().cast("array<int>").alias("open"), number(-1, "begins"), number(0, "size"))
    found = F.aggregate(chunks, start, step, lambda s: F.when(s["begins"] >= 0, F.substring(text, s["begins"] + 1, s["size"])))
    return F.when(text.contains("\\boxed{"), found)


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _divisor(a: Column, b: Column) -> Column:
    """Greatest common divisor of numbers of at most 18 digits."""
    step = lambda s, _: F.when(s["b"] == 0, s).otherwise(F.struct(s["b"].alias("a"), F.try_mod(s["a"], s["b"]).alias("b")))
    pair = F.struct(F.abs(a).alias("a"), F.abs(b).alias("b"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(90)), pair, step, lambda s: s["a"])


def canonical_answer(answer: Column) -> Column:
    """One text for equal numbers: whole numbers, decimals, percentages and fractions become ``p`` or ``p/q`` in lowest terms.

    Numbers may have a sign, commas between thousands, and up to 17 digits;
    fractions are ``a/b`` or ``\\frac{a}{b}``. Any other answer loses white
    space, dollar signs and spacing commands only.
    """
    fraction = r"^([+-]?)(?:\\[dt]?frac\{([+-]?)(\d+)\}\{(\d+)\}|(\d+)/(\d+))$"
    decimal = r"^([+-]?)(?=\.?\d)(\d*)(?:\.(\d*))?(%?)$"

    def ungrouped(bare: Column) -> Column:
        grouped = bare.rlike(r"^[+-]?\d{1,3}(,\d{3})+(\.\d*)?%?$")
        return F.when(grouped, F.replace(bare, F.lit(","), F.lit(""))).otherwise(bare)

    def parts(bare: Column) -> Column:
        """Sign, digits above and below the line; null if the answer is no number."""
        either = lambda pattern, *groups: F.concat(*[F.regexp_extract(bare, pattern, n) for n in groups])
        places = F.length(either(decimal, 3)) + F.when(either(decimal, 4) == "%", 2).otherwise(0)
        digits = lambda sign, above, below: F.struct(
            sign.alias("sign"), F.ltrim(above, F.lit("0")).alias("above"), F.ltrim(below, F.lit("0")).alias("below")
        )
        return F.when(bare.rlike(fraction), digits(either(fraction, 1, 2), either(fraction, 3, 5), either(fraction, 4, 6))).when(
            bare.rlike(decimal), digits(either(decimal, 1), either(decimal, 2, 3), F.concat(F.lit("1"), F.repeat(F.lit("0"), places)))
        )

    def written(p: Column) -> Column:
        top, bottom = F.concat(F.lit("0"), p["above"]).try_cast("long"), p["below"].try_cast("long")
        part = lambda number, by: F.call_function("div", number, by)
        minus = F.when((F.replace(p["sign"], F.lit("+"), F.lit("")) == "-") & (top > 0), "-").otherwise("")
        under = lambda n: F.when(n > 1, F.concat(F.lit("/"), n.cast("string"))).otherwise("")
        short = (F.length(p["above"]) <= 17) & F.length(p["below"]).between(1, 18)
        value = _let(_divisor(top, bottom), lambda by: F.concat(minus, part(top, by).cast("string"), under(part(bottom, by))))
        return F.when(short, value)

    stripped = F.regexp_replace(answer, r"(?U)[\s$]|\\[,!;:]|\\(?:left|right)(?![a-zA-Z])|\\(?=%)", "")
    return _let(_let(stripped, ungrouped), lambda bare: F.coalesce(_let(parts(bare), written), bare))


def choice_answer(text: Column) -> Column:
    """Letter of the first ``"answer": "C"``; null if none."""
    letter = F.regexp_extract(text, r'"answer"\s*:\s*"([A-Z])"', 1)
    return F.when(letter != "", letter)


def soft_switch(text: Column) -> Column:
    """The last ``/think`` or ``/no_think`` in a text, without the slash; null if none."""
    switches = F.regexp_extract_all(text, F.lit(r"(?:^|\s)/(no_think|think)\b"), 1)
    return F.try_element_at(switches, F.lit(-1))


def tool_call_bodies(text: Column) -> Column:
    """JSON texts of the tool calls in an assistant text, in order."""
    pattern = r"(?s)<tool_call>\n(.*?)\n</tool_call>"
    return F.regexp_extract_all(text, F.lit(pattern), 1)
