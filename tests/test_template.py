"""Prompts traced by hand from the format's rules."""

import pytest

from colloquy.functions.fixed import TOOLS_INTRO, TOOLS_OUTRO
from colloquy.operators.render import (
    history_examples,
    history_spans,
    render_conversation,
    render_in_cells,
    sft_examples,
)

SCHEMA = (
    "conv_id long, turn long, role string, content string, reasoning_content string, "
    "tool_calls array<struct<name: string, arguments: string>>, tools array<string>"
)
TOOLS = ['{"name": "f"}', '{"name": "g"}']
HEAD = TOOLS_INTRO + '\n{"name": "f"}\n{"name": "g"}' + TOOLS_OUTRO + "<|im_end|>\n"


def turns(spark, *messages, tools=None):
    rows = []
    for turn, message in enumerate(messages):
        role, content, *rest = message
        aside, calls = (list(rest) + [None, None])[:2]
        rows.append((1, turn * 3, role, content, aside, calls, tools))
    return spark.createDataFrame(rows, SCHEMA)


def prompt(spark, *messages, tools=None, **options):
    rows = render_conversation(turns(spark, *messages, tools=tools), **options).collect()
    assert len(rows) == 1 and rows[0].prompt_start == 0
    return rows[0].prompt


USER = "<|im_start|>user\nhi<|im_end|>\n"

CASES = {
    "no system": ([("user", "hi")], USER),
    "system first": (
        [("system", "s"), ("user", "hi")],
        "<|im_start|>system\ns<|im_end|>\n" + USER,
    ),
    "second system": (
        [("system", "s"), ("user", "hi"), ("system", "t")],
        "<|im_start|>system\ns<|im_end|>\n" + USER + "<|im_start|>system\nt<|im_end|>\n",
    ),
    "last answer gets an empty block": (
        [("user", "hi"), ("assistant", "\n\nyo")],
        USER + "<|im_start|>assistant\n<think>\n\n</think>\n\nyo<|im_end|>\n",
    ),
    "reasoning before the last query goes": (
        [("user", "hi"), ("assistant", "<think>\nr\n</think>\n\nyo"), ("user", "hi")],
        USER + "<|im_start|>assistant\nyo<|im_end|>\n" + USER,
    ),
    "several closing marks": (
        [("user", "hi"), ("assistant", "x<think>\n\na<think>b\n</think>lost</think>\nyo")],
        USER + "<|im_start|>assistant\n<think>\nb\n</think>\n\nyo<|im_end|>\n",
    ),
    "null content": (
        [("user", None), ("assistant", None), ("user", "hi")],
        "<|im_start|>user\n<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n" + USER,
    ),
    "null user content is no query, so nothing comes after the last one": (
        [("user", None), ("assistant", "<think>\nr\n</think>\n\nyo")],
        "<|im_start|>user\n<|im_end|>\n<|im_start|>assistant\nyo<|im_end|>\n",
    ),
    "unknown role": ([("note", "n"), ("user", "hi"), (None, "n")], USER),
    "separate reasoning wins": (
        [("user", "hi"), ("assistant", "a</think>b", "\nr\n")],
        USER + "<|im_start|>assistant\n<think>\nr\n</think>\n\na</think>b<|im_end|>\n",
    ),
    "tool results in a row": (
        [
            ("user", "hi"),
            ("assistant", "<think>\nr\n</think>\n\ncall", None, [("f", '{"a": 1}'), ("g", "{}")]),
            ("tool", "one"),
            ("tool", "two"),
            ("assistant", "end"),
        ],
        USER
        + "<|im_start|>assistant\n<think>\nr\n</think>\n\ncall\n"
        + '<tool_call>\n{"name": "f", "arguments": {"a": 1}}\n</tool_call>\n'
        + '<tool_call>\n{"name": "g", "arguments": {}}\n</tool_call><|im_end|>\n'
        + "<|im_start|>user\n<tool_response>\none\n</tool_response>"
        + "\n<tool_response>\ntwo\n</tool_response><|im_end|>\n"
        + "<|im_start|>assistant\n<think>\n\n</think>\n\nend<|im_end|>\n",
    ),
    "calls without text": (
        [("user", "hi"), ("assistant", "", None, [("f", "{}"), ("g", "{}")]), ("user", "hi")],
        USER
        + '<|im_start|>assistant\n<tool_call>\n{"name": "f", "arguments": {}}\n</tool_call>\n'
        + '<tool_call>\n{"name": "g", "arguments": {}}\n</tool_call><|im_end|>\n'
        + USER,
    ),
    "a wrapped tool result is no query": (
        [
            ("user", "hi"),
            ("assistant", "<think>r</think>a"),
            ("user", "<tool_response>x</tool_response>"),
            ("assistant", "b"),
        ],
        USER
        + "<|im_start|>assistant\n<think>\nr\n</think>\n\na<|im_end|>\n"
        + "<|im_start|>user\n<tool_response>x</tool_response><|im_end|>\n"
        + "<|im_start|>assistant\n<think>\n\n</think>\n\nb<|im_end|>\n",
    ),
    "tool first": (
        [("tool", "x"), ("user", "hi")],
        "<|im_start|>user\n<tool_response>\nx\n</tool_response><|im_end|>\n" + USER,
    ),
}


@pytest.mark.parametrize("case", CASES)
def test_prompt(spark, case):
    messages, expected = CASES[case]
    assert prompt(spark, *messages) == expected


@pytest.mark.parametrize("case", CASES)
def test_prompt_of_a_cut_conversation(spark, cutting, case):
    messages, expected = CASES[case]
    assert prompt(spark, *messages) == expected


def test_tools_without_system(spark):
    assert prompt(spark, ("user", "hi"), tools=TOOLS) == "<|im_start|>system\n" + HEAD + USER


def test_tools_with_system(spark):
    assert (
        prompt(spark, ("system", "s"), ("user", "hi"), tools=TOOLS)
        == "<|im_start|>system\ns\n\n" + HEAD + USER
    )


def test_empty_list_of_tools(spark):
    assert prompt(spark, ("system", "s"), tools=[]) == "<|im_start|>system\ns<|im_end|>\n"


def test_generation_prompt(spark):
    opened = USER + "<|im_start|>assistant\n"
    assert prompt(spark, ("user", "hi"), add_generation_prompt=True) == opened
    assert (
        prompt(spark, ("user", "hi"), add_generation_prompt=True, enable_thinking=False)
        == opened + "<think>\n\n</think>\n\n"
    )


def test_cells_join_to_the_prompt(spark):
    messages = [("user", "a" * 50), ("assistant", "b" * 70)] * 20
    whole = prompt(spark, *messages)
    cells = render_in_cells(turns(spark, *messages), cell_chars=300).orderBy("prompt_start")
    rows = cells.collect()
    assert len(rows) > 5
    assert "".join(r.prompt for r in rows) == whole
    assert all(whole[r.prompt_start :].startswith(r.prompt) for r in rows)


def test_order_of_input_rows_does_not_matter(spark):
    messages = CASES["tool results in a row"][0]
    shuffled = turns(spark, *messages).orderBy("content").repartition(3)
    assert render_conversation(shuffled).first().prompt == CASES["tool results in a row"][1]


def test_loss_spans_lie_on_the_answers(spark):
    messages = CASES["tool results in a row"][0]
    whole = prompt(spark, *messages)
    spans = sft_examples(turns(spark, *messages)).collect()
    assert len(spans) == 2
    for s in spans:
        assert whole[s.loss_start : s.loss_start + s.loss_chars] == s.segment


def test_history_depends_on_the_query_before(spark):
    messages = [
        ("user", "hi"),
        ("assistant", "<think>r</think>a"),
        ("assistant", "b"),
        ("user", "hi"),
        ("assistant", "c"),
    ]
    rows = {r.turn: r for r in history_examples(turns(spark, *messages)).collect()}
    opened = "<|im_start|>assistant\n"
    kept = opened + "<think>\nr\n</think>\n\na<|im_end|>\n"
    assert rows[3].prompt == USER + opened
    assert rows[6].prompt == USER + kept + opened
    assert (
        rows[12].prompt
        == USER + opened + "a<|im_end|>\n" + opened + "b<|im_end|>\n" + USER + opened
    )
    assert [rows[t].response for t in (3, 6, 12)] == ["<think>r</think>a", "b", "c"]


@pytest.mark.parametrize("hot", ["4", "1000"])
def test_long_histories_have_whole_prompts(spark, hot):
    from colloquy.plans.ordered_groups import HOT_ROWS_SETTING

    spark.conf.set(HOT_ROWS_SETTING, hot)
    try:
        messages = [("user", "hi"), ("assistant", "x" * 250_000)] * 6
        rows = {r.turn: r for r in history_examples(turns(spark, *messages)).collect()}
    finally:
        spark.conf.unset(HOT_ROWS_SETTING)
    assert len(rows) == 6 and max(len(r.prompt) for r in rows.values()) > 1 << 20
    said = USER + "<|im_start|>assistant\n" + "x" * 250_000 + "<|im_end|>\n"
    assert rows[max(rows)].prompt == said * 5 + USER + "<|im_start|>assistant\n"


def test_long_conversation_is_one_row(spark):
    messages = [("user", "y" * 1_000_000)] * 18
    (row,) = render_conversation(turns(spark, *messages)).collect()
    assert row.prompt_start == 0 and len(row.prompt) > 17 * 1024 * 1024


def test_spans_make_the_prompts(spark):
    messages = [
        ("user", "hi"), ("assistant", "<think>r</think>a"), ("assistant", "b"), ("tool", "t"), ("assistant", "<think>s</think>c"),
        ("user", "again"), ("assistant", "d"), ("assistant", "e"), ("system", "x"), ("assistant", "f"),
    ]
    for some in (messages, messages[1:5], messages[5:], messages[:1], messages[1:3] * 3):
        chat = turns(spark, *some)
        sizes = {r.turn: r.short_chars + r.long_chars + r.before_chars + r.ending_chars for r in history_spans(chat).collect()}
        assert sizes == {r.turn: len(r.prompt) for r in history_examples(chat).collect()}


def test_spans_are_linear_in_the_turns(spark):
    import time

    def seconds(n):
        rows = spark.range(n).selectExpr("1L AS conv_id", "id AS turn", "if(id % 2 = 0, 'user', 'assistant') AS role", "concat('t', id) AS content")
        began = time.time()
        assert history_spans(rows).count() == n // 2
        return time.time() - began

    seconds(100)
    assert seconds(9001) < 10


def test_thinking_column_ends_the_prompt_of_its_turn(spark):
    from pyspark.sql import functions as F

    chat = turns(spark, ("user", "hi"), ("assistant", "a"), ("user", "hi"), ("assistant", "b")).withColumn("enable_thinking", F.col("turn") < 5)
    prompts = [r.prompt for r in history_examples(chat).orderBy("turn").collect()]
    assert [p.endswith("</think>\n\n") for p in prompts] == [False, True]
