"""String rules against plain Python."""

import pytest
from pyspark.sql import functions as F

from colloquy.functions import text
from colloquy.functions.fixed import ADDED_TOKENS, PLAIN_TOKENS, SPECIAL_TOKENS, WHITESPACE

C = F.col


def apply(spark, values, function, type_="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i long, x {type_}")
    return [r[0] for r in df.orderBy("i").select(function(C("x"))).collect()]


STRINGS = ["", " ", "a", " a b ", "　a ", "\x1c\x1fa\x85\xa0", "a\n", "\n\n a \t\r\x0b\x0c", "​a​", "﻿a"]


def test_strip_is_python_strip(spark):
    assert apply(spark, STRINGS, text.strip) == [s.strip() for s in STRINGS]


def test_whitespace_is_what_python_strips():
    assert sorted(WHITESPACE) == [chr(c) for c in range(0x110000) if not chr(c).strip()]


def test_exit_words(spark):
    values = ["quit", " EXIT\n", "退出", "Quit!", "", None, "exit now", "　qUiT"]
    expected = [v is not None and v.strip().lower() in ("quit", "exit", "退出") for v in values]
    assert apply(spark, values, text.is_exit) == expected


def split_python(content):
    if "</think>" not in content:
        return "", content
    reasoning = content.split("</think>")[0].rstrip("\n").split("<think>")[-1].lstrip("\n")
    return reasoning, content.split("</think>")[-1].lstrip("\n")


THOUGHTS = [
    "plain",
    "<think>\nr\n</think>\n\na",
    "a<think>b<think>\n\nc\n\n</think>x</think>\n\ny",
    "</think>",
    "r</think>",
    "<think>open",
    "\n<think> \n r \n </think> a",
]


def test_reasoning_and_answer(spark):
    expected = [split_python(t) for t in THOUGHTS]
    assert apply(spark, THOUGHTS, text.reasoning_of) == [e[0] for e in expected]
    assert apply(spark, THOUGHTS, text.answer_of) == [e[1] for e in expected]


@pytest.mark.parametrize("ids", [[1, 2], [9], [9, 1], [1, 9], [1, 9, 2, 9, 3], []])
def test_split_ids(spark, ids):
    try:
        cut = len(ids) - ids[::-1].index(9)
    except ValueError:
        cut = 0
    df = spark.createDataFrame([(ids,)], "ids array<int>")
    assert tuple(df.select(*text.split_ids(C("ids"), 9)).first()) == (ids[:cut], ids[cut:])


def test_special_tokens_go_and_plain_ones_stay(spark):
    assert len(SPECIAL_TOKENS) == 14 and len(PLAIN_TOKENS) == 12
    whole = "a".join(ADDED_TOKENS)
    (clean,) = apply(spark, [whole], text.strip_special_tokens)
    assert clean == "a" * 14 + "a".join(PLAIN_TOKENS)
    assert apply(spark, [whole], text.control_tokens) == [ADDED_TOKENS]


def test_echo(spark):
    df = spark.createDataFrame(
        [("ab c", "ab"), ("xab", "ab"), ("ab", "ab"), ("  ", "ab")], "o string, p string"
    )
    got = [r[0] for r in df.select(text.strip_echo(C("o"), C("p"))).collect()]
    assert got == ["c", "xab", "", ""]


def test_boxed_answers(spark):
    values = [
        r"\boxed{1} and \boxed{\frac{1}{2}}",
        r"\boxed{}",
        "none",
        r"\boxed{open",
        r"\boxed{1",
        "\\boxed{" + "x" * 200_000 + "}",
        "\\boxed{" + "{a}b" * 20_000 + "}",
    ]
    got = apply(spark, values, text.boxed_answer)
    assert got[:5] == [r"\frac{1}{2}", "", None, None, None]
    assert len(got[5]) == 200_000 and len(got[6]) == 80_000


def test_choices(spark):
    values = ['x "answer": "B"', '"answer" :  "C" "answer": "D"', '"answer": "b"', ""]
    assert apply(spark, values, text.choice_answer) == ["B", "C", None, None]


def test_soft_switch(spark):
    values = ["/think", "a /no_think", "/think x /no_think", "/no_think /think", "a/think", "/thinking", None]
    expected = ["think", "no_think", "no_think", "think", None, None, None]
    assert apply(spark, values, text.soft_switch) == expected


def test_tool_calls_on_long_texts(spark):
    body = '{"name": "f", "arguments": {"a": "' + "x\n" * 50_000 + '"}}'
    value = f"a<tool_call>\n{body}\n</tool_call>\n<tool_call>\n{{}}\n</tool_call><tool_call>x</tool_call>"
    assert apply(spark, [value], text.tool_call_bodies) == [[body, "{}"]]


def plain_longest(value, tokens):
    out, at = [], 0
    while at < len(value):
        best = max((t for t in tokens if t and value.startswith(t, at)), key=len, default=None)
        if best is not None:
            out.append(best)
        at += len(best or "x")
    return out


def test_longest_token_of_any_table(spark):
    import random
    import re

    from colloquy.functions.tokens import longest_of

    chance = random.Random(4)
    for letters in ("ab", "<|>x\\]^-", "abcdefghijklmnop𝒳é你"):
        tokens = {"".join(chance.choice(letters) for _ in range(chance.randint(0, 5))) for _ in range(60)}
        values = ["".join(chance.choice(letters) for _ in range(50)) for _ in range(40)] + [""]
        want = [plain_longest(v, tokens) for v in values]
        assert [re.findall(longest_of(tokens), v) for v in values] == want
        assert apply(spark, values, lambda c: text.control_tokens(c, tokens)) == want
        gone = apply(spark, values, lambda c: text.strip_special_tokens(c, tokens))
        assert gone == [re.sub(longest_of(tokens), "", v) for v in values]
    assert apply(spark, ["abc"], lambda c: text.control_tokens(c, [])) == [[]]
    long = "y" * 3000
    assert apply(spark, [long + "z" + long[:-1]], lambda c: text.control_tokens(c, [long, "z"])) == [[long, "z"]]


def test_boxed_answers_at_any_depth(spark):
    deep = lambda n: r"\sqrt{" * n + "x" + "}" * n
    cases = {
        r"so \boxed{" + deep(3) + "}.": deep(3),
        r"\boxed{" + deep(2000) + "}": deep(2000),
        r"\boxed{1} then \boxed{\frac{1}{\sqrt{2}}} end": r"\frac{1}{\sqrt{2}}",
        r"\boxed{a \boxed{b} c}": r"a \boxed{b} c",
        r"\boxed{open \boxed{3}": "3",
        r"\boxed{\{1, 2\}}": r"\{1, 2\}",
        r"\boxed{\{}": r"\{",
        r"\boxed{7} and \boxed{never": "7",
        r"} \boxed{8}": "8",
        r"\\boxed{9}": None,
        r"boxed{9} \box{2}": None,
        "\\boxed{é𝒳{\n}}": "é𝒳{\n}",
        "": None,
    }
    assert apply(spark, list(cases), text.boxed_answer) == list(cases.values())
    assert apply(spark, [None], text.boxed_answer) == [None]


def test_canonical_answers(spark):
    cases = {
        "1/2": "1/2", "0.5": "1/2", r"\frac{1}{2}": "1/2", r"$\dfrac{2}{4}$": "1/2", ".50": "1/2", "50%": "1/2", r"50\%": "1/2", "007/14": "1/2",
        "-0.5": "-1/2", r"-\frac{1}{2}": "-1/2", r"\frac{-1}{2}": "-1/2", r"-\frac{-1}{2}": "1/2", "+3": "3", "3.0": "3", "3.": "3", "003": "3",
        "1,234,567": "1234567", "1,234.50": "2469/2", "1,23": "1,23", "0": "0", "-0.0": "0", "0/7": "0", "7/0": "7/0", "12345678901234567": "12345678901234567",
        "123456789012345678901": "123456789012345678901", "0.00000000000000001": "1/100000000000000000", " x + 1 ": "x+1", r"\left( 1,\, 2 \right)": "(1,2)",
        "": "", ".": ".", "-": "-", "%": "%", "1e5": "1e5", "6/4": "3/2", "99999999999999999/99999999999999999": "1",
    }
    assert apply(spark, list(cases), text.canonical_answer) == list(cases.values())
    assert apply(spark, [None], text.canonical_answer) == [None]
