"""Generation over tables, sources and sinks."""

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from colloquy.functions.fixed import DEFAULT_SYSTEM_PROMPT
from colloquy.operators import answers, turns
from colloquy.operators.render import render_conversation
from colloquy.plans.shared import scratch_path
from colloquy.sources import datasets, dimensions
from colloquy.sources.messages import read_messages

C = F.col


def shouting():
    def make():
        def generate(prompts, settings):
            if any("bad" in p for p in prompts):
                raise RuntimeError("bad prompt")
            return [f"{p.upper()} {s.get('temperature')} {s.get('max_length')}" for p, s in zip(prompts, settings)]

        return generate

    return make


def test_one_bad_prompt_does_not_spoil_its_batch(spark):
    prompts = spark.createDataFrame([(i, "bad" if i == 3 else f"p{i}") for i in range(10)], "id long, prompt string")
    rows = answers.batch_generate(prompts.coalesce(1), shouting()).orderBy("id").collect()
    assert [r.id for r in rows if r.error] == [3]
    assert rows[3].output is None and rows[3].error == "RuntimeError: bad prompt"
    assert rows[4].output == "P4 None None" and all(r.elapsed_s >= 0 for r in rows)


def test_settings_reach_the_generator(spark):
    cases = answers.dispatch_prompts(answers.resolve_params(dimensions.literal_cases(spark)))
    rows = {r.name: r for r in answers.batch_generate(cases, shouting()).collect()}
    assert len(rows) == 5
    completion = [r for r in rows.values() if r.type == "generate"]
    assert len(completion) == 1 and completion[0].output.endswith(" 0.8 200")
    chats = [r for r in rows.values() if r.type == "chat"]
    assert all(r.output.endswith(" 0.7 512") for r in chats)
    assert all(r.prompt.startswith(f"<|im_start|>system\n{DEFAULT_SYSTEM_PROMPT}<|im_end|>\n") for r in chats)


def test_generator_runs_once_per_prompt(spark):
    plan = answers.batch_generate(spark.createDataFrame([("p",)], "prompt string"), shouting())
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("ArrowEvalPython") == 1 and "pythonUDF1" not in text


def test_output_loses_the_prompt(spark):
    prompt = "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\n"
    decoded = "user\nhi\nassistant\n yo <think>\n"
    df = spark.createDataFrame([(prompt, decoded)], "prompt string, output string")
    assert answers.clean_output(df).first().answer == "yo <think>"


def test_length_budget(spark):
    df = spark.createDataFrame([(5,), (100,), (40000,)], "n int")
    rows = answers.length_budget(df, C("n"), max_length=60, max_new=30).orderBy("n").collect()
    assert [(r.room, r.fits) for r in rows] == [(30, True), (0, False), (0, False)]
    rows = answers.length_budget(df, C("n")).orderBy("n").collect()
    assert [r.room for r in rows] == [32763, 32668, 0]


def test_bad_json_records_are_kept_aside(spark):
    path = scratch_path(spark, "json")
    good = {"pair_id": "1", "prompt": "p\nq", "chosen": "c", "rejected": None}
    lines = [json.dumps(good), '{"pair_id": ', "[1"]
    spark.createDataFrame([(v,) for v in lines], "value string").write.text(path)
    rows = datasets.read_json_dataset(spark, path).collect()
    bad = [r for r in rows if r._corrupt is not None]
    assert sorted(r._corrupt for r in bad) == sorted(lines[1:])
    (kept,) = [r for r in rows if r._corrupt is None]
    assert (kept.pair_id, kept.prompt, kept.chosen, kept.rejected) == ("1", "p\nq", "c", None)


def test_json_array_file(spark, tmp_path):
    records = [{"pair_id": str(i), "prompt": "p", "chosen": "c", "rejected": "r"} for i in range(3)]
    (tmp_path / "all.json").write_text(json.dumps(records, indent=1))
    rows = datasets.read_json_dataset(spark, str(tmp_path / "all.json"), multi_line=True).collect()
    assert sorted(r.pair_id for r in rows) == ["0", "1", "2"]


def test_report_is_written_once(spark):
    df = spark.createDataFrame([("a", "out", None, 0.5)], "name string, output string, error string, elapsed_s double")
    report = datasets.write_report(df, scratch_path(spark, "report"))
    assert report.schema == df.schema and report.collect() == df.collect()


def test_dimensions(spark):
    tokens = {r.token: r for r in dimensions.special_tokens(spark).collect()}
    assert len(tokens) == 26 and sum(r.special for r in tokens.values()) == 14
    assert tokens["<|im_end|>"].id == 151645 and tokens["</think>"].id == 151668
    presets = {r["mode"]: tuple(r)[1:] for r in dimensions.sampling_presets(spark).collect()}
    assert presets == {"thinking": (0.6, 0.95, 20, 0.0), "non_thinking": (0.7, 0.8, 20, 0.0)}


def test_sweep_passes_its_temperatures_on(spark):
    df = answers.config_sweep(spark.createDataFrame([("p",)], "prompt string"))
    assert [(r.config, r.temperature) for r in df.collect()] == [("low", 0.1), ("medium", 0.7), ("high", 1.0)]


def test_turns_without_a_place_stop_the_job(spark):
    df = spark.createDataFrame([(1, 0, "user"), (1, None, "user")], "conv_id long, turn long, role string")
    with pytest.raises(PySparkException, match="lacks"):
        turns.require_valid_turns(df).collect()
    assert turns.require_valid_turns(df.where("turn is not null")).count() == 1


def test_hard_switch_overrides(spark):
    df = spark.createDataFrame([(1, 0, "user", "x /think")], "conv_id long, turn long, role string, content string")
    assert turns.thinking_mode(df).first()["mode"] == "thinking"
    assert turns.thinking_mode(df, enable_thinking=False).first()["mode"] == "non_thinking"


def test_configuration_files(spark, tmp_path):
    flags = {"lstrip": False, "normalized": False, "rstrip": True, "single_word": False}
    tokens = {"7": {"content": "<a>", "special": True, **flags}, "8": {"content": "<b>", "special": False, **flags}}
    (tmp_path / "t.json").write_text(json.dumps({"x": 1, "added_tokens_decoder": tokens}, indent=1))
    rows = dimensions.read_added_tokens(spark, str(tmp_path / "t.json")).orderBy("id").collect()
    assert [(r.id, r.token, r.rstrip, r.lstrip, r.special) for r in rows] == [
        (7, "<a>", True, False, True),
        (8, "<b>", True, False, False),
    ]
    (tmp_path / "g.json").write_text(json.dumps({"temperature": 0.6, "top_k": 20, "eos_token_id": [1, 2]}, indent=1))
    (row,) = dimensions.read_generation_config(spark, str(tmp_path / "g.json")).collect()
    assert (row.temperature, row.top_k, row.top_p, row.eos_token_id) == (0.6, 20, None, [1, 2])


def test_messages_keep_the_spelling_of_tools_and_arguments(spark):
    path = scratch_path(spark, "messages")
    calls = [
        {"function": {"name": "f", "arguments": {"b": [1, 2], "a": "ä"}}},
        {"name": "g", "arguments": '{"x":1}'},
    ]
    record = {
        "conv_id": 7,
        "tools": [{"type": "function", "name": "f"}],
        "messages": [
            {"role": "user", "content": "hi"},
            {"role": "assistant", "content": ["no text"], "tool_calls": calls},
            {"role": "user", "content": "more"},
        ],
    }
    lines = [json.dumps(record), '{"conv_id": 8}', "nonsense"]
    spark.createDataFrame([(v,) for v in lines], "value string").write.text(path)
    read, bad = read_messages(spark, path)
    assert sorted(r.value for r in bad.collect()) == sorted(lines[1:])
    prompt = render_conversation(read).first().prompt
    assert '\n{"type": "function", "name": "f"}\n</tools>' in prompt
    assert prompt.endswith(
        "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\n"
        '<tool_call>\n{"name": "f", "arguments": {"b": [1, 2], "a": "ä"}}\n</tool_call>\n'
        '<tool_call>\n{"name": "g", "arguments": {"x":1}}\n</tool_call><|im_end|>\n'
        "<|im_start|>user\nmore<|im_end|>\n"
    )


def lines(spark, records):
    path = scratch_path(spark, "lines")
    spark.createDataFrame([(json.dumps(r) if not isinstance(r, str) else r,) for r in records], "value string").write.text(path)
    return path


def test_ids_of_another_kind_are_set_aside(spark):
    said = [{"role": "user", "content": "hi"}]
    odd = [1.0, True, "7", None, 1 << 63, -(1 << 63) - 1, [1]]
    path = lines(spark, [{"conv_id": i, "messages": said} for i in [3, -(1 << 63), *odd]] + [{"messages": said}, "{", "3"])
    read, bad = read_messages(spark, path)
    assert sorted(r.conv_id for r in read.collect()) == [-(1 << 63), 3]
    assert bad.count() == len(odd) + 3


def test_records_with_another_key_or_none(spark):
    said = [{"role": "user", "content": "hi"}, {"role": "assistant", "content": "ho"}]
    path = lines(spark, [{"name": "a", "messages": said}, {"name": 5, "messages": said}])
    read, bad = read_messages(spark, path, key="name", kind="string")
    assert [(r.conv_id, r.turn) for r in read.orderBy("turn").collect()] == [("a", 0), ("a", 1)] and bad.count() == 1
    path = lines(spark, [{"messages": said}, {"messages": said}, {"messages": said[:1]}, {"messages": 3}])
    read, bad = read_messages(spark, path, key=None)
    assert read.count() == 3 and read.select("conv_id").distinct().count() == 2 and bad.count() == 1


def test_json_functions_do_not_tell_text_from_objects(spark):
    calls = [{"name": "f", "arguments": '{"k":1}'}, {"name": "f", "arguments": {"k": 1}}]
    record = {"conv_id": 1, "messages": [{"role": "assistant", "content": "", "tool_calls": calls}]}
    path = lines(spark, [record])
    (row,) = read_messages(spark, path)[0].collect()
    assert [c.arguments for c in row.tool_calls] == ['{"k":1}', '{"k": 1}']
    kind = "messages array<struct<tool_calls: array<struct<arguments: string>>>>"
    (plain,) = spark.read.text(path).select(F.from_json("value", kind).alias("r")).collect()
    assert len({c.arguments for c in plain.r.messages[0].tool_calls}) == 1
