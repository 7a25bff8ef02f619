"""The registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from colloquy.functions import template, text
from colloquy.operators import answers, candidates, corpus, ledger, preferences, render, sequences, turns, uncertainty
from colloquy.plans.shared import scratch_path
from colloquy.sources import datasets, dimensions, messages
from colloquy.sources.tables import read_table, read_turns
from colloquy.streaming import latency, ordering, sessions
from workload import inputs

C = F.col
Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
ONCE = {"availableNow": True}


def query(run: Query) -> Query:
    REGISTRY[run.__name__] = run
    return run


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Six digits: sums of doubles differ in the last ones with the order of addition."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


# Sources, sinks and dimensions


@query
def json_dataset_scan(spark, sf_dir):
    pairs = inputs.preference_candidates(spark, sf_dir)
    pair_id = F.concat_ws("-", C("conv_id").cast("string"), C("turn").cast("string"))
    record = F.to_json(F.struct(pair_id.alias("pair_id"), "prompt", "chosen", "rejected"))
    broken = F.when(C("rejected").isNull(), F.lit('{"pair_id": '))
    lines = pairs.select(F.explode(F.array_compact(F.array(record, broken))).alias("value"))
    path = scratch_path(spark, "preferences")
    lines.write.text(path)
    return datasets.read_json_dataset(spark, path).select(
        "pair_id", "prompt", "chosen", "rejected", C("_corrupt").isNotNull().alias("is_bad")
    )


@query
def json_array_scan(spark, sf_dir):
    """The same records as elements of arrays, one array per file, read as many objects of few files."""
    pairs = inputs.preference_candidates(spark, sf_dir)
    pair_id = F.concat_ws("-", C("conv_id").cast("string"), C("turn").cast("string"))
    record = F.to_json(F.struct(pair_id.alias("pair_id"), "prompt", "chosen", "rejected"))
    odd = F.when(C("rejected").isNull(), F.lit('"no {record}"'))
    elements = pairs.select(
        F.floor(C("conv_id") / 1000).alias("file"), "conv_id", "turn", F.posexplode(F.array_compact(F.array(record, odd))).alias("n", "element")
    )
    along = Window.partitionBy("file").orderBy("conv_id", "turn", "n")
    is_first, is_last = F.lag("n").over(along).isNull(), F.lead("n").over(along).isNull()
    value = F.concat(F.when(is_first, "[").otherwise(", "), "element", F.when(is_last, "]").otherwise(""))
    path = scratch_path(spark, "arrays")
    elements.select("file", value.alias("value")).write.partitionBy("file").text(path)
    return datasets.read_json_dataset(spark, f"{path}/*", multi_line=True).select(
        "pair_id", "prompt", "chosen", "rejected", C("_corrupt").isNotNull().alias("is_bad")
    )


@query
def test_cases(spark, sf_dir):
    setting = [F.try_element_at("params", F.lit(n)).alias(n) for n in ("max_length", "temperature")]
    return inputs.cases(spark, sf_dir).select("name", "input", "type", *setting)


@query
def cap_rows(spark, sf_dir):
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "source")
    return corpus.cap_rows(documents, 500, "doc_id", seed="7")


@query
def special_token_dim(spark, sf_dir):
    uses = turns.control_token_scan(inputs.rendered(spark, sf_dir), "prompt")
    tokens = dimensions.special_tokens(spark)
    # uses has at most one row per token of the dimension
    return tokens.join(F.broadcast(uses), "token", "left").select(
        "id", "token", "special", F.coalesce("uses", F.lit(0)).alias("uses")
    )


@query
def sampling_presets(spark, sf_dir):
    per_mode = (
        turns.thinking_mode(inputs.chat_marked(spark, sf_dir))
        .groupBy("mode")
        .agg(F.count(F.lit(1)).alias("turns"))
    )
    presets = dimensions.sampling_presets(spark)
    return presets.join(per_mode, "mode", "left").withColumn(
        "turns", F.coalesce("turns", F.lit(0))
    )


def stub_generator():
    """A stand-in for loading a model; nested so that workers get it by value."""

    def make_generator():
        import hashlib

        def generate(prompts, settings):
            if any("z" in p for p in prompts):
                raise ValueError("no z please")
            return [f"reply {len(p)} {hashlib.md5(p.encode()).hexdigest()}" for p in prompts]

        return generate

    return make_generator


@query
def run_report(spark, sf_dir):
    cases = answers.dispatch_prompts(answers.resolve_params(inputs.cases(spark, sf_dir)))
    answered = answers.batch_generate(cases, stub_generator())
    report = datasets.write_report(
        answered.select("name", "output", "error", "elapsed_s"), scratch_path(spark, "report")
    )
    return report.select("name", "output", "error", (C("elapsed_s") >= 0).alias("timed"))


@query
def messages_scan(spark, sf_dir):
    """Conversations written as lists of messages, read back as turns with all their fields.

    Half of the conversations wrap calls in ``function`` and have arguments as
    text, the others have them as objects.
    """
    chat = inputs.chat_marked(spark, sf_dir)
    wraps = C("conv_id") % 2 == 0
    text_of = lambda value: F.regexp_extract(F.to_json(F.struct(value.alias("v"))), r"(?s)^\{\"v\":(.*)\}$", 1)
    plain = lambda c: F.concat(F.lit('{"name": '), text_of(c["name"]), F.lit(', "arguments": '), c["arguments"], F.lit("}"))
    wrapped = lambda c: F.concat(
        F.lit('{"type": "function", "function": {"name": '), text_of(c["name"]), F.lit(', "arguments": '), text_of(c["arguments"]), F.lit("}}")
    )
    calls = F.array_join(F.transform("tool_calls", lambda c: F.when(wraps, wrapped(c)).otherwise(plain(c))), ", ")
    fields = F.rtrim(F.to_json(F.struct("role", "content", "reasoning_content")), F.lit("}"))
    message = F.concat(fields, F.coalesce(F.concat(F.lit(', "tool_calls": ['), calls, F.lit("]")), F.lit("")), F.lit("}"))
    lists = chat.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", message.alias("m")))).alias("sorted"), F.first("tools").alias("tools")
    )
    tools = F.coalesce(F.concat(F.lit(', "tools": ['), F.array_join("tools", ", "), F.lit("]")), F.lit(""))
    record = F.concat(
        F.lit('{"conversation": '), C("conv_id").cast("string"), F.lit(', "messages": ['),
        F.array_join(F.transform("sorted", lambda x: x["m"]), ", "), F.lit("]"), tools, F.lit("}"),
    )
    path = scratch_path(spark, "messages")
    lists.select(record.alias("value")).write.text(path)
    turns_read, _ = messages.read_messages(spark, path, key="conversation")
    shown = F.array_join(F.transform("tool_calls", lambda c: F.concat_ws("=", c["name"], c["arguments"])), ";")
    return turns_read.select(
        "conv_id", "turn", "role", "content", "reasoning_content", shown.alias("calls"), F.array_join("tools", "\n").alias("tools")
    )


# Projections and filters


@query
def dispatch_prompts(spark, sf_dir):
    return answers.dispatch_prompts(inputs.cases(spark, sf_dir)).select("name", "prompt")


@query
def resolve_params(spark, sf_dir):
    return answers.resolve_params(inputs.cases(spark, sf_dir)).select(
        "name", "max_length", "temperature", "top_p", "do_sample"
    )


@query
def drop_empty_turns(spark, sf_dir):
    return turns.drop_empty_turns(inputs.exit_turns(spark, sf_dir))


@query
def take_until_exit(spark, sf_dir):
    return turns.take_until_exit(inputs.exit_turns(spark, sf_dir))


@query
def validate_turns(spark, sf_dir):
    return turns.validate_turns(inputs.chat_marked(spark, sf_dir))


# Strings


def user_prompts(spark, sf_dir):
    return (
        read_turns(spark, sf_dir)
        .where(C("role") == "user")
        .select("conv_id", "turn", text.chat_prompt(C("content")).alias("prompt"))
    )


@query
def two_turn_prompt(spark, sf_dir):
    return user_prompts(spark, sf_dir)


@query
def unicode_strip(spark, sf_dir):
    padded = F.concat("content", F.lit(" \n"))
    return inputs.exit_turns(spark, sf_dir).select(
        "conv_id", "turn", text.strip(padded).alias("stripped")
    )


@query
def strip_echo(spark, sf_dir):
    return inputs.echoed(spark, sf_dir).select(
        "conv_id", text.strip_echo(C("output"), C("prompt")).alias("answer")
    )


@query
def clean_output(spark, sf_dir):
    """Outputs as a decoder gives them: special tokens gone from the prompt they repeat."""
    decoded = inputs.echoed(spark, sf_dir).withColumn(
        "output", text.strip_special_tokens(C("output"))
    )
    return answers.clean_output(decoded).select("conv_id", "answer")


@query
def strip_special_tokens(spark, sf_dir):
    return inputs.rendered(spark, sf_dir).select(
        "conv_id", text.strip_special_tokens(C("prompt")).alias("clean")
    )


@query
def split_reasoning(spark, sf_dir):
    aside, content = C("reasoning_content"), F.coalesce("content", F.lit(""))
    separate = aside.isNotNull()
    return (
        inputs.chat_marked(spark, sf_dir)
        .where(C("role") == "assistant")
        .select(
            "conv_id",
            "turn",
            F.when(separate, aside).otherwise(text.reasoning_of(content)).alias("reasoning"),
            F.when(separate, content).otherwise(text.answer_of(content)).alias("answer"),
        )
    )


@query
def split_reasoning_ids(spark, sf_dir):
    reasoning, answer = text.split_ids(C("ids"))
    return inputs.token_ids(spark, sf_dir).select(
        "conv_id",
        "turn",
        F.array_join(reasoning, " ").alias("reasoning_ids"),
        F.array_join(answer, " ").alias("answer_ids"),
    )


@query
def standardise_prompt(spark, sf_dir):
    return inputs.answers(spark, sf_dir).select(
        "item_id", text.with_instruction(C("text"), C("task")).alias("prompt")
    )


@query
def extract_boxed(spark, sf_dir):
    return inputs.answers(spark, sf_dir).select(
        "item_id", text.boxed_answer(C("output")).alias("boxed")
    )


@query
def extract_boxed_nested(spark, sf_dir):
    """Results with up to nine levels of braces, after one that is never closed."""
    items, depth = read_table(spark, sf_dir, "benchmark"), (C("item_id") % 10).cast("int")
    result = F.concat(F.repeat(F.lit("\\sqrt{"), depth), C("item_id").cast("string"), F.repeat(F.lit("}"), depth))
    output = F.concat(F.lit("\\boxed{never "), "text", F.lit(" \\boxed{0} so \\boxed{"), result, F.lit("} {end"))
    return items.select("item_id", text.boxed_answer(output).alias("boxed"))


@query
def answer_equivalence(spark, sf_dir):
    """The same results as fractions, unreduced fractions, decimals, and wrong ones."""
    n = C("item_id")
    top, bottom = n % 7 + 1, F.element_at(F.array(*map(F.lit, (2, 4, 5, 8))), (n % 4 + 1).cast("int"))
    words = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    kind = (n / 4).cast("long") % 4
    decimal = (top.cast("decimal(10,3)") / bottom.cast("decimal(10,3)")).cast("decimal(10,4)")
    spelt = (
        F.when(kind == 0, words("\\frac{", top * 2, "}{", bottom * 2, "}"))
        .when(kind == 1, words(top * 3, "/", bottom * 3))
        .when(kind == 2, words(decimal))
        .otherwise(words(top + bottom, "/", bottom))
    )
    items = read_table(spark, sf_dir, "benchmark").select(
        "item_id", F.when(n.isNotNull(), "math").alias("task"), words(C("text"), " \\boxed{", spelt, "}").alias("output"), words(top, "/", bottom).alias("gold")
    )
    accuracy = answers.answer_accuracy(items, equivalent=True).select("task", F.round("accuracy", 6).alias("accuracy"))
    canonical = items.select(
        "item_id", "task", text.canonical_answer(text.boxed_answer(C("output"))).alias("canonical"), text.canonical_answer(C("gold")).alias("gold")
    )
    return canonical.join(F.broadcast(accuracy), "task").drop("task")  # a row per task


@query
def extract_choice(spark, sf_dir):
    return inputs.answers(spark, sf_dir).select(
        "item_id", text.choice_answer(C("output")).alias("choice")
    )


@query
def control_token_scan(spark, sf_dir):
    return turns.control_token_scan(inputs.rendered(spark, sf_dir), "prompt")


@query
def token_table_scan(spark, sf_dir):
    """Uses of ten thousand tokens, some the beginning of others, in turns that hold two of them each."""
    names = [f"<|extra_{n}|>" for n in range(5000)] + [f"<|extra_{n}" for n in range(5000)]
    number = lambda a, b: ((C("conv_id") * a + C("turn") * b) % 7000).cast("string")
    content = F.concat(F.lit("<|extra_"), number(7, 3), F.lit("|>"), "content", F.lit("<|extra_"), number(5, 1), F.lit("<|"))
    marked = read_turns(spark, sf_dir).select("conv_id", "turn", content.alias("content"))
    return turns.control_token_scan(marked, "content", names)


@query
def extract_tool_calls(spark, sf_dir):
    segments = render.render_segments(inputs.chat_marked(spark, sf_dir))
    calls = turns.extract_tool_calls(segments.withColumnRenamed("segment", "content"))
    return calls.select(
        "conv_id", "turn", "call", "name", F.get_json_object("arguments", "$.k").alias("k")
    )


@query
def length_budget(spark, sf_dir):
    budgeted = answers.length_budget(
        inputs.echoed(spark, sf_dir), F.length("prompt"), max_length=6000, max_new=30
    )
    kept = answers.cut_output(F.split("output", " "), C("room"))
    return budgeted.select("conv_id", "room", "fits", F.array_join(kept, " ").alias("kept"))


# Rendering


@query
def render_conversation(spark, sf_dir):
    return render.render_conversation(inputs.chat_marked(spark, sf_dir))


@query
def render_plain(spark, sf_dir):
    return render.render_conversation(read_turns(spark, sf_dir))


@query
def render_in_cells(spark, sf_dir):
    return render.render_in_cells(inputs.chat_marked(spark, sf_dir), cell_chars=1000)


@query
def render_tools_head(spark, sf_dir):
    """The tools block alone: the tools, and the system text of conversations that have one."""
    marked = inputs.chat_marked(spark, sf_dir).where(template.has_tools(C("tools")))
    system = F.when(C("role") == "system", F.coalesce("content", F.lit("")))
    first = marked.groupBy("conv_id").agg(
        F.min_by(F.struct(system.alias("system"), "tools"), "turn").alias("first")
    )
    head = template.tools_head(C("first.system"), C("first.tools"))
    return first.select("conv_id", head.alias("head"))


@query
def last_query_index(spark, sf_dir):
    return turns.last_query_index(inputs.chat_marked(spark, sf_dir))


def segments_of(spark, sf_dir, role):
    segments = render.render_segments(inputs.chat_marked(spark, sf_dir))
    return segments.where(C("role") == role).select("conv_id", "turn", "segment")


@query
def prune_history_reasoning(spark, sf_dir):
    return segments_of(spark, sf_dir, "assistant")


@query
def render_tool_calls(spark, sf_dir):
    content = F.coalesce("content", F.lit(""))
    answer = F.when(C("reasoning_content").isNotNull(), content).otherwise(text.answer_of(content))
    return (
        inputs.chat_marked(spark, sf_dir)
        .where(C("tool_calls").isNotNull())
        .select(
            "conv_id", "turn", template.tool_call_text(C("tool_calls"), answer).alias("call_text")
        )
    )


@query
def render_tool_results(spark, sf_dir):
    return segments_of(spark, sf_dir, "tool")


@query
def render_generation_prompt(spark, sf_dir):
    chat = inputs.chat_marked(spark, sf_dir).withColumn("enable_thinking", C("conv_id") % 2 != 0)
    return render.render_conversation(chat, add_generation_prompt=True)


# Windows


@query
def number_turns(spark, sf_dir):
    return turns.number_turns(read_turns(spark, sf_dir).select("conv_id", "turn"))


@query
def thinking_mode(spark, sf_dir):
    return turns.thinking_mode(inputs.chat_marked(spark, sf_dir)).select(
        "conv_id", "turn", "role", "mode"
    )


@query
def thinking_mode_flagged(spark, sf_dir):
    """Conversations that say themselves whether thinking is enabled."""
    flag = F.when(C("conv_id") % 3 != 0, C("conv_id") % 2 != 0)
    chat = inputs.chat_marked(spark, sf_dir).withColumn("enable_thinking", flag)
    return turns.thinking_mode(chat).select("conv_id", "turn", "role", "mode")


@query
def history_examples(spark, sf_dir):
    return render.history_examples(inputs.chat_marked(spark, sf_dir))


@query
def history_spans(spark, sf_dir):
    return render.history_spans(inputs.chat_marked(spark, sf_dir)).withColumn(
        "prompt_chars", C("short_chars") + C("long_chars") + C("before_chars") + C("ending_chars")
    ).select("conv_id", "turn", "short_chars", "before_turn", "prompt_chars")


@query
def qa_pairs(spark, sf_dir):
    return turns.qa_pairs(read_turns(spark, sf_dir))


# Joins


@query
def config_sweep(spark, sf_dir):
    asked = read_turns(spark, sf_dir).where(C("role") == "user").select("conv_id", "turn")
    return answers.config_sweep(asked)


@query
def preset_lookup(spark, sf_dir):
    chat = inputs.chat_marked(spark, sf_dir).select("conv_id", "turn", "role", "content")
    return turns.preset_lookup(chat, dimensions.sampling_presets(spark)).select(
        "conv_id", "turn", "mode", "temperature", "top_p", "top_k", "min_p"
    )


# Aggregations


@query
def loss_bearing_totals(spark, sf_dir):
    return turns.loss_bearing_totals(read_turns(spark, sf_dir))


@query
def latency_summary(spark, sf_dir):
    summary = answers.latency_summary(inputs.runs(spark, sf_dir))
    return rounded(summary, "mean_s", "max_s", "p50_s", "p95_s")


@query
def latency_sketches(spark, sf_dir):
    """The summary of a stream of runs; of the percentiles, whether they lie as near as they should."""
    runs, base = inputs.runs(spark, sf_dir).select("config", "elapsed_s"), scratch_path(spark, "latency")
    for n in range(3):
        runs.where(F.pmod(F.hash("elapsed_s"), F.lit(3)) == n).coalesce(1).write.mode("append").parquet(f"{base}/runs")
    stream = spark.readStream.schema(runs.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/runs")
    latency.summarise(stream, f"{base}/out", f"{base}/checkpoint", ONCE).awaitTermination()
    summary = latency.latency_of(latency.read_summaries(spark, f"{base}/out"))
    share = lambda p: F.avg((C("elapsed_s") <= C(p)).cast("double"))
    near = lambda p, s: (F.abs(share(p) - s) <= 2 * latency.RANK_ERROR + 1 / F.count(F.lit(1))).alias(f"{p}_near")
    checked = runs.join(F.broadcast(summary), "config").groupBy("config")  # a row per configuration
    exact = [F.first(c).alias(c) for c in ("runs", "mean_s", "max_s")]
    return rounded(checked.agg(*exact, near("p50_s", 0.5), near("p95_s", 0.95)), "mean_s", "max_s")


@query
def answer_accuracy(spark, sf_dir):
    return rounded(answers.answer_accuracy(inputs.answers(spark, sf_dir)), "accuracy")


# Candidates


@query
def temperature_softmax(spark, sf_dir):
    weighted = candidates.temperature_softmax(inputs.candidates(spark, sf_dir), 0.7)
    return rounded(weighted, "score", "prob")


@query
def top_k(spark, sf_dir):
    return rounded(candidates.top_k(inputs.candidates(spark, sf_dir), 20), "score")


@query
def top_p(spark, sf_dir):
    kept = candidates.top_p(inputs.candidates(spark, sf_dir), 0.9, temperature=0.7)
    return rounded(kept, "score", "prob")


@query
def top_p_off(spark, sf_dir):
    kept = candidates.top_p(inputs.candidates(spark, sf_dir), 1.0, temperature=0.7)
    return rounded(kept, "score", "prob")


@query
def top_k_with_gaps(spark, sf_dir):
    return rounded(candidates.top_k(inputs.candidates_with_gaps(spark, sf_dir), 20), "score")


@query
def min_p(spark, sf_dir):
    kept = candidates.min_p(inputs.candidates(spark, sf_dir), 0.05, temperature=0.7)
    return rounded(kept, "score", "prob")


@query
def greedy_pick(spark, sf_dir):
    return rounded(candidates.greedy_pick(inputs.candidates(spark, sf_dir)), "score")


@query
def weighted_pick(spark, sf_dir):
    weighted = candidates.temperature_softmax(inputs.candidates(spark, sf_dir), 0.7)
    return candidates.weighted_pick(weighted, "draw")


@query
def mark_seen(spark, sf_dir):
    marked = candidates.mark_seen(inputs.candidates(spark, sf_dir), inputs.seen(spark, sf_dir))
    return rounded(marked, "score")


@query
def unseen_candidates(spark, sf_dir):
    left = candidates.unseen(inputs.candidates(spark, sf_dir), inputs.seen(spark, sf_dir))
    return rounded(left, "score")


@query
def repetition_penalty(spark, sf_dir):
    # centred, so that both signs of score occur
    scored = inputs.candidates(spark, sf_dir).withColumn("score", C("score") - 2)
    return rounded(candidates.repetition_penalty(scored, inputs.seen(spark, sf_dir)), "score")


@query
def presence_penalty(spark, sf_dir):
    pushed = candidates.presence_penalty(
        inputs.candidates(spark, sf_dir), inputs.seen(spark, sf_dir), 1.5
    )
    return rounded(pushed, "score")


@query
def select_candidates(spark, sf_dir):
    chosen = candidates.select_candidates(
        inputs.candidates(spark, sf_dir), temperature=0.6, k=20, p=0.95, share=0.02
    )
    return rounded(chosen, "score", "prob")


@query
def sample_candidates(spark, sf_dir):
    """The whole chain: penalties on seen items, temperature, top-k, top-p, a draw."""
    chosen = candidates.select_candidates(
        inputs.candidates(spark, sf_dir), 0.7, 50, 0.9, seen=inputs.seen(spark, sf_dir), repetition=1.1, presence=0.25, draw="chain"
    )
    return rounded(chosen, "score", "prob")


# Generation


@query
def batch_generate(spark, sf_dir):
    answered = answers.batch_generate(user_prompts(spark, sf_dir), stub_generator())
    return answered.select("conv_id", "turn", "output", "error")


@query
def resume_generate(spark, sf_dir):
    """A run that breaks off after two of five slices, and one that answers the rest."""
    prompts, folder = user_prompts(spark, sf_dir), scratch_path(spark, "answers")

    def break_off(number):
        if number == 1:
            raise InterruptedError

    try:
        ledger.answer_missing(prompts, stub_generator(), folder, slices=5, on_commit=break_off)
    except InterruptedError:
        pass
    known = ledger.with_answers(prompts, folder).select("conv_id", "turn", C("slice").isNotNull().alias("at_first"))
    before = scratch_path(spark, "known")
    known.write.parquet(before)
    ledger.answer_missing(prompts, stub_generator(), folder, slices=5)
    whole = ledger.with_answers(prompts, folder).select("conv_id", "turn", "output", "error")
    return whole.join(spark.read.parquet(before), ["conv_id", "turn"])


# Streams


def turn_stream(spark, sf_dir):
    table = f"{sf_dir.rstrip('/')}/conversations.parquet"  # a file, or a folder of files
    stream = sessions.read_turn_stream(spark, table, spark.read.parquet(table).schema)
    return stream.select("conv_id", "turn", "role", C("text").alias("content"))


@query
def stream_take_until_exit(spark, sf_dir):
    sessions.use_rocksdb(spark)
    base = scratch_path(spark, "exits")
    kept = sessions.take_until_exit(inputs.mark_exits(turn_stream(spark, sf_dir)))
    sessions.write_batches(kept, f"{base}/out", f"{base}/checkpoint", ONCE).awaitTermination()
    return spark.read.parquet(f"{base}/out")


@query
def stream_history_prompt(spark, sf_dir):
    sessions.use_rocksdb(spark)
    base = scratch_path(spark, "prompts")
    prompts = sessions.history_prompts(inputs.mark_chat(turn_stream(spark, sf_dir)))
    sessions.write_batches(prompts, f"{base}/out", f"{base}/checkpoint", ONCE).awaitTermination()
    return spark.read.parquet(f"{base}/out")


@query
def stream_late_turns(spark, sf_dir):
    """Prompts with history of turns that arrive out of order, in several batches."""
    sessions.use_rocksdb(spark)
    base = scratch_path(spark, "late")
    at = F.timestamp_seconds(F.lit(1_700_000_000) + C("turn") * 60)
    marked = inputs.chat_marked(spark, sf_dir).withColumn("at", at)
    pile = F.pmod(F.crc32(F.concat_ws(":", C("conv_id").cast("string"), C("turn").cast("string")).cast("binary")), F.lit(3))
    # any turn may come last, so the delay spans them all
    first, last = marked.agg(F.unix_seconds(F.min("at")), F.unix_seconds(F.max("at"))).first()
    span = (last or 0) - (first or 0) + 86_400
    files = spark.sparkContext.defaultParallelism  # of a batch
    for n in range(3):
        marked.where(pile == n).repartition(files).write.mode("append").parquet(f"{base}/turns")
    # what tells that no older turn comes: turns of no session, far ahead; then some more, so that timers run
    none = spark.createDataFrame([], marked.schema)
    for n in range(1, 3):
        far = F.timestamp_seconds(F.lit((last or 0) + n * (span + 366 * 86_400))).alias("at")
        ahead = spark.range(n * files, (n + 1) * files, 1, files).select(F.lit(-1).cast("long").alias("conv_id"), C("id").alias("turn"), far)
        ahead.unionByName(none, allowMissingColumns=True).write.mode("append").parquet(f"{base}/turns")
    stream = sessions.read_turn_stream(spark, f"{base}/turns", marked.schema, files_per_batch=files)
    turns = ordering.in_turn_order(stream, "at", f"{span} seconds", first_turn=None).where("conv_id >= 0 AND NOT late").drop("at", "late")
    sessions.write_batches(sessions.history_prompts(turns), f"{base}/out", f"{base}/checkpoint", ONCE).awaitTermination()
    return spark.read.parquet(f"{base}/out")


@query
def stream_latest_response(spark, sf_dir):
    base = scratch_path(spark, "latest")
    sessions.latest_response(
        turn_stream(spark, sf_dir), f"{base}/out", f"{base}/checkpoint", ONCE
    ).awaitTermination()
    return sessions.read_latest(spark, f"{base}/out")


# Stages


@query
def pack_corpus(spark, sf_dir):
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return corpus.pack_corpus(documents, 4096, corpus.shards_for(documents, shard_chars=4_000_000))


@query
def pack_examples(spark, sf_dir):
    """Turns as arrays of word ids, packed into sequences; per example what the sequences hold of it."""
    id_of = lambda w: F.conv(F.substring(F.md5(w), 1, 4), 16, 10).cast("int")
    turns = read_turns(spark, sf_dir)
    examples = turns.select((C("conv_id") * 1000 + C("turn")).alias("example_id"), F.transform(F.split("content", " "), id_of).alias("ids"))
    packed = sequences.pack_examples(examples, 512)
    each = packed.select(
        "shard", "bin", "examples", (F.size("ids") <= 512).alias("fits"), F.inline(F.arrays_zip("ids", "positions", "segments"))
    ).withColumn("example_id", C("examples")[C("segments") - 1])
    return each.groupBy("example_id").agg(
        F.count(F.lit(1)).alias("n_ids"), F.sum(C("ids").cast("long") * (C("positions") + 1)).alias("weighted"),
        F.countDistinct("shard", "bin").alias("n_sequences"), F.bool_and("fits").alias("fits"),
    )


@query
def sft_examples(spark, sf_dir):
    return render.sft_examples(inputs.chat_marked(spark, sf_dir))


@query
def preference_pairs(spark, sf_dir):
    return preferences.preference_pairs(inputs.preference_candidates(spark, sf_dir))


@query
def dpo_scores(spark, sf_dir):
    scored = preferences.dpo_scores(inputs.pair_logps(spark, sf_dir))
    return rounded(scored.select("conv_id", "turn", "margin", "loss", "correct"), "margin", "loss")


def summary(scored):
    return rounded(preferences.score_summary(scored), "mean_loss", "accuracy")


@query
def dpo_summary(spark, sf_dir):
    return summary(preferences.dpo_scores(inputs.pair_logps(spark, sf_dir)))


@query
def orpo_scores(spark, sf_dir):
    scored = preferences.orpo_scores(inputs.pair_logps(spark, sf_dir))
    columns = scored.select("conv_id", "turn", "log_odds_ratio", "loss", "correct")
    return rounded(columns, "log_odds_ratio", "loss")


@query
def orpo_summary(spark, sf_dir):
    return summary(preferences.orpo_scores(inputs.pair_logps(spark, sf_dir)))


@query
def reward_pair_accuracy(spark, sf_dir):
    judged = preferences.reward_pair_accuracy(inputs.reward_scores(spark, sf_dir), ["source", "pair"])
    return rounded(judged, "mean_loss", "accuracy")


@query
def reward_intervals(spark, sf_dir):
    pairs = preferences.reward_pairs(inputs.reward_scores(spark, sf_dir), ["source", "pair"])
    judged = pairs.select("source", "pair", "loss", C("correct").cast("double").alias("right"))
    found = uncertainty.bootstrap_intervals(judged, ["source"], ["source", "pair"], ["loss", "right"], 24)
    return rounded(found, *[f"{v}_{n}" for v in ("loss", "right") for n in ("mean", "low", "high")])


@query
def reward_ranking(spark, sf_dir):
    """Rewards of one digit, so that many are equal."""
    rewards = inputs.reward_scores(spark, sf_dir).withColumn("reward", F.round("reward", 1))
    return rounded(uncertainty.ranking_quality(rewards, ["source"], "reward", C("side") == "chosen"), "auc")


@query
def kl_shaped_reward(spark, sf_dir):
    shaped = preferences.kl_shaped_reward(
        inputs.token_logps(spark, sf_dir), inputs.sequence_rewards(spark, sf_dir)
    )
    return rounded(shaped, "reward", "kl", "shaped_reward")


@query
def group_advantage(spark, sf_dir):
    events = read_table(spark, sf_dir, "events").select("user_id", "event_id", "value")
    scored = preferences.group_advantage(events, "user_id", "event_id", reward="value")
    return rounded(scored.drop("value"), "advantage")


@query
def distill_loss(spark, sf_dir):
    losses = preferences.distill_loss(inputs.distill_logits(spark, sf_dir), alpha=0.7, temperature=1.0)
    return rounded(losses, "kl", "cross_entropy", "loss")


def queries() -> dict[str, Query]:
    return dict(REGISTRY)
