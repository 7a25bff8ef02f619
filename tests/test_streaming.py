"""Streams in many batches against the batch operators."""

import pytest
from check import SMALL
from pyspark.sql import functions as F

from colloquy.operators import turns as batch
from colloquy.operators.render import history_examples
from colloquy.plans.shared import scratch_path
from colloquy.sources.tables import read_turns
from colloquy.streaming import sessions
from workload import inputs
from workload.queries import queries

C = F.col
ONCE = {"availableNow": True}
CHAT = "conv_id long, turn long, role string, content string"


def stream_of(spark, turns, slices):
    """Turns as files in order of turn, one file per batch."""
    folder = scratch_path(spark, "turns")
    turns = turns.select("conv_id", "turn", "role", "content")
    lo, hi = turns.agg(F.min("turn"), F.max("turn")).first()
    step = (hi - lo) // slices + 1
    for k in range(slices):
        part = turns.where((C("turn") >= lo + k * step) & (C("turn") < lo + (k + 1) * step))
        part.coalesce(1).write.mode("append").parquet(folder)
    return sessions.read_turn_stream(spark, folder, turns.schema, files_per_batch=1)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("slices", [1, 4])
def test_exit_closes_the_session_for_later_batches(spark, slices):
    sessions.use_rocksdb(spark)
    marked = inputs.mark_exits(read_turns(spark, SMALL))
    base = scratch_path(spark, "exits")
    kept = sessions.take_until_exit(stream_of(spark, marked, slices))
    sessions.write_batches(kept, f"{base}/out", f"{base}/checkpoint", ONCE).awaitTermination()
    got = spark.read.parquet(f"{base}/out")
    expected = batch.take_until_exit(batch.drop_empty_turns(marked))
    columns = ["conv_id", "turn", "role", "content"]
    assert rows(got.select(columns)) == rows(expected.select(columns))


def test_sessions_of_any_key_type(spark):
    sessions.use_rocksdb(spark)
    data = [("a", 0, "user", "hi"), ("a", 1, "user", "exit"), ("b", 1, "user", "hi"), ("a", 2, "user", "more")]
    turns = spark.createDataFrame(data, CHAT.replace("conv_id long", "conv_id string"))
    base = scratch_path(spark, "keys")
    kept = sessions.take_until_exit(stream_of(spark, turns, 3))
    sessions.write_batches(kept, f"{base}/out", f"{base}/c1", ONCE).awaitTermination()
    assert [r[:2] for r in rows(spark.read.parquet(f"{base}/out"))] == [("a", 0), ("b", 1)]
    prompts = sessions.history_prompts(stream_of(spark, turns, 3))
    sessions.write_batches(prompts, f"{base}/prompts", f"{base}/c2", ONCE).awaitTermination()
    assert spark.read.parquet(f"{base}/prompts").count() == 4


@pytest.mark.parametrize("slices", [1, 3])
def test_prompts_with_history(spark, slices):
    sessions.use_rocksdb(spark)
    marked = inputs.mark_chat(read_turns(spark, SMALL))
    base = scratch_path(spark, "prompts")
    prompts = sessions.history_prompts(stream_of(spark, marked, slices))
    sessions.write_batches(prompts, f"{base}/out", f"{base}/checkpoint", ONCE).awaitTermination()
    got = {(r.conv_id, r.turn): r.prompt for r in spark.read.parquet(f"{base}/out").collect()}

    # The batch form: the prompt for a user turn is what an answer right after it would see.
    plain = marked.select("conv_id", "turn", "role", "content")
    asked = plain.where(C("role") == "user").select("conv_id", "turn").collect()
    assert set(got) == {(r.conv_id, r.turn) for r in asked}
    for conv, turn in sorted(got)[::9]:
        answer = spark.createDataFrame([(conv, turn + 1, "assistant", "x")], CHAT)
        upto = plain.where((C("conv_id") == conv) & (C("turn") <= turn))
        (row,) = history_examples(upto.union(answer)).where(C("turn") == turn + 1).collect()
        assert got[conv, turn] == row.prompt


@pytest.mark.parametrize("slices", [1, 3])
def test_long_sessions_have_whole_prompts(spark, slices):
    sessions.use_rocksdb(spark)
    answer = "<think>\nr\n</think>\n\n" + "x" * 300_000
    data = [(1, t, "user" if t % 2 == 0 else "assistant", "u" if t % 2 == 0 else answer) for t in range(12)]
    base = scratch_path(spark, "long")
    prompts = sessions.history_prompts(stream_of(spark, spark.createDataFrame(data, CHAT), slices))
    sessions.write_batches(prompts, f"{base}/out", f"{base}/checkpoint", ONCE).awaitTermination()
    got = {r.turn: r.prompt for r in spark.read.parquet(f"{base}/out").collect()}
    user, plain = "<|im_start|>user\nu<|im_end|>\n", "<|im_start|>assistant\n" + "x" * 300_000 + "<|im_end|>\n"
    assert set(got) == set(range(0, 12, 2)) and len(got[10]) > 1 << 20
    for turn, prompt in got.items():
        assert prompt == (user + plain) * (turn // 2) + user + "<|im_start|>assistant\n"


def test_thinking_column_in_streams(spark):
    sessions.use_rocksdb(spark)
    data = [(1, t, "user", "u") for t in range(4)]
    base = scratch_path(spark, "flags")
    flagged = stream_of(spark, spark.createDataFrame(data, CHAT), 2).withColumn("enable_thinking", C("turn") % 2 == 0)
    sessions.write_batches(sessions.history_prompts(flagged), f"{base}/out", f"{base}/checkpoint", ONCE).awaitTermination()
    got = {r.turn: r.prompt.endswith("</think>\n\n") for r in spark.read.parquet(f"{base}/out").collect()}
    assert got == {0: False, 1: True, 2: False, 3: True}


@pytest.mark.parametrize("every", [2, 100])
def test_latest_response(spark, every):
    import os

    turns = read_turns(spark, SMALL)
    base = scratch_path(spark, "latest")
    sessions.latest_response(
        stream_of(spark, turns, 5), f"{base}/out", f"{base}/checkpoint", ONCE, compact_every=every
    ).awaitTermination()
    got = sessions.read_latest(spark, f"{base}/out")
    expected = turns.groupBy("conv_id", "role").agg(F.max_by("content", "turn"), F.count("*"))
    assert rows(got) == rows(expected)
    assert len(os.listdir(f"{base}/out")) == (2 if every == 2 else 5)


@pytest.mark.parametrize("name", ["stream_take_until_exit", "stream_history_prompt", "stream_latest_response"])
def test_queries_read_a_table_that_is_a_folder_of_files(spark, name):
    folder = scratch_path(spark, "tables")
    spark.read.parquet(f"{SMALL}/conversations.parquet").repartition(3).write.parquet(f"{folder}/conversations.parquet")
    run = queries()[name]
    assert rows(run(spark, folder)) == rows(run(spark, SMALL)) != []
