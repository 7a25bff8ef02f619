"""Streams whose turns arrive out of order against the batch operators."""

import random

import pytest
from check import SMALL
from pyspark.sql import functions as F

from colloquy.operators import turns as batch
from colloquy.plans.shared import scratch_path
from colloquy.sources.tables import read_turns
from colloquy.streaming import ordering, sessions
from workload import inputs

C = F.col
ONCE = {"availableNow": True}
TIMED = "conv_id long, turn long, role string, content string, at timestamp"


def dealt(spark, rows, batches, seed, parts=2):
    """Rows dealt to batches at random, one folder file per batch, then a turn of another session far ahead."""
    from datetime import datetime, timedelta

    folder, chance = scratch_path(spark, "dealt"), random.Random(seed)
    piles = [[] for _ in range(batches)]
    for row in rows:
        piles[chance.randrange(batches)].append(row)
    for pile in piles:
        chance.shuffle(pile)
        if pile:
            spark.createDataFrame(pile, TIMED).coalesce(1).write.mode("append").parquet(folder)
    for ahead in (30, 60):
        late = max(r[4] for r in rows) + timedelta(days=ahead)
        spark.createDataFrame([(-1, ahead // 30 - 1, "user", "far", late)], TIMED).coalesce(1).write.mode("append").parquet(folder)
    return sessions.read_turn_stream(spark, folder, spark.createDataFrame([], TIMED).schema, files_per_batch=1)


def timed(turns):
    at = F.timestamp_seconds(F.lit(1_700_000_000) + C("conv_id") * 7 + C("turn") * 60)
    return [tuple(r) for r in turns.select("conv_id", "turn", "role", "content", at.alias("at")).collect()]


def run(spark, stream, name):
    sessions.use_rocksdb(spark)
    base, before = scratch_path(spark, name), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    sessions.write_batches(stream, f"{base}/out", f"{base}/checkpoint", ONCE).awaitTermination()
    spark.conf.set("spark.sql.shuffle.partitions", before)
    return spark.read.parquet(f"{base}/out")


@pytest.mark.parametrize("first,seed", [(0, 1), (None, 2)])
def test_turns_leave_in_order(spark, first, seed):
    rows = [r for r in timed(read_turns(spark, SMALL)) if (r[0] + r[1]) % 9]  # with gaps
    stream = ordering.in_turn_order(dealt(spark, rows, 4, seed), "at", "1 day", first)
    seen = run(spark, stream.withColumn("left", F.current_timestamp()), "ordered").collect()
    assert sorted(tuple(r)[:5] for r in seen if r.conv_id >= 0) == sorted(rows)
    assert not any(r.late for r in seen)
    last = {}
    for r in sorted(seen, key=lambda r: (r.left, r.turn)):
        assert r.turn > last.get(r.conv_id, -1)
        last[r.conv_id] = r.turn


@pytest.mark.parametrize("seed", [3, 4])
def test_prompts_and_exits_of_any_dealing(spark, seed):
    marked = inputs.mark_exits(read_turns(spark, SMALL).where("conv_id < 12"))
    rows = timed(marked)
    in_order = ordering.in_turn_order(dealt(spark, rows, 5, seed), "at", "1 day").where("conv_id >= 0")
    kept = run(spark, sessions.take_until_exit(in_order.drop("late", "at")), "exits")
    columns = ["conv_id", "turn", "role", "content"]
    want = batch.take_until_exit(batch.drop_empty_turns(marked))
    table = lambda df: sorted(map(tuple, df.select(columns).collect()))
    assert table(kept) == table(want)
    in_order = ordering.in_turn_order(dealt(spark, rows, 5, seed + 10), "at", "1 day").where("conv_id >= 0")
    got = run(spark, sessions.history_prompts(in_order.drop("late", "at")), "prompts")
    whole = run(spark, sessions.history_prompts(dealt(spark, rows, 1, 0).where("conv_id >= 0").drop("at")), "whole")
    prompts = lambda df: sorted(map(tuple, df.select("conv_id", "turn", "prompt").collect()))
    assert prompts(got) == prompts(whole) and len(prompts(got)) > 10


def test_late_repeated_and_odd_turns(spark):
    from datetime import datetime, timedelta

    start = datetime(2024, 1, 1)
    at = lambda n: start + timedelta(minutes=n)
    batches = [
        [(1, 2, "user", "c", at(2)), (1, 0, "user", "a", at(0)), (1, 2, "user", "c", at(2))],
        [(1, 0, "user", "a again", at(0)), (1, None, "user", "no turn", at(1)), (1, 1, None, None, at(1))],
        [(1, 9, "user", "after a gap", at(9)), (2, 5, "user", "waits for the watermark", at(5))],
        [(3, 0, "user", "far", at(5000))],
        [(3, 1, "user", "far", at(5001))],
        [(1, 3, "user", "too late", at(4000))],
    ]
    folder = scratch_path(spark, "late")
    for rows in batches:
        spark.createDataFrame(rows, TIMED).coalesce(1).write.mode("append").parquet(folder)
    stream = sessions.read_turn_stream(spark, folder, spark.createDataFrame([], TIMED).schema, files_per_batch=1)
    got = run(spark, ordering.in_turn_order(stream, "at", "1 day"), "odd").collect()
    mine = sorted(((r.conv_id, r.turn, r.content, r.late) for r in got if r.conv_id != 3), key=repr)
    assert mine == sorted(
        [
            (1, 0, "a", False), (1, 1, None, False), (1, 2, "c", False), (1, 2, "c", True), (1, 0, "a again", True), (1, None, "no turn", True),
            (1, 9, "after a gap", False), (2, 5, "waits for the watermark", False), (1, 3, "too late", True),
        ],
        key=repr,
    )


def test_query_of_late_turns_keeps_a_conversation_of_any_length(spark):
    """Longer than a day of event time, in which a turn may come last."""
    from workload.queries import queries

    folder = scratch_path(spark, "long")
    text = F.concat(F.lit("turn "), C("id").cast("string")).alias("text")
    turns = spark.range(400).select(F.lit(1).cast("long").alias("conv_id"), C("id").alias("turn"), F.expr("IF(id % 2 = 0, 'user', 'assistant')").alias("role"), text)
    turns.write.parquet(f"{folder}/conversations.parquet")
    got, want = (queries()[n](spark, folder) for n in ("stream_late_turns", "stream_history_prompt"))
    table = lambda df: sorted(map(tuple, df.select("conv_id", "turn", "prompt").collect()))
    assert len(table(got)) == 200 and table(got) == table(want)
