"""Preference, reward and distillation scores against plain Python."""

import math

import pytest
from pyspark.sql import functions as F

from colloquy.operators import corpus, preferences
from colloquy.plans.ordered_groups import HOT_ROWS_SETTING


def test_losses_stay_finite_for_large_margins(spark):
    df = spark.createDataFrame(
        [(0.0, 0.0, -1e6, 0.0), (-1e6, 0.0, 0.0, 0.0)],
        "pi_chosen double, ref_chosen double, pi_rejected double, ref_rejected double",
    )
    rows = preferences.dpo_scores(df, beta=1.0).orderBy("margin").collect()
    assert [r.loss for r in rows] == [1e6, 0.0] and [r.correct for r in rows] == [False, True]


def test_distillation_at_extreme_logits(spark):
    teacher = [900.0, 895.0, -3000.0, 0.5]
    student = [-2000.0, -2001.0, -1e4, -1999.5]
    rows = [(1, i, t, s, i == 1) for i, (t, s) in enumerate(zip(teacher, student))]
    df = spark.createDataFrame(rows, "pos long, item int, teacher double, student double, is_gold boolean")

    def logs(values, t):
        top = max(values)
        mass = sum(math.exp((v - top) / t) for v in values)
        return [(v - top) / t - math.log(mass) for v in values]

    t = 2.0
    a, b, c = logs(teacher, t), logs(student, t), logs(student, 1.0)
    kl = sum(math.exp(x) * (x - y) for x, y in zip(a, b))
    (row,) = preferences.distill_loss(df.repartition(4), alpha=0.7, temperature=t).collect()
    assert row.kl == pytest.approx(kl)
    assert row.cross_entropy == pytest.approx(-c[1])
    assert row.loss == pytest.approx(0.7 * t * t * kl + 0.3 * -c[1])


@pytest.mark.parametrize("hot", ["2", "1000"])
def test_group_advantage(spark, hot):
    spark.conf.set(HOT_ROWS_SETTING, hot)
    try:
        df = spark.createDataFrame(
            [(1, 1, 1.0), (1, 2, 2.0), (1, 3, 6.0), (2, 1, 5.0)], "g long, i long, reward double"
        )
        sample = {(r.g, r.i): r.advantage for r in preferences.group_advantage(df, "g", "i", epsilon=0.5).collect()}
        whole = {
            (r.g, r.i): r.advantage
            for r in preferences.group_advantage(df, "g", "i", epsilon=0.5, sample=False).collect()
        }
    finally:
        spark.conf.unset(HOT_ROWS_SETTING)
    assert sample[2, 1] == 0 and whole[2, 1] == 0
    assert sample[1, 3] == pytest.approx(3 / (math.sqrt(7) + 0.5))
    assert whole[1, 3] == pytest.approx(3 / (math.sqrt(14 / 3) + 0.5))


@pytest.mark.parametrize("hot", ["3", "1000"])
def test_packing_keeps_all_text(spark, hot):
    texts = {i: chr(97 + i % 26) * (i * 7 % 50) for i in range(60)}
    texts[17], texts[20] = "z" * 1000, None
    spark.conf.set(HOT_ROWS_SETTING, hot)
    try:
        df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
        rows = corpus.pack_corpus(df, block_chars=64, shards=3).orderBy("shard", "block").collect()
    finally:
        spark.conf.unset(HOT_ROWS_SETTING)
    for shard in range(3):
        mine = [r for r in rows if r.shard == shard]
        assert [r.block for r in mine] == list(range(len(mine)))
        assert all(len(r.text) == 64 for r in mine[:-1])
        assert "".join(r.text for r in mine) == "".join(
            (texts[i] or "") + "<|endoftext|>" for i in range(60) if i % 3 == shard
        )


def test_preference_pairs_drop_useless_ones(spark):
    rows = [
        (2, 0, "p", "c", "r"),
        (1, 0, "p", "c", "r"),
        (3, 0, "p", "c", "c"),
        (4, 0, "", "c", "r"),
        (5, 0, "p", "c", None),
        (6, 0, "p", "r", "c"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, prompt string, chosen string, rejected string")
    got = {r.conv_id for r in preferences.preference_pairs(df).collect()}
    assert got == {1, 6}


def test_a_pair_without_both_sides_is_left_out(spark):
    df = spark.createDataFrame(
        [(1, "chosen", 2.0), (1, "rejected", 1.0), (2, "chosen", 1.0)], "p long, side string, reward double"
    )
    (row,) = preferences.reward_pair_accuracy(df, ["p"]).collect()
    assert (row.pairs, row.accuracy, row.unpaired, row.repeated) == (1, 1.0, 1, 0)
    assert row.mean_loss == pytest.approx(math.log1p(math.exp(-1)))


def test_cap_is_repeatable(spark):
    df = spark.range(1000)
    first = {r.id for r in corpus.cap_rows(df, 50, "id", "a").collect()}
    assert first == {r.id for r in corpus.cap_rows(df.repartition(9), 50, "id", "a").collect()}
    assert len(first) == 50 and first != {r.id for r in corpus.cap_rows(df, 50, "id", "b").collect()}
    assert corpus.cap_rows(df.where(F.col("id") < 3), 50, "id").count() == 3


@pytest.mark.parametrize("rows", [0, 1, 37, 499, 500, 900])
def test_cap_of_any_size_and_repeated_keys(spark, monkeypatch, rows):
    monkeypatch.setattr(corpus, "_FEW", 5)
    monkeypatch.setattr(corpus, "_DIGITS", 1)
    df = spark.range(500).selectExpr("id % 100 AS id", "id AS row")
    capped = corpus.cap_rows(df, rows, "id", "s")
    assert capped.count() == min(rows, 500)
    text = capped._jdf.queryExecution().executedPlan().toString()
    assert rows % 5 or "SinglePartition" not in text
    least = {r.id for r in corpus.cap_rows(df.select("id").distinct(), -(-rows // 5), "id", "s").collect()}
    assert {r.id for r in capped.collect()} == least


def test_packing_is_linear_in_a_document(spark):
    import time

    def seconds(n):
        df = spark.range(1).selectExpr("id AS doc_id", f"repeat('abcdefgh', {n // 8}) AS text")
        began = time.time()
        assert corpus.pack_corpus(df, 4096, 1).count() == (n + 13 + 4095) // 4096
        return time.time() - began

    seconds(8000)
    short = seconds(4_000_000)
    assert seconds(8_000_000) <= 2.5 * short + 1


def test_a_mode_without_a_preset_stops_the_job(spark):
    from colloquy.operators import turns

    chat = spark.createDataFrame([(1, 0, "user", "hi /no_think")], "conv_id long, turn long, role string, content string")
    presets = spark.createDataFrame([("thinking", 0.6)], "mode string, temperature double")
    with pytest.raises(Exception, match="no preset for mode non_thinking"):
        turns.preset_lookup(chat, presets).collect()


def test_masked_items_and_sequences_without_tokens(spark):
    masked = float("-inf")
    rows = [(1, 0, 1.0, 0.5, True), (1, 1, 0.0, 0.0, False), (1, 2, masked, masked, False), (2, 0, 1.0, masked, True)]
    df = spark.createDataFrame(rows, "pos int, item int, teacher double, student double, is_gold boolean")
    got = {r.pos: r for r in preferences.distill_loss(df).collect()}
    (plain,) = preferences.distill_loss(df.where("pos = 1 AND item < 2")).collect()
    assert got[1].kl == pytest.approx(plain.kl) and got[1].loss == pytest.approx(plain.loss)
    tokens = spark.createDataFrame([(1, -1.0, -2.0)], "seq_id long, logp double, ref_logp double")
    rewards = spark.createDataFrame([(1, 3.0), (2, 4.0)], "seq_id long, reward double")
    shaped = {r.seq_id: (r.kl, r.shaped_reward) for r in preferences.kl_shaped_reward(tokens, rewards, 0.5).collect()}
    assert shaped == {1: (1.0, 2.5), 2: (0.0, 4.0)}
