"""Choosing among candidates, on tied scores and hot groups, against plain Python."""

import math
import random

import pytest
from pyspark.sql import functions as F

from colloquy.operators import candidates as ops
from colloquy.plans.ordered_groups import HOT_ROWS_SETTING


@pytest.fixture(params=["8", "1000000"])
def hot_rows(request, spark):
    spark.conf.set(HOT_ROWS_SETTING, request.param)
    yield int(request.param)
    spark.conf.unset(HOT_ROWS_SETTING)


def sample(seed):
    """Few distinct scores, so that most of them tie; group 0 has a third of the rows."""
    draw = random.Random(seed)
    return [
        (0 if i % 3 == 0 else draw.randrange(1, 30), i, draw.randrange(5) * 0.5)
        for i in draw.sample(range(10_000), 300)
    ]


def groups_of(rows):
    groups = {}
    for g, i, s in rows:
        groups.setdefault(g, []).append((i, s))
    return groups


def softmax(members, t):
    top = max(s for _, s in members)
    weights = {i: math.exp((s - top) / t) for i, s in members}
    mass = sum(weights.values())
    return {i: w / mass for i, w in weights.items()}


def frame(spark, rows):
    return spark.createDataFrame(rows, "group_id long, item_id long, score double").repartition(5)


def items(df):
    return {(r.group_id, r.item_id) for r in df.collect()}


def test_top_k_keeps_ties(spark, hot_rows):
    rows = sample(1)
    expected = set()
    for g, members in groups_of(rows).items():
        kth = sorted((s for _, s in members), reverse=True)[:4][-1]
        expected |= {(g, i) for i, s in members if s >= kth}
    assert items(ops.top_k(frame(spark, rows), 4)) == expected


@pytest.mark.parametrize("p", [0.05, 0.333, 0.77, 0.999])
def test_top_p_by_mass_before(spark, hot_rows, p):
    rows = sample(2)
    expected = set()
    for g, members in groups_of(rows).items():
        prob, before = softmax(members, 0.7), 0.0
        for i, s in sorted(members, key=lambda m: (-m[1], m[0])):
            if before < p:
                expected.add((g, i))
            before += prob[i]
    kept = ops.top_p(frame(spark, rows), p, temperature=0.7)
    assert items(kept) == expected
    assert {r.group_id for r in kept.collect()} == {g for g, _, _ in rows}


def test_softmax_sums_to_one(spark, hot_rows):
    rows = [(g, i, s * 3000) for g, i, s in sample(3)]
    sums = ops.temperature_softmax(frame(spark, rows), 0.1).groupBy("group_id").agg(F.sum("prob").alias("p"))
    assert all(abs(r.p - 1) < 1e-9 for r in sums.collect())


def test_selection_sums_to_one(spark, hot_rows):
    chosen = ops.select_candidates(frame(spark, sample(4)), 0.6, 20, 0.95, 0.02)
    sums = chosen.groupBy("group_id").agg(F.sum("prob").alias("p")).collect()
    assert len(sums) == len(groups_of(sample(4))) and all(abs(r.p - 1) < 1e-9 for r in sums)


def test_greedy_takes_lowest_item_among_equals(spark):
    rows = sample(5)
    got = {r.group_id: r.item_id for r in ops.greedy_pick(frame(spark, rows)).collect()}
    assert got == {
        g: min(members, key=lambda m: (-m[1], m[0]))[0] for g, members in groups_of(rows).items()
    }


def test_draws_follow_the_weights_and_repeat(spark):
    rows = [(g, g * 10 + i, 0.0) for g in range(2000) for i in range(2)]
    weighted = frame(spark, rows).withColumn("prob", F.when(F.col("item_id") % 10 == 0, 0.8).otherwise(0.2))
    first = items(ops.weighted_pick(weighted, "a"))
    assert first == items(ops.weighted_pick(weighted.repartition(3), "a"))
    assert first != items(ops.weighted_pick(weighted, "b"))
    assert 0.76 < sum(i % 10 == 0 for _, i in first) / 2000 < 0.84


def test_penalties_count_a_seen_item_once(spark):
    df = frame(spark, [(1, 1, 2.2), (1, 2, -2.0), (1, 3, 1.0)])
    seen = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (9, 3)], "group_id long, item_id long")
    pushed = {r.item_id: r.score for r in ops.repetition_penalty(df, seen).collect()}
    assert pushed == pytest.approx({1: 2.0, 2: -2.2, 3: 1.0})
    lowered = {r.item_id: r.score for r in ops.presence_penalty(df, seen, 1.5).collect()}
    assert lowered == pytest.approx({1: 0.7, 2: -3.5, 3: 1.0})


def test_temperature_has_to_be_positive(spark):
    with pytest.raises(ValueError):
        ops.temperature_softmax(frame(spark, sample(1)), 0)


ODD = [None, float("nan"), float("-inf"), float("inf"), 0.5, 0.5, 1.0]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_odd_scores_mean_the_same_in_both_plans(spark, seed):
    draw = random.Random(seed)
    rows = [(0 if i % 3 == 0 else draw.randrange(1, 9), i, draw.choice(ODD)) for i in range(150)]
    rows += [(50, 1000 + i, float("-inf")) for i in range(12)] + [(51, 2000 + i, None) for i in range(12)]
    chains = [
        lambda df: ops.top_k(df, 5),
        lambda df: ops.top_k(df, 0),
        lambda df: ops.top_p(df, 0.6),
        lambda df: ops.top_p(df, 1.0),
        lambda df: ops.min_p(df, 0.1),
        lambda df: ops.select_candidates(df, 0.7, 4, 0.9, 0.01, draw="s"),
    ]

    def chosen(hot):
        spark.conf.set(HOT_ROWS_SETTING, hot)
        try:
            return [sorted(map(tuple, f(frame(spark, rows)).select("group_id", "item_id").collect())) for f in chains]
        finally:
            spark.conf.unset(HOT_ROWS_SETTING)

    plain = chosen("1000000")
    assert chosen("4") == plain
    numbers = sorted((g, i) for g, i, s in rows if s is not None and s == s)
    assert plain[1] == plain[3] == numbers
    assert len(plain[5]) == len({g for g, _ in numbers})
