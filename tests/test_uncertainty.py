"""Bootstrap intervals and ranking quality."""

import hashlib
import math
import random

from pyspark.sql import functions as F

from colloquy.operators import uncertainty

C = F.col


def plain_weight(key, n, seed="0"):
    block, rest = divmod(n, 6)
    digest = hashlib.md5(f"boot|{seed}|{block}|{key}".encode()).hexdigest()
    number = int(digest[12 * (rest // 3) :][:12], 16) >> (16 * (rest % 3)) & 0xFFFF
    return sum(number >= s for s in uncertainty.STEPS)


def test_as_brute_force_at_any_partitioning(spark):
    chance = random.Random(1)
    rows = [(n % 3, n, None if n % 50 == 0 else chance.random()) for n in range(600)]
    df = spark.createDataFrame(rows, "g long, k long, x double")
    ones = [tuple(r) for r in uncertainty.bootstrap_intervals(df.repartition(1), ["g"], ["k"], ["x"], 24).orderBy("g").collect()]
    many = [tuple(r) for r in uncertainty.bootstrap_intervals(df.repartition(7), ["g"], ["k"], ["x"], 24).orderBy("g").collect()]
    for got, other, g in zip(ones, many, range(3)):
        mine = [(k, x) for h, k, x in rows if h == g and x is not None]
        means = []
        for n in range(24):
            weights = [plain_weight(k, n) for k, _ in mine]
            means.append(sum(w * x for w, (_, x) in zip(weights, mine)) / sum(weights))
        means.sort()
        want = (g, 200, sum(x for _, x in mine) / len(mine), means[0], means[23])
        for a, b, c in zip(got, other, want):
            assert math.isclose(a, c, rel_tol=1e-9) and math.isclose(b, c, rel_tol=1e-9)


def test_weights_are_poisson_and_intervals_cover(spark):
    weights = [plain_weight(k, n) for k in range(3000) for n in range(6)]
    for w, share in ((0, 0.368), (1, 0.368), (2, 0.184), (3, 0.061)):
        assert abs(weights.count(w) / len(weights) - share) < 0.02
    df = spark.range(40_000).select((C("id") % 40).alias("g"), C("id").alias("k"), F.randn(3).alias("x"))
    rows = uncertainty.bootstrap_intervals(df, ["g"], ["k"], ["x"], 60, level=0.9).collect()
    assert sum(r.x_low <= 0 <= r.x_high for r in rows) >= 30
    assert all(0.02 < r.x_high - r.x_low < 0.25 for r in rows)


def test_odd_groups(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, None), (None, 3, 2.0), (None, 4, 2.0)], "g long, k long, x double")
    got = {r.g: tuple(r)[1:] for r in uncertainty.bootstrap_intervals(df, ["g"], ["k"], ["x"], 6).collect()}
    assert got == {1: (2, None, None, None), None: (2, 2.0, 2.0, 2.0)}
    assert uncertainty.bootstrap_intervals(df.where("false"), ["g"], ["k"], ["x"], 6).collect() == []


def test_ranking_quality_with_ties(spark, cutting):
    chance = random.Random(2)
    rows = [(g, chance.randrange(8) / 4, chance.random() < 0.4) for g in (1, 2) for _ in range(200)]
    rows += [(3, 1.0, True), (3, None, False), (4, 1.0, False), (4, 1.0, True), (5, None, True)]
    df = spark.createDataFrame(rows, "g long, s double, p boolean").repartition(5)
    got = {r.g: (r.positives, r.negatives, r.auc) for r in uncertainty.ranking_quality(df, ["g"], "s", C("p")).collect()}
    for g in (1, 2):
        pos = [s for h, s, p in rows if h == g and p]
        neg = [s for h, s, p in rows if h == g and not p]
        won = sum((a > b) + (a == b) / 2 for a in pos for b in neg)
        assert got[g][:2] == (len(pos), len(neg)) and math.isclose(got[g][2], won / len(pos) / len(neg))
    assert got[3] == (1, 0, None) and got[4] == (1, 1, 0.5) and 5 not in got
