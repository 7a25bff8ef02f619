"""Windows over cut groups against plain Python, with one group of a third of the rows."""

import random

import pytest
from pyspark.sql import functions as F

from colloquy.plans.ordered_groups import (
    HOT_ROWS_SETTING,
    OrderedGroups,
    following,
    position,
    previous,
    running_last,
    running_max,
    running_sum,
    total,
    total_count,
)

C = F.col


def sample(seed, n=600):
    draw = random.Random(seed)
    orders = draw.sample(range(-5000, 5000), n)
    rows = []
    for i, order in enumerate(orders):
        key = 0 if i % 3 == 0 else draw.randrange(1, 60)
        key = None if key == 1 else key
        value = None if draw.random() < 0.3 else draw.randrange(100)
        rows.append((key, order, value))
    return rows


def by_hand(rows):
    groups = {}
    for key, order, value in rows:
        groups.setdefault(key, []).append((order, value))
    out = {}
    for key, members in groups.items():
        members.sort()
        values = [v for _, v in members]
        for i, (order, value) in enumerate(members):
            before = [v for v in values[:i] if v is not None]
            upto = [v for v in values[: i + 1] if v is not None]
            known = [v for v in values if v is not None]
            out[key, order] = (
                i,
                len(members),
                sum(before),
                sum(upto),
                max(before, default=None),
                upto[-1] if upto else None,
                max(known, default=None),
                members[i - 1][0] if i else None,
                members[i + 1][0] if i + 1 < len(members) else None,
            )
    return out


@pytest.mark.parametrize("hot_rows", [3, 20, 150, 100_000])
@pytest.mark.parametrize("seed", [1, 2])
def test_all_steps(spark, hot_rows, seed):
    rows = sample(seed)
    df = spark.createDataFrame(rows, "k int, o long, v int").repartition(7)
    spark.conf.set(HOT_ROWS_SETTING, str(hot_rows))
    try:
        groups = OrderedGroups.of(df, ["k"], "o").with_columns(
            i=position(),
            n=total_count(),
            before=running_sum(C("v")),
            upto=running_sum(C("v"), inclusive=True),
            top=running_max(C("v")),
            latest=running_last(C("v")),
            best=total(F.max, C("v")),
            prev=previous(F.struct("o")),
            next=following(F.struct("o")),
            wide_prev=previous(F.struct("o", "v"), wide=True),
            wide_next=following(F.struct("o", "v"), wide=True),
        )
        assert groups.cut == (hot_rows < 200)
        collected = groups.df.collect()
        values = {(r.k, r.o): r.v for r in collected}
        for r in collected:
            for near, wide in ((r.prev, r.wide_prev), (r.next, r.wide_next)):
                assert (near is None) == (wide is None)
                assert near is None or (near.o, values[r.k, near.o]) == tuple(wide)
        got = {
            (r.k, r.o): (
                r.i,
                r.n,
                r.before,
                r.upto,
                r.top,
                r.latest,
                r.best,
                r.prev and r.prev.o,
                r.next and r.next.o,
            )
            for r in collected
        }
    finally:
        spark.conf.unset(HOT_ROWS_SETTING)
    assert got == by_hand(rows)


def test_blocks_of_a_hot_group_are_balanced(spark):
    spark.conf.set(HOT_ROWS_SETTING, "1000")
    try:
        hot = spark.range(50_000).select(F.lit(7).alias("k"), (C("id") * C("id")).alias("o"))
        cold = spark.range(500).select((C("id") % 5 + 10).cast("int").alias("k"), C("id").alias("o"))
        groups = OrderedGroups.of(hot.union(cold), ["k"], "o")
        sizes = groups.rows.groupBy("k", "_block").count().collect()
    finally:
        spark.conf.unset(HOT_ROWS_SETTING)
    assert len([s for s in sizes if s.k != 7]) == 5
    blocks = [s["count"] for s in sizes if s.k == 7]
    assert sum(blocks) == 50_000 and max(blocks) <= 1000 and len(blocks) <= 150


def test_ordinary_groups_need_one_shuffle(spark):
    df = spark.range(1000).select((C("id") % 50).alias("k"), C("id").alias("o"))
    groups = OrderedGroups.of(df, ["k"], "o").with_columns(i=position(), n=total_count())
    again = groups.with_columns(s=running_sum(C("i")))
    plan = again.df.groupBy("k").agg(F.max("s"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort ") == 1


def test_few_but_large_rows_are_cut(spark):
    from colloquy.plans.ordered_groups import HOT_BYTES_SETTING

    rows = [(1, i, "x" * 1000) for i in range(20)] + [(2, i, "y") for i in range(20)]
    df = spark.createDataFrame(rows, "k long, o long, text string").repartition(3)
    spark.conf.set(HOT_BYTES_SETTING, "5000")
    try:
        groups = OrderedGroups.of(df, ["k"], "o")
        assert groups.cut
        got = groups.with_columns(n=position(), before=running_sum(F.length("text"))).rows.collect()
    finally:
        spark.conf.unset(HOT_BYTES_SETTING)
    assert {(r.k, r.o): (r.n, r.before) for r in got} == {
        (k, o): (o, o * len(t)) for k, o, t in rows
    }
    assert len({r["_block"] for r in got if r.k == 1}) > 4 and {r["_block"] for r in got if r.k == 2} == {0}


def test_groups_are_counted_in_one_job(spark):
    df = spark.createDataFrame([(1, i) for i in range(30)], "k long, o long")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("count", "count")
    try:
        assert not OrderedGroups.of(df, ["k"], "o").cut
        jobs = tracker.getJobIdsForGroup("count")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 1 <= len(jobs) <= 3  # the scan with its partial counts, and the stages that combine them


def test_many_large_groups(spark):
    """As many cut groups as a table of 10 ** 10 rows may have; their table stays off the driver."""
    spark.conf.set(HOT_ROWS_SETTING, "3")
    try:
        df = spark.range(200_000).select((C("id") % 50_000).alias("k"), C("id").alias("o"))
        placed = OrderedGroups.of(df, ["k"], "o").with_columns(n=position(), size=total_count())
        wrong = placed.df.where((C("n") != F.floor(C("o") / 50_000)) | (C("size") != 4))
        assert placed.cut and wrong.isEmpty() and placed.df.count() == 200_000
    finally:
        spark.conf.unset(HOT_ROWS_SETTING)
