"""Merged latency summaries against exact ones."""

import random

from pyspark.sql import functions as F

from colloquy.operators.answers import latency_summary
from colloquy.plans.shared import scratch_path
from colloquy.streaming import latency

C = F.col
RUNS = "config string, elapsed_s double, runs string, sketch string"


def shares(rows, config, value):
    mine = [s for c, s, *_ in rows if c == config and s is not None]
    return sum(s < value for s in mine) / len(mine), sum(s <= value for s in mine) / len(mine)


def test_batches_agree_with_one_table(spark):
    chance = random.Random(1)
    rows = [(f"c{n % 3}", None if n % 97 == 0 else chance.lognormvariate(0, 1 + n % 3), "x", "y") for n in range(12_000)]
    rows += [("ties", float(n % 2), "x", "y") for n in range(500)] + [("none", None, "x", "y")]
    runs = spark.createDataFrame(rows, RUNS)
    folder, base = scratch_path(spark, "runs"), scratch_path(spark, "latency")
    for n in range(5):
        runs.where(F.pmod(F.hash("elapsed_s", "config"), F.lit(5)) == n).coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(runs.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    latency.summarise(stream, f"{base}/out", f"{base}/checkpoint", {"availableNow": True}).awaitTermination()
    summaries = latency.read_summaries(spark, f"{base}/out")
    assert summaries.groupBy("config").count().agg(F.max("count")).first()[0] == 5
    exact = {r.config: r for r in latency_summary(runs).collect()}
    for got in (latency.latency_of(summaries), latency.latency_of(latency.batch_summary(runs))):
        found = {r.config: r for r in got.collect()}
        assert set(found) == set(exact)
        for config, want in exact.items():
            r = found[config]
            assert (r.runs, r.max_s) == (want.runs, want.max_s)
            if config == "none":
                assert (r.mean_s, r.p50_s, r.p95_s) == (None, None, None) == (want.mean_s, want.p50_s, want.p95_s)
                continue
            assert abs(r.mean_s - want.mean_s) < 1e-9
            for value, share in ((r.p50_s, 0.5), (r.p95_s, 0.95)):
                below, upto = shares(rows, config, value)
                assert below - 2 * latency.RANK_ERROR <= share <= upto + 2 * latency.RANK_ERROR


def test_no_runs(spark):
    assert latency.latency_of(latency.batch_summary(spark.createDataFrame([], RUNS))).collect() == []
