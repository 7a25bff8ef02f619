"""Latency summaries that merge: per batch of runs a row per configuration, put together when read.

Counts, sums and maxima are exact. Percentiles come from quantile sketches, whose
size does not grow with the runs and whose merging loses nothing that one sketch
over all runs would keep. ``answers.latency_summary`` is the exact way, over a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

C = F.col
SKETCH_SIZE = 400
#: Largest distance of a percentile's share of runs from the one asked for, with 99 % confidence at ``SKETCH_SIZE``.
RANK_ERROR = 0.01


def batch_summary(runs: DataFrame) -> DataFrame:
    """``config, runs, timed, sum_s, max_s, sketch`` of runs ``config, elapsed_s``; a run without a time is a run only."""
    return runs.groupBy("config").agg(
        F.count(F.lit(1)).alias("runs"),
        F.count("elapsed_s").alias("timed"),
        F.sum("elapsed_s").alias("sum_s"),
        F.max("elapsed_s").alias("max_s"),
        F.kll_sketch_agg_double("elapsed_s", SKETCH_SIZE).alias("sketch"),
    )


def merged(summaries: DataFrame) -> DataFrame:
    """One row per configuration of any number of summaries."""
    return summaries.groupBy("config").agg(
        F.sum("runs").alias("runs"),
        F.sum("timed").alias("timed"),
        F.sum("sum_s").alias("sum_s"),
        F.max("max_s").alias("max_s"),
        F.kll_merge_agg_double("sketch", SKETCH_SIZE).alias("sketch"),
    )


def latency_of(summaries: DataFrame) -> DataFrame:
    """``config, runs, mean_s, max_s, p50_s, p95_s`` of summaries; the percentiles within ``RANK_ERROR``, null without times."""
    quantile = lambda share: F.when(C("timed") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(share)))
    return merged(summaries).select(
        "config", "runs", F.try_divide("sum_s", "timed").alias("mean_s"), "max_s", quantile(0.5).alias("p50_s"), quantile(0.95).alias("p95_s")
    )


def summarise(runs: DataFrame, output: str, checkpoint: str, trigger: dict) -> StreamingQuery:
    """Write each batch's summary to ``output``; a batch that is run again replaces its own."""

    def process(batch: DataFrame, number: int) -> None:
        batch_summary(batch).write.mode("overwrite").parquet(f"{output}/batch={number}")

    return runs.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def read_summaries(spark: SparkSession, output: str) -> DataFrame:
    return spark.read.parquet(output).drop("batch")
