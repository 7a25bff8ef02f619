"""Parquet tables and chat turns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def read_turns(spark: SparkSession, folder: str) -> DataFrame:
    """Chat turns in long form: ``(conv_id, turn, role, content)``."""
    return read_table(spark, folder, "conversations").select(
        "conv_id", "turn", "role", F.col("text").alias("content")
    )
