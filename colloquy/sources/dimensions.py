"""Small fixed tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colloquy.functions.fixed import (
    ADDED_TOKENS,
    FIRST_TOKEN_ID,
    SAMPLING_PRESETS,
    SMOKE_CASES,
    SPECIAL_TOKENS,
)

CASES = T.StructType(
    [
        T.StructField("name", T.StringType(), False),
        T.StructField("input", T.StringType(), False),
        T.StructField("type", T.StringType(), False),
        T.StructField("params", T.MapType(T.StringType(), T.DoubleType())),
    ]
)


def literal_cases(spark: SparkSession, rows: Sequence[tuple] = tuple(SMOKE_CASES)) -> DataFrame:
    """Test cases ``(name, input, type, params)`` written in code."""
    return spark.createDataFrame(list(rows), CASES)


def special_tokens(spark: SparkSession) -> DataFrame:
    """The 26 added tokens: ``(id, token, special)``."""
    rows = [
        F.struct(
            F.lit(FIRST_TOKEN_ID + i).alias("id"),
            F.lit(token).alias("token"),
            F.lit(token in SPECIAL_TOKENS).alias("special"),
        )
        for i, token in enumerate(ADDED_TOKENS)
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


TOKEN = "struct<content: string, lstrip: boolean, normalized: boolean, rstrip: boolean, single_word: boolean, special: boolean>"


def read_added_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The added tokens of a tokenizer's JSON configuration, one row each.

    ``(id, token, lstrip, normalized, rstrip, single_word, special)`` from the
    map ``added_tokens_decoder``, whose keys are the ids.
    """
    return (
        spark.read.schema(f"added_tokens_decoder map<string, {TOKEN}>")
        .option("multiLine", True)
        .json(path)
        .select(F.explode("added_tokens_decoder").alias("id", "t"))
        .select(
            F.col("id").cast("int"),
            F.col("t.content").alias("token"),
            "t.lstrip",
            "t.normalized",
            "t.rstrip",
            "t.single_word",
            "t.special",
        )
    )


def read_generation_config(spark: SparkSession, path: str) -> DataFrame:
    """Sampling settings and end tokens of a model's JSON generation configuration."""
    return (
        spark.read.schema(
            "do_sample boolean, temperature double, top_p double, top_k int, "
            "bos_token_id int, pad_token_id int, eos_token_id array<int>"
        )
        .option("multiLine", True)
        .json(path)
    )


def sampling_presets(spark: SparkSession) -> DataFrame:
    """One row per mode: ``(mode, temperature, top_p, top_k, min_p)``."""
    names = ["mode", "temperature", "top_p", "top_k", "min_p"]
    rows = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, r)]) for r in SAMPLING_PRESETS]
    return spark.range(1).select(F.inline(F.array(*rows)))
