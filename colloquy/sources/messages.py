"""Conversations as lists of messages, one JSON record per line.

``{"conv_id": 1, "messages": [{"role": ..., "content": ..., "tool_calls":
[...]}], "tools": [...]}``. Prompts show tools and call arguments as JSON with a
blank after commas and colons and with keys in their given order, and tell
arguments that are text from arguments that are an object. Spark's JSON
functions read both as the same text (``test_json_functions_do_not_tell_text_from_objects``),
so each record goes through Python's ``json`` in Arrow batches; the rest is an explode.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MESSAGES = (
    "messages array<struct<role: string, content: string, reasoning_content: string, "
    "tool_calls: array<struct<name: string, arguments: string>>>>, tools array<string>"
)
LIMITS = {"long": 1 << 63, "int": 1 << 31, "string": None}


def parsed(line: Column, key: str | None = "conv_id", kind: str = "long") -> Column:
    """A record ``conv_id`` and ``MESSAGES``; null for a line that is no such record.

    ``conv_id`` is the record's field ``key``: a whole number in the range of
    ``kind``, or a text if that is ``string``. Other values make the line a bad one. Without
    a key, ``conv_id`` is a hash of the line, so equal lines are one conversation.
    """
    limit = LIMITS[kind]

    # Nested, so that workers get the function by value.
    def parse(lines: pd.Series) -> pd.DataFrame:
        import json

        def text(value):
            return value if isinstance(value, str) else None

        def call(item):
            item = item.get("function") or item
            arguments = item.get("arguments")
            if not isinstance(arguments, str):
                arguments = json.dumps(arguments, ensure_ascii=False)
            return {"name": item.get("name"), "arguments": arguments}

        def message(m):
            calls = m.get("tool_calls")
            return {
                "role": text(m.get("role")),
                "content": text(m.get("content")),
                "reasoning_content": text(m.get("reasoning_content")),
                "tool_calls": [call(c) for c in calls] if calls else None,
            }

        def named(value):
            if limit is None:
                good = isinstance(value, str)
            else:
                good = type(value) is int and -limit <= value < limit
            if not good:
                raise ValueError("no key")
            return value

        def record(raw):
            try:
                row = json.loads(raw)
                tools = row.get("tools")
                found = [message(m) for m in row["messages"]]
                return {
                    "conv_id": None if key is None else named(row[key]),
                    "messages": found,
                    "tools": [json.dumps(t, ensure_ascii=False) for t in tools] if tools else None,
                }
            except (ValueError, KeyError, TypeError, AttributeError):
                return {"conv_id": None, "messages": None, "tools": None}

        return pd.DataFrame(
            [record(raw) for raw in lines], columns=["conv_id", "messages", "tools"]
        ).astype({"conv_id": object})

    return F.pandas_udf(parse, f"conv_id {kind}, {MESSAGES}")(line)


def turns_of(records: DataFrame) -> DataFrame:
    """One row per message, ``turn`` being its place in the list."""
    return records.select("conv_id", "tools", F.posexplode("messages").alias("turn", "m")).select(
        "conv_id", F.col("turn").cast("long"), "m.*", "tools"
    )


def read_messages(
    spark: SparkSession, path: str, key: str | None = "conv_id", kind: str = "long"
) -> tuple[DataFrame, DataFrame]:
    """The turns of a dataset, and the lines that are no records.

    ``key`` names the field that tells conversations apart, ``kind`` its type;
    None takes records that have no such field.
    """
    lines = spark.read.text(path)
    if key is None:
        lines = lines.distinct()
    records = lines.select("value", parsed(F.col("value"), key, kind).alias("r"))
    bad = records.where(F.col("r.messages").isNull()).select("value")
    good = records.where(F.col("r.messages").isNotNull())
    if key is None:
        return turns_of(good.select(F.xxhash64("value").alias("conv_id"), "r.messages", "r.tools")), bad
    return turns_of(good.select("r.*")), bad
