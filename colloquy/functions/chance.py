"""Numbers in (0, 1) that depend on their key only, so that re-runs agree."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_text(tag: str, *keys: Column) -> Column:
    return F.concat_ws("|", F.lit(tag), *[k.cast("string") for k in keys])


def unit(tag: str, *keys: Column) -> Column:
    """The first 32 bits of an md5 of the keys, scaled into the open unit interval."""
    head = F.conv(F.substring(F.md5(key_text(tag, *keys)), 1, 8), 16, 10).cast("bigint")
    return (head + F.lit(0.5)) / F.lit(4294967296.0)
