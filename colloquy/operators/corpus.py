"""Continued pre-training input: packing, and repeatable samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.functions.chance import key_text
from colloquy.functions.fixed import END_OF_TEXT
from colloquy.plans.ordered_groups import OrderedGroups, running_sum


SHARD_CHARS = 1 << 30


def shards_for(documents: DataFrame, shard_chars: int = SHARD_CHARS) -> int:
    """As many shards as the characters of the documents fill."""
    size = documents.agg(F.sum(F.length("text"))).first()[0] or 0
    return max(1, -(-size // shard_chars))


def pack_corpus(documents: DataFrame, block_chars: int, shards: int | None = None) -> DataFrame:
    """Documents end to end, cut into blocks of equal length.

    ``(shard, block, text, documents)``. A document goes to shard ``doc_id mod
    shards`` and is followed by the end-of-text mark. All of a shard's text is
    kept: documents run on from block to block and the last block may be short.
    ``shards`` is by default what the size of the documents asks for; a shard
    that is too large for one task is cut by ``OrderedGroups``. A document is
    cut in one pass: the rest of its first block, then whole blocks.
    """
    pieces = documents.select(
        F.pmod("doc_id", F.lit(shards or shards_for(documents))).alias("shard"),
        "doc_id",
        F.concat(F.coalesce("text", F.lit("")), F.lit(END_OF_TEXT)).alias("_text"),
    )
    placed = OrderedGroups.of(pieces, ["shard"], "doc_id").with_columns(
        _start=running_sum(F.length("_text"))
    )
    room = (F.lit(block_chars) - F.col("_start") % block_chars).cast("int")
    head = F.substring(F.col("_text"), F.lit(1), room)
    rest = F.substring(F.col("_text"), room + 1, F.length("_text"))
    parts = F.concat(
        F.array(head), F.regexp_extract_all(rest, F.lit(f"(?s).{{1,{block_chars}}}"), F.lit(0))
    )
    first = F.floor(F.col("_start") / block_chars)
    return (
        placed.df.select("shard", "doc_id", first.alias("_first"), F.posexplode(parts).alias("_n", "part"))
        .groupBy("shard", (F.col("_first") + F.col("_n")).alias("block"))
        .agg(
            F.expr("listagg(part, '') WITHIN GROUP (ORDER BY doc_id)").alias("text"),
            F.count(F.lit(1)).alias("documents"),
        )
    )


_DIGITS = 4
_FEW = 10_000


def cap_rows(df: DataFrame, rows: int, key: str, seed: str = "0") -> DataFrame:
    """A repeatable sample of ``rows`` rows: those with the lowest md5 of seed and key.

    The md5 of the last row of the sample is found by counts of rows per leading
    digits, a few digits at a time, so no task holds the sample. Repeated keys
    share their md5; if the sample ends among them, any of them fill it up.
    """
    if rows < 1:
        return df.limit(0)
    digest = F.md5(key_text(seed, F.col(key)))
    hashes = df.select(F.coalesce(digest, F.lit("")).alias("h"))
    last, left, same = "", rows, 0  # of the rows whose md5 begins with ``last``, ``left`` are wanted
    while len(last) < 32:
        upto = F.substring("h", 1, len(last) + _DIGITS).alias("p")
        counts = hashes.where(F.col("h").startswith(last)).groupBy(upto).count().collect()
        for last, same in sorted((r["p"], r["count"]) for r in counts):  # 16 ** _DIGITS at most
            if left <= same:
                break
            left -= same
        else:
            return df
        if same <= _FEW:
            few = sorted(r["h"] for r in hashes.where(F.col("h").startswith(last)).collect())
            last = few[left - 1]
            left, same = left - few.index(last), few.count(last)
            break
    found = F.coalesce(digest, F.lit(""))
    if left == same:
        return df.where(found <= last)
    return df.where(found < last).unionByName(df.where(found == last).limit(left))
