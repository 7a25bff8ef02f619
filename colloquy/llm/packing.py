"""Shards balanced in bytes, tokens and rows at once, by vector bin packing.

Rows with equal texts are a group and stay together, unless a group is itself a
large part of a shard; then it is cut into pieces. Pieces are packed, large ones
first, each into the shard where the dot product of its sizes and the shard's
residual capacities is highest among those it fits in; where no shard has room
for all sizes, the size that would go furthest beyond its part decides.

Packing is sequential, so it is done twice over small inputs instead of once
over all: the pieces of a block are packed into as many bundles as there are
shards, in parallel for all blocks, and then the bundles into the shards.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.llm.common import Stored

C = F.col
SIZES = ("bytes", "tokens", "rows")
FINE = 16  # a piece of a cut group is at most this part of a shard, in every size
BLOCK_PIECES = 100_000
SLACK = 1e-3  # by which a shard may exceed its even part while others have room
FIRST_COUNTS = 5  # times that an excess of bytes weighs as much as one of tokens or rows
SLOT_ROWS = 50_000


def pack(sizes: np.ndarray, shards: int) -> np.ndarray:
    """A shard for each row of sizes, which are parts of the whole.

    A shard's capacity in every size is its even part of the whole. An item goes
    where the dot product of its sizes and the residual capacities is highest, of
    the shards where it fits; if there is none, where it exceeds the capacity
    least in the size that it exceeds most, the first size counting
    ``FIRST_COUNTS`` times. Ties go to the shard of lowest number.
    """
    scaled = np.asarray(sizes, float) * shards
    totals = scaled.sum(axis=0)
    scaled = scaled / np.where(totals > 0, totals, 1) * shards
    left = np.ones((shards, scaled.shape[1]))
    weights = np.array([FIRST_COUNTS] + [1] * (scaled.shape[1] - 1))
    chosen = np.empty(len(scaled), np.int32)
    order = np.lexsort((np.arange(len(scaled)), -scaled.sum(axis=1)))
    for n in order:
        item = scaled[n]
        value = left @ item
        room = left + SLACK >= item
        fits = room.all(axis=1)
        over = np.minimum((left - item) * weights, 0).min(axis=1) + left[:, 0] * 1e-6
        best = int(np.argmax(np.where(fits, value, -np.inf) if fits.any() else over))
        left[best] -= item
        chosen[n] = best
    return chosen


def assign(
    spark: SparkSession, docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key, size, crc32, shard, slot`` of every row; slots count from 0 in each shard without gaps.

    ``size`` is the UTF-8 bytes of the text (null: none) plus 1, tokens are runs
    between white space. Null and empty texts are one group. Repeated rows and
    null keys are placed like others, each with a slot of its own. An empty
    table gives no rows. Other columns are not read. The result depends on the
    rows alone.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    store = Stored(spark, "packing")
    content = F.coalesce(C(text), F.lit(""))
    words = F.size(F.filter(F.split(content, r"\s+"), lambda w: w != ""))
    rows = store.put(
        docs.select(
            C(key).alias("key"),
            F.unhex(F.sha2(content, 256)).alias("digest"),
            (F.octet_length(content) + 1).cast("long").alias("bytes"),
            words.cast("long").alias("tokens"),
            F.crc32(content.cast("binary")).alias("crc32"),
        )
    )
    whole = rows.agg(F.sum("bytes").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")).first()
    whole = {name: whole[name] or 0 for name in SIZES}
    groups = rows.groupBy("digest").agg(
        F.sum("bytes").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")
    )
    # pieces a group is cut into: at most 3 * FINE * shards groups exceed a piece in some size
    parts = F.greatest(*[F.ceil(C(n) * (FINE * shards) / F.lit(max(1, whole[n]))) for n in SIZES])
    large = store.put(groups.select("digest", F.least(parts, C("rows")).cast("long").alias("cut")).where("cut > 1"))
    cut = rows.join(F.broadcast(large), "digest", "left")  # bounded by the number of shards, see above
    piece = F.when(C("cut").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("key", "crc32"), C("cut")))
    cut = cut.select("*", piece.cast("long").alias("piece"))
    pieces = store.put(
        cut.groupBy("digest", "piece").agg(
            F.sum("bytes").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")
        )
    )
    blocks = max(1, -(-pieces.count() // BLOCK_PIECES))
    bundled = store.put(bundles(pieces, blocks, shards))
    placed = store.put(shards_of(bundled, shards))
    where = bundled.select("digest", "piece", "block", "bundle").join(placed, ["block", "bundle"]).select("digest", "piece", "shard")
    seated = cut.join(where, ["digest", "piece"]).select("key", "bytes", "crc32", "digest", "shard")
    return slots(store, store.put(seated), whole["rows"]).select(
        C("key").alias(key), C("bytes").alias("size"), "crc32", "shard", "slot"
    )


def bundles(pieces: DataFrame, blocks: int, shards: int) -> DataFrame:
    """Pack the pieces of each block into ``shards`` bundles."""

    def run(table):
        sizes = np.stack([table.column(n).to_numpy() for n in SIZES], axis=1)
        tie = table.column("digest").combine_chunks().to_pylist()
        order = sorted(range(len(tie)), key=lambda i: (tie[i], table.column("piece")[i].as_py()))
        bundle = np.empty(len(tie), np.int32)
        bundle[order] = pack(sizes[order], shards)
        return table.append_column("bundle", pa.array(bundle, pa.int32()))

    block = F.pmod(F.xxhash64("digest", "piece"), F.lit(blocks)).cast("int").alias("block")
    return (
        pieces.select("digest", "piece", *SIZES, block)
        .groupBy("block")
        .applyInArrow(run, "digest binary, piece long, bytes long, tokens long, rows long, block int, bundle int")
    )


def shards_of(bundled: DataFrame, shards: int) -> DataFrame:
    """``block, bundle, shard``; one task packs ``shards`` bundles for each ``BLOCK_PIECES`` pieces."""

    def run(table):
        block, bundle = table.column("block").to_numpy(), table.column("bundle").to_numpy()
        order = np.lexsort((bundle, block))
        sizes = np.stack([table.column(n).to_numpy() for n in SIZES], axis=1)[order]
        return pa.table(
            {"block": block[order], "bundle": bundle[order], "shard": pa.array(pack(sizes, shards), pa.int32())}
        )

    sums = bundled.groupBy("block", "bundle").agg(*[F.sum(n).alias(n) for n in SIZES])
    return sums.groupBy(F.lit(0).alias("all")).applyInArrow(
        lambda table: run(table), "block int, bundle int, shard int"
    )


def slots(store: Stored, rows: DataFrame, count: int) -> DataFrame:
    """Number the rows of each shard from 0: rows are numbered in blocks, and blocks follow each other."""
    blocks = max(1, count // SLOT_ROWS)
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("key", "digest"), F.lit(blocks)).cast("int"))
    sizes = store.put(dealt.groupBy("shard", "block").count())

    def offsets(table):
        order = np.lexsort((table.column("block").to_numpy(), table.column("shard").to_numpy()))
        shard, block, n = (table.column(c).to_numpy()[order] for c in ("shard", "block", "count"))
        before = np.cumsum(n) - n
        first = np.searchsorted(shard, shard, side="left")
        return pa.table({"shard": shard, "block": block, "first": before - before[first]})

    from pyspark.sql.window import Window

    firsts = sizes.groupBy(F.lit(0).alias("all")).applyInArrow(lambda t: offsets(t), "shard int, block int, first long")
    order = Window.partitionBy("shard", "block").orderBy("key", "digest")
    numbered = dealt.withColumn("n", F.row_number().over(order))
    return numbered.join(firsts, ["shard", "block"]).withColumn("slot", (C("first") + C("n") - 1).cast("long"))
