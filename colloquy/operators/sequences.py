"""Examples of token ids packed whole into sequences of a fixed capacity.

Examples are dealt to shards by key; a shard's sizes are counted, and its counts
are packed best fit, the large ones first: an example goes where the least room
is left that still holds it. Open sequences are kept by the room they have left,
in a tree over the rooms from 0 to the capacity, so a step costs the logarithm of
the capacity. Only counts of sizes reach Python; the ids move in Spark alone.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

C = F.col
SHARD_ROWS = 50_000
PLACES = "shard int, size int, rank int, bin int, slot int"


class Rooms:
    """Open sequences by the room they have left; finds the least room that is enough."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, bin: int) -> None:
        self.bins[room].append(bin)
        self._change(room, 1)

    def _change(self, room: int, by: int) -> None:
        node = room + self.leaves
        while node:
            self.count[node] += by
            node >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """Remove and return (room, sequence) with the least room of at least ``least``."""
        node = least + self.leaves
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node + (not self.count[2 * node])
        room = node - self.leaves
        self._change(room, -1)
        return room, self.bins[room].pop()


def best_fit(sizes: list[tuple[int, int]], capacity: int) -> list[tuple[int, int, int, int]]:
    """``(size, rank, bin, slot)`` of every example, of ``(size, how many)`` pairs; too large ones have a bin each."""
    rooms, used, placed = Rooms(capacity), [], []
    for size, many in sorted(sizes, reverse=True):
        for rank in range(1, many + 1):
            found = rooms.take(size) if size <= capacity else None
            if found is None:
                room, bin = max(capacity, size), len(used)
                used.append(0)
            else:
                room, bin = found
            placed.append((size, rank, bin, used[bin]))
            used[bin] += 1
            if size <= capacity:
                rooms.add(room - size, bin)
    return placed


def pack_examples(examples: DataFrame, capacity: int, key: str = "example_id", ids: str = "ids", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``shard, bin, ids, positions, segments, examples, is_over``: sequences of whole examples.

    ``positions`` begin at 0 with each example, ``segments`` number a sequence's
    examples from 1, ``examples`` are their keys in that order. No example is cut:
    one above the capacity is a sequence of its own, with ``is_over``. An
    example without ids, or with null, is in a sequence too, without ids. Rows
    of equal keys are packed each. The result depends on keys and sizes, not on
    partitions; among equal keys of one size any order may hold.
    """
    rows = examples.select(C(key).alias("key"), F.coalesce(C(ids), F.array().cast(examples.schema[ids].dataType)).alias("own"))
    shards = max(1, -(-rows.count() // shard_rows))
    rows = rows.select("*", F.size("own").alias("size"), F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int").alias("shard"))

    def packed(shard_key: tuple, counts: pa.Table) -> pa.Table:
        pairs = list(zip(counts.column("size").to_pylist(), counts.column("count").to_pylist()))
        columns = list(zip(*best_fit(pairs, capacity)))
        shard = pa.array([shard_key[0].as_py()] * len(columns[0]), pa.int32())
        return pa.table([shard, *[pa.array(c, pa.int32()) for c in columns]], ["shard", "size", "rank", "bin", "slot"])

    places = rows.groupBy("shard", "size").count().groupBy("shard").applyInArrow(packed, PLACES)
    rank = F.row_number().over(Window.partitionBy("shard", "size").orderBy("key"))
    placed = rows.withColumn("rank", rank).join(places, ["shard", "size", "rank"])
    parts = F.array_sort(F.collect_list(F.struct("slot", "key", "own")))
    bins = placed.groupBy("shard", "bin").agg(parts.alias("parts"))
    counted = lambda p: F.when(F.size(p["own"]) > 0, F.sequence(F.lit(0), F.size(p["own"]) - 1)).otherwise(F.array().cast("array<int>"))
    numbered = lambda p, n: F.array_repeat(n + 1, F.size(p["own"]))
    return bins.select(
        "shard",
        "bin",
        F.flatten(F.transform("parts", lambda p: p["own"])).alias("ids"),
        F.flatten(F.transform("parts", counted)).alias("positions"),
        F.flatten(F.transform("parts", numbered)).alias("segments"),
        F.transform("parts", lambda p: p["key"]).alias("examples"),
    ).withColumn("is_over", F.size("ids") > capacity)
