"""Helpers the operators share: stored tables, and cut points of an integer key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.plans.shared import scratch_path

C = F.col


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


class Stored:
    """Tables written to the shared folder in the course of one operator.

    A written table cuts the lineage: after the loss of an executor only what
    follows it is computed again. Tables that a later one replaces are deleted
    with ``drop``; what the result reads stays until the folder is cleared.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name = spark, name
        self.paths: dict[int, str] = {}

    def put(self, df: DataFrame) -> DataFrame:
        path = scratch_path(self.spark, self.name)
        df.write.parquet(path)
        kept = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(kept)] = path
        return kept

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            path = self.paths.pop(id(table), None)
            if path is not None:
                delete(self.spark, path)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a table of ours through the file system its path names."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


BINS = 1024


def integer_cuts(df: DataFrame, key: str, weight: Column, parts: int) -> list[int]:
    """At most ``parts - 1`` ascending keys that cut the rows into ranges of about equal weight.

    The cuts depend on the rows alone, not on their order or partitions: exact
    sums per bin of the key, and again within each bin that outweighs a range,
    down to single keys. A pass brings at most ``BINS`` sums per open bin to the
    driver; open bins are fewer than ``parts``. Range ``i`` has the keys from
    ``cuts[i - 1]`` up to but not including ``cuts[i]``; a null key is in range 0.
    """
    rows = df.select(C(key).cast("long").alias("k"), weight.cast("double").alias("w")).where("k IS NOT NULL")
    low, high, total = rows.agg(F.min("k"), F.max("k"), F.sum("w")).first()
    if low is None or not total or parts < 2:
        return []
    share = total / parts
    done: list[tuple[int, float]] = []  # first key of a bin, its weight
    todo = [(low, high)]
    while todo:
        spans = []
        for a, b in todo:
            width = max(1, -(-(b - a + 1) // BINS))
            spans.append((a, b, width))
        pick = None
        for n, (a, b, width) in enumerate(spans):
            at = C("k").between(a, b)
            # the difference of far keys may exceed 64 bits, so it is a decimal
            step = ((C("k").cast("decimal(20,0)") - F.lit(str(a)).cast("decimal(20,0)")) / F.lit(str(width)).cast("decimal(20,0)"))
            value = F.struct(F.lit(n).alias("n"), F.floor(step).cast("long").alias("i"))
            pick = F.when(at, value) if pick is None else pick.when(at, value)
        sums = rows.select(pick.alias("bin"), "w").where("bin IS NOT NULL").groupBy("bin").agg(F.sum("w").alias("w"))
        todo = []
        for found, w in sums.collect():
            a, b, width = spans[found.n]
            first = a + found.i * width
            last = min(b, first + width - 1)
            if w > share and last > first:
                todo.append((first, last))
            else:
                done.append((first, w))
    cuts, filled = [], 0.0
    for first, w in sorted(done):
        if filled and filled + w / 2 > share * (len(cuts) + 1) and len(cuts) < parts - 1:
            cuts.append(first)
        filled += w
    return cuts


def range_of(key: Column, cuts: list[int]) -> Column:
    """Number of the range that holds the key, found by two short searches."""
    if not cuts:
        return F.lit(0)
    step = max(1, round(len(cuts) ** 0.5))
    rows = [cuts[i : i + step] for i in range(0, len(cuts), step)]
    numbers = lambda values: F.array(*[F.lit(int(v)).cast("long") for v in values])
    upto = lambda values: F.size(F.filter(values, lambda c: c <= key.cast("long")))
    row = upto(numbers([r[0] for r in rows])) - 1
    inside = upto(F.get(F.array(*[numbers(r) for r in rows]), row))
    return F.when(key.isNull() | (row < 0), F.lit(0)).otherwise(row * step + inside)
