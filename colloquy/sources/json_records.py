"""JSON objects out of files of any size and layout, each file read by many tasks.

A file may hold one array, lines, or objects one after the other. Spark's text
reader cuts it into blocks at any ``}``, so that it works on every store that
Spark reads, and every task has a byte range of its own. Whether a block begins
inside a text, and how deep inside an object, is not known before the blocks
ahead of it have been seen. So there are two passes:

1. Each block tells what it does to both: it flips being inside a text or not,
   and takes a depth ``d`` to ``max(d + rise, floor)``, with one such pair for
   either case. These functions are composed along each file, one row per block.
2. Each block is read again from its known beginning. An object ends where the
   depth comes back to zero. What crosses a border of blocks is put together from
   the pieces of its blocks; these are two rows per block at most.

The row order within a block is that of the file.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from colloquy.plans.shared import scratch_path

C = F.col
FEW_BLOCKS = 500_000  # rows of about 150 bytes that may go to every task; more blocks are joined by a sort
BETWEEN = b" \t\r\n,[]"  # what may stand between two objects
_escaped = re.compile(rb"\\.", re.DOTALL)
BLOCKS = "path string, start long, bytes long, flips boolean, rise long, floor long, rise_in long, floor_in long"
PIECES = "path string, start long, place long, whole boolean, ends boolean, value binary"


def _opened(text: bytes) -> tuple[int, int, bool]:
    """Braces opened outside texts if the bytes begin outside one and if inside one, and whether the quotes are odd."""
    if b"\\" in text:
        text = _escaped.sub(b"", text)
    if b'"' not in text:
        return text.count(b"{"), 0, False
    parts = text.split(b'"')
    return b"".join(parts[0::2]).count(b"{"), b"".join(parts[1::2]).count(b"{"), len(parts) % 2 == 0


def _fragments(batches: Iterator[pa.RecordBatch], *also: str) -> Iterator[tuple]:
    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in ("path", "start", *also)]
        yield from zip(*columns, (v.as_buffer().to_pybytes() for v in batch.column("value")))


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pass 1: a row per block of ``BLOCKS``."""
    held: dict[tuple[str, int], list] = {}
    for path, start, text in _fragments(batches):
        block = held.setdefault((path, start), [0, False, [0, 0], [0, 0]])
        block[0] += len(text) + 1
        outside, inside, odd = _opened(text)
        flips = block[1] != odd
        for starts_inside, depth in enumerate(block[2:]):
            now_inside = block[1] != bool(starts_inside)
            opened = inside if now_inside else outside
            closed = 0 if flips != bool(starts_inside) else 1  # the brace after the fragment may be inside a text
            depth[0] += opened - closed
            depth[1] = max(depth[1] + opened - closed, 0)
        block[1] = flips
    rows = [(path, start, b[0], b[1], *b[2], *b[3]) for (path, start), b in held.items()]
    names = [f.split()[0] for f in BLOCKS.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), *[pa.int64()] * 4]
    yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in enumerate(kinds)], names)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pass 2: objects that lie in the block, and the pieces of those that do not."""
    names = [f.split()[0] for f in PIECES.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.binary()]

    def pieces() -> Iterator[tuple]:
        rows = _fragments(batches, "inside", "depth", "unclosed")
        for (path, start), block in groupby(rows, key=lambda r: r[:2]):
            parts, place, begun = [], 0, False
            row = next(block)
            _, _, inside, depth, unclosed, _ = row
            while row is not None:
                text, row = row[-1], next(block, None)
                blank = not text.strip(BETWEEN) and depth == 0 and not inside
                if row is None and (blank if unclosed is None else unclosed):
                    parts.append(text)
                    break
                outside_opened, inside_opened, odd = _opened(text)
                depth += inside_opened if inside else outside_opened
                inside = inside != odd
                parts.append(text + b"}")
                if not inside:
                    depth = max(depth - 1, 0)
                    if depth == 0:
                        yield path, start, place, begun, True, b"".join(parts)
                        parts, place, begun = [], place + 1, True
            if parts:
                yield path, start, place, False, False, b"".join(parts)

    held, size = [], 0
    for piece in pieces():
        held.append(piece)
        size += len(piece[-1])
        if size > 1 << 22:
            yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in held], k) for n, k in enumerate(kinds)], names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in held], k) for n, k in enumerate(kinds)], names)


def _beginnings(_key: tuple, blocks: pa.Table) -> pa.Table:
    """How each block of a file begins, and whether its last fragment is without a brace."""
    blocks = blocks.sort_by([("start", "ascending")])
    sizes = blocks.column("bytes").to_pylist()
    flips = blocks.column("flips").to_pylist()
    ways = [list(zip(blocks.column(a).to_pylist(), blocks.column(b).to_pylist())) for a, b in (("rise", "floor"), ("rise_in", "floor_in"))]
    inside, depth, begun = False, 0, []
    for n, flip in enumerate(flips):
        begun.append((inside, depth))
        rise, floor = ways[inside][n]
        inside, depth = inside != flip, max(depth + rise, floor)
    over = sum(sizes) - blocks.column("size")[0].as_py()
    # one brace counted that is not there; a byte order mark is left out; a compressed file does not tell
    open_end = True if over in (1, -2) else False if over in (0, -3) else None
    last = len(flips) - 1
    return pa.table(
        {
            "of": blocks.column("path"),
            "at": blocks.column("start"),
            "inside": pa.array([i for i, _ in begun], pa.bool_()),
            "depth": pa.array([d for _, d in begun], pa.int64()),
            "unclosed": pa.array([open_end if n == last else False for n in range(len(flips))], pa.bool_()),
        }
    )


def json_objects(spark: SparkSession, path: str) -> DataFrame:
    """``value``: the text of every JSON object of the files, and what stands between objects and is no white space or comma.

    An object that never ends gives its pieces, one per block. After an object
    with a brace too many the next ones are whole again; after one with a brace
    too few they are part of it. Compressed files are one block each.
    """
    source = spark.read.option("lineSep", "}").text(path)
    fragments = source.select(
        C("_metadata.file_path").alias("path"),
        C("_metadata.file_block_start").alias("start"),
        C("_metadata.file_size").alias("size"),
        C("value").cast("binary").alias("value"),
    )
    stored: list[DataFrame] = []

    def put(df: DataFrame) -> DataFrame:
        at = scratch_path(spark, "json")
        df.write.parquet(at)
        stored.append(spark.read.schema(df.schema).parquet(at))
        return stored[-1]

    sizes = source.select(C("_metadata.file_path").alias("path"), C("_metadata.file_size").alias("size"))
    found = fragments.select("path", "start", "value").mapInArrow(_summaries, BLOCKS)
    blocks = put(found.join(sizes.distinct(), "path"))
    state = "of string, at long, inside boolean, depth long, unclosed boolean"
    begun = put(blocks.groupBy("path").applyInArrow(_beginnings, state))
    if begun.count() <= FEW_BLOCKS:
        known = fragments.join(F.broadcast(begun), (C("path") == C("of")) & (C("start") == C("at")))
    else:
        numbered = fragments.withColumn("row", F.monotonically_increasing_id())
        known = numbered.join(begun, (C("path") == C("of")) & (C("start") == C("at"))).repartition("path", "start")
        known = known.sortWithinPartitions("path", "start", "row")
    pieces = put(known.select("path", "start", "inside", "depth", "unclosed", "value").mapInArrow(_pieces, PIECES))
    whole = pieces.where("whole").select(C("value").cast("string").alias("value"))

    crossing = pieces.where("NOT whole")
    along = Window.partitionBy("path").orderBy("start", "place")
    ended = F.coalesce(F.sum(C("ends").cast("long")).over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbers = crossing.select("path", "start", "place", "ends").withColumn("object", ended)
    complete = numbers.withColumn("complete", F.max("ends").over(Window.partitionBy("path", "object")))
    alone = ~C("complete")
    keyed = crossing.join(complete.drop("ends"), ["path", "start", "place"]).select(
        "path", "object", F.when(alone, C("start")).alias("own_start"), F.when(alone, C("place")).alias("own_place"),
        F.struct("start", "place", C("value").cast("string").alias("text")).alias("piece"),
    )
    together = keyed.groupBy("path", "object", "own_start", "own_place").agg(F.array_sort(F.collect_list("piece")).alias("pieces"))
    joined = together.select(F.array_join(F.transform("pieces", lambda p: p["text"]), "").alias("value"))

    bare = F.ltrim(C("value"), F.lit(BETWEEN.decode()))
    before = r'(?s)^((?:[^"{]++|"(?:[^"\\]++|\\.)*+"?+)*+)(.*)$'
    split = lambda n: F.regexp_extract("bare", before, n)
    parts = F.when(C("bare").startswith("{"), F.array("bare")).otherwise(F.array(F.rtrim(split(1), F.lit(BETWEEN.decode())), split(2)))
    objects = whole.unionByName(joined).select(bare.alias("bare")).select(F.explode(parts).alias("value"))
    return objects.where("value <> ''")
