"""Document fingerprints that add up: homomorphic hashes of multisets of paragraphs.

A fingerprint is the sum, lane by lane, of vectors hashed from the paragraphs
of a text. Addition modulo a power of two has neither order nor loss, so equal
multisets have equal fingerprints in any order, and a paragraph is inserted or
deleted by adding or subtracting its vector. Two kinds of lanes:

- ``EVEN_LANES`` lanes modulo 2**64 of uniform values, of whole paragraphs: for equality;
- ``SIGN_LANES`` lanes modulo 2**32 of values +1 and -1, of pieces of paragraphs:
  the squared difference of two sums estimates how many pieces differ, so they
  tell how alike two texts are.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from colloquy.llm.common import Stored, integer_cuts, range_of

C = F.col
EVEN_LANES = 16
SIGN_LANES = 128
PIECE_ENDS = 8  # one word in so many ends a piece
AT_ONCE = 4096
RANGE_BYTES = 16 << 20  # of text that are sorted together


def paragraphs(text: str | None) -> list[bytes]:
    """Lines with something other than white space, without white space around them."""
    return [p for line in (text or "").split("\n") if (p := line.strip().encode())]


def pieces(paragraph: bytes) -> Iterator[bytes]:
    """Runs of words, each up to a word whose own checksum ends it, so an edit moves no other ends."""
    run: list[bytes] = []
    for word in paragraph.split():
        run.append(word)
        if not zlib.crc32(word) % PIECE_ENDS:
            yield b" ".join(run)
            run = []
    if run:
        yield b" ".join(run)


class Sum:
    """A fingerprint: the sums of both kinds of lanes."""

    def __init__(self, even: np.ndarray | None = None, sign: np.ndarray | None = None):
        self.even = np.zeros(EVEN_LANES, np.uint64) if even is None else even
        self.sign = np.zeros(SIGN_LANES, np.uint32) if sign is None else sign

    @classmethod
    def of(cls, text: str | None) -> Sum:
        whole = paragraphs(text)
        return cls().changed(Counter(whole), Counter(x for p in whole for x in pieces(p)))

    def changed(self, whole: Counter, parts: Counter) -> Sum:
        """With these paragraphs and pieces inserted, or deleted where the count is negative."""
        even, sign = self.even.copy(), self.sign.copy()
        for names, counts in in_runs(whole):
            data = b"".join(hashlib.shake_128(p).digest(8 * EVEN_LANES) for p in names)
            even += (np.frombuffer(data, np.uint64).reshape(-1, EVEN_LANES) * counts.astype(np.uint64)[:, None]).sum(0, np.uint64)
        for names, counts in in_runs(parts):
            data = b"".join(hashlib.blake2b(p, digest_size=SIGN_LANES // 8).digest() for p in names)
            bits = np.unpackbits(np.frombuffer(data, np.uint8).reshape(-1, SIGN_LANES // 8), axis=1)
            sign += ((2 * bits.astype(np.int64) - 1) * counts[:, None]).sum(0).astype(np.uint32)
        return Sum(even, sign)

    def likeness(self, other: Sum) -> float:
        """From 0 (nothing in common) to 1 (equal): twice the common mass over the mass of both."""
        if self == other:
            return 1.0
        a, b = self.sign.view(np.int32).astype(float), other.sign.view(np.int32).astype(float)
        both = float(a @ a + b @ b)
        return min(1.0, max(0.0, 2 * float(a @ b) / both)) if both else 0.0

    def __eq__(self, other: object) -> bool:
        return isinstance(other, Sum) and (self.even == other.even).all() and (self.sign == other.sign).all()

    def __add__(self, other: Sum) -> Sum:
        return Sum(self.even + other.even, self.sign + other.sign)

    def __sub__(self, other: Sum) -> Sum:
        return Sum(self.even - other.even, self.sign - other.sign)

    def hex(self) -> str:
        return self.even.astype("<u8").tobytes().hex() + self.sign.astype("<u4").tobytes().hex()

    @classmethod
    def from_hex(cls, text: str) -> Sum:
        data = bytes.fromhex(text)
        return cls(np.frombuffer(data[: 8 * EVEN_LANES], "<u8").copy(), np.frombuffer(data[8 * EVEN_LANES :], "<u4").copy())


def in_runs(counted: Counter) -> Iterator[tuple[list[bytes], np.ndarray]]:
    found = [(k, n) for k, n in counted.items() if n]
    for at in range(0, len(found), AT_ONCE):
        run = found[at : at + AT_ONCE]
        yield [k for k, _ in run], np.array([n for _, n in run], np.int64)


def fingerprint(text: Column) -> Column:
    """Fingerprint of a text as hexadecimal digits; a null text counts as empty, whose fingerprint is zero."""

    @pandas_udf("string")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([Sum.of(t).hex() for t in texts], dtype=object)

    return of(text)


EDITED = "n_chars long, edited string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def edited(text: str, following: str) -> str:
    """The text with its latter half replaced by as many first characters of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compared(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each text's fingerprint beside those of its edited text and of the next document.

    Columns ``key`` and those of ``EDITED``. The next document is that of the
    next higher integer key, after the last the first; a single document is its
    own next. Rows of one key are in the order of their texts, null keys come
    first. A null text counts as empty. Other columns are not read. The edited
    text's fingerprint comes from the text's own by deletion and insertion.

    Texts are sorted once, in ranges of about equal size whose limits depend on
    the rows alone. The first row of a range goes to the range before it too, so
    every row meets its next one.
    """
    kind = docs.schema[key].dataType.simpleString()
    content = F.coalesce(C(text), F.lit("")).alias("text")
    rows = docs.select(C(key).alias("key"), content)
    store = Stored(spark, "multiset")
    sizes = store.put(rows.select("key", (F.octet_length("text") + 1).alias("size")))
    total = sizes.agg(F.sum("size")).first()[0] or 0
    cuts = integer_cuts(sizes, "key", C("size"), max(1, round(total / RANGE_BYTES)))
    at = range_of(C("key"), cuts)
    firsts = sizes.groupBy(at.alias("range")).agg(F.min("key").alias("first"), F.max(C("key").isNull()).alias("nulls"))
    held = sorted(firsts.collect())  # one row per range
    store.drop(sizes)
    count = len(cuts) + 1
    first: list[int | None] = [None] * count
    before = [0] * count
    for n, row in enumerate(held):
        first[row["range"]] = None if row["nulls"] else row["first"]
        before[row["range"]] = held[n - 1]["range"]
    lent = C("key").eqNullSafe(F.get(F.array(*[F.lit(f).cast("long") for f in first]), at))
    back = F.get(F.array(*[F.lit(b) for b in before]), at)
    own = F.struct(at.alias("range"), F.lit(False).alias("lent"))
    places = F.when(lent, F.array(own, F.struct(back.alias("range"), F.lit(True).alias("lent")))).otherwise(F.array(own))
    dealt = rows.select(F.explode(places).alias("at"), "key", "text").select("at.range", "at.lent", "key", "text")
    dealt = dealt.repartitionById(count, C("range")).sortWithinPartitions("range", "lent", "key", "text")
    return dealt.mapInArrow(walked, f"key {kind}, {EDITED}").withColumnRenamed("key", key)


def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order; a row is ready when the next one of its range is there."""
    names = ["key", *[part.split()[0] for part in EDITED.split(", ")]]
    last = None  # range, key, text, its fingerprint, its paragraphs and pieces
    for batch in batches:
        out: list[tuple] = []
        keys = batch.column("key")
        for n, (place, lent, text) in enumerate(
            zip(batch.column("range").to_pylist(), batch.column("lent").to_pylist(), batch.column("text").to_pylist())
        ):
            if lent and (last is None or last[0] != place):
                continue
            whole = Counter(paragraphs(text))
            parts = Counter(x for p in paragraphs(text) for x in pieces(p))
            print_ = Sum().changed(whole, parts)
            if last is not None and last[0] == place:
                out.append((last[1], *row_of(*last[2:], text, print_)))
            last = None if lent else (place, keys[n].as_py(), text, print_, whole, parts)
        if out:
            columns = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], keys.type), pa.array(columns[1], pa.int64()), *[pa.array(c) for c in columns[2:]]], names
            )


def row_of(text: str, print_: Sum, whole: Counter, parts: Counter, following: str, next_print: Sum) -> tuple:
    after = edited(text, following)
    new_whole, new_parts = Counter(paragraphs(after)), Counter(x for p in paragraphs(after) for x in pieces(p))
    new_whole.subtract(whole)
    new_parts.subtract(parts)
    changed = print_.changed(new_whole, new_parts)
    return len(text), after, print_.hex(), changed.hex(), print_.likeness(changed), print_.likeness(next_print)
