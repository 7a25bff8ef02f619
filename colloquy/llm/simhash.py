"""Near copies by SimHash fingerprints and ball hashing.

Two fingerprints at most ``radius`` bits apart have a word in common that is
within half the radius of both: they meet in the middle. So every fingerprint
stands in the ball of all its variants within half the radius, and those that
meet in a variant are near.

A variant is sent to the task of its leading bits: the fingerprint goes once to
each prefix that any of its variants has, and the variants of that prefix are
made where they meet. This is the shuffle on variants, with the rows of a
fingerprint that would go to one task as one row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from colloquy.llm.common import Stored
from colloquy.llm.components import connected

C = F.col

SEED = 42
HASHES_AT_ONCE = 1 << 16
MEMBERS = 8_000  # of a prefix, on average; decides how many leading bits a prefix has
MOST_MEMBERS = 50_000  # a prefix with more is cut by further bits
FURTHER_BITS = 6
VARIANTS_AT_ONCE = 2_000_000


def shingle_hashes(text: str | None, width: int) -> Iterator[list[int]]:
    """Hashes of all runs of ``width`` words, in pieces of bounded size."""
    joined = b" ".join(text.encode().lower().split()) if text else b""
    if not joined:
        return
    spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    digest = xxhash.xxh64_intdigest
    runs = len(spaces) + 2 - width
    if runs < 1:
        yield [digest(joined, SEED)]
        return
    starts = np.concatenate([[0], spaces + 1])
    ends = np.concatenate([spaces, [len(joined)]])[width - 1 :]
    for at in range(0, runs, HASHES_AT_ONCE):
        till = min(runs, at + HASHES_AT_ONCE)
        yield [digest(joined[a:b], SEED) for a, b in zip(starts[at:till].tolist(), ends[at:till].tolist())]


def octet_sums(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits."""
    octets = np.ascontiguousarray(hashes).view(np.uint8).reshape(-1, 8)
    return np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def simhash(text: str | None, width: int = 4) -> int:
    """The fingerprint, as a signed 64-bit number. No words: zero."""
    ones, count = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(text, width):
        ones += octet_sums(np.array(hashes, np.uint64))
        count += len(hashes)
    return int(np.packbits(2 * ones > count, bitorder="little").view(np.int64)[0])


def fingerprint(text: Column, width: int = 4) -> Column:
    """Fingerprint of a text: lower case for A-Z, words between ASCII white space, shingles with repeats."""

    @pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash(t, width) for t in texts], dtype="int64")

    return of(text)


# Ball hashing


def masks(bits: int, most: int) -> list[list[int]]:
    """Words of ``bits`` bits, by how many are set, up to ``most``."""
    return [[sum(1 << i for i in chosen) for chosen in combinations(range(bits), n)] for n in range(min(bits, most) + 1)]


def prefix_bits(count: int, half: int) -> int:
    """Leading bits for which a prefix has about ``MEMBERS`` members."""
    for bits in range(8, 40):
        if count * sum(map(len, masks(bits, half))) / (1 << bits) <= MEMBERS:
            return bits
    return 40


def sent(rows: DataFrame, known: int, further: int, half: int) -> DataFrame:
    """Rows ``prefix, fp`` with each prefix longer by ``further`` bits, for all variants within ``half``."""
    own = C("fp").bitwiseXOR(F.lit(0))
    top = F.shiftrightunsigned(own, 64 - known - further)
    flips = F.array(*[F.lit(m).cast("long") for same in masks(further, half) for m in same])
    if not known:
        return rows.select(F.explode(F.transform(flips, lambda m: top.bitwiseXOR(m))).alias("prefix"), "fp")
    spent = F.bit_count(C("prefix").bitwiseXOR(F.shiftrightunsigned(own, 64 - known)))
    tail = top.bitwiseAND(F.lit((1 << further) - 1))
    longer = F.transform(
        F.filter(flips, lambda m: F.bit_count(m) + spent <= half),
        lambda m: F.shiftleft(C("prefix"), further).bitwiseOR(tail.bitwiseXOR(m)),
    )
    return rows.select(F.explode(longer).alias("prefix"), "fp")


def meetings(prefix: int, bits: int, fps: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of positions in ``fps`` that meet in a variant with this prefix.

    All that meet in a variant are paired with the one nearest to it, not with
    each other. Pairs are verified. Too many variants at once are made prefix by
    longer prefix.
    """
    half = (radius + 1) // 2
    width = 64 - bits
    spent = np.bitwise_count((fps >> np.uint64(width) if width < 64 else fps * 0) ^ np.uint64(prefix))
    here = np.flatnonzero(spent <= half)
    if len(here) < 2:
        return
    tails = masks(width, half) if width <= 64 and len(here) <= VARIANTS_AT_ONCE else []
    sizes = np.cumsum([len(m) for m in tails]) if tails else np.array([1 << 62])
    total = sum(int(sizes[min(len(sizes) - 1, half - int(s))]) * int(n) for s, n in zip(*np.unique(spent[here], return_counts=True)))
    if total > VARIANTS_AT_ONCE and width > 0:
        more = min(FURTHER_BITS, width)
        for tail in range(1 << more):
            for a, b in meetings(prefix << more | tail, bits + more, fps[here], radius):
                yield here[a], here[b]
        return
    low = fps[here] & np.uint64((1 << width) - 1)
    words, who, far = [], [], []
    for s in range(half + 1):
        own = np.flatnonzero(spent[here] == s)
        for n, same in enumerate(tails[: half - s + 1]):
            words.append((low[own][:, None] ^ np.array(same, np.uint64)[None, :]).ravel())
            who.append(np.repeat(own.astype(np.int32), len(same)))
            far.append(np.full(len(own) * len(same), s + n, np.uint8))
    words, who, far = np.concatenate(words), np.concatenate(who), np.concatenate(far)
    order = np.argsort(words, kind="stable")
    ordered = words[order]
    shared = np.zeros(len(ordered), bool)
    shared[1:] = ordered[1:] == ordered[:-1]
    shared[:-1] |= shared[1:].copy()
    order = order[shared]
    if not len(order):
        return
    words, who, far = words[order], who[order], far[order]
    order = np.lexsort((who, far, words))
    words, who, far = words[order], who[order], far[order]
    first = np.concatenate([[True], words[1:] != words[:-1]])
    centre = np.flatnonzero(first)[np.cumsum(first) - 1]
    pair = np.unique((who[centre].astype(np.int64) * len(here) + who)[(far[centre] + far <= radius) & ~first])
    a, b = here[pair // len(here)], here[pair % len(here)]
    near = (np.bitwise_count(fps[a] ^ fps[b]) <= radius) & (a != b)
    yield a[near], b[near]


def forest(count: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For each position the smallest one that the pairs connect it with."""
    label = np.arange(count)
    for a, b in pairs:
        while True:
            la, lb = label[a], label[b]
            differs = la != lb
            if not differs.any():
                break
            a, b, la, lb = a[differs], b[differs], la[differs], lb[differs]
            np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label = up
    return label


LINKS = "a long, b long"


def met(rows: DataFrame, bits: int, radius: int) -> DataFrame:
    """Links ``a, b`` that connect what the verified pairs of each prefix connect."""

    def within(key, table):
        fps = np.unique(table.column("fp").combine_chunks().to_numpy(zero_copy_only=False).view(np.uint64))
        label = forest(len(fps), meetings(key[0].as_py(), bits, fps, radius))
        moved = np.flatnonzero(label != np.arange(len(fps)))
        a, b = fps[label[moved]].view(np.int64), fps[moved].view(np.int64)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return rows.groupBy("prefix").applyInArrow(within, LINKS)


def near_links(spark: SparkSession, fps: DataFrame, radius: int, store: Stored) -> DataFrame:
    """Links between the distinct fingerprints ``fp``, enough to connect all that are within ``radius``."""
    half = (radius + 1) // 2
    bits = prefix_bits(fps.count(), half)
    rows, found = sent(fps, 0, bits, half), []
    while True:
        crowded = rows.groupBy("prefix").count().where(C("count") > MOST_MEMBERS).select("prefix")
        crowded = store.put(crowded) if bits + FURTHER_BITS <= 64 else crowded.limit(0)
        if bits + FURTHER_BITS > 64 or crowded.isEmpty():
            found.append(store.put(met(rows, bits, radius)))
            break
        found.append(store.put(met(rows.join(crowded, "prefix", "left_anti"), bits, radius)))
        rows = store.put(sent(rows.join(crowded, "prefix", "left_semi"), bits, FURTHER_BITS, half))
        bits += FURTHER_BITS
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    return links


def near_copies(
    spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 4, radius: int = 4, extra: dict[str, Column] | None = None
) -> DataFrame:
    """One row per document: ``key, fp, component, head``, and the columns of ``extra``.

    ``component`` is the smallest key among all documents that links of at most
    ``radius`` differing bits reach, the document itself included. Equal
    fingerprints are one node, so copies make no links. Texts without words
    (null, empty, blank) have fingerprint 0 and link as any other. A null key is
    never the smallest unless the component has no other. Repeated rows stay.
    ``head`` names the component by one of its fingerprints.
    """
    store = Stored(spark, "simhash")
    chosen = docs.select(C(key).alias("id"), fingerprint(C(text), width).alias("fp"), *[v.alias(k) for k, v in (extra or {}).items()])
    prints = store.put(chosen)
    nodes = store.put(prints.groupBy("fp").agg(F.min("id").alias("id")))
    heads = connected(spark, near_links(spark, nodes.select("fp"), radius, store), store)
    grouped = nodes.join(heads.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "id", F.coalesce("head", "fp").alias("head")
    )
    least = grouped.groupBy("head").agg(F.min("id").alias("component"))
    of = store.put(grouped.select("fp", "head").join(least, "head").select("fp", "component", "head"))
    return prints.join(of, "fp").select(C("id").alias(key), "fp", "component", "head", *(extra or {}))


def one_of_each(
    spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text", near: Callable[..., DataFrame] = near_copies
) -> DataFrame:
    """The rows of ``docs`` with the smallest key of each component of near copies, all columns as they were.

    ``near`` names the component of each document: ``head``.

    Of rows with that key one stays: that of the smallest hash of all its values.
    A null key comes after all others.
    """
    store = Stored(spark, "dedup")
    hashable = [f.name for f in docs.schema if "map<" not in f.dataType.simpleString()]
    tie = F.xxhash64(*[C(f"`{name}`") for name in hashable])
    copies = near(spark, docs, key, text, extra={"tie": tie})
    rows = copies.groupBy("head", C(key).alias("id"), "tie").agg(F.count("*").alias("n"))
    first = rows.groupBy("head").agg(F.min(F.struct(C("id").isNull().alias("last"), "id", "tie", "n")).alias("row"))
    kept = store.put(first.select("row.id", "row.tie", "row.n"))
    whole = docs.select(F.struct(*[C(f"`{c}`") for c in docs.columns]).alias("row"), C(key).alias("own"), tie.alias("own_tie"))
    same = C("own").eqNullSafe(C("id")) & (C("own_tie") == C("tie"))
    result = whole.join(kept.where("n = 1"), same, "left_semi").select("row.*")
    again = kept.where("n > 1")
    if again.isEmpty():  # no row is there twice in full
        return result
    one = whole.join(again, same).groupBy("id", "tie").agg(F.first("row").alias("row")).select("row.*")
    return result.unionByName(one)


def hexadecimal(fp: Column) -> Column:
    """The 16 lower-case digits of a signed 64-bit number."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
