"""Benchmark decontamination by greedy string tiling.

Texts and test items are words. Runs of ``SHORTEST`` words that a text shares
with an item, found by a rolling hash, are the seeds. Seeds in step make longest
matches, and again and again the longest match with no marked word is marked as
a tile. Tiles do not overlap and may stand in any order, so a passage whose
parts were moved about is covered as well as one in order.
"""

from __future__ import annotations

import heapq
import re
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

C = F.col
SHORTEST = 5
COVERED = 0.6
BLOCK_CHARS = 8 << 20  # of test items that every task holds at a time
TEXT_AT_ONCE = 1 << 20
_word = re.compile(r"\w+")
_base = np.uint64(0x9E3779B97F4A7C15)


def portions(text: str) -> Iterator[str]:
    """The text in pieces of bounded length, cut at white space."""
    at = 0
    while len(text) - at > TEXT_AT_ONCE:
        end = at + TEXT_AT_ONCE
        while end < len(text) and not text[end].isspace():
            end += 1
        yield text[at:end]
        at = end
    yield text[at:]


def words(text: str | None) -> list[str]:
    return _word.findall((text or "").lower())


def rolling(ids: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` numbers."""
    out = np.zeros(len(ids) - size + 1, np.uint64)
    for n in range(size):
        out = out * _base + ids[n : len(ids) - size + 1 + n].astype(np.uint64) + np.uint64(1)
    return out


class Items:
    """Test items of one block, and where each seed stands in them."""

    def __init__(self, items: list[tuple[object, str | None]], shortest: int):
        self.shortest = shortest
        self.number: dict[str, int] = {}
        self.keys, self.texts = [], []
        hashes, owners, places = [], [], []
        for key, text in items:
            ids = np.array([self.number.setdefault(w, len(self.number)) for w in words(text)], np.int64)
            if len(ids) < shortest:
                continue
            seeds = rolling(ids, shortest)
            hashes.append(seeds)
            owners.append(np.full(len(seeds), len(self.keys), np.int32))
            places.append(np.arange(len(seeds), dtype=np.int32))
            self.keys.append(key)
            self.texts.append(ids)
        none = [np.zeros(0, np.uint64)]
        found = np.concatenate(hashes or none)
        order = np.argsort(found, kind="stable")
        self.hashes = found[order]
        self.owners, self.places = (np.concatenate(x or none)[order].astype(np.int64) for x in (owners, places))

    def numbered(self, text: str) -> np.ndarray:
        """Numbers of the words of a text; -1 for one that no item has."""
        number = self.number.get
        return np.concatenate([np.array([number(w, -1) for w in words(p)], np.int64) for p in portions(text)])

    def shared(self, ids: np.ndarray) -> dict[int, list[tuple[int, int]]]:
        """By item, the places of seeds in the item and in the text."""
        size = self.shortest
        if len(ids) < size or not len(self.hashes):
            return {}
        known = np.concatenate([[0], np.cumsum(ids >= 0)])
        starts = np.flatnonzero(known[size:] - known[:-size] == size)
        if not len(starts):
            return {}
        hashes = np.zeros(len(starts), np.uint64)
        for n in range(size):
            hashes = hashes * _base + ids[starts + n].astype(np.uint64) + np.uint64(1)
        first = np.searchsorted(self.hashes, hashes, side="left")
        hit = (first < len(self.hashes)) & (self.hashes[np.minimum(first, len(self.hashes) - 1)] == hashes)
        found = defaultdict(list)
        last = np.searchsorted(self.hashes, hashes[hit], side="right")
        for p, a, b in zip(starts[hit].tolist(), first[hit].tolist(), last.tolist()):
            run = ids[p : p + size]
            for n in range(a, b):
                owner, q = int(self.owners[n]), int(self.places[n])
                if (self.texts[owner][q : q + size] == run).all():
                    found[owner].append((q, p))
        return found


def tiles(seeds: list[tuple[int, int]], shortest: int) -> list[tuple[int, int, int]]:
    """Non-overlapping tiles ``place in the item, place in the text, length``, the longest first.

    Of equally long matches the first one in the item, then in the text, is marked.
    """
    by_step: dict[int, list[int]] = defaultdict(list)
    for q, p in seeds:
        by_step[p - q].append(q)
    heap = []
    for step, places in by_step.items():
        places.sort()
        begin = 0
        for n in range(1, len(places) + 1):
            if n == len(places) or places[n] != places[n - 1] + 1:
                heap.append((-(places[n - 1] - places[begin] + shortest), places[begin], places[begin] + step))
                begin = n
    heapq.heapify(heap)
    in_item: set[int] = set()
    in_text: set[int] = set()
    marked = []
    while heap:
        length, q, p = heapq.heappop(heap)
        free = [n for n in range(-length) if q + n not in in_item and p + n not in in_text]
        if len(free) == -length:
            marked.append((q, p, -length))
            in_item.update(range(q, q - length))
            in_text.update(range(p, p - length))
            continue
        begin = 0
        for n in range(1, len(free) + 1):  # what is left of it, as shorter matches
            if n == len(free) or free[n] != free[n - 1] + 1:
                if n - begin >= shortest:
                    heapq.heappush(heap, (-(n - begin), q + free[begin], p + free[begin]))
                begin = n
    return marked


def covered(text: str | None, items: Items) -> list[tuple[object, float, list[tuple[int, int, int]]]]:
    """For each item that shares a seed: its key, the part of its words under tiles, the tiles."""
    if not text:
        return []
    out = []
    for owner, seeds in sorted(items.shared(items.numbered(text)).items()):
        marked = tiles(seeds, items.shortest)
        out.append((items.keys[owner], sum(t[2] for t in marked) / len(items.texts[owner]), marked))
    return out


def matcher(
    benchmark: DataFrame, key: str = "item_id", text: str = "text", shortest: int = SHORTEST, least: float = 0.0
) -> Callable[[Column], Column]:
    """A function from a text column to its matches with the test items.

    A match is ``struct<item, coverage, tiles>``, for items of which at least
    ``least`` of the words lie under tiles of at least ``shortest`` words, and
    at least one tile; sorted by item. Words are runs of letters, digits and
    underscores in lower case. A null or empty text has no matches. Items of
    fewer than ``shortest`` words, null ones among them, cannot be told from
    chance and match nothing; items of equal text all match.

    Items are matched in blocks of about ``BLOCK_CHARS`` characters, so that a
    table of seeds is bounded; each block is one more pass over the words of a
    text, not over the table. The driver and every task hold all blocks: their
    memory grows with the benchmark.
    """
    kind = benchmark.schema[key].dataType.simpleString()
    rows = benchmark.select(C(key).alias("key"), C(text).alias("text"))
    size = rows.agg(F.sum(F.char_length("text"))).first()[0] or 0
    count = max(1, -(-size // BLOCK_CHARS))
    found = f"array<struct<item:{kind},coverage:double,tiles:array<struct<in_item:int,in_text:int,length:int>>>>"

    def of_block(held: list) -> Callable[[Column], Column]:
        items: list[Items] = []

        @pandas_udf(found)
        def of(texts: pd.Series) -> pd.Series:
            if not items:
                items.append(Items(held, shortest))
            return pd.Series(
                [
                    [
                        {"item": i, "coverage": c, "tiles": [{"in_item": q, "in_text": p, "length": n} for q, p, n in t]}
                        for i, c, t in covered(x, items[0])
                        if c >= least
                    ]
                    for x in texts
                ],
                dtype=object,
            )

        return of

    blocks = []
    for n in range(count):
        block = rows.where(F.pmod(F.xxhash64("key", "text"), F.lit(count)) == n)
        held = [(r["key"], r["text"]) for r in block.toLocalIterator()]
        blocks.append(of_block(sorted(held, key=lambda r: (r[0] is not None, r[0], repr(r[1])))))

    def matches(text_column: Column) -> Column:
        parts = [of(text_column) for of in blocks]
        return parts[0] if count == 1 else F.array_sort(F.concat(*parts))

    return matches
