"""Spelling variants: words one edit apart, found by k-d trees over letter counts.

A word is the vector of how often it has each letter. An inserted or deleted
letter changes one count by one, a replaced one changes two, so words that are
one edit apart lie within an L1 distance of two. Words of one length are the
points of one tree; those of the same length and of one letter less search it,
and whole boxes beyond the distance are left out. What is near by counts is
compared letter by letter.

The upper part of each tree is fitted on a bounded sample and cuts the words
into cells; each word goes to its own cell and to every cell whose box it may
have a near word in. A cell is one group, with a tree of its own.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.llm.common import Stored

C = F.col
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))
RUN = re.compile("[A-Za-zÀ-ÿ]+")
AT_ONCE = 1 << 20  # characters of a text that are looked at together
HELD_WORDS = 200_000  # whose counts a task keeps before it passes them on
SAMPLE = 200_000  # words that the upper trees are fitted on
CELL = 50_000  # words a cell aims at
CROWDED = 8  # times that size; then its words are dealt by halves
LEAF = 64  # points of a leaf within a cell
PAIRS_AT_ONCE = 1 << 20
WORDS_AT_ONCE = 20_000


# Words and their numbers


def portions(text: str) -> Iterator[str]:
    """The text in pieces of bounded length that no run of letters crosses."""
    at = 0
    while len(text) - at > AT_ONCE:
        gap = re.compile("[^A-Za-zÀ-ÿ]").search(text, at + AT_ONCE)
        if gap is None:
            break
        yield text[at : gap.start()]
        at = gap.start()
    yield text[at:]


def word_counts(docs: DataFrame, least: int, dropping: int | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, n`` over all texts: runs of letters, with A-Z in lower case, of at least ``least`` characters.

    With ``dropping``, a run whose hash with its document's key is a multiple of
    it loses one letter: planted variants. A null key stands as an empty string,
    a null text has no words; repeated rows count each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def passed() -> pa.RecordBatch:
            rows = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()
            return rows

        for batch in batches:
            for name, body in zip(batch.column("key").to_pylist(), batch.column("text")):
                lower = body.as_buffer().to_pybytes().lower().decode() if body.is_valid else ""  # A-Z only
                for part in portions(lower):
                    found = Counter(RUN.findall(part))
                    if dropping is None:
                        for word, n in found.items():
                            if len(word) >= least:
                                held[word] += n
                        continue
                    start = zlib.crc32(f"{name}:".encode())
                    for word, n in found.items():
                        if len(word) < least:
                            continue
                        h = zlib.crc32(word.encode(), start)
                        if h % dropping == 0:
                            word = word[: h % len(word)] + word[h % len(word) + 1 :]
                            if len(word) < least:
                                continue
                        held[word] += n
                if len(held) >= HELD_WORDS:
                    yield passed()
        yield passed()

    rows = docs.select(F.coalesce(C(key).cast("string"), F.lit("")).alias("key"), C(text).alias("text"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


# Trees


_place = np.full(0x100, -1, np.int16)
_place[[ord(c) for c in LETTERS]] = np.arange(len(LETTERS))


def coded(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The letters of all words by number, end to end, and where each word begins and ends."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    return _place[np.frombuffer("".join(words).encode("latin-1"), np.uint8)], np.concatenate([[0], np.cumsum(sizes)])


def vectors(words: list[str]) -> np.ndarray:
    """How often each word has each letter."""
    out = np.zeros((len(words), len(LETTERS)), np.int32)
    for at in range(0, len(words), WORDS_AT_ONCE):
        flat, ends = coded(words[at : at + WORDS_AT_ONCE])
        rows = len(ends) - 1
        owner = np.repeat(np.arange(rows), np.diff(ends))
        out[at : at + rows] = np.bincount(owner * len(LETTERS) + flat, minlength=rows * len(LETTERS)).reshape(rows, -1)
    return out


class Tree:
    """A k-d tree over whole numbers: median splits of the widest letter, down to ``leaf`` points or equal ones."""

    def __init__(self, points: np.ndarray, leaf: int):
        self.split: list[tuple[int, int, int, int] | None] = []  # letter, highest count on the left, left, right
        self.members: list[np.ndarray | None] = []
        self.leaves = 0
        self.number: list[int] = []
        self._grow(points, np.arange(len(points)), leaf)

    def _grow(self, points: np.ndarray, ids: np.ndarray, leaf: int) -> int:
        node = len(self.split)
        self.split.append(None)
        self.members.append(None)
        self.number.append(-1)
        if len(ids) > leaf:
            own = points[ids]
            spread = own.var(axis=0)
            letter = int(spread.argmax())
            if spread[letter] > 0:
                counts = own[:, letter]
                middle = int(np.median(counts))
                middle = min(middle, int(counts.max()) - 1)
                left = counts <= middle
                self.split[node] = (letter, middle, self._grow(points, ids[left], leaf), self._grow(points, ids[~left], leaf))
                return node
        self.members[node] = ids
        self.number[node] = self.leaves
        self.leaves += 1
        return node

    def search(self, queries: np.ndarray, less: int, more: int) -> Iterator[tuple[int, np.ndarray]]:
        """Leaves, with the queries from which a point in their box may be ``less`` down and ``more`` up in L1.

        A box is what the splits above it allow. Its distance changes in one letter at a step.
        """
        everywhere = np.arange(len(queries))
        zero = np.zeros(len(queries), np.int32)
        stack = [(0, everywhere, zero, zero, {})]
        while stack:
            node, ids, down, up, box = stack.pop()
            if self.split[node] is None:
                yield node, ids
                continue
            letter, middle, left, right = self.split[node]
            low, high = box.get(letter, (None, None))
            counts = queries[ids, letter]
            was_down = 0 if high is None else np.maximum(0, counts - high)
            now_down = down - was_down + np.maximum(0, counts - middle)
            was_up = 0 if low is None else np.maximum(0, low - counts)
            now_up = up - was_up + np.maximum(0, middle + 1 - counts)
            for child, far, down_, up_, side in (
                (left, now_down <= less, now_down, up, (low, middle)),
                (right, now_up <= more, down, now_up, (middle + 1, high)),
            ):
                if far.any():
                    stack.append((child, ids[far], down_[far], up_[far], box | {letter: side}))


def upper_tree(words: list[str], cells: int) -> Tree:
    """A tree with about so many leaves, without its points."""
    tree = Tree(vectors(words), max(1, -(-len(words) // cells)))
    tree.members = [None] * len(tree.members)
    return tree


# Cells


def router(trees: dict[int, tuple[int, Tree | None]]):
    """The cells of a word: its own, those it searches for its own length, those for one letter more.

    ``trees`` has, by length, the number of the first cell and the tree, or no
    tree where one cell holds all.
    """

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            words = batch.to_pylist()
            lengths = np.fromiter(map(len, words), np.int64, len(words))
            home = np.zeros(len(words), np.int32)
            rows: list[np.ndarray] = []
            cells: list[np.ndarray] = []
            for length in np.unique(lengths):
                ids = np.flatnonzero(lengths == length)
                own = [words[i] for i in ids]
                points = None
                for size, less, more in ((int(length), 0, 0), (int(length), 1, 1), (int(length) + 1, 0, 1)):
                    if size not in trees:
                        continue
                    first, tree = trees[size]
                    if tree is not None and points is None:
                        points = vectors(own)
                    reached = ((0, np.arange(len(ids))),) if tree is None else tree.search(points, less, more)
                    for node, which in reached:
                        cell = first if tree is None else first + tree.number[node]
                        if not more:
                            home[ids[which]] = cell
                        else:
                            rows.append(ids[which])
                            cells.append(np.full(len(which), cell, np.int32))
            owners = np.concatenate(rows) if rows else np.zeros(0, np.int64)
            places = np.concatenate(cells) if cells else np.zeros(0, np.int32)
            order = np.argsort(owners, kind="stable")
            ends = np.concatenate([[0], np.cumsum(np.bincount(owners, minlength=len(words)))])
            searched = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(places[order], pa.int32()))
            yield pa.StructArray.from_arrays([pa.array(home, pa.int32()), searched], ["home", "cells"])

    return F.arrow_udf(run, "home int, cells array<int>")


def same_letters(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether words of one length differ in one place."""
    return (left != right).sum(axis=1) == 1


def one_more(shorter: np.ndarray, longer: np.ndarray) -> np.ndarray:
    """Whether the longer word is the shorter one and one letter inside, before or after it."""
    size = shorter.shape[1]
    ahead = np.logical_and.accumulate(shorter == longer[:, :-1], axis=1).sum(axis=1)
    behind = np.logical_and.accumulate((shorter == longer[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return ahead + behind >= size


def matrix(words: list[str], length: int) -> np.ndarray:
    return coded(words)[0].astype(np.uint8).reshape(len(words), length) if words else np.zeros((0, length), np.uint8)


def near_in_cell(points: list[str], queries: list[str], more: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of queries and points one edit apart; the points have ``more`` letters more than the queries."""
    if not points or not queries:
        return
    length = len(points[0])
    targets, letters = vectors(points), matrix(points, length)
    kind = np.float32 if length < 1024 else np.float64  # in which the squares are exact
    verified = one_more if more else same_letters
    apart = 1 if more else 2  # squared distance of counts, which tells one edit's counts exactly
    tree = Tree(targets, LEAF)
    for start in range(0, len(queries), WORDS_AT_ONCE):
        asking = queries[start : start + WORDS_AT_ONCE]
        asked, asked_letters = vectors(asking), matrix(asking, length - more)
        for node, ids in tree.search(asked, 0 if more else 1, 1):
            members = tree.members[node]
            there = targets[members].astype(kind)
            step = max(1, PAIRS_AT_ONCE // len(members))
            for at in range(0, len(ids), step):
                some = ids[at : at + step]
                here = asked[some].astype(kind)
                squares = (here * here).sum(axis=1)[:, None] + (there * there).sum(axis=1)[None, :] - 2 * (here @ there.T)
                i, j = np.nonzero(squares == apart)
                for a in range(0, len(i), PAIRS_AT_ONCE):
                    q, p = some[i[a : a + PAIRS_AT_ONCE]], members[j[a : a + PAIRS_AT_ONCE]]
                    good = verified(asked_letters[q], letters[p])
                    yield q[good] + start, p[good]


CREDIT = "word string, near long, best_n long, best string"


def cell_credits(_key: tuple, table: pa.Table) -> pa.Table:
    """Of each word that has near ones in this cell: how many, and the one of largest number."""
    words, numbers = table.column("word").to_pylist(), np.asarray(table.column("n").to_pylist(), np.int64)
    is_point = table.column("point").to_numpy(zero_copy_only=False).astype(bool)
    side = table.column("side").to_numpy(zero_copy_only=False)
    length = int(table.column("length")[0].as_py())
    order = sorted(range(len(words)), key=lambda i: (-numbers[i], words[i]))
    rank = np.empty(len(words), np.int64)
    rank[order] = np.arange(len(words))
    points = np.flatnonzero(is_point)
    owners, others = [], []
    for more in (0, 1):
        ids = np.flatnonzero(~is_point & (np.fromiter(map(len, words), np.int64, len(words)) == length - more))
        for q, p in near_in_cell([words[i] for i in points], [words[i] for i in ids], more):
            q, p = ids[q], points[p]
            if len(q) and side[0] == 2:  # met by their second halves: those with equal first halves meet elsewhere
                half = (length - more) // 2
                apart = np.fromiter((words[a][:half] != words[b][:half] for a, b in zip(q, p)), bool, len(q))
                q, p = q[apart], p[apart]
            owners += [q, p] if more else [q]
            others += [p, q] if more else [p]
    who = np.concatenate(owners) if owners else np.zeros(0, np.int64)
    whom = np.concatenate(others) if others else np.zeros(0, np.int64)
    by = np.lexsort((rank[whom], who))
    who, whom = who[by], whom[by]
    first = np.flatnonzero(np.diff(who, prepend=-1))
    counts = np.diff(np.append(first, len(who)))
    return pa.table(
        {
            "word": pa.array([words[i] for i in who[first]], pa.string()),
            "near": pa.array(counts, pa.int64()),
            "best_n": pa.array(numbers[whom[first]], pa.int64()),
            "best": pa.array([words[i] for i in whom[first]], pa.string()),
        }
    )


def near_words(spark: SparkSession, words: DataFrame, store: Stored) -> DataFrame:
    """``word, near, best_n, best``: the number of near words and that of largest ``n``, ties the first by code point.

    ``words`` (``word, n``) has each word once, of the letters a-z and those
    from U+00C0 to U+00FF; it is read several times, so it is to be a stored
    table. A word without near ones has no row. Words of lengths that nothing
    else is close to cost a row each.

    A cell of more than ``CROWDED`` times its aim is dealt anew: one edit leaves
    the first half or the second half of a word as it was, so words meet by
    either, and a pair that has both alike counts once.
    """
    sized = words.select("word", "n", F.char_length("word").alias("length"))
    sizes = {r["length"]: r["count"] for r in sized.groupBy("length").count().collect()}
    total = sum(sizes.values())
    rate = -(-total // SAMPLE)  # by a hash, so that the same words fit the trees each time
    chosen: dict[int, list[str]] = {}
    large = [n for n, count in sizes.items() if count > CELL]
    if large:
        part = sized.where(C("length").isin(large) & (F.pmod(F.xxhash64("word"), F.lit(rate)) == 0))
        for row in part.select("word", "length").orderBy("word").toLocalIterator():
            chosen.setdefault(row["length"], []).append(row["word"])
    trees: dict[int, tuple[int, Tree | None]] = {}
    first = 0
    lengths: list[int] = []
    for length, count in sorted(sizes.items()):
        tree = upper_tree(chosen[length], -(-count // CELL)) if length in chosen else None
        trees[length] = (first, tree)
        leaves = 1 if tree is None else tree.leaves
        first += leaves
        lengths += [length] * leaves
    routed = sized.select("word", "n", router(trees)(C("word")).alias("to"))
    home = F.array(F.struct(C("to.home").alias("cell"), F.lit(True).alias("point")))
    asked = F.transform("to.cells", lambda c: F.struct(c.alias("cell"), F.lit(False).alias("point")))
    rows = store.put(routed.select("word", "n", F.inline(F.concat(home, asked))))
    crowded = {r["cell"]: r["count"] for r in rows.groupBy("cell").count().where(C("count") > CROWDED * CELL).collect()}
    length_of = F.get(F.array(*[F.lit(n) for n in lengths]) if lengths else F.array().cast("array<int>"), C("cell"))
    rows = rows.withColumn("length", length_of)
    plain = rows.withColumn("side", F.lit(0)).withColumn("half", F.lit(""))
    if crowded:
        # the half of the shorter word of a pair: points are met by words of their length and by shorter ones
        plain = rows.where(~C("cell").isin(list(crowded))).withColumn("side", F.lit(0)).withColumn("half", F.lit(""))
        tight = rows.where(C("cell").isin(list(crowded)))
        size = F.char_length("word")
        halves = []
        for more in (0, 1):
            half = F.floor((C("length") - more) / 2).cast("int")
            after = F.when(C("point"), half + 1 + more).otherwise(half + 1)
            mine = C("point") | (size == C("length") - more)
            ends = F.array(
                F.struct(F.lit(1).alias("side"), F.concat(F.lit(str(more)), F.substring(C("word"), F.lit(1), half)).alias("half")),
                F.struct(F.lit(2).alias("side"), F.concat(F.lit(str(more)), F.substring(C("word"), after, size)).alias("half")),
            )
            halves.append(tight.where(mine).select("word", "n", "cell", "point", "length", F.inline(ends)))
        plain = plain.unionByName(halves[0]).unionByName(halves[1])
    credits = plain.groupBy("cell", "side", "half").applyInArrow(cell_credits, CREDIT)
    found = credits.groupBy("word").agg(F.sum("near").alias("near"), F.min(F.struct((-C("best_n")).alias("n"), C("best").alias("w"))).alias("best"))
    return found.select("word", "near", (-C("best.n")).alias("best_n"), C("best.w").alias("best"))


def grouped(spark: SparkSession, words: DataFrame, ratio: int = 5) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of ``word, n``.

    A word's form is its near word of largest ``n`` (ties: the first by code
    point), if that is at least ``ratio`` times its own; else null. The root is
    the last form that forms lead to, or the word. A form has at least ``ratio``
    times the number, so chains are short, and each round halves them. No words:
    no rows.
    """
    store = Stored(spark, "variants")
    words = store.put(words)
    near = near_words(spark, words, store)
    joined = words.join(near, "word", "left")
    enough = C("best_n") >= ratio * C("n")
    formed = store.put(
        joined.select(
            "word", F.when(enough, C("best")).alias("form"), "n", F.coalesce("near", F.lit(0)).alias("n_near"), F.when(enough, C("best_n")).alias("form_n")
        )
    )
    chain = store.put(formed.where("form IS NOT NULL").select("word", C("form").alias("root")))
    while True:
        onward = chain.select(C("word").alias("root"), C("root").alias("next"))
        moved = store.put(chain.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), C("next").isNotNull().alias("moved")))
        last = moved.where("moved").isEmpty()
        store.drop(chain)
        chain = moved.drop("moved") if last else store.put(moved.drop("moved"))
        if last:
            break
        store.drop(moved)
    return formed.join(chain, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
