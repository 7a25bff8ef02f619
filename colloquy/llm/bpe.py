"""Byte-level BPE: texts to token ids, and ids back to bytes.

A text is split by the tokenizer's pattern. Of a block of texts the distinct
words are taken, each is merged once by a fold of Spark's higher-order functions,
and the texts are put together from their words' ids. A block has all it needs,
with a bounded number of words, so memory is bounded. Blocks are shuffled between
the two steps, words as numbers: in one stage each task would have two Python
workers at once. Words that are frequent in a large table are folded once for all
tasks, which get a bounded number of them with their ids. Which ones these are
changes the time alone: all other words are folded where they are met.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

C = F.col
#: A piece in the fold: what it merges to with the next one, where it begins, its own id, in bits from the top.
ID_BITS, PLACE_BITS = 20, 12
MERGE_BIT = ID_BITS + PLACE_BITS
NO_RANK = 1 << 29
LONG_WORD = 1024  # bytes, below 2 ** PLACE_BITS; the fold's time grows with the square, so a heap merges longer words
BLOCK_WORDS = 4_000_000  # whose distinct ones are merged together
KNOWN_WORDS = 200_000  # distinct ones of a block, beside the frequent ones
READ_WORDS = 300_000  # that are numbered at once
FREQUENT_WORDS = 250_000  # that every task gets with their ids
SAMPLE_BYTES = 32 << 20  # of texts in which the frequent words are counted; smaller tables do without
WORDS_AT_ONCE = 500_000  # that are put together again
BATCH_BYTES = 4 << 20  # that go to Python, and come to the second step, at once
LONG_TEXT = 1 << 20  # characters; longer texts are split one word at a time


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks by piece, of a file with a base64 piece and its rank in each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}


class RankMap:
    """Ranks of all pieces as columns of one row: by the ranks of the two parts a piece is merged from.

    Spark looks a key of a map up by going through the map, so the map is laid
    out as a table of slots, of which a pair can be in two. The XXH64 hash of one
    64-bit number is a permutation, so equal hashes are equal pairs. The row is
    broadcast: as literals, its megabytes would stand in every description of a
    plan that the driver keeps.
    """

    def __init__(self, ranks: dict[bytes, int]):
        if max(ranks.values(), default=0) >= 1 << ID_BITS:
            raise ValueError(f"ids must be below 2 ** {ID_BITS}")
        pairs = {}
        for piece, rank in ranks.items():
            for i in range(1, len(piece)):
                if piece[:i] in ranks and piece[i:] in ranks:
                    pairs[self.hash(ranks[piece[:i]], ranks[piece[i:]])] = rank
        self.bits = max(4, (9 * len(pairs) // 4).bit_length())
        slots: list[int | None] = [None] * (1 << self.bits)
        for pair in pairs:
            at, moving = self.slots(pair)[0], pair
            for _ in range(1000):
                slots[at], moving = moving, slots[at]
                if moving is None:
                    break
                one, two = self.slots(moving)
                at = two if at == one else one
            else:
                raise ValueError("the pairs do not fit in the table")
        columns = {
            "slot_pairs": pa.array(slots, pa.int64()),
            "slot_ranks": pa.array([NO_RANK if s is None else pairs[s] for s in slots], pa.int64()),
        }
        self.row = pa.table({name: pa.ListArray.from_arrays([0, len(values)], values) for name, values in columns.items()})

    def beside(self, rows: DataFrame) -> DataFrame:
        """The rows with the columns that ``bound`` and ``coded`` read."""
        return rows.crossJoin(F.broadcast(rows.sparkSession.createDataFrame(self.row)))

    @staticmethod
    def hash(left: int, right: int) -> int:
        """As Spark's ``xxhash64``, signed."""
        digest = xxhash.xxh64_intdigest((left << ID_BITS | right).to_bytes(8, "little"), 42)
        return digest - (1 << 64) if digest >= 1 << 63 else digest

    def slots(self, pair: int) -> tuple[int, int]:
        mask = (1 << self.bits) - 1
        return pair & mask, pair >> 32 & mask

    def bound(self, body) -> Column:
        """``body(rank)``, where ``rank`` gives what two pieces merge to, or ``NO_RANK``."""
        mask = F.lit((1 << self.bits) - 1).cast("long")

        def within(keys: Column, values: Column) -> Column:
            def rank(left: Column, right: Column) -> Column:
                def found(pair: Column) -> Column:
                    one = pair.bitwiseAND(mask).cast("int")
                    two = F.shiftright(pair, 32).bitwiseAND(mask).cast("int")
                    return (
                        F.when(F.get(keys, one) == pair, F.get(values, one))
                        .when(F.get(keys, two) == pair, F.get(values, two))
                        .otherwise(none())
                    )

                return let(F.xxhash64(F.shiftleft(left, ID_BITS).bitwiseOR(right)), found)

            return body(rank)

        return let(C("slot_pairs"), lambda keys: let(C("slot_ranks"), lambda values: within(keys, values)))


def none() -> Column:
    return F.lit(NO_RANK).cast("long")


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def merged_ids(pieces: Column, rank) -> Column:
    """Ids of a word given as its bytes, each in the form of a piece.

    The fold merges the neighbours of lowest rank, leftmost first, until none
    has a rank. That is the least piece, as the rank stands above the place. The
    id of a merged piece is its rank.
    """
    ones = lambda bits: F.lit((1 << bits) - 1).cast("long")
    merge = lambda x: F.shiftright(x, MERGE_BIT)
    own = lambda x: x.bitwiseAND(ones(ID_BITS))
    place = lambda x: F.shiftleft(F.shiftright(x, ID_BITS).bitwiseAND(ones(PLACE_BITS)), ID_BITS)
    above = lambda low: F.shiftleft(low, MERGE_BIT)

    def joined(state: Column, at: Column, lowest: Column) -> Column:
        both = merge(lowest)
        changed = lambda x, n: (
            F.when(F.abs(n - at) > 1, x)
            .when(n == at, above(rank(both, own(F.get(state, at + 2)))).bitwiseOR(place(x)).bitwiseOR(both))
            .when(n < at, above(rank(own(x), both)).bitwiseOR(x.bitwiseAND(ones(MERGE_BIT))))
        )
        return F.array_compact(F.transform(state, changed))  # the piece after is now part of this one

    def step(state: Column, _: Column) -> Column:
        first = lambda lowest: F.array_position(state, lowest).cast("int") - 1
        return let(
            F.array_min(state),
            lambda lowest: F.when(lowest < above(none()), let(first(lowest), lambda at: joined(state, at, lowest))).otherwise(state),
        )

    rounds = F.sequence(F.lit(2), F.greatest(F.size(pieces), F.lit(2)))
    return F.aggregate(rounds, pieces, step, lambda state: F.transform(state, own))


def merged_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same for a long word, with the pairs in a heap."""
    if word in ranks:
        return [ranks[word]]
    end = len(word)
    after, before = list(range(1, end + 1)), list(range(-1, end - 1))
    piece = [word[i : i + 1] for i in range(end)]
    heap = [(r, i, 2) for i in range(end - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, size = heapq.heappop(heap)
        j = after[i]
        if piece[i] is None or j >= end or len(piece[i]) + len(piece[j]) != size:
            continue
        piece[i] += piece[j]
        piece[j] = None
        after[i] = after[j]
        if after[i] < end:
            before[after[i]] = i
        for k in (before[i], i):
            if k >= 0 and after[k] < end:
                both = piece[k] + piece[after[k]]
                if (r := ranks.get(both)) is not None:
                    heapq.heappush(heap, (r, k, len(both)))
    return [ranks[p] for p in piece if p is not None]


def split_words(text: Column, pattern: str) -> Column:
    """All matches of the pattern, which is to cover every character."""
    return F.regexp_extract_all(text, F.lit("(?U)" + pattern), F.lit(0))


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, ids, decoded`` for every row: the ids of the text, and the bytes that the ids stand for.

    Special tokens are ordinary text. A null text counts as empty, and an empty
    one has no ids and decodes to no bytes. Repeated rows and null keys stay.
    Other columns are not read. The pattern is split by the JVM; a text with
    characters that the JVM's Unicode version does not know, or a very long one,
    is split word by word in Python, by the same pattern.
    """
    content = F.coalesce(C(text), F.lit(""))
    aside = content.rlike(r"\p{Cn}") | (F.char_length(content) > LONG_TEXT)
    split = docs.select(
        C(key).alias("key"),
        F.when(~aside, split_words(content, pattern)).alias("words"),
        F.when(aside, content).alias("text"),
    )
    small_batches(docs.sparkSession)
    table = RankMap(ranks)
    return coded(split, table, pattern, ranks, frequent(docs, table, pattern, ranks, key, text)).withColumnRenamed("key", key)


def small_batches(spark: SparkSession) -> None:
    """Bound the bytes of an Arrow batch, for all queries of the session: by rows alone, one holds most of a task's words."""
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(setting).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(setting, str(BATCH_BYTES))


def coded(split: DataFrame, table: RankMap, pattern: str, ranks: dict[bytes, int], known: Broadcast | None = None) -> DataFrame:
    """``key, ids, decoded`` of rows ``key, words, text``, of which a row has words or a text that is not split yet."""
    kind = split.schema["key"].dataType.simpleString()
    blocks = split.mapInArrow(
        packed(pattern, ranks, known),
        f"keys array<{kind}>, counts array<int>, codes binary, words array<array<bigint>>, given array<array<bigint>>",
    )
    ids = table.bound(lambda rank: F.transform("words", lambda w: merged_ids(w, rank)))
    merged = table.beside(blocks).select("keys", "counts", "codes", F.concat(ids, "given").cast("array<array<int>>").alias("ids"))
    dealt = merged.withColumn("block", F.monotonically_increasing_id()).repartition("block").drop("block")  # ends the stage, and a task's first Python worker
    return dealt.mapInArrow(unpacked(ranks, known), f"key {kind}, ids array<int>, decoded binary")


def frequent(docs: DataFrame, table: RankMap, pattern: str, ranks: dict[bytes, int], key: str, text: str) -> Broadcast | None:
    """Words that occur most in a sample of the texts, with their ids and bytes; None for a small table.

    Of the texts about ``SAMPLE_BYTES`` are split, so the driver sees at most
    ``FREQUENT_WORDS`` words of up to ``LONG_WORD`` bytes at any size.
    """
    size = docs.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0
    if size <= SAMPLE_BYTES:
        return None
    share = F.lit(int(SAMPLE_BYTES / size * (1 << 30)))
    sample = docs.where(F.pmod(F.xxhash64(key, text), F.lit(1 << 30)) < share).where(F.char_length(text) <= LONG_TEXT)
    words = sample.select(F.explode(split_words(C(text), pattern)).alias("key")).where(F.octet_length("key") <= LONG_WORD)
    most = words.groupBy("key").count().where("count > 1").orderBy(F.desc("count"), "key").limit(FREQUENT_WORDS)
    spread = most.repartition(docs.sparkSession.sparkContext.defaultParallelism, "key")
    rows = spread.select("key", F.array("key").alias("words"), F.lit(None).cast("string").alias("text"))
    found = coded(rows, table, pattern, ranks).toArrow().combine_chunks()
    columns = [found.column(c).combine_chunks() for c in ("key", "ids", "decoded")]
    return docs.sparkSession.sparkContext.broadcast([c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in columns])


def packed(pattern: str, ranks: dict[bytes, int], frequent: Broadcast | None = None):
    """Per block of texts one row: the keys, the number of words of each, the words by number, the words that are not frequent.

    Words that are pieces, and long ones, come last and with their ids; of the
    others come the bytes, in the form of pieces. The frequent words have the
    first numbers. A block ends at about ``BLOCK_WORDS`` words, or ``KNOWN_WORDS``
    distinct ones that are not frequent.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_memory_pool(pa.system_memory_pool())  # gives memory back between blocks
        find = regex.compile(pattern).findall
        vocabulary, numbers = pa.array(list(ranks), pa.binary()), np.array(list(ranks.values()), np.int64)
        octet_ids = np.array([ranks.get(bytes([b]), 0) for b in range(256)], np.int64)
        pairs = np.array([ranks.get(bytes([a, b]), NO_RANK) for a in range(256) for b in range(256)], np.int64)
        common = frequent.value[0].cast(pa.binary()).to_pylist() if frequent else []
        common = {w: n for n, w in enumerate(common)}
        known: dict[bytes, int] = {}  # other words of the block by number
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []  # keys, counts and codes of the block so far

        def counts_of(words: pa.Array, texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
            if texts.null_count == len(texts):
                return pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int32), words.flatten()
            lists = [pa.array(find(t.as_py()) if t.is_valid else w.as_py(), pa.string()) for w, t in zip(words, texts)]
            return np.array([len(x) for x in lists], np.int32), pa.concat_arrays(lists)

        def hold(keys: pa.Array, counts: np.ndarray, flat: pa.Array) -> None:
            coded = flat.cast(pa.binary()).dictionary_encode()
            listed = coded.dictionary.to_pylist()
            first = len(common)
            place = [common[w] if w in common else known.setdefault(w, first + len(known)) for w in listed]
            codes = np.array(place, np.int32)[coded.indices.to_numpy(zero_copy_only=False)]
            held.append((keys, counts, codes.astype(np.int32)))

        def block() -> pa.RecordBatch:
            keys, counts = pa.concat_arrays([k for k, _, _ in held]), np.concatenate([c for _, c, _ in held])
            codes = np.concatenate([c for _, _, c in held])
            held.clear()
            distinct = pa.array(list(known), pa.binary())
            known.clear()
            piece = pc.index_in(distinct, value_set=vocabulary).fill_null(-1).to_numpy(zero_copy_only=False)
            is_long = pc.greater(pc.binary_length(distinct), LONG_WORD).to_numpy(zero_copy_only=False).astype(bool)
            ready = (piece >= 0) | is_long
            order = np.argsort(ready, kind="stable")
            place = np.arange(len(common) + len(order), dtype=np.int32)
            place[len(common) + order] = np.arange(len(common), len(place))
            codes = place[codes]
            folds = len(order) - int(ready.sum())
            given = [
                [int(numbers[piece[n]])] if piece[n] >= 0 else merged_long(distinct[int(n)].as_py(), ranks) for n in order[folds:]
            ]
            octets = in_pieces(distinct.take(pa.array(order[:folds])), octet_ids, pairs)
            one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
            planes = codes.view(np.uint8).reshape(-1, 4).T.copy()  # the high bytes are nearly all alike
            numbered = [None, pa.py_buffer(np.array([0, planes.nbytes], np.int32)), pa.py_buffer(planes)]
            return pa.RecordBatch.from_arrays(
                [
                    one(keys),
                    one(pa.array(counts, pa.int32())),
                    pa.BinaryArray.from_buffers(pa.binary(), 1, numbered),
                    one(octets),
                    one(pa.array(given, pa.list_(pa.int64()))),
                ],
                ["keys", "counts", "codes", "words", "given"],
            )

        words = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column("key")
            counts, flat = counts_of(batch.column("words"), batch.column("text"))
            del batch
            ends = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
            for first, last in portions(ends, READ_WORDS):
                hold(keys.slice(first, last - first), counts[first:last], flat[int(ends[first]) : int(ends[last])])
                words += int(ends[last] - ends[first])
                if words >= BLOCK_WORDS or len(known) >= KNOWN_WORDS:
                    yield block()
                    words = 0
        if held:
            yield block()

    return run


def in_pieces(words: pa.Array, octet_ids: np.ndarray, pairs: np.ndarray) -> pa.Array:
    """The bytes of each word as pieces of one byte."""
    sizes = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    octets = np.frombuffer(b"".join(words.to_pylist()), np.uint8)
    place = np.arange(len(octets)) - np.repeat(ends[:-1], sizes)
    low = np.full(len(octets), NO_RANK, np.int64)
    low[:-1] = pairs[octets[:-1].astype(np.int64) << 8 | octets[1:]]
    low[ends[1:] - 1] = NO_RANK  # the last byte merges with nothing
    return pa.ListArray.from_arrays(
        pa.array(ends, pa.int32()), pa.array(low << MERGE_BIT | place << ID_BITS | octet_ids[octets], pa.int64())
    )


def unpacked(ranks: dict[bytes, int], frequent: Broadcast | None = None):
    """The texts of a packed row, as ids and as bytes, with the frequent words and its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_memory_pool(pa.system_memory_pool())
        by_rank: list[bytes | None] = [None] * (max(ranks.values(), default=-1) + 1)
        for piece, rank in ranks.items():
            by_rank[rank] = piece
        pieces = pa.array(by_rank, pa.binary())
        ids, data = pa.array([], pa.list_(pa.int32())), pa.array([], pa.binary())
        if frequent:
            ids, data = frequent.value[1].cast(ids.type), frequent.value[2].cast(data.type)
        common_ids, common_data = ids, data
        for batch in batches:
            for row in range(batch.num_rows):
                keys, counts = batch.column("keys")[row].values, batch.column("counts")[row].values
                codes = np.frombuffer(batch.column("codes")[row].as_buffer(), np.uint8).reshape(4, -1).T.copy().view(np.int32).reshape(-1)
                new_ids = batch.column("ids")[row].values.cast(pa.list_(pa.int32()))
                new_data = end_to_end(new_ids, pieces)
                ids, data = pa.concat_arrays([common_ids, new_ids]), pa.concat_arrays([common_data, new_data])
                ends = np.concatenate([[0], np.cumsum(counts.to_numpy(zero_copy_only=False), dtype=np.int64)])
                for first, last in portions(ends, WORDS_AT_ONCE):
                    own = pa.array(codes[ends[first] : ends[last]])
                    cuts = ends[first : last + 1] - ends[first]
                    tokens, text = ids.take(own), data.take(own)
                    sizes = np.concatenate([[0], np.cumsum(pc.list_value_length(tokens).to_numpy(zero_copy_only=False), dtype=np.int64)])
                    widths = np.concatenate([[0], np.cumsum(pc.binary_length(text).to_numpy(zero_copy_only=False), dtype=np.int64)])
                    whole = b"".join(text.to_pylist()) if text.offset else text.buffers()[2]
                    texts = [None, pa.py_buffer(widths[cuts].astype(np.int32)), whole if isinstance(whole, pa.Buffer) else pa.py_buffer(whole or b"")]
                    yield pa.RecordBatch.from_arrays(
                        [
                            keys.slice(first, last - first),
                            pa.ListArray.from_arrays(pa.array(sizes[cuts], pa.int32()), tokens.flatten()),
                            pa.BinaryArray.from_buffers(pa.binary(), last - first, texts),
                        ],
                        ["key", "ids", "decoded"],
                    )

    return run


def end_to_end(ids: pa.ListArray, pieces: pa.Array) -> pa.Array:
    """The bytes of each word: its ids' pieces, end to end."""
    single = pieces.take(ids.flatten())
    if not len(single):
        return pa.array([b""] * len(ids), pa.binary())
    _, places, octets = single.buffers()
    ends = np.frombuffer(places, np.int32)[single.offset : single.offset + len(single) + 1]
    words = ends[ids.offsets.to_numpy(zero_copy_only=False) - ids.offsets[0].as_py()]
    return pa.BinaryArray.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(words), octets])


def portions(ends: np.ndarray, words: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about a bounded number of words each."""
    first = 0
    while first < len(ends) - 1:
        last = int(np.searchsorted(ends, ends[first] + words, side="right")) - 1
        last = max(first + 1, last)
        yield first, last
        first = last
