import zlib
from collections import Counter

import numpy as np
import pytest

from colloquy.llm import packing


def placed(spark, docs, shards):
    return packing.assign(spark, docs, shards).collect()


def gapless(rows):
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
    return all(sorted(v) == list(range(len(v))) for v in by.values())


def test_odd_rows_are_all_placed(spark, table, odd_rows):
    rows = placed(spark, table(odd_rows), 3)
    assert Counter(r.doc_id for r in rows) == Counter(k for k, _ in odd_rows)
    sizes = Counter((k, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t in odd_rows)
    assert Counter((r.doc_id, r["size"], r.crc32) for r in rows) == sizes
    assert gapless(rows) and {r.shard for r in rows} <= {0, 1, 2}


def test_empty_table_and_one_shard(spark, table):
    assert placed(spark, table([]), 4) == []
    rows = placed(spark, table([(i, "x" * i) for i in range(9)]), 1)
    assert {r.shard for r in rows} == {0} and gapless(rows)
    with pytest.raises(ValueError):
        packing.assign(spark, table([]), 0)


def test_balance_and_groups_do_not_depend_on_partitions(spark, table):
    chance = np.random.default_rng(5)
    texts = ["word " * int(n) + str(i) for i, n in enumerate(chance.integers(1, 60, 1500))]
    some = [(i, t) for i, t in enumerate(texts)] + [(5000 + i, "copy of a text") for i in range(40)]
    rows = placed(spark, table(some), 8)
    sums = Counter()
    for r in rows:
        sums[r.shard] += r["size"]
    counts = Counter(r.shard for r in rows)
    assert max(sums.values()) < 1.02 * sum(sums.values()) / 8
    assert max(counts.values()) < 1.1 * len(rows) / 8
    again = placed(spark, table(some[::-1], parts=7), 8)
    assert {(r.doc_id, r.shard, r.slot) for r in rows} == {(r.doc_id, r.shard, r.slot) for r in again}


def test_small_group_stays_together_large_one_is_cut(spark, table):
    rows = [(i, f"text {i} " + "y " * (i % 30)) for i in range(2000)]
    rows += [(9000 + i, "few copies") for i in range(3)] + [(20_000 + i, "hot copies of one text") for i in range(1000)]
    shard = {r.doc_id: r.shard for r in placed(spark, table(rows), 4)}
    assert len({shard[9000 + i] for i in range(3)}) == 1
    assert len({shard[20_000 + i] for i in range(1000)}) > 1


def test_blocks_balance_like_one(spark, table, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK_PIECES", 100)
    monkeypatch.setattr(packing, "SLOT_ROWS", 50)
    rows = placed(spark, table([(i, "ab " * (i % 83 + 1) + str(i)) for i in range(1500)]), 5)
    sums = Counter()
    for r in rows:
        sums[r.shard] += r["size"]
    assert len(rows) == 1500 and gapless(rows) and max(sums.values()) < 1.03 * sum(sums.values()) / 5


def test_pack_prefers_the_highest_dot_product():
    sizes = np.array([[0.5, 0.1], [0.1, 0.5], [0.2, 0.2], [0.2, 0.2]])
    assert packing.pack(sizes, 2).tolist()[:2] == [0, 1]  # the second fits only beside the first
    sizes = np.array([[0.4, 0.1], [0.1, 0.4], [0.3, 0.05], [0.2, 0.45]])
    chosen = packing.pack(sizes, 2).tolist()
    assert chosen[3] != chosen[1]  # more room there for what it has most of
    assert packing.pack(np.zeros((0, 3)), 4).tolist() == []
