"""Examples packed whole into sequences."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from colloquy.operators import sequences

ROWS = "example_id long, ids array<int>, shard string, size string, key string"


def made(spark, sizes, parts=4):
    rows = [(n, None if s is None else [n % 1000 * 1000 + i for i in range(s)], "s", "z", "k") for n, s in enumerate(sizes)]
    return spark.createDataFrame(rows, ROWS).repartition(parts), {r[0]: r[1] or [] for r in rows}


def unpacked(rows):
    out = []
    for r in rows:
        parts = [[] for _ in r.examples]
        for id_, position, segment in zip(r.ids, r.positions, r.segments):
            assert position == len(parts[segment - 1])
            parts[segment - 1].append(id_)
        out += zip(r.examples, parts)
    return out


@pytest.mark.parametrize("shard_rows", [50_000, 200])
def test_every_id_once_and_full_sequences(spark, shard_rows):
    chance = random.Random(1)
    sizes = [min(512, int(chance.lognormvariate(4, 1)) + 1) for _ in range(3000)]
    df, want = made(spark, sizes)
    rows = sequences.pack_examples(df, 512, shard_rows=shard_rows).collect()
    assert dict(unpacked(rows)) == want and len(unpacked(rows)) == len(want)
    assert max(len(r.ids) for r in rows) <= 512 and not any(r.is_over for r in rows)
    assert sum(sizes) / (512 * len(rows)) > (0.95 if shard_rows == 50_000 else 0.9)


def test_result_does_not_depend_on_partitions(spark):
    sizes = [n % 37 for n in range(400)]
    one, two = (sorted(map(tuple, sequences.pack_examples(made(spark, sizes, p)[0], 64, shard_rows=90).collect())) for p in (1, 7))
    assert one == two


def test_odd_rows(spark):
    df, want = made(spark, [0, None, 5, 700, 512, 512, 1, None])
    rows = sequences.pack_examples(df, 512).collect()
    assert dict(unpacked(rows)) == want
    assert [len(r.ids) for r in rows if r.is_over] == [700]
    assert sequences.pack_examples(df.where("false"), 512).collect() == []
    twice = df.where("example_id = 2").unionByName(df).withColumn("example_id", F.when(F.col("example_id") != 4, F.col("example_id")))
    found = Counter((k, tuple(v)) for k, v in unpacked(sequences.pack_examples(twice, 512).collect()))
    assert found == Counter((r.example_id, tuple(r.ids or [])) for r in twice.collect())


def test_best_fit_takes_the_least_room():
    assert sequences.best_fit([(6, 1), (5, 1), (4, 1), (3, 1)], 10) == [(6, 1, 0, 0), (5, 1, 1, 0), (4, 1, 0, 1), (3, 1, 1, 1)]
    chance = random.Random(2)
    for _ in range(50):
        rooms, plain = sequences.Rooms(40), []
        for n in range(200):
            if chance.random() < 0.5:
                room = chance.randrange(41)
                rooms.add(room, n)
                plain.append(room)
            else:
                least = chance.randrange(41)
                want = min((r for r in plain if r >= least), default=None)
                found = rooms.take(least)
                assert (found and found[0]) == want
                if want is not None:
                    plain.remove(want)
