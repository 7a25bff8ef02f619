import numpy as np
import pytest
from pyspark.sql import functions as F

from colloquy.llm.common import integer_cuts, range_of

LEAST, MOST = -(1 << 63), (1 << 63) - 1


@pytest.mark.parametrize("kind", ["dense", "far", "hot", "edges"])
def test_ranges_are_even_whatever_the_keys(spark, kind):
    chance = np.random.default_rng(1)
    keys = {
        "dense": list(range(4000)),
        "far": [int(k) for k in chance.integers(0, 3000, 3900)] + [MOST - i for i in range(100)],
        "hot": [7] * 1500 + list(range(2500)),
        "edges": [LEAST, MOST, 0] * 3 + [int(k) for k in chance.integers(LEAST, MOST, 4000)],
    }[kind]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    cuts = integer_cuts(df, "k", F.lit(1), 8)
    assert cuts == sorted(set(cuts)) and len(cuts) <= 7
    assert cuts == integer_cuts(df.orderBy(F.rand(3)).repartition(5), "k", F.lit(1), 8)
    counts = np.bincount(np.searchsorted(cuts, keys, side="right"), minlength=len(cuts) + 1)
    largest = max(keys.count(k) for k in set(keys)) if kind == "hot" else 0
    assert counts.max() <= max(2.1 * len(keys) / 8, largest + 2 * len(keys) / 8)
    placed = df.select("k", range_of(F.col("k"), cuts).alias("r")).collect()
    assert all(r.r == np.searchsorted(cuts, r.k, side="right") for r in placed)


def test_nulls_and_no_rows(spark):
    df = spark.createDataFrame([(None,), (3,)], "k long")
    assert integer_cuts(df.where("k = 4"), "k", F.lit(1), 4) == []
    assert integer_cuts(df.where("k IS NULL"), "k", F.lit(1), 4) == []
    assert [r.r for r in df.select(range_of(F.col("k"), [1, 2]).alias("r")).collect()] == [0, 2]
