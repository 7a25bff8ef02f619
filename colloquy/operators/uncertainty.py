"""How sure an evaluation is: bootstrap intervals and ranking quality, each from one grouping.

A row's weight in a replicate is a Poisson(1) number made of an md5 of its key,
so a replicate is the same at any partitioning and on every run, and all
replicates are sums of one aggregate: no row is drawn, copied or sorted.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.functions.chance import key_text
from colloquy.plans.ordered_groups import OrderedGroups, running_sum, total

C = F.col
BITS, PER_NUMBER = 16, 3  # bits of a weight, weights of 12 hexadecimal digits
_cumulative = [sum(math.exp(-1) / math.factorial(i) for i in range(k + 1)) for k in range(9)]
#: A weight is the number of these that a 16-bit number reaches.
STEPS = [math.ceil(c * (1 << BITS)) for c in _cumulative if c * (1 << BITS) < (1 << BITS) - 0.5]


def bootstrap_intervals(
    rows: DataFrame, groups: Sequence[str], keys: Sequence[str], values: Sequence[str], replicates: int = 60, level: float = 0.95, seed: str = "0"
) -> DataFrame:
    """``groups, rows`` and, for each of ``values``, ``v_mean, v_low, v_high``.

    The interval holds the share ``level`` of the replicates' means, the middle
    ones. ``keys`` tell rows apart; rows of equal keys have equal weights. A null
    value is left out of that value's means; a group without values, or whose
    replicates are all empty, has nulls. Memory is ``replicates`` sums per group
    and value.
    """
    # each md5 gives two numbers, each number PER_NUMBER weights
    per_md5 = 2 * PER_NUMBER
    parts = {}
    for block in range(-(-replicates // per_md5)):
        digest = F.md5(key_text(f"boot|{seed}|{block}", *[C(k) for k in keys]))
        for half in range(2):
            parts[f"_w{block}_{half}"] = F.conv(F.substring(digest, 1 + 12 * half, 12), 16, 10).cast("long")
    numbers = list(parts)

    def weight(n: int) -> Column:
        bits = F.shiftright(C(numbers[n // PER_NUMBER]), BITS * (n % PER_NUMBER)).bitwiseAND(F.lit((1 << BITS) - 1))
        count = F.lit(0)
        for step in STEPS:
            count = count + (bits >= step).cast("int")
        return count

    weighted = rows.select(*groups, *values, *[p.alias(n) for n, p in parts.items()])
    weighted = weighted.select(*groups, *values, *[weight(n).alias(f"_r{n}") for n in range(replicates)])
    sums = [F.count(F.lit(1)).alias("rows")]
    for v in values:
        sums.append(F.avg(v).alias(f"{v}_mean"))
        for n in range(replicates):
            own = F.when(C(v).isNotNull(), C(f"_r{n}"))
            sums += [F.sum(own * C(v)).alias(f"_{v}_s{n}"), F.sum(own).alias(f"_{v}_n{n}")]
    summed = weighted.groupBy(*groups).agg(*sums)
    tail = (1 - level) / 2
    out = [*groups, "rows"]
    for v in values:
        means = F.array_sort(F.array_compact(F.array(*[F.try_divide(C(f"_{v}_s{n}"), C(f"_{v}_n{n}")) for n in range(replicates)])))
        size = F.size(means)
        low = F.floor(size * F.lit(tail)).cast("int")
        out += [f"{v}_mean", F.get(means, low).alias(f"{v}_low"), F.get(means, size - 1 - low).alias(f"{v}_high")]
    return summed.select(*out)


def ranking_quality(rows: DataFrame, groups: Sequence[str], score: str, is_positive: Column) -> DataFrame:
    """``groups, positives, negatives, auc``: the chance that a positive row scores above a negative one, ties half.

    Equal scores are counted first, so ties cost nothing; negatives below a score
    are a running sum over distinct scores, cut into blocks where a group has very
    many. Rows without a score are left out. Without both kinds ``auc`` is null.
    """
    counted = rows.where(C(score).isNotNull()).groupBy(*groups, score).agg(
        F.count_if(is_positive).alias("_pos"), F.count_if(~is_positive).alias("_neg")
    )
    placed = OrderedGroups.of(counted, list(groups), score).with_columns(
        _below=running_sum(C("_neg"), inclusive=False), _negatives=total(F.sum, C("_neg"))
    )
    won = C("_pos").cast("double") * (F.coalesce(C("_below"), F.lit(0)) + C("_neg") / 2)
    summed = placed.df.groupBy(*groups).agg(F.sum("_pos").alias("positives"), F.max("_negatives").alias("negatives"), F.sum(won).alias("_won"))
    pairs = C("positives").cast("double") * C("negatives")
    return summed.select(*groups, "positives", "negatives", F.try_divide(C("_won"), pairs).alias("auc"))
