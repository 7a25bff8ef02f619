"""Scoring and choosing among candidates ``(group_id, item_id, score)``.

The steps of one choice, in order: penalties on seen items, temperature, top-k,
top-p, min-p, then a draw or the best. ``item_id`` is a number, unique in its
group; scores may tie. A null or NaN score is no candidate and is left out of
every choice. A score of minus infinity is a masked item: it has no probability
unless all of its group are masked, and then all have the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colloquy.functions import chance
from colloquy.functions.fixed import REPETITION_PENALTY
from colloquy.plans.ordered_groups import OrderedGroups, attach, running_sum, settled, total


def _scored(candidates: DataFrame) -> DataFrame:
    return candidates.where(F.col("score").isNotNull() & ~F.isnan(F.col("score").cast("double")))


def _groups(candidates: DataFrame, ordered: bool = False) -> OrderedGroups:
    return OrderedGroups.of(_scored(candidates), ["group_id"], "item_id", ordered)


def mark_seen(candidates: DataFrame, seen: DataFrame) -> DataFrame:
    """Add ``seen``: whether the item is among the group's seen ones, repeats or not."""
    known = seen.select("group_id", "item_id").distinct().withColumn("seen", F.lit(True))
    return candidates.join(known, ["group_id", "item_id"], "left").withColumn(
        "seen", F.coalesce("seen", F.lit(False))
    )


def unseen(candidates: DataFrame, seen: DataFrame) -> DataFrame:
    """The candidates that have not been seen."""
    return candidates.join(seen, ["group_id", "item_id"], "left_anti")


def repetition_penalty(
    candidates: DataFrame, seen: DataFrame, penalty: float = REPETITION_PENALTY
) -> DataFrame:
    """Push the scores of seen items down: negative ones times, others divided by ``penalty``."""
    score = F.col("score")
    pushed = F.when(score < 0, score * penalty).otherwise(score / penalty)
    return (
        mark_seen(candidates, seen)
        .withColumn("score", F.when(F.col("seen"), pushed).otherwise(score))
        .drop("seen")
    )


def presence_penalty(candidates: DataFrame, seen: DataFrame, penalty: float) -> DataFrame:
    """Subtract ``penalty`` (0 to 2) from the scores of seen items, once each."""
    score = F.col("score")
    return (
        mark_seen(candidates, seen)
        .withColumn("score", F.when(F.col("seen"), score - penalty).otherwise(score))
        .drop("seen")
    )


def _softmax(groups: OrderedGroups, temperature: float) -> OrderedGroups:
    if temperature <= 0:
        raise ValueError("temperature must be positive; use greedy_pick for the limit 0")
    gap = F.when(F.col("score") == F.col("_top"), 0.0).otherwise(F.col("score") - F.col("_top"))
    weight = F.exp(gap / temperature)  # the best has weight 1, an infinite one too
    return (
        groups.with_columns(_top=total(F.max, F.col("score")))
        .replace(lambda df: df.withColumn("_weight", weight))
        .with_columns(_mass=total(F.sum, F.col("_weight")))
        .replace(
            lambda df: df.withColumn("prob", F.col("_weight") / F.col("_mass")).drop(
                "_top", "_weight", "_mass"
            )
        )
    )


def _top_k(groups: OrderedGroups, k: int | None) -> OrderedGroups:
    if not k:
        return groups
    best_first = Window.partitionBy(*groups.partition).orderBy(F.desc("score"))

    def by_rank(df: DataFrame) -> DataFrame:
        return df.withColumn("_rank", F.rank().over(best_first)).where(F.col("_rank") <= k).drop("_rank")

    if not groups.cut:
        return groups.replace(by_rank)
    # In a cut group the k-th score decides: every task sends at most k rows for it.
    in_group = Window.partitionBy("group_id").orderBy(F.desc("score"))
    kth = (
        groups.hot_rows.select("group_id", "score")
        .withColumn("_n", F.row_number().over(in_group))
        .where(F.col("_n") <= k)
        .groupBy("group_id")
        .agg(F.min("score").alias("_kth"))
    )

    kth = settled(kth, "kth")
    at_least = F.col("score") >= F.col("_kth")

    def by_either(df: DataFrame) -> DataFrame:
        ranked = attach(df.withColumn("_rank", F.rank().over(best_first)), kth, ["group_id"])
        keep = F.when(groups.hot, at_least).otherwise(F.col("_rank") <= k)
        return ranked.where(keep).drop("_rank", "_kth")

    def by_score(df: DataFrame) -> DataFrame:
        return attach(df, kth, ["group_id"]).where(at_least).drop("_kth")

    return groups.replace(by_either, by_score)


def _top_p(groups: OrderedGroups, p: float) -> OrderedGroups:
    if p >= 1:
        return groups
    best_first = Window.partitionBy(*groups.partition).orderBy(F.desc("score"), "item_id")
    before = F.coalesce(
        F.sum("prob").over(best_first.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)
    )
    if not groups.cut:
        return groups.replace(
            lambda df: df.withColumn("_before", before).where(F.col("_before") < p).drop("_before")
        )
    # In a cut group, go by distinct scores: find the score at which the mass
    # passes p, then take items of that score in order of their id.
    levels = (
        groups.hot_rows.groupBy("group_id", "score")
        .agg((F.count(F.lit(1)) * F.first("prob")).alias("_level_mass"))
        .withColumn("_down", -F.col("score"))
    )
    last_level = (
        OrderedGroups.of(levels, ["group_id"], "_down")
        .with_columns(_above=running_sum(F.col("_level_mass")))
        .df.where(F.col("_above") < p)
        .groupBy("group_id")
        .agg(F.max(F.struct("_down", "_above")).alias("_last"))
        .select("group_id", (-F.col("_last._down")).alias("_cut_score"), F.col("_last._above"))
    )
    last_level = settled(last_level, "levels")
    tied = F.coalesce((F.col("score") == F.col("_cut_score")).cast("bigint"), F.lit(0))
    placed = groups.replace(
        lambda df: attach(df, last_level, ["group_id"]).withColumn("_before", before),
        lambda df: attach(df, last_level, ["group_id"]),
    ).with_columns(_ties_before=running_sum(tied))
    in_cut_group = (F.col("score") > F.col("_cut_score")) | (
        (F.col("score") == F.col("_cut_score"))
        & (F.col("_above") + F.col("_ties_before") * F.col("prob") < p)
    )
    either = F.when(groups.hot, in_cut_group).otherwise(F.col("_before") < p)
    helpers = ("_before", "_above", "_cut_score", "_ties_before")
    return placed.replace(
        lambda df: df.where(either).drop(*helpers), lambda df: df.where(in_cut_group).drop(*helpers)
    )


def _min_p(groups: OrderedGroups, min_p: float) -> OrderedGroups:
    return groups.with_columns(_best=total(F.max, F.col("prob"))).replace(
        lambda df: df.where(F.col("prob") >= min_p * F.col("_best")).drop("_best")
    )


def temperature_softmax(candidates: DataFrame, temperature: float) -> DataFrame:
    """Add ``prob``: softmax of score / temperature in each group."""
    return _softmax(_groups(candidates), temperature).df


def top_k(candidates: DataFrame, k: int | None) -> DataFrame:
    """The k best of each group; ties with the k-th score stay. 0 or None is off."""
    return _top_k(_groups(candidates), k).df


def top_p(candidates: DataFrame, p: float, temperature: float = 1.0) -> DataFrame:
    """Items while the mass before them is below ``p``, best first, then by ``item_id``; 1 or more is off."""
    return _top_p(_softmax(_groups(candidates, ordered=True), temperature), p).df


def min_p(candidates: DataFrame, share: float, temperature: float = 1.0) -> DataFrame:
    """Items whose probability is at least ``share`` of the best one's."""
    return _min_p(_softmax(_groups(candidates), temperature), share).df


def select_candidates(
    candidates: DataFrame,
    temperature: float,
    k: int | None,
    p: float,
    share: float = 0.0,
    seen: DataFrame | None = None,
    repetition: float = 1.0,
    presence: float = 0.0,
    draw: str | None = None,
) -> DataFrame:
    """Penalties, temperature, top-k, top-p, min-p and a draw over one partitioning.

    Penalties need the ``seen`` items, one join. Top-k does not depend on the
    temperature, so it goes first and limits what is shuffled; ``prob`` sums to 1
    over the items left. A ``draw`` is the seed of a choice: one item per group
    stays, with its score and ``prob``.
    """
    if seen is not None and (repetition != 1.0 or presence != 0.0):
        score = F.col("score")
        pushed = F.when(score < 0, score * repetition).otherwise(score / repetition) - presence
        candidates = (
            mark_seen(candidates, seen)
            .withColumn("score", F.when(F.col("seen"), pushed).otherwise(score))
            .drop("seen")
        )
    kept = _top_p(_softmax(_top_k(_groups(candidates, ordered=True), k), temperature), p)
    if share > 0:
        kept = _min_p(kept, share)
    left = (
        kept.with_columns(_left=total(F.sum, F.col("prob")))
        .df.withColumn("prob", F.col("prob") / F.col("_left"))
        .drop("_left")
    )
    if draw is None:
        return left
    item = F.struct("item_id", "score", "prob")
    return (
        left.where(F.col("prob") > 0)
        .groupBy("group_id")
        .agg(F.max_by(item, F.struct(_luck(draw), -F.col("item_id"))).alias("_item"))
        .select("group_id", "_item.*")
    )


def greedy_pick(candidates: DataFrame) -> DataFrame:
    """The best item of each group; the lowest ``item_id`` among equals."""
    return _scored(candidates).groupBy("group_id").agg(
        F.max_by("item_id", F.struct(F.col("score"), -F.col("item_id"))).alias("item_id"),
        F.max("score").alias("score"),
    )


def _luck(seed: str) -> Column:
    return F.log("prob") - F.log(-F.log(chance.unit(seed, F.col("group_id"), F.col("item_id"))))


def weighted_pick(weighted: DataFrame, seed: str) -> DataFrame:
    """One item per group, drawn with chance ``prob``; the same seed gives the same draw."""
    return weighted.groupBy("group_id").agg(
        F.max_by("item_id", F.struct(_luck(seed), -F.col("item_id"))).alias("item_id")
    )
