"""Preference pairs, and the scores of preference, reward and distillation stages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colloquy.functions import scores
from colloquy.plans.ordered_groups import OrderedGroups, following, total


def with_rejected(pairs: DataFrame) -> DataFrame:
    """Give each question-answer pair the answer of the next conversation as rejected one.

    Input ``(conv_id, turn, prompt, answer)``, output ``(conv_id, turn, prompt,
    chosen, rejected)``; the next conversation is the one with the next
    ``conv_id`` that has an answer at the same turn. Few turns serve many
    conversations, so these are large groups by nature.
    """
    return (
        OrderedGroups.of(pairs, ["turn"], "conv_id", store=True)
        .with_columns(_next=following(F.struct("answer"), wide=True))
        .df.select(
            "conv_id",
            "turn",
            "prompt",
            F.col("answer").alias("chosen"),
            F.col("_next.answer").alias("rejected"),
        )
    )


def preference_pairs(pairs: DataFrame) -> DataFrame:
    """Usable pairs: all three texts present, chosen unlike rejected, each triple once.

    Of equal triples the one with the lowest ``(conv_id, turn)`` stays; copies
    are combined before the shuffle.
    """
    usable = (
        (F.length("prompt") > 0)
        & (F.length("chosen") > 0)
        & (F.length("rejected") > 0)
        & (F.col("chosen") != F.col("rejected"))
    )
    return (
        pairs.where(usable)
        .groupBy("prompt", "chosen", "rejected")
        .agg(F.min(F.struct("conv_id", "turn")).alias("_first"))
        .select("_first.conv_id", "_first.turn", "prompt", "chosen", "rejected")
    )


def dpo_scores(logps: DataFrame, beta: float = 0.1) -> DataFrame:
    """Add margin, loss and whether the chosen side wins.

    Input columns ``pi_chosen, ref_chosen, pi_rejected, ref_rejected``: log
    probabilities of whole answers.
    """
    margin = scores.dpo_margin(
        F.col("pi_chosen"), F.col("ref_chosen"), F.col("pi_rejected"), F.col("ref_rejected"), beta
    )
    return logps.withColumn("margin", margin).withColumns(
        {"loss": scores.softplus(-F.col("margin")), "correct": F.col("margin") > 0}
    )


def orpo_scores(logps: DataFrame) -> DataFrame:
    """Add the log odds ratio of length-mean log-probabilities, its loss and the winner.

    A side that is certain (mean 0) has infinite odds: the loss is then 0 or
    infinite. A pair without a ratio (an answer of no length, a mean above 0, both
    sides certain) has a null ratio, loss and winner, and ``score_summary`` counts it.
    """
    ratio = scores.log_odds_ratio(
        F.col("pi_chosen"), F.col("len_chosen"), F.col("pi_rejected"), F.col("len_rejected")
    )
    return logps.withColumn("log_odds_ratio", ratio).withColumns(
        {
            "loss": scores.softplus(-F.col("log_odds_ratio")),
            "correct": F.col("log_odds_ratio") > 0,
        }
    )


def score_summary(scored: DataFrame) -> DataFrame:
    """Number of pairs, those without a loss, and of the others mean loss and share of correct ones."""
    return scored.agg(
        F.count(F.lit(1)).alias("pairs"),
        F.count_if(F.col("loss").isNull()).alias("unusable"),
        F.avg("loss").alias("mean_loss"),
        F.avg(F.col("correct").cast("double")).alias("accuracy"),
    )


def _sides(rewards: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per pair: the reward of both sides and how often each side is there."""

    def side(name: str) -> list[Column]:
        own = F.col("side") == name
        return [F.max(F.when(own, F.col("reward"))).alias(name), F.count_if(own).alias(f"_n_{name}")]

    gap = F.col("chosen") - F.col("rejected")
    return (
        rewards.groupBy(*keys)
        .agg(*side("chosen"), *side("rejected"))
        .withColumns({"loss": scores.softplus(-gap), "correct": gap > 0})
    )


def reward_pairs(rewards: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Both sides of a pair in one row, with loss and winner.

    Input: one row per pair and ``side`` ('chosen' or 'rejected') with
    ``reward``. One grouping replaces the self-join; a pair that lacks a side is
    left out, of a side that is there several times the highest reward counts.
    ``reward_pair_accuracy`` counts both.
    """
    return _sides(rewards, keys).where(F.col("loss").isNotNull()).drop("_n_chosen", "_n_rejected")


def reward_pair_accuracy(rewards: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Pairs, mean loss, accuracy; pairs that lack a side or its reward, and pairs with a repeated side."""
    return _sides(rewards, keys).agg(
        F.count("loss").alias("pairs"),
        F.avg("loss").alias("mean_loss"),
        F.avg(F.col("correct").cast("double")).alias("accuracy"),
        F.count_if(F.col("loss").isNull()).alias("unpaired"),
        F.count_if((F.col("_n_chosen") > 1) | (F.col("_n_rejected") > 1)).alias("repeated"),
    )


def kl_shaped_reward(token_logps: DataFrame, rewards: DataFrame, beta: float = 0.05) -> DataFrame:
    """Reward of each sequence less ``beta`` times its summed log-ratio to the reference.

    A sequence without tokens has not drifted: its ``kl`` is 0.
    """
    drift = token_logps.groupBy("seq_id").agg(F.sum(F.col("logp") - F.col("ref_logp")).alias("_kl"))
    kl = F.coalesce("_kl", F.lit(0.0))
    return rewards.join(drift, "seq_id", "left").select(
        "seq_id", "reward", kl.alias("kl"), (F.col("reward") - beta * kl).alias("shaped_reward")
    )


def group_advantage(
    answers: DataFrame,
    group: str,
    item: str,
    reward: str = "reward",
    epsilon: float = 1e-4,
    sample: bool = True,
) -> DataFrame:
    """Add ``advantage``: the reward against the mean and spread of its group.

    ``sample`` takes the sample standard deviation, else that of the population.
    """
    gap = F.col(reward) - F.col("_sum") / F.col("_n")
    freedom = F.greatest(F.col("_n") - (1 if sample else 0), F.lit(1))
    spread = F.sqrt(F.col("_squares") / freedom)
    return (
        OrderedGroups.of(answers, [group], item, ordered=False)
        .with_columns(
            _n=total(F.count, F.col(reward), F.sum), _sum=total(F.sum, F.col(reward))
        )
        .replace(lambda df: df.withColumn("_gap", gap))
        .with_columns(_squares=total(F.sum, F.col("_gap") * F.col("_gap")))
        .df.withColumn("advantage", F.col("_gap") / (spread + epsilon))
        .drop("_n", "_sum", "_gap", "_squares")
    )


_SPAN = 512.0


def distill_loss(logits: DataFrame, alpha: float = 0.7, temperature: float = 1.0) -> DataFrame:
    """Loss of each position from ``(pos, item, teacher, student, is_gold)``.

    ``alpha * T^2 * KL(teacher || student)`` at temperature T plus ``(1 -
    alpha)`` times the cross-entropy of the gold item.

    The sums of exponentials are kept per (position, exponent range): within a
    range of 512 nothing overflows, so no maximum has to be known beforehand and
    the rows are summed before their shuffle. A position then has a handful of
    partial sums, which are brought to its highest range and added.

    Minus infinity is a masked item. Masked by the teacher it adds nothing to the
    divergence; masked by the student alone it makes the divergence infinite.
    """
    t = temperature
    terms = {
        "a": F.col("teacher") / t,
        "b": F.col("student") / t,
        "c": F.col("student").cast("double"),
    }
    possible = {n: x > F.lit(float("-inf")) for n, x in terms.items()}
    ranges = {f"{n}_range": F.when(possible[n], F.round(x / _SPAN)) for n, x in terms.items()}

    def mass(name: str) -> Column:
        within = F.exp(F.col(name) - F.col(f"{name}_range") * _SPAN)
        return F.when(F.col(f"{name}_range").isNotNull(), within).otherwise(0.0)

    gap = (F.col("teacher") - F.col("student")) / t
    partial = (
        logits.withColumns({**terms, **ranges})
        .groupBy("pos", *ranges)
        .agg(
            *[F.sum(mass(n)).alias(f"{n}_mass") for n in terms],
            F.sum(F.when(F.col("a_range").isNotNull(), mass("a") * gap).otherwise(0.0)).alias("a_gap"),
            F.max(F.when(F.col("is_gold"), F.col("student"))).alias("gold"),
        )
    )
    position = Window.partitionBy("pos")
    tops = {f"{n}_top": F.max(f"{n}_range").over(position) for n in terms}

    def scaled(name: str, value: str) -> Column:
        return F.col(value) * F.exp((F.col(f"{name}_range") - F.col(f"{name}_top")) * _SPAN)

    sums = (
        partial.withColumns(tops)
        .groupBy("pos")
        .agg(
            *[
                (F.first(f"{n}_top") * _SPAN + F.log(F.sum(scaled(n, f"{n}_mass")))).alias(n)
                for n in terms
            ],
            (F.sum(scaled("a", "a_gap")) / F.sum(scaled("a", "a_mass"))).alias("gap"),
            F.max("gold").alias("gold"),
        )
    )
    kl = F.col("gap") - F.col("a") + F.col("b")
    cross_entropy = F.col("c") - F.col("gold")
    return sums.select("pos", kl.alias("kl"), cross_entropy.alias("cross_entropy")).withColumn(
        "loss", alpha * t * t * F.col("kl") + (1 - alpha) * F.col("cross_entropy")
    )
