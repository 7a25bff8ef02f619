"""Preference and reward scores from log-probability columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def softplus(x: Column) -> Column:
    """log(1 + exp(x)) without overflow; -log sigmoid(m) is softplus(-m)."""
    return F.greatest(x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x)))


def dpo_margin(
    pi_chosen: Column, ref_chosen: Column, pi_rejected: Column, ref_rejected: Column, beta: float
) -> Column:
    return F.lit(beta) * ((pi_chosen - ref_chosen) - (pi_rejected - ref_rejected))


def log_odds(mean_logp: Column) -> Column:
    """log(p / (1 - p)) for p = exp(mean_logp): infinite for p = 1, null above."""
    odds = mean_logp - F.log(-F.expm1(mean_logp))
    return F.when(mean_logp < 0, odds).when(mean_logp == 0, F.lit(float("inf")))


def log_odds_ratio(logp_chosen: Column, len_chosen: Column, logp_rejected: Column, len_rejected: Column) -> Column:
    """Null if a length is 0 or both sides are certain."""
    chosen = log_odds(F.try_divide(logp_chosen, len_chosen))
    rejected = log_odds(F.try_divide(logp_rejected, len_rejected))
    return F.nanvl(chosen - rejected, F.lit(None).cast("double"))
