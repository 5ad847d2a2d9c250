"""Scores, caps and cost.  Native columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import FIT_WEIGHTS, MONITOR_FROM, NO_BUYER_CAP, NO_SEPARATION_CAP, PRICE_IN, PRICE_OUT, PURSUE_FROM


def fit_from_scores() -> Column:
    """The weighted fit that the sub-scores imply, for checking a model's own figure."""
    return reduce(lambda a, b: a + b, [F.col(n) * w for n, w in FIT_WEIGHTS]) / 100


def action_from_fit(fit: Column) -> Column:
    return F.when(fit >= PURSUE_FROM, "pursue").when(fit >= MONITOR_FROM, "monitor").otherwise("discard")


def capped(fit: Column, action: Column, pe_buyer: Column, separation: Column) -> tuple[Column, Column]:
    """A score of 0 (a missing one is 0) for buyer or separation caps the fit and discards."""
    no_buyer, no_separation = F.coalesce(pe_buyer, F.lit(0)) == 0, F.coalesce(separation, F.lit(0)) == 0
    fit = F.when(no_buyer, F.least(fit, F.lit(NO_BUYER_CAP))).otherwise(fit)
    fit = F.when(no_separation, F.least(fit, F.lit(NO_SEPARATION_CAP))).otherwise(fit)
    return fit, F.when(no_buyer | no_separation, "discard").otherwise(action)


def cost(tokens_in: Column, tokens_out: Column) -> Column:
    return (tokens_in * PRICE_IN + tokens_out * PRICE_OUT) / 1_000_000


def scale_workers(n: Column, floor: int = 10, cap: int = 32, each: int = 10) -> Column:
    """Workers for n items."""
    return F.when(n <= 0, floor).otherwise(F.least(F.lit(cap), F.greatest(F.lit(floor), F.ceil(n / each)))).cast("int")


def workers(n: int, floor: int = 10, cap: int = 32, each: int = 10) -> int:
    return floor if n <= 0 else min(cap, max(floor, -(-n // each)))
