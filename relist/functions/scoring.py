"""Similarity of a candidate listing and an earlier listing."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from relist.functions.times import micros_between

SCORE_DIGITS = 6


@dataclass(frozen=True)
class MatchRules:
    """Tunable limits of the matcher; the defaults are the fixed values of the contract."""

    time_window_days: int = 5
    parser_lag_days: int = 3
    price_tolerance: float = 0.10
    mileage_tolerance: float = 0.05
    min_score: float = 0.7
    end_weight: float = 3.0
    price_weight: float = 2.0
    mileage_weight: float = 1.5


def relative_bounds(target: Column, tolerance: float) -> tuple[Column, Column]:
    low = F.round(target * F.lit(1 - tolerance), SCORE_DIGITS)
    high = F.round(target * F.lit(1 + tolerance), SCORE_DIGITS)
    return low, high


def within_relative(value: Column, target: Column, tolerance: float) -> Column:
    """True when ``value`` is close enough, or when the target sets no usable bounds."""
    if tolerance < 0:
        return F.lit(True)
    low, high = relative_bounds(target, tolerance)
    unbounded = target.isNull() | (low > high)
    return unbounded | F.coalesce(value.between(low, high), F.lit(False))


def numeric_weight(actual: Column, target: Column, tolerance: float, weight: float) -> Column:
    if tolerance < 0 or weight <= 0:
        return F.lit(0.0)
    return F.when(actual.isNotNull() & target.isNotNull(), F.lit(float(weight))).otherwise(F.lit(0.0))


def numeric_proximity(actual: Column, target: Column, tolerance: float, weight: float) -> Column:
    """Weighted closeness, falling linearly to 0 at the tolerance; 0 when a side is missing."""
    if tolerance < 0 or weight <= 0:
        return F.lit(0.0)
    scale = F.greatest(F.abs(target) * F.lit(float(tolerance)), F.lit(1.0))
    closeness = F.greatest(F.lit(0.0), F.lit(1.0) - F.abs(actual - target) / scale)
    return F.coalesce(F.round(closeness * F.lit(float(weight)), SCORE_DIGITS), F.lit(0.0))


def date_proximity(actual: Column, target: Column, days: float, weight: float) -> Column:
    if days <= 0 or weight <= 0:
        return F.lit(0.0)
    seconds = F.abs(micros_between(target, actual)) / F.lit(1e6)
    closeness = F.greatest(F.lit(0.0), F.lit(1.0) - seconds / F.lit(days * 86400.0))
    return F.round(closeness * F.lit(float(weight)), SCORE_DIGITS)


def score_parts(
    offer_start: Column,
    initial_price: Column,
    mileage: Column,
    other_end: Column,
    other_price: Column,
    other_mileage: Column,
    rules: MatchRules,
) -> dict[str, Column]:
    """Parts and total of the pair score; all are null when the earlier listing has no end."""
    price, other_price = initial_price.cast("double"), other_price.cast("double")
    mileage, other_mileage = mileage.cast("double"), other_mileage.cast("double")
    end_part = date_proximity(other_end, offer_start, rules.time_window_days, rules.end_weight)
    price_part = numeric_proximity(other_price, price, rules.price_tolerance, rules.price_weight)
    mileage_part = numeric_proximity(other_mileage, mileage, rules.mileage_tolerance, rules.mileage_weight)
    end_max = rules.end_weight if rules.time_window_days > 0 and rules.end_weight > 0 else 0.0
    reachable = (
        F.lit(float(end_max))
        + numeric_weight(other_price, price, rules.price_tolerance, rules.price_weight)
        + numeric_weight(other_mileage, mileage, rules.mileage_tolerance, rules.mileage_weight)
    )
    share = F.least(F.greatest((end_part + price_part + mileage_part) / F.nullif(reachable, F.lit(0.0)), F.lit(0.0)), F.lit(1.0))
    total = F.coalesce(F.round(share, SCORE_DIGITS), F.lit(0.0))
    known = other_end.isNotNull()
    return {
        "end_part": F.when(known, end_part),
        "price_part": F.when(known, price_part),
        "mileage_part": F.when(known, mileage_part),
        "score": F.when(known, total),
    }
