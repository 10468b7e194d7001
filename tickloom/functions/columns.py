"""Small column expressions shared by the operators."""

from __future__ import annotations

import math

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_utc(ts: Column) -> Column:
    """ISO-8601 UTC text; the fraction is written with six digits, and only when there is one."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(ts, ".SSSSSS")
    return F.concat(whole, F.when(fraction == ".000000", "").otherwise(fraction), F.lit("Z"))


def epoch_millis_to_iso(millis: Column) -> Column:
    return iso_utc(F.timestamp_millis(millis))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient for a positive denominator, NULL otherwise."""
    return F.when(denominator > 0, numerator / denominator)


def is_positive(value: Column) -> Column:
    """True for a real number above zero. NaN compares as larger than anything in Spark, so exclude it."""
    return (value > 0) & ~F.isnan(value)


def is_non_negative(value: Column) -> Column:
    return (value >= 0) & ~F.isnan(value)


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def price_from_return(price: Column, predicted_return: Column) -> Column:
    """Turn a predicted return back into a price."""
    return price * (F.lit(1.0) + predicted_return)


def direction(predicted_return: Column) -> Column:
    """+1 to go long on a positive predicted return, -1 otherwise (a predicted return of 0 is -1)."""
    return F.when(predicted_return > 0, 1).otherwise(-1)


def same_sign(predicted: Column, actual: Column) -> Column:
    """Did both go up, or both not go up?"""
    return (predicted > 0) == (actual > 0)


def improvement_passes(challenger: Column, current: Column, min_pct: float = 0.0) -> Column:
    """Is the challenger's error lower than the current one by at least ``min_pct`` percent?

    Nothing in production means yes; an equal error passes at 0 percent.
    """
    gain = (current - challenger) / current * 100
    return F.when(current.isNull(), True).otherwise(gain >= min_pct)


def smirnov_p_value(statistic: Column, n1: Column, n2: Column) -> Column:
    """Asymptotic two-sided p-value of the two-sample Kolmogorov-Smirnov statistic.

    The limit law has two series; each is used on the side where a few terms reach double precision.
    """
    n1, n2 = n1.cast("double"), n2.cast("double")
    x = statistic * F.sqrt(n1 * n2 / (n1 + n2))
    near_one = sum((F.exp(F.lit(-((2 * k - 1) ** 2) * math.pi**2 / 8) / (x * x)) for k in range(1, 6)), F.lit(0.0))
    tail = sum(((-1) ** (j - 1) * F.exp(F.lit(-2.0 * j * j) * x * x) for j in range(1, 6)), F.lit(0.0))
    p = F.when(x < 1.18, 1 - math.sqrt(2 * math.pi) / x * near_one).otherwise(2 * tail)
    return F.when(statistic <= 0, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), p)))
