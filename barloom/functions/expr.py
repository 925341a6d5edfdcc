"""Scalar column expressions: returns, guarded ratios, flags, rounding.

Two rounding rules are in use and they are part of the results.  Columns that
are plain SQL expressions round half up on the decimal form of the double
(``round_half_up``); EMA- and RSI-derived columns round to the even neighbour of
``x * 10**d`` (``round_even``).
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(x: Column, digits: int | None) -> Column:
    return x if digits is None else F.round(x, digits)


def round_even(x: Column, digits: int | None) -> Column:
    if digits is None:
        return x
    scale = F.lit(float(10**digits))
    return F.rint(x * scale) / scale


def safe_ratio(num: Column, den: Column) -> Column:
    """``num / den``, NULL for a zero denominator (ANSI ``/`` would raise)."""
    return F.try_divide(num, den)


def pct_change(value: Column, base: Column, digits: int | None = 2, rounding=round_half_up) -> Column:
    """``(value - base) / base * 100``."""
    return rounding(F.try_divide(value - base, base) * F.lit(100.0), digits)


def pct_of(part: Column, whole: Column, digits: int | None = 2) -> Column:
    return round_half_up(F.try_divide(part, whole) * F.lit(100.0), digits)


def guarded_ratio(num: Column, den: Column, digits: int | None = 4) -> Column:
    return F.when(den != 0, round_half_up(F.try_divide(num, den), digits))


def above(x: Column, threshold: float) -> Column:
    """Strict threshold flag; NULL counts as FALSE."""
    return F.coalesce(x > F.lit(threshold), F.lit(False))


def direction_label(ret: Column, threshold: float = 0.1) -> Column:
    return F.when(ret > F.lit(threshold), F.lit(1)).otherwise(F.lit(0))


def reward_risk(high_ret: Column, low_ret: Column, digits: int = 4) -> Column:
    return F.when(low_ret != 0, round_half_up(F.abs(F.try_divide(high_ret, low_ret)), digits))


def gain(delta: Column) -> Column:
    return F.greatest(F.coalesce(delta, F.lit(0.0)), F.lit(0.0))


def loss(delta: Column) -> Column:
    return F.greatest(-F.coalesce(delta, F.lit(0.0)), F.lit(0.0))


def rsi_from_means(mean_gain: Column, mean_loss: Column, digits: int = 2) -> Column:
    """100 - 100 / (1 + gain/loss); 100 when only gains, NULL when flat."""
    rs = F.try_divide(mean_gain, mean_loss)
    regular = F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + rs)
    one_sided = F.when(mean_gain > 0, F.lit(100.0))
    return round_even(F.when(mean_loss == 0, one_sided).otherwise(regular), digits)
