"""Price response and the profit-maximising price, all closed form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import ColumnLike, clip, col, ratio

# Fixed values of the price response.
MIN_ELASTICITY = -5.0
MAX_ELASTICITY = -0.1
DEFAULT_ELASTICITY = -1.0
MIN_MARKUP = 1.05
MAX_MARKUP = 1.50


def clamp_elasticity(elasticity: ColumnLike) -> Column:
    """Elasticity in [-5, -0.1]; null and NaN count as -1."""
    e = F.coalesce(F.nanvl(col(elasticity).cast("double"), F.lit(None).cast("double")), F.lit(DEFAULT_ELASTICITY))
    return F.least(F.lit(MAX_ELASTICITY), F.greatest(F.lit(MIN_ELASTICITY), e))


def lerner_elasticity(elasticity: ColumnLike) -> Column:
    """The measured elasticity if it is below -0.1, else -1."""
    e = col(elasticity)
    return F.when(e < MAX_ELASTICITY, e).otherwise(F.lit(DEFAULT_ELASTICITY))


def linear_demand(
    price: ColumnLike, base_price: ColumnLike, level: ColumnLike, elasticity: ColumnLike
) -> Column:
    """Unrounded demand at ``price``: the level at base price times the linear response to a
    clamped elasticity.

    Without a base price there is nothing to compare with and the level holds.
    """
    p, b = col(price), col(base_price)
    change = F.coalesce(ratio(p - b, b), F.lit(0.0))
    return col(level) * (F.lit(1.0) + col(elasticity) * change)


def rounded_demand(
    price: ColumnLike, base_price: ColumnLike, level: ColumnLike, elasticity: ColumnLike
) -> Column:
    """Whole units, never below zero."""
    return F.greatest(F.lit(0.0), F.rint(linear_demand(price, base_price, level, elasticity)))


def power_demand(price: ColumnLike, base_price: ColumnLike, level: ColumnLike, elasticity: ColumnLike) -> Column:
    """level x (price / base) ^ elasticity, never below zero."""
    return clip(col(level) * F.pow(ratio(price, base_price), col(elasticity)), low=0.0)


def best_price(cost: ColumnLike, base_price: ColumnLike, elasticity: ColumnLike) -> Column:
    """Price in the allowed interval with the highest profit, for a clamped elasticity.

    (p - c) (1 + e (p - b) / b) is a concave parabola in p for e < 0, so its peak is
    (c + b (1 - 1/e)) / 2, moved to the nearer end when it lies outside the interval.
    """
    c, b, e = col(cost), col(base_price), col(elasticity)
    lower = c * F.lit(MIN_MARKUP)
    upper = b * F.lit(MAX_MARKUP)
    upper = F.when(lower >= upper, lower * F.lit(1.2)).otherwise(upper)
    peak = (c + b * (F.lit(1.0) - F.lit(1.0) / e)) / F.lit(2.0)
    return F.least(upper, F.greatest(lower, peak))
