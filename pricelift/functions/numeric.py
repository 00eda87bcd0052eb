"""Rounding, safe ratios, banding and order-independent means."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def col(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def round_to(value: ColumnLike, digits: int) -> Column:
    """Round half to even on the scaled double, the convention of numpy and pandas."""
    scale = float(10**digits)
    return F.rint(col(value) * F.lit(scale)) / F.lit(scale)


def ratio(numerator: ColumnLike, denominator: ColumnLike) -> Column:
    """Division that yields null, not an ANSI error, on a zero denominator."""
    return F.try_divide(col(numerator), col(denominator))


def finite(value: ColumnLike) -> Column:
    """NaN and both infinities become null."""
    v = col(value).cast("double")
    return F.when(F.isnan(v) | v.isin(float("inf"), float("-inf")), F.lit(None)).otherwise(v)


def clip(value: ColumnLike, low: float | None = None, high: float | None = None) -> Column:
    """Clamp to [low, high]; null stays null (``least``/``greatest`` alone skip nulls)."""
    v = col(value)
    out = v
    if low is not None:
        out = F.greatest(out, F.lit(low))
    if high is not None:
        out = F.least(out, F.lit(high))
    return F.when(v.isNotNull(), out)


# Grids of the order-independent mean.  Sums of multiples of 2^-24 are exact in a double while they
# stay below 2^29; what that grid leaves of a value is summed on a grid of 2^-62.
MEAN_GRID, FINE_GRID = float(2**24), float(2**62)


def grid_parts(value: ColumnLike) -> tuple[Column, Column]:
    """A number as a part on the coarse grid and the rest on the fine one; nulls and NaN have neither."""
    v = F.nanvl(col(value).cast("double"), F.lit(None).cast("double"))
    coarse = F.rint(v * F.lit(MEAN_GRID)) / F.lit(MEAN_GRID)
    return coarse, F.rint((v - coarse) * F.lit(FINE_GRID)) / F.lit(FINE_GRID)


def stable_mean(value: ColumnLike) -> Column:
    """Mean that does not depend on the order in which shuffle blocks arrive.

    A value is split into its part on a grid of 2^-24 and the rest on a finer one; sums of either are exact, so a
    rerun after a lost executor gives the same price, and small values keep their digits.  Larger sums
    round like any double sum.  Nulls and NaN are left out.
    """
    coarse, fine = grid_parts(value)
    return F.avg(coarse) + F.avg(fine)


def exact_sum(value: ColumnLike) -> Column:
    """Sum of amounts to a millionth, added as decimals: the same in any order and at any size; NaN and infinities are left out."""
    return F.sum(finite(value).cast("decimal(28,6)")).cast("double")


def band(value: ColumnLike, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed intervals (edge, next edge] to labels; outside them null.  An infinite last edge
    leaves the last interval open."""
    if len(edges) != len(labels) + 1:
        raise ValueError("band needs one more edge than labels")
    v = col(value)
    out: Column | None = None
    for low, high, label in zip(edges[:-1], edges[1:], labels):
        hit = (v > F.lit(low)) & (v <= F.lit(high))
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out
