"""A seasonal demand model per product: weekday, yearly cycle, trend and festival fitted together.

One-way means count an effect twice where causes come together (a product that sells on December weekends).
Here all effects of a product are the least-squares solution of one regression on log units.  Its normal equations are
sums, so every product is "trained" in two aggregates, and solved where its row is, in column expressions.
"""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import calendar as cal

ORIGIN = dt.date(2000, 1, 1)
YEAR = 365.25
#: Waves of the yearly cycle, days in a unit of the trend, and the ridge that keeps short histories solvable.
WAVES, TREND_UNIT, RIDGE = 3, 365.25, 1e-3
#: Half width of the band in deviations (80 % of a normal distribution).
BAND_DEVIATIONS = 1.2816

#: Effects beside those of the weekdays, in order; then Tuesday to Sunday against Monday.
BASE = ("level", "trend", *(f"{f}_{k}" for k in range(1, WAVES + 1) for f in ("sin", "cos")), "festival")
TERMS = (*BASE, *(f"weekday_{d}" for d in range(1, 7)))


def base_terms(date: Column, festival: Column) -> list[Column]:
    """Values of BASE on a day."""
    day = F.datediff(date, F.lit(ORIGIN)).cast("double")
    waves = []
    for k in range(1, WAVES + 1):
        angle = day * F.lit(2 * math.pi * k / YEAR)
        waves += [F.sin(angle), F.cos(angle)]
    return [F.lit(1.0), day / F.lit(TREND_UNIT), *waves, F.coalesce(festival.cast("double"), F.lit(0.0))]


def _solved(matrix: Column, size: int) -> Column:
    """Solution of a symmetric positive definite system given as rows with their right side: elimination without pivoting."""
    def step(rows: Column, k: Column) -> Column:
        pivot = F.transform(rows[k], lambda x: x / rows[k][k])
        return F.transform(rows, lambda row, i: F.when(i == k, pivot).otherwise(F.zip_with(row, pivot, lambda a, b: a - row[k] * b)))

    done = F.aggregate(F.sequence(F.lit(0), F.lit(size - 1)), matrix, step)
    return F.transform(done, lambda row: row[size])


def joint_seasonal_fit(sales: DataFrame) -> DataFrame:
    """product_id, days, terms (values of TERMS), spread: log(1 + units) of a day as a sum of effects.

    Units are first summed to product and day.  Rows without a product, date or units do not count, a missing
    festival flag counts as 0.  Days are exchanged by product once.  The sums of one weekday hold what the base terms need; seven of them make the equations of a
    product.  The ridge is on everything but the level: a product with a single day has its level only.
    """
    days = sales.filter(F.col("product_id").isNotNull() & F.col("date").isNotNull() & F.col("units_sold").isNotNull()).groupBy("product_id", "date").agg(
        F.sum("units_sold").alias("units"), F.max("festival_flag").alias("festival"))
    # a product has few days, but its sums are many: days are exchanged, four columns each, and all sums are made where they are
    days = days.repartition("product_id")
    n = len(BASE)
    terms = [t.alias(f"x{i}") for i, t in enumerate(base_terms(F.col("date"), F.col("festival")))]
    rows = days.filter(F.col("units") >= 0).select("product_id", F.weekday("date").alias("weekday"), F.log1p(F.col("units").cast("double")).alias("y"), *terms)
    pairs = [(i, j) for i in range(n) for j in range(i, n)]
    sums = [F.sum(F.col(f"x{i}") * F.col(f"x{j}")) for i, j in pairs] + [F.sum(F.col(f"x{i}") * F.col("y")) for i in range(n)] + [F.sum(F.col("y") * F.col("y"))]
    weekdays = rows.groupBy("product_id", "weekday").agg(*[s.alias(f"s{k}") for k, s in enumerate(sums)])
    packed = weekdays.select("product_id", "weekday", F.array(*[f"s{k}" for k in range(len(sums))]).alias("s"))
    place = {p: k for k, p in enumerate(pairs)}
    at = lambda i, j: place[min(i, j), max(i, j)]
    count = len(pairs)
    # seven rows a product at most; a weekday without sales has zeros
    zeros = F.array(*[F.lit(0.0)] * len(sums))
    of_day = [F.coalesce(F.max(F.when(F.col("weekday") == d, F.col("s"))), zeros).alias(f"w{d}") for d in range(7)]
    wide = packed.groupBy("product_id").agg(*of_day)
    total = F.array(*[F.lit(0.0)] * len(sums))
    for d in range(7):
        total = F.zip_with(total, F.col(f"w{d}"), lambda a, b: a + b)
    wide = wide.withColumn("all", total)
    every = F.col("all")

    def ridged(value: Column, i: int, j: int) -> Column:
        return value + F.lit(RIDGE) if i == j and i else value

    matrix = [
        F.array(*[ridged(every[at(i, j)], i, j) for j in range(n)], *[F.col(f"w{d}")[at(0, i)] for d in range(1, 7)], every[count + i]) for i in range(n)
    ] + [
        F.array(
            *[F.col(f"w{d}")[at(0, j)] for j in range(n)],
            *[F.col(f"w{d}")[at(0, 0)] + F.lit(RIDGE) if e == d else F.lit(0.0) for e in range(1, 7)], F.col(f"w{d}")[count],
        ) for d in range(1, 7)
    ]
    right = F.array(*[every[count + i] for i in range(n)], *[F.col(f"w{d}")[count] for d in range(1, 7)])
    equations = wide.select("product_id", F.array(*matrix).alias("m"), right.alias("right"), every[0].alias("days"), every[count + n].alias("yy"))
    solved = equations.select("product_id", "days", "yy", "right", _solved(F.col("m"), len(TERMS)).alias("terms"))
    # what is left of the squares: y'y - b'X'y, but for the ridge
    explained = F.aggregate(F.zip_with("terms", "right", lambda b, r: b * r), F.lit(0.0), lambda a, x: a + x)
    free = F.col("days") - F.lit(float(len(TERMS)))
    spread = F.when(free > 0, F.sqrt(F.greatest(F.lit(0.0), F.col("yy") - explained) / free))
    return solved.select("product_id", F.col("days").cast("long").alias("days"), "terms", spread.alias("spread"))


def joint_effects(fit: DataFrame) -> DataFrame:
    """The fit as rows: product_id, term, effect (on log units)."""
    named = F.transform("terms", lambda v, i: F.struct(F.element_at(F.array(*[F.lit(t) for t in TERMS]), i + 1).alias("term"), v.alias("effect")))
    return fit.select("product_id", F.inline(named))


def joint_seasonal_forecast(fit: DataFrame, start: dt.date, days: int = 30) -> DataFrame:
    """product_id, ds, yhat, yhat_lower, yhat_upper: units expected on each day, never below zero."""
    dated = fit.withColumn("ds", F.explode(F.sequence(F.lit(start), F.lit(start + dt.timedelta(days=days - 1)))))
    values = base_terms(F.col("ds"), cal.festival("ds")) + [F.when(F.weekday("ds") == d, F.lit(1.0)).otherwise(F.lit(0.0)) for d in range(1, 7)]
    line = F.aggregate(F.zip_with("terms", F.array(*values), lambda b, x: b * x), F.lit(0.0), lambda a, x: a + x)
    half = F.lit(BAND_DEVIATIONS) * F.coalesce("spread", F.lit(0.0))
    # beyond any sale, so that a wild trend ends in a large number and not in infinity
    units = lambda z: F.greatest(F.lit(0.0), F.expm1(F.least(z, F.lit(50.0))))
    lined = dated.select("product_id", "ds", line.alias("z"), half.alias("half"))
    return lined.select("product_id", "ds", units(F.col("z")).alias("yhat"), units(F.col("z") - F.col("half")).alias("yhat_lower"), units(F.col("z") + F.col("half")).alias("yhat_upper"))
