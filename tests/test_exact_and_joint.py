"""Exact medians per key and the joint seasonal fit, against numpy."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelift.operators import clean, ranks, seasonal
from pricelift.sources import testdata as td


def lower_median(values):
    ordered = sorted(values)
    return ordered[(len(ordered) - 1) // 2]


def test_median_of_a_large_key_is_exact(spark):
    rows = spark.range(200_000).select(F.lit("a").alias("k"), (F.rand(4) * 1e4).alias("v")).unionByName(
        spark.range(7).select(F.lit("b").alias("k"), F.col("id").cast("double").alias("v")))
    table = rows.toPandas()
    fixed = spark.createDataFrame(table)
    got = {r.k: r.m for r in ranks.lower_median_by(fixed, "k", "v", "m").collect()}
    assert got == {k: lower_median(g.v) for k, g in table.groupby("k")}


def test_median_of_odd_values(spark):
    rng = np.random.default_rng(2)
    keys = {
        "wide": (10.0 ** rng.uniform(-300, 300, 501) * rng.choice([-1, 1], 501)).tolist(), "ties": [2.5] * 10 + [1.0] * 9, "one": [-0.0],
        "near": (1.0 + rng.integers(0, 400, 300) * 2.0**-52).tolist(), "endless": [math.inf] * 3 + [-math.inf, 1.0], None: [3.0, 1.0, 2.0, 4.0],
        "zeros": [0.0, 0.0, -1.0, 1.0, 5e-324],
    }
    rows = [(k, v) for k, vs in keys.items() for v in vs] + [("ties", None), ("one", math.nan), ("none", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    got = {r.k: r.m for r in ranks.lower_median_by(df, "k", "v", "m").collect()}
    assert got == {k: lower_median(vs) for k, vs in keys.items()}
    assert ranks.lower_median_by(df.limit(0), "k", "v", "m").count() == 0


def test_cleaning_uses_the_exact_median(spark):
    base = spark.range(30_000).select(F.col("id").alias("product_id"), F.lit("d").alias("department"), (F.col("id") * 0.01 + 1).alias("current_base_price"),
                                      F.when(F.col("id") == 3, F.lit(math.inf)).otherwise(F.lit(9.0)).alias("recommended_optimal_price"))
    row = clean.clean_elasticity(base).filter("product_id = 3").first()
    assert row.recommended_optimal_price == lower_median([n * 0.01 + 1 for n in range(30_000)])


def design(day, festival):
    t = (day - seasonal.ORIGIN).days
    waves = [f(2 * math.pi * k * t / seasonal.YEAR) for k in range(1, seasonal.WAVES + 1) for f in (math.sin, math.cos)]
    return [1.0, t / seasonal.TREND_UNIT, *waves, float(festival), *[float(day.weekday() == d) for d in range(1, 7)]]


def ridge_fit(rows):
    x = np.array([design(d, f) for d, _, f in rows])
    y = np.log1p([u for _, u, _ in rows])
    penalty = seasonal.RIDGE * np.diag([0.0] + [1.0] * (x.shape[1] - 1))
    return np.linalg.solve(x.T @ x + penalty, x.T @ y)


@pytest.fixture(scope="module")
def confounded():
    """A product sold on weekends and before Christmas: weekday, season and festival days come together."""
    rng = np.random.default_rng(6)
    rows = []
    for n in range(900):
        day = dt.date(2001, 1, 1) + dt.timedelta(days=n)
        weekend, winter, festival = day.weekday() >= 5, day.month in (11, 12), day.month == 12 and day.day > 20
        if rng.random() < (0.9 if weekend or winter else 0.15):
            level = 3 + 0.8 * weekend + 0.5 * math.cos(2 * math.pi * (day - seasonal.ORIGIN).days / seasonal.YEAR) + 0.6 * festival
            rows.append((day, int(round(math.expm1(level + rng.normal(0, 0.05)))), int(festival)))
    return rows


def test_joint_fit_equals_least_squares_and_finds_the_effects(spark, confounded):
    data = [(1, d, u, f) for d, u, f in confounded] + [(2, dt.date(2001, 5, 5), 4, 0)] + [(1, None, 5, 0), (None, dt.date(2001, 5, 5), 5, 0), (3, dt.date(2001, 5, 5), None, 0)]
    # a day in two rows counts as one day
    data.append((2, dt.date(2001, 5, 5), 2, None))
    sales = spark.createDataFrame(data, "product_id long, date date, units_sold long, festival_flag int")
    got = {r.product_id: r for r in seasonal.joint_seasonal_fit(sales).collect()}
    assert set(got) == {1, 2}
    np.testing.assert_allclose(got[1].terms, ridge_fit(confounded), rtol=1e-6, atol=1e-8)
    effect = dict(zip(seasonal.TERMS, got[1].terms, strict=True))
    assert abs(effect["weekday_5"] - 0.8) < 0.03 and abs(effect["festival"] - 0.6) < 0.05 and abs(effect["cos_1"] - 0.5) < 0.03
    assert got[1].spread == pytest.approx(0.05, abs=0.02) and got[1].days == len(confounded)
    assert got[2].days == 1 and got[2].spread is None
    # one-way means lay the festival's and the winter's share of weekends on the weekday as well
    weekend = np.mean([np.log1p(u) for d, u, _ in confounded if d.weekday() >= 5]) - np.mean([np.log1p(u) for d, u, _ in confounded if d.weekday() < 5])
    assert abs(weekend - 0.8) > 0.08
    days = {r.ds: r for r in seasonal.joint_seasonal_forecast(seasonal.joint_seasonal_fit(sales).filter("product_id = 1"), dt.date(2003, 7, 1), 20).collect()}
    for day, r in days.items():
        assert r.yhat == pytest.approx(max(0.0, math.expm1(float(np.dot(design(day, 0), got[1].terms)))), rel=1e-6)
        assert 0 <= r.yhat_lower <= r.yhat <= r.yhat_upper
    assert seasonal.joint_seasonal_fit(sales.limit(0)).count() == 0


def test_joint_fit_of_all_products_equals_least_squares(spark, small):
    sales = td.sales(spark, small)
    got = {r.product_id: r.terms for r in seasonal.joint_seasonal_fit(sales).collect()}
    by_day = sales.filter("date is not null and units_sold is not null").groupBy("product_id", "date").agg(
        F.sum("units_sold").alias("u"), F.max("festival_flag").alias("f")).collect()
    rows = {}
    for r in by_day:
        rows.setdefault(r.product_id, []).append((r.date, r.u, r.f or 0))
    assert got.keys() == rows.keys()
    for product, days in rows.items():
        np.testing.assert_allclose(got[product], ridge_fit(days), rtol=1e-4, atol=1e-6)
    effects = seasonal.joint_effects(seasonal.joint_seasonal_fit(sales))
    assert effects.count() == len(got) * len(seasonal.TERMS) and effects.filter("effect is null").count() == 0


def test_joint_fit_exchanges_days_and_no_sums(spark, small):
    """The sums of a product are wider than its days; they are made behind one exchange by product."""
    fit = seasonal.joint_seasonal_fit(td.sales(spark, small))
    fit.collect()
    plan = fit._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "REPARTITION_BY_COL" in plan and "hashpartitioning(product_id#" in plan
    assert "weekday" not in "".join(line for line in plan.splitlines() if "hashpartitioning" in line)
