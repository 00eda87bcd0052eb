"""Operators on small hand-written tables."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from pricelift.operators import clean, elasticity, features, forecast, joins, metrics, patterns, pricing, quality, reports, split
from pricelift.plans.master import build_master, build_master_busy
from pricelift.sources import testdata as td

D = dt.date


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


# ------------------------------------------------------------------ cleaning

def test_clean_sales_edges(spark):
    df = spark.createDataFrame([
        (1, 0, 5.0, 5.0, None, "2024-01-02"), (2, -1, 5.0, 1.0, "a", "2024-01-02"), (3, 1, 4.0, 5.0, "a", "2024-01-02"),
        (4, 1, None, 5.0, "a", "2024-01-02"), (5, 1, 5.0, 1.0, "a", "garbage"),
    ], "product_id long, units_sold long, current_price double, cost_price double, department string, date string")
    got = {r.product_id: r for r in clean.clean_sales(df).collect()}
    assert sorted(got) == [1, 5]
    assert got[1].department == "Unknown" and got[1].year_month == "2024-01" and got[1].date_only == D(2024, 1, 2)
    assert got[5].date is None and got[5].year_month is None


def test_clean_elasticity_infinities(spark):
    df = spark.createDataFrame([
        (1, "a", 10.0, math.inf, -math.inf, "High"), (2, "a", 30.0, 7.0, 0.5, "odd"), (3, "a", 20.0, None, 0.5, None),
        (4, None, 20.0, math.inf, 0.5, "Low"),
    ], "product_id long, department string, current_base_price double, recommended_optimal_price double,"
       " price_sensitivity double, price_sensitivity_category string")
    got = {r.product_id: r for r in clean.clean_elasticity(df).collect()}
    assert [got[i].recommended_optimal_price for i in (1, 2, 3, 4)] == [20.0, 7.0, 20.0, None]
    assert got[1].price_sensitivity == 0.0 and got[4].department == "Unknown"
    assert [got[i].sensitivity_encoded for i in (1, 2, 3, 4)] == [3, 1, 1, 1]


def test_clean_forecast_bands(spark):
    df = spark.createDataFrame(
        [(1, 0.0, 0.0, 0.0, 1), (2, 1.0, 2.0, 3.0, None), (3, 3.0, 2.0, 4.0, 0), (4, None, 2.0, 4.0, 0)],
        "product_id long, low double, mid double, high double, festival_flag int",
    ).withColumn("day", F.lit("2024-02-30"))
    got = clean.clean_forecast(df, "low", "mid", "high", "day").collect()
    assert [(r.product_id, r.festival_flag, r.day) for r in got] == [(2, 0, None)]


def test_resolve_column(spark):
    df = spark.createDataFrame([], "id int, price_sensitivity_category string, sensitivity double, Mean_x double")
    assert clean.resolve_column(df, ["sensitivity"], ["category"]) == "sensitivity"
    assert clean.resolve_column(df, ["mid", "expected", "mean"]) == "Mean_x"
    assert clean.resolve_column(df, ["date"]) is None


def test_uplift_backfill_only_when_nothing_is_there(spark):
    schema = "product_id long, profit_uplift double, current_profit double, profit_uplift_pct double"
    some = spark.createDataFrame([(1, 5.0, 10.0, None), (2, 5.0, 10.0, 1.0)], schema)
    none = spark.createDataFrame([(1, 5.0, 10.0, None), (2, 5.0, 0.0, math.nan)], schema)
    assert [r.profit_uplift_pct for r in clean.uplift_pct_backfill(some).orderBy("product_id").collect()] == [None, 1.0]
    assert [r.profit_uplift_pct for r in clean.uplift_pct_backfill(none).orderBy("product_id").collect()] == [50.0, None]


def test_load_results_keeps_missing_uplift(spark):
    df = spark.createDataFrame(
        [(1, "tea", "4.0", "3.0", None, "8", "oops", None, "expiry_discount", None)],
        "product_id long, product_name string, ` current_price` string, recommended_price string, profit_uplift string,"
        " current_profit string, predicted_demand string, spoilage_savings_estimate string, optimization_method string,"
        " inventory_ratio string",
    )
    r = clean.load_results(df).first()
    assert r.profit_uplift is None and r.predicted_demand == 0.0 and r.inventory_ratio == 0.0
    assert r.display_label == "tea (#1)" and r.recommendation == "Decrease" and r.is_profit_comparable is False
    assert r.inventory_health == "Critical"


# ------------------------------------------------------------------ joins

def test_name_join_refuses_repeated_names(spark):
    left = spark.createDataFrame([(1, "tea")], "product_id long, product_name string")
    right = spark.createDataFrame([("tea", 1.0), ("tea", 2.0)], "product_name string, price double")
    with pytest.raises(ValueError):
        joins.join_dim(left, right, "product_name", require_unique=True)
    assert joins.join_dim(left, right, "product_name").count() == 2


def test_fold_back_twice_is_once(spark):
    master = spark.createDataFrame([(1, "tea", 2.0)], "product_id long, product_name string, current_price double")
    log = spark.createDataFrame([(1, 3.0, 7), (2, 4.0, 8)], "product_id long, current_price double, batch_id long")
    seen = spark.createDataFrame([], "batch_id long")
    first = joins.fold_back(master, log, seen)
    assert rows(first, "product_id", "current_price") == [(1, "tea", 2.0), (1, None, 3.0), (2, None, 4.0)]
    again = joins.fold_back(first, log, log.select("batch_id"))
    assert rows(again, "product_id", "current_price") == rows(first, "product_id", "current_price")
    assert joins.fold_back(master, log.limit(0)).count() == 1


# ------------------------------------------------------------------ features

def sales_rows(spark, data):
    return spark.createDataFrame(data, "product_id long, date date, units_sold long")


def test_single_row_window_has_no_volatility(spark):
    got = features.rolling_features(sales_rows(spark, [(1, D(2024, 1, 1), 4)])).first()
    assert got.moving_avg_7day == 4.0 and got.demand_volatility == 0.0


def test_split_rolling_equals_plain_with_gaps_and_busy_days(spark):
    rng = random.Random(5)
    data = []
    for product in range(6):
        day = D(2024, 1, 1)
        for i in range(rng.choice([1, 3, 40, 200])):
            day += dt.timedelta(days=rng.choice([0, 0, 1, 1, 2, 45]))
            data.append((product, day, i, rng.randrange(50)))
    df = spark.createDataFrame(data, "product_id long, date date, seq long, units_sold long")
    w = features.Window.partitionBy("product_id").orderBy("date", "seq").rowsBetween(-6, 0)
    plain = df.select("product_id", "date", "seq", F.avg("units_sold").over(w).alias("m"),
                      F.round(F.coalesce(F.stddev_samp("units_sold").over(w), F.lit(0.0)), 9).alias("s"))
    cut = features.rolling_features_split(df, order=("date", "seq")).select(
        "product_id", "date", "seq", F.col("moving_avg_7day").alias("m"), F.round("demand_volatility", 9).alias("s"))
    order = ("product_id", "date", "seq")
    assert rows(cut, *order) == rows(plain, *order)


def test_conditional_ratio_edges(spark):
    df = spark.createDataFrame(
        [(1, 1, 6), (1, 0, 3), (2, 1, 6), (3, 0, 6), (4, 1, 5), (4, 0, 0)], "product_id long, flag int, units long"
    )
    plain = dict(rows(features.conditional_ratio(df, "flag", "units", "r"), "product_id"))
    assert plain == {1: 2.0, 2: None, 3: None, 4: 5.0}
    filled = dict(rows(features.conditional_ratio(df, "flag", "units", "r", 1.0), "product_id"))
    assert filled == {1: 2.0, 2: 1.0, 3: 1.0, 4: 5.0}
    windowed = features.with_conditional_ratio(df, "flag", "units", "r", 1.0).select("product_id", "r").distinct()
    assert dict(rows(windowed, "product_id")) == filled


def test_product_lookup_modes(spark):
    df = spark.createDataFrame(
        [(1, "b", 1.0), (1, "a", 2.0), (1, None, None), (2, None, math.nan), (2, None, 3.0)],
        "product_id long, tag string, price double",
    )
    expected = [(1, "a", 1.5), (2, None, 3.0)]
    assert rows(features.product_lookup(df), "product_id") == expected
    assert rows(features.product_lookup(df, {"tag": ("b", "a")}), "product_id") == expected


def test_days_since_prior_keeps_orders_without_user_or_date(spark):
    df = spark.createDataFrame([(1, 7, D(2024, 1, 1)), (2, 7, D(2024, 1, 4)), (3, None, D(2024, 1, 4)), (4, 7, None)], "order_id long, user_id long, order_date date")
    got = {r.order_id: r.days_since_prior_order for r in features.days_since_prior(df).collect()}
    assert got == {1: None, 2: 3, 3: None, 4: None}


def test_rolling_ties_go_by_transaction(spark):
    data = [(1, None, t, float(t * t)) for t in range(20)]
    runs = set()
    for seed in range(3):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "product_id long, date date, transaction_id long, units_sold double").repartition(3)
        runs.add(tuple(rows(features.rolling_features(df).select("transaction_id", "moving_avg_7day"), "transaction_id")))
    assert len(runs) == 1


def test_error_spread_is_lazy(spark):
    df = spark.range(500).select(F.col("id").alias("product_id"), (F.col("id") * 0.5).alias("mape"))
    spark.sparkContext.setJobGroup("lazy", "build only")
    try:
        out = metrics.describe_col(df, "mape")
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("lazy")
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    r = out.first()
    assert (r["count"], r["mean"], r["p25"], r["p50"], r["max"], r["n_above"]) == (500, 124.75, 62.375, 124.75, 249.5, 439)


def test_patterns_do_not_keep_maps(spark):
    lines = spark.createDataFrame([(1, 1, 1, 1)], "order_id long, product_id long, reordered int, add_to_cart_order int")
    orders = spark.createDataFrame([(1, 1, 8, 3)], "order_id long, order_dow int, order_hour_of_day int, days_since_prior_order int")
    products = spark.createDataFrame([(1, "tea")], "product_id long, product_name string")
    plan = patterns.purchase_patterns(lines, orders, products)._jdf.queryExecution().executedPlan().toString()
    assert "mode(" not in plan and "ObjectHashAggregate" not in plan


def test_filters_on_plain_result_columns_reach_the_scan(spark, small, tmp_path):
    td.lookup_edge(spark, small).write.parquet(str(tmp_path / "lookup"))
    results = pricing.price_products(spark.read.parquet(str(tmp_path / "lookup")))
    plan = results.filter("product_id = 7")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(product_id,7)" in plan


def test_product_lookup_mean_does_not_depend_on_order(spark):
    rng = random.Random(1)
    prices = [rng.random() * 1000 for _ in range(3000)]
    results = set()
    for seed in range(4):
        random.Random(seed).shuffle(prices)
        df = spark.createDataFrame([(1, p) for p in prices], "product_id long, price double").repartition(seed + 1)
        results.add(features.product_lookup(df).first().price)
    assert len(results) == 1


def test_weekly_uses_the_iso_year(spark):
    data = [(1, "x", "d", D(2024, 12, 30), 2), (1, "x", "d", D(2025, 1, 2), 3)]
    df = spark.createDataFrame(data, "product_id long, product_name string, department string, date date, units_sold long")
    zero = {c: F.lit(1.0) for c in ("revenue", "profit", "current_price", "discount_pct", "inventory_ratio")}
    flags = {c: F.lit(0) for c in ("festival_flag", "is_weekend", "inventory_level", "transaction_id")}
    got = features.weekly_demand(df.withColumns({**zero, **flags})).select("year", "week", "weekly_units_sold").collect()
    assert [tuple(r) for r in got] == [(2025, 1, 5)]


def test_weekly_sums_equal_daily_sums(spark, small):
    sales = td.sales_full(spark, small)
    assert features.weekly_demand(sales).agg(F.sum("weekly_units_sold")).first()[0] == sales.agg(F.sum("units_sold")).first()[0]


def test_pct_change_from_zero_is_null(spark):
    df = spark.createDataFrame(
        [(1, 2024, 1, 0, 2.0), (1, 2024, 2, 4, 2.0), (1, 2024, 3, 2, 3.0)],
        "product_id long, year int, week int, weekly_units_sold long, avg_price double",
    )
    got = features.elasticity_weekly(features.pct_changes(df)).orderBy("week").collect()
    assert [r.demand_change_pct for r in got] == [None, None, -0.5]
    assert [r.price_change_pct for r in got] == [None, 0.0, 0.5]
    assert [r.price_elasticity_est for r in got] == [None, None, -1.0]


@pytest.mark.parametrize("n", [3, 10, 14, 40])
def test_recent_stats_against_python(spark, n):
    units = [(i * 7) % 11 for i in range(n)]
    df = sales_rows(spark, [(1, D(2024, 1, 1) + dt.timedelta(days=i), u) for i, u in enumerate(units)])
    got = features.recent_stats(df).first()
    last30, last14 = units[-30:], units[-14:]
    mean = lambda v: sum(v) / len(v)
    assert got.avg_daily == pytest.approx(mean(last30)) and got.recent_rows == len(last30)
    assert got.last7 == pytest.approx(mean(units[-7:])) and got.prior7 == pytest.approx(mean(last14[:7]))


def test_days_since_prior_with_busy_user(spark):
    df = spark.createDataFrame(
        [(1, 1, D(2024, 1, 1)), (2, 1, D(2024, 1, 1)), (3, 1, D(2024, 1, 9)), (4, 2, D(2024, 1, 3))],
        "order_id long, user_id long, order_date date",
    )
    got = dict(features.days_since_prior(df).select("order_id", "days_since_prior_order").collect())
    assert got == {1: None, 2: 0, 3: 8, 4: None}


def test_purchase_patterns_ties(spark):
    lines = spark.createDataFrame([(1, 9, 1, 0), (2, 9, 30, 1)], "order_id long, product_id long, add_to_cart_order int, reordered int")
    orders = spark.createDataFrame(
        [(1, 5, 3, 20, None), (2, 5, 1, 8, 4)],
        "order_id long, user_id long, order_dow int, order_hour_of_day int, days_since_prior_order int",
    )
    products = spark.createDataFrame([(9, "tea")], "product_id long, product_name string")
    r = patterns.purchase_patterns(lines, orders, products).first()
    assert (r.peak_hour, r.peak_day, r.total_orders, r.reorder_rate, r.purchase_frequency) == (8, 1, 2, 0.5, "Rare")
    assert r.loyalty_index == pytest.approx((0.5 * 0.6 + (1 - 15.5 / 20) * 0.4) * 100, abs=0.05)
    assert r.avg_days_between_orders == 4.0


# ------------------------------------------------------------------ elasticity and pricing

def elastic_row(spark, e, cost=4.0, base=10.0, demand=100.0, profit=600.0):
    return spark.createDataFrame(
        [(1, "tea", "d", cost, base, e, retail_class(e), demand, profit)],
        "product_id long, product_name string, department string, cost_price double, current_base_price double,"
        " avg_price_elasticity double, price_sensitivity_category string, avg_weekly_demand double, current_weekly_profit double",
    )


def retail_class(e):
    return "High" if e < -1.5 else "Medium" if e < -0.8 else "Low"


def test_lerner_rule(spark):
    usual = elasticity.lerner_price(elastic_row(spark, -2.0)).first()
    assert usual.recommended_optimal_price == 8.0 and usual.predicted_demand_at_optimal == 156.0
    assert usual.expected_weekly_profit_at_optimal == 624.0 and usual.profit_improvement_pct == 4.0
    none = elasticity.lerner_price(elastic_row(spark, -1.0)).first()
    assert none.recommended_optimal_price is None and none.predicted_demand_at_optimal is None
    assert elasticity.lerner_price(elastic_row(spark, -0.05)).first().recommended_optimal_price is None
    assert elasticity.lerner_price(elastic_row(spark, -0.5)).first().recommended_optimal_price == pytest.approx(4.2)


@pytest.mark.parametrize("stock,factor", [("EXCESS", 0.85), ("CRITICAL", 1.10), ("NORMAL", 1.0)])
def test_price_grid_against_python(spark, stock, factor):
    df = elasticity.lerner_price(elastic_row(spark, -2.0))
    inventory = spark.createDataFrame([(1, stock)], "product_id long, stock_urgency string")
    got = elasticity.price_grid(df, inventory).first()
    grid = [4.2 + i * (15 - 4.2) / 6 for i in range(7)]
    best = max(grid, key=lambda p: 100 * (p / 10) ** -2 * (p - 4))
    assert got.recommended_price == pytest.approx(best * factor, abs=0.006)


def test_price_grid_without_profit_keeps_base_price(spark):
    df = elastic_row(spark, -2.0, demand=0.0).withColumn("recommended_optimal_price", F.lit(1.0))
    inventory = spark.createDataFrame([], "product_id long, stock_urgency string")
    got = elasticity.price_grid(df, inventory).first()
    assert got.recommended_price == 10.0 and got.stock_urgency == "NORMAL"


def test_inventory_status_edges(spark):
    df = spark.createDataFrame(
        [(1, 10, 0.0), (2, 30, 10.0), (3, 29, 10.0), (4, 70, 10.0), (5, 300, 10.0), (6, 301, 10.0), (7, 451, 10.0)],
        "product_id long, current_stock_units long, daily_avg_sales double",
    ).withColumn("current_price", F.lit(2.0))
    got = {r.product_id: r for r in elasticity.inventory_status(df).collect()}
    assert [got[i].stock_urgency for i in range(1, 8)] == ["EXCESS", "LOW", "CRITICAL", "NORMAL", "NORMAL", "HIGH", "EXCESS"]
    assert got[1].days_of_stock_remaining == 99.0 and [got[i].needs_reorder for i in (4, 5)] == [1, 0]


LOOKUP = (
    "product_id long, cost_price double, base_price double, current_price double, price_elasticity double,"
    " price_sensitivity_category string, stock_urgency_category string, expiry_risk_flag int, inventory_level long,"
    " baseline_demand double"
)


def price_one(spark, *values):
    return pricing.price_products(spark.createDataFrame([(1, *values)], LOOKUP)).first()


def test_pricing_branches(spark):
    assert price_one(spark, 4.0, 10.0, 10.0, -0.5, "Low", "Normal", 1, 5, 50.0).optimization_method == "inelastic_markup"
    kept = price_one(spark, 4.0, 10.0, 10.5, -5.0, "Low", "Normal", 0, 5, 50.0)
    assert kept.optimization_method == "inelastic_no_change" and kept.recommended_price == 10.5
    expiry = price_one(spark, 9.0, 10.0, 10.0, -2.0, "High", "Normal", 1, 7, 50.0)
    assert expiry.optimization_method == "expiry_discount" and expiry.recommended_price == 9.18
    assert expiry.profit_uplift is None and expiry.spoilage_savings_estimate == pytest.approx(64.26)
    capped = price_one(spark, 4.0, 10.0, 10.0, -0.1, "Medium", "Critical", 0, 5, 50.0)
    assert capped.optimization_method == "elasticity_optimized" and capped.recommended_price == 11.5
    assert price_one(spark, 4.0, 10.0, 10.0, -0.1, "Medium", "Normal", 0, 5, 50.0).recommended_price == 15.0


def test_pricing_with_cost_above_the_interval(spark):
    # 1.05 x cost is above 1.5 x base: the last limit (1.5 x base) wins, as stated
    got = price_one(spark, 20.0, 10.0, 10.0, -2.0, "High", "Normal", 0, 5, 50.0)
    assert got.recommended_price == 15.0


def test_pricing_of_empty_figures(spark):
    zero = price_one(spark, 0.0, 0.0, 0.0, None, "Medium", "Normal", 0, 0, 0.0)
    assert zero.price_change_pct == 0.0 and zero.profit_uplift_pct == 0.0 and zero.predicted_demand == 0.0
    nan = price_one(spark, 4.0, 10.0, 10.0, math.nan, "High", "Normal", 0, 5, 50.0)
    none = price_one(spark, 4.0, 10.0, 10.0, None, "High", "Normal", 0, 5, 50.0)
    assert nan.recommended_price == none.recommended_price == 12.0


def test_recommended_price_stays_in_bounds(spark, small):
    got = pricing.optimize_price(td.lookup_edge(spark, small)).filter(F.col("optimization_method") == "elasticity_optimized")
    bad = got.filter(
        (F.col("recommended_price") > F.col("base_price") * 1.5 + 0.005)
        | (F.col("recommended_price") < F.least(F.col("cost_price") * 1.05, F.col("base_price") * 1.5) - 0.005)
    )
    assert bad.count() == 0


def test_lookup_defaults_fill_rows_not_columns(spark):
    df = spark.createDataFrame([(1, 10.0, None, None), (2, 10.0, 12.0, 3.0)], "product_id long, current_price double, base_price double, cost_price double")
    got = rows(pricing.lookup_defaults(df).select("product_id", "base_price", "cost_price", "department"), "product_id")
    assert got == [(1, 10.0, 7.0, "General"), (2, 12.0, 3.0, "General")]


def test_filters_do_not_repeat_the_pricing_expression(spark, small):
    results = pricing.price_products(td.lookup_edge(spark, small))
    filtered = clean.filter_results(results, method="elasticity_optimized", uplift_range=(0.0, 1e6), change_range=(-50.0, 50.0))
    plan = lambda df: len(df._jdf.queryExecution().optimizedPlan().toString())
    assert plan(filtered) < 1.2 * plan(results)


# ------------------------------------------------------------------ forecast

def test_forecast_skips_short_history_and_floors_at_zero(spark):
    recent = spark.createDataFrame(
        [(1, 9, 5.0, 1.0, 0.0), (2, 30, 5.0, 2.0, -3.0)],
        "product_id long, recent_rows long, avg_daily double, std_daily double, trend double",
    )
    prices = spark.createDataFrame([(1, 2.0), (2, 2.0)], "product_id long, recommended_price double")
    got = forecast.forecast_project(recent, prices, D(2024, 12, 1), 30).orderBy("forecast_date").collect()
    assert len(got) == 30 and {r.product_id for r in got} == {2}
    assert got[0].predicted_units == 8.8 and got[-1].predicted_units == 0.0 and got[-1].predicted_units_lower == 0.0
    assert all(r.festival_flag == 0 for r in got)  # December is no festival month of the forecast


def test_seasonal_model_finds_festival_and_trend(spark):
    days = [D(2023, 1, 1) + dt.timedelta(days=n) for n in range(730)]
    data = [(1, d, int(d.month in (10, 12) and d.day >= 20), 100 + n // 10 + (300 if d.month in (10, 12) and d.day >= 20 else 0)) for n, d in enumerate(days)]
    df = spark.createDataFrame(data, "product_id long, date date, festival_flag int, units_sold long")
    index = {(r.kind, r.bucket): r for r in forecast.seasonal_index(df).collect()}
    assert index["festival", 1].seasonal_index > 2.5 and index["month", 10].seasonal_index < 1.3
    assert index["trend", None].mean_units == pytest.approx(0.1, abs=0.1)
    got = {r.ds: r for r in forecast.seasonal_forecast(forecast.seasonal_index(df), D(2025, 10, 10)).collect()}
    assert got[D(2025, 10, 25)].yhat > 2 * got[D(2025, 10, 18)].yhat
    assert all(r.yhat_lower <= r.yhat <= r.yhat_upper for r in got.values())


def test_seasonal_factor_limits(spark):
    df = spark.createDataFrame(
        [(1, D(2024, 1, 1), 9.0), (1, D(2024, 1, 2), 1.0), (1, D(2024, 1, 3), 1.0), (2, D(2024, 1, 1), 0.0), (3, D(2024, 1, 1), 1.0), (3, D(2024, 1, 2), 9.0)],
        "product_id long, ds date, yhat double",
    )
    assert rows(forecast.seasonal_factor(df), "product_id") == [(1, 2.0), (2, 1.0), (3, 0.5)]


# ------------------------------------------------------------------ split, metrics, quality, reports

@pytest.mark.parametrize("fraction", [0.0, 0.013, 0.5, 0.85, 1.0])
def test_chrono_split_is_exact(spark, fraction):
    rng = random.Random(3)
    # two thirds of all rows on one date
    data = [(i, rng.randrange(5), D(2024, 1, 9) if i % 3 else D(2024, 1, 1) + dt.timedelta(days=i % 20)) for i in range(900)]
    df = spark.createDataFrame(data, "transaction_id long, product_id long, date date")
    older, newer = split.chrono_split(df, fraction)
    old, new = [r.transaction_id for r in older.collect()], [r.transaction_id for r in newer.collect()]
    assert len(old) == int(900 * fraction) and sorted(old + new) == list(range(900))
    if old and new:
        assert older.agg(F.max("date")).first()[0] <= newer.agg(F.min("date")).first()[0]


def test_copies_stay_on_one_side(spark):
    df = spark.createDataFrame([(1, 1, D(2024, 1, 1))] * 30 + [(2, 2, D(2024, 1, 2))] * 3, "transaction_id long, product_id long, date date")
    older, newer = split.chrono_split(df, 0.5)
    assert (older.count(), newer.count()) == (30, 3)


def test_split_of_nothing(spark):
    df = spark.createDataFrame([], "transaction_id long, product_id long, date date")
    older, newer = split.chrono_split(df, 0.85)
    assert older.count() == 0 and newer.count() == 0


@pytest.mark.parametrize("n", [1, 2, 7, 2000])
def test_exact_quantiles(spark, n):
    rng = random.Random(n)
    values = [rng.choice([1.0, 1.0, rng.random() * 50]) for _ in range(n)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (math.nan,)], "v double")
    got = metrics.describe_col(df, "v", above=20.0).first()
    ordered = sorted(values)

    def quantile(p):
        at = (n - 1) * p
        low, high = ordered[math.floor(at)], ordered[math.ceil(at)]
        return low + (high - low) * (at - math.floor(at))

    assert got["count"] == n and got["min"] == ordered[0] and got["max"] == ordered[-1]
    for name, p in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75)):
        assert got[name] == pytest.approx(quantile(p))
    assert got["mean"] == pytest.approx(sum(values) / n)
    assert got["n_above"] == sum(v > 20 for v in values)
    assert (got["std"] is None) == (n == 1)


def test_validation_gate(spark):
    df = spark.createDataFrame([(None, 600.0, None)], "product_id long, current_price double, department string")
    report = {r.rule: r for r in quality.validate(df).collect()}
    assert report["product_id_not_null"].failing_rows == 1 and report["price_in_range"].status == "failed"
    assert report["cost_positive"].status == "failed" and report["cost_positive"].failing_rows is None
    assert report["inventory_ratio_in_range"].status == "skipped"
    with pytest.raises(quality.ValidationFailed, match="4 rule"):
        quality.assert_valid(quality.validate(df))
    good = spark.createDataFrame([(1, 5.0, "a", 1.0)], "product_id long, current_base_price double, department string, cost_price double")
    quality.assert_valid(quality.validate(good))


def test_nulls_do_not_violate_ranges(spark):
    df = spark.createDataFrame([(1, None, None, None, "a")], "product_id long, current_price double, cost_price double, inventory_ratio double, department string")
    assert {r.status for r in quality.validate(df).collect()} == {"passed", "skipped"}


def test_top_department_needs_a_gain(spark):
    schema = "department string, optimization_method string, profit_uplift double"
    loss = spark.createDataFrame([("a", "x", -5.0), ("b", "x", 2.0)], schema)
    assert reports.top_department(loss).count() == 0
    tie = spark.createDataFrame([("b", "x", 5.0), ("a", "x", 5.0), ("c", "expiry_discount", None)], schema)
    assert tuple(reports.top_department(tie).first()) == ("a", 5.0, 50.0)


def test_reports_on_an_empty_table(spark, small):
    empty = pricing.price_products(td.lookup_edge(spark, small)).limit(0)
    kpi = reports.kpi_totals(empty).first()
    assert kpi.n_rows == 0 and kpi.total_uplift == 0.0 and kpi.mean_uplift_pct is None
    status = reports.freshness_status(empty.withColumn("event_time", F.lit(None).cast("timestamp")), dt.datetime(2024, 1, 1))
    assert status.first().status == "Offline"


@pytest.mark.parametrize("seconds,status", [(0, "Live"), (120, "Live"), (121, "Idle")])
def test_freshness(spark, seconds, status):
    now = dt.datetime(2024, 1, 1, 12, 0, 0)
    df = spark.createDataFrame([((now - dt.timedelta(seconds=seconds)).isoformat(),)], "t string")
    df = df.select(F.col("t").cast("timestamp").alias("event_time"))
    assert reports.freshness_status(df, now).first().status == status


def test_parse_explanation_of_arrays(spark):
    df = spark.createDataFrame([(1, '[{"explanation": "x"}]'), (2, '{"explanation": "y", "confidence_pct": "many"}')], "id long, reply string")
    got = {r.id: r for r in reports.parse_explanation(df).collect()}
    assert got[1].confidence_label == "Unavailable" and got[1].explanation.startswith("[")
    assert got[2].explanation == "y" and got[2].confidence_pct is None and got[2].confidence_label == "Medium"


# ------------------------------------------------------------------ plans

def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def master_of(spark, small):
    from pricelift.checks.joins import master

    return master(spark, small)


def test_master_has_76_columns_and_keeps_the_grain(spark, small):
    master = master_of(spark, small)
    assert len(master.columns) == 76 and len(set(master.columns)) == 76
    assert master.count() == td.sales(spark, small).count()


def test_master_exchanges_sales_once(spark, small, tmp_path):
    td.sales_full(spark, small).write.parquet(str(tmp_path / "sales"))
    sales = spark.read.parquet(str(tmp_path / "sales"))
    product = td.catalog_full(spark, small)
    elastic = product.select("product_id", F.lit("a").alias("department"), F.lit(1.0).alias("recommended_optimal_price"), F.lit(1.0).alias("current_base_price"))
    optimal = product.select("product_id", F.lit(-1.0).alias("price_elasticity"))
    fc = product.select("product_id", *[F.lit(1.0).alias(c) for c in ("predicted_units", "predicted_revenue", "confidence_pct")])
    master = build_master(sales, product, elastic, optimal, fc)
    scans = [line for line in executed(master).splitlines() if "FileScan" in line and "transaction_id" in line]
    assert len(scans) == 1
    assert "CartesianProduct" not in executed(master) and "BroadcastNestedLoopJoin" not in executed(master)


def test_busy_master_equals_the_plain_one(spark, small):
    from pricelift.checks import inputs
    from pricelift.checks.base import comparable

    t = inputs.derived(spark, small)
    tables = (td.sales_full(spark, small), td.catalog_full(spark, small), clean.clean_elasticity(t.elasticity), t.optimal, t.forecast)
    plain, busy = build_master(*tables), build_master_busy(*tables)
    assert set(plain.columns) == set(busy.columns)
    columns = ["product_id", "date", "moving_avg_7day", "demand_volatility", "total_units_sold", "weekend_demand_boost",
               "festival_demand_multiplier", "product_name_opt", "department_elas", "predicted_units_avg", "competitor_price_gap"]
    assert rows(comparable(busy.select(columns)), "product_id", "date") == rows(comparable(plain.select(columns)), "product_id", "date")


@pytest.mark.parametrize("busy_rows", [0, 35, 10**6])
def test_busy_master_copies_product_columns_for_busy_products_only(spark, small, busy_rows):
    """All products, some and none split by month: the same rows; product columns are laid out once for the rest."""
    from pricelift.checks.base import comparable

    sales = td.sales_full(spark, small).withColumn("transaction_id", F.xxhash64("product_id", "date"))
    sales = sales.withColumn("date", F.when(F.col("transaction_id") % 9 != 0, F.col("date"))).persist()
    counts = {r.product_id: r["count"] for r in sales.groupBy("product_id").count().collect()}
    months = features.busy_months(sales, busy_rows)
    assert {r._product for r in months.collect()} == {p for p, n in counts.items() if n > busy_rows}
    chunks = features.with_busy_chunk(sales, months).select("product_id", features.CHUNK).distinct().groupBy("product_id").count().collect()
    assert all(r["count"] == 1 for r in chunks if counts[r.product_id] <= busy_rows)
    product = td.catalog_full(spark, small).select("product_id", "aisle", "shelf_life_days", "is_perishable")
    forecast = sales.select("product_id", F.lit(1.0).alias("predicted_units"), F.lit(1.0).alias("predicted_revenue"), F.lit(1.0).alias("confidence_pct"))
    none = product.select("product_id", F.lit(1.5).alias("x")).limit(0)
    tables = (sales, product, none.withColumnRenamed("x", "e"), none.withColumnRenamed("x", "o"), forecast)
    shown = ["product_id", "date", "transaction_id", "moving_avg_7day", "demand_volatility", "total_units_sold", "aisle", "predicted_units_avg"]
    key = ("product_id", "date", "transaction_id")
    got, want = (rows(comparable(m.select(shown), ("demand_volatility",)), *key) for m in (build_master_busy(*tables, busy_rows=busy_rows), build_master(*tables)))
    assert got == want and len(got) == sales.count()


@pytest.mark.parametrize("key", ["product_lookup", "product_lookup_levels", "build_master"])
def test_no_table_of_products_is_gathered_by_the_driver(spark, small, key):
    """The files of these tables are small enough to broadcast; their rows grow with the products."""
    from pricelift.checks.registry import all_checks

    assert "Broadcast" not in all_checks()[key].run(spark, small)._jdf.queryExecution().executedPlan().toString()


def test_pricing_needs_no_shuffle(spark, small):
    assert "Exchange" not in executed(pricing.price_products(td.lookup_edge(spark, small)))


def test_recent_rows_are_cut_before_the_shuffle(spark, small):
    plan = executed(features.recent_stats(td.sales(spark, small)))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_hot_product_keeps_results_whole(spark):
    """One product with a third of all order lines: the same totals, one row per day."""
    lines = [(i, 7 if i % 3 == 0 else i % 50, D(2024, 1, 1) + dt.timedelta(days=i % 90), 1 + i % 4) for i in range(6000)]
    df = spark.createDataFrame(lines, "transaction_id long, product_id long, date date, units_sold long")
    daily = df.groupBy("product_id", "date").agg(F.sum("units_sold").alias("units_sold"))
    assert daily.filter("product_id = 7").count() <= 90
    got = features.with_total(daily).filter("product_id = 7").first().total_units_sold
    assert got == sum(u for _, p, _, u in lines if p == 7)
