"""Rows that go by product are laid out in parts of a bounded number of rows, and not exchanged again."""

import math

import pytest

from pricelift.checks import inputs as x
from pricelift.checks.base import comparable
from pricelift.checks.registry import all_checks
from pricelift.operators import features, forecast
from pricelift.sources import testdata as td


def hash_exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    return [line.strip() for line in plan.splitlines() if "Exchange hashpartitioning" in line]


@pytest.fixture
def small_tasks(monkeypatch):
    monkeypatch.setattr(features, "ROWS_PER_TASK", 300)
    monkeypatch.setattr(features, "MANY_ROWS", 1000)


def test_parts_grow_with_the_rows_whatever_their_packed_size(spark, small, small_tasks):
    lines = td.table(spark, small, "lineitem").count()
    sales = td.sales(spark, small, by_product=True)
    assert sales.rdd.getNumPartitions() == math.ceil(lines / 300) > 8
    assert features.weekly_features(x.weekly(spark, small)).rdd.getNumPartitions() == math.ceil(lines / 300)


def test_weekly_features_and_elasticity_stay_where_the_days_are(spark, small, small_tasks):
    sales = td.sales_full(spark, small)
    assert len(hash_exchanges(features.weekly_features(x.weekly(spark, small)))) == len(hash_exchanges(sales))
    # the catalog alone comes to them
    assert len(hash_exchanges(x.elasticity(spark, small))) <= len(hash_exchanges(sales)) + 1


def test_seasonal_indices_and_forecast_stay_where_the_days_are(spark, small, small_tasks):
    sales = td.sales(spark, small, by_product=True)
    index = forecast.seasonal_index(sales)
    factor = forecast.seasonal_factor(forecast.seasonal_forecast(index, x.FORECAST_START))
    assert len(hash_exchanges(index)) == len(hash_exchanges(factor)) == len(hash_exchanges(sales))
    # rows that lie anyhow give the same
    assert sorted(map(str, index.collect())) == sorted(map(str, forecast.seasonal_index(td.sales(spark, small)).collect()))


def test_few_rows_take_no_tasks_of_their_own(spark, small):
    """Numbered parts are not put together again; a wide plan over few rows would begin each of them."""
    plan = td.sales(spark, small, by_product=True)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" not in plan


def test_code_of_the_wide_table_is_short_enough_to_be_compiled(spark, small):
    """HotSpot leaves methods of more than 8,000 bytes uncompiled: the last step of 76 columns then takes twice as long."""
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        stages = all_checks()["build_master"].run(spark, small)._jdf.queryExecution().debug().codegenToSeq()
        assert max(stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())) < 8000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_minus_zero_is_shown_as_zero_and_all_else_as_it_is(spark):
    values = [-0.0, 0.0, -1e-320, float("inf"), None]
    shown = [r.v for r in comparable(spark.createDataFrame([(v,) for v in values], "v double").coalesce(1)).collect()]
    assert list(map(str, shown)) == ["0.0", "0.0", "-1e-320", "inf", "None"]
