"""Edge values of the column expressions, written by hand."""

import math

import pytest
from pyspark.sql import functions as F

from pricelift.functions import calendar as cal
from pricelift.functions import demand, numeric, retail, text


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def lit(value, kind="double"):
    return F.lit(value).cast(kind)


@pytest.mark.parametrize("value,digits,expected", [
    (2.5, 0, 2.0), (3.5, 0, 4.0), (-2.5, 0, -2.0), (1.234, 2, 1.23), (0.125, 2, 0.12), (0.375, 2, 0.38),
])
def test_round_to_is_half_even(spark, value, digits, expected):
    assert one(spark, numeric.round_to(lit(value), digits)) == expected


def test_ratio_of_zero_is_null(spark):
    assert one(spark, numeric.ratio(lit(1), lit(0))) is None


@pytest.mark.parametrize("value", [math.nan, math.inf, -math.inf])
def test_finite(spark, value):
    assert one(spark, numeric.finite(lit(value))) is None


def test_clip_keeps_null(spark):
    assert one(spark, numeric.clip(lit(None), 0.0, 1.0)) is None
    assert one(spark, numeric.clip(lit(7), 0.0, 1.0)) == 1.0


@pytest.mark.parametrize("orders,label", [
    (0, None), (1, "Rare"), (5, "Rare"), (6, "Occasional"), (20, "Occasional"), (21, "Frequent"), (50, "Frequent"),
    (51, "Very Frequent"), (10000, "Very Frequent"), (10**12, "Very Frequent"), (None, None),
])
def test_frequency_band(spark, orders, label):
    assert one(spark, retail.frequency_band(lit(orders, "long"))) == label


@pytest.mark.parametrize("ratio,label", [
    (0.3, "Critical"), (0.30001, "Warning"), (0.6, "Warning"), (0.7, "Healthy"), (-100.0, None), (None, None),
])
def test_inventory_health(spark, ratio, label):
    assert one(spark, retail.inventory_health(lit(ratio))) == label


@pytest.mark.parametrize("ratio,label", [(0.2, "Normal"), (0.19, "Critical"), (0.7, "Normal"), (0.71, "Low"), (None, "Normal")])
def test_stock_category(spark, ratio, label):
    assert one(spark, retail.stock_category(lit(ratio))) == label


@pytest.mark.parametrize("e,label", [(-1.5, "Medium"), (-1.51, "High"), (-0.8, "Low"), (-0.81, "Medium"), (0.0, "Low")])
def test_sensitivity_class(spark, e, label):
    assert one(spark, retail.sensitivity_class(lit(e))) == label


def test_sensitivity_encode_of_unknown_is_one(spark):
    assert one(spark, retail.sensitivity_encode(lit(None, "string"))) == 1


@pytest.mark.parametrize("perishable,life,flag", [(1, 13, 1), (1, 14, 0), (0, 5, 0), (None, 5, 0), (1, None, 0)])
def test_expiry_risk(spark, perishable, life, flag):
    assert one(spark, retail.expiry_risk(lit(perishable, "int"), lit(life, "int"))) == flag


@pytest.mark.parametrize("name,days", [
    ("Fresh PRODUCE", 7), ("dairy eggs", 14), ("pantry and deli", 7), ("household", 180), (None, 180),
])
def test_shelf_life_first_keyword_wins(spark, name, days):
    assert one(spark, retail.shelf_life(lit(name, "string"))) == days


@pytest.mark.parametrize("day,flag", [
    ("2024-10-19", 0), ("2024-10-20", 1), ("2024-12-20", 1), ("2024-11-25", 0), (None, None),
])
def test_festival(spark, day, flag):
    assert one(spark, cal.festival(lit(day, "date"))) == flag


def test_calendar_of_a_saturday(spark):
    day = lit("2024-06-01", "date")
    assert one(spark, cal.day_of_week(day)) == 5
    assert one(spark, cal.is_weekend(day)) == 1
    assert one(spark, cal.season_factor(day)) == pytest.approx(1.1 * 1.35)


@pytest.mark.parametrize("e,expected", [(None, -1.0), (math.nan, -1.0), (-9.0, -5.0), (0.4, -0.1), (-2.0, -2.0)])
def test_clamp_elasticity(spark, e, expected):
    assert one(spark, demand.clamp_elasticity(lit(e))) == expected


def test_demand_without_base_price_is_the_level(spark):
    for base in (0.0, None):
        assert one(spark, demand.rounded_demand(lit(5), lit(base), lit(8.4), lit(-1))) == 8.0


def test_demand_is_never_negative(spark):
    assert one(spark, demand.rounded_demand(lit(100), lit(10), lit(50), lit(-5))) == 0.0


@pytest.mark.parametrize("cost,base,e", [(4.0, 10.0, -0.1), (4.0, 10.0, -1.7), (4.0, 10.0, -5.0), (9.9, 10.0, -3.0), (20.0, 10.0, -2.0)])
def test_best_price_beats_a_fine_grid(spark, cost, base, e):
    low, high = cost * 1.05, base * 1.5
    high = low * 1.2 if low >= high else high
    best = one(spark, demand.best_price(lit(cost), lit(base), lit(e)))
    assert low - 1e-9 <= best <= high + 1e-9

    def gain(p):
        return (p - cost) * (1 + e * (p - base) / base)

    grid = max(gain(low + (high - low) * i / 5000) for i in range(5001))
    assert gain(best) >= grid - 1e-9


def test_rule_sentence_for_expiry_rows(spark):
    usual = one(spark, text.rule_sentence(lit(-5.25), lit(12.5), lit(9.0)))
    assert usual == "New price $9.00 (-5.3%): adds an estimated $12.50 a week." or usual == "New price $9.00 (-5.2%): adds an estimated $12.50 a week."
    assert "expiry" in one(spark, text.rule_sentence(lit(-5.0), lit(None), lit(9.0)))


def test_json_object_in_a_reply(spark):
    for reply, body in {"```json\n{\"a\": {}}\n```": '{"a": {}}', "Sure: {x} ok": "{x}", "none": None, "[{}]": None, "}{": None}.items():
        assert one(spark, text.json_object(lit(reply, "string"))) == body


def test_small_means_keep_their_digits(spark):
    df = spark.createDataFrame([(1e-9,), (3e-9,), (None,)], "v double")
    assert df.agg(numeric.stable_mean("v")).first()[0] == pytest.approx(2e-9, rel=1e-8)
